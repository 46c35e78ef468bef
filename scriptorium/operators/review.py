"""Human review round trip: export sentences with relative spans, import decisions by sentence id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,label:string>>"


def to_review(annotated: DataFrame) -> DataFrame:
    """id, data, label [[start, end, name]] with offsets in the sentence; rows without an id are left out."""
    label = F.transform("entities", lambda e: F.array(
        (e["start"] - F.col("start")).cast("string"), (e["end"] - F.col("start")).cast("string"), e["label"]))
    return annotated.where("sid IS NOT NULL").select(F.col("sid").alias("id"), F.col("text").alias("data"), label.alias("label"))


def read_review(raw: DataFrame) -> DataFrame:
    """sid, reviewed text, spans from id, data or text, label; labels with fewer than three parts are skipped."""
    body = F.coalesce(*[F.col(c) for c in ("data", "text") if c in raw.columns])
    spans = F.transform(F.filter(F.coalesce("label", F.array().cast("array<array<string>>")), lambda x: F.size(x) >= 3),
                        lambda x: F.struct(x[0].cast("int").alias("start"), x[1].cast("int").alias("end"), x[2].alias("label")))
    return raw.select(F.col("id").alias("sid"), body.alias("reviewed"), F.array_sort(spans).alias("spans"))


def review_problems(review: DataFrame) -> DataFrame:
    """Fatal ones: missing ids, repeated ids, spans out of bounds."""
    missing = review.where("sid IS NULL").select("sid", F.lit("missing_id").alias("code"))
    again = review.groupBy("sid").agg(F.count("*").alias("n")).where("n > 1 AND sid IS NOT NULL").select("sid", F.lit("duplicate_id").alias("code"))
    out = F.exists("spans", lambda s: (s["start"] < 0) | (s["end"] > F.length("reviewed")) | (s["start"] >= s["end"]))
    return missing.union(again).union(review.where(out).select("sid", F.lit("invalid_span").alias("code")))


def apply_review(annotated: DataFrame, review: DataFrame, annotator: str = "human", gold_version: str = "1") -> DataFrame:
    """annotated(sid, start, text, entities, conflicts) with reviewed spans in place; joined by id alone.

    status: checked, text_mismatch or missing. A sentence is added when only the review has spans, removed when only the corpus
    has, and else updated when their number differs, or a label where both sides are paired in order of start. An empty
    reviewed text is not compared.
    """
    old = F.array_sort(F.transform("entities", lambda e: F.struct(
        (e["start"] - F.col("start")).alias("start"), (e["end"] - F.col("start")).alias("end"), e["label"].alias("label"))))
    df = annotated.withColumn("__old", old).join(review.select(F.col("sid").alias("__s"), "reviewed", "spans"), F.col("sid") == F.col("__s"), "left")
    status = F.when(F.col("__s").isNull(), "missing").when((F.col("reviewed") != "") & (F.col("reviewed") != F.col("text")), "text_mismatch").otherwise("checked")
    df = df.withColumn("status", status)
    ok = F.col("status") == "checked"
    had, has = F.size("__old") > 0, F.size("spans") > 0
    differs = had & has & ((F.size("spans") != F.size("__old")) | F.exists(F.zip_with("spans", "__old", lambda a, b: a["label"] != b["label"]), lambda x: F.coalesce(x, F.lit(False))))
    count = lambda c: F.when(ok, c).otherwise(F.lit(0))
    entity = lambda s, k: F.struct(
        F.concat(F.col("sid"), F.lit("-e"), (k + 1).cast("string")).alias("eid"), F.col("text").substr(s["start"] + 1, s["end"] - s["start"]).alias("text"),
        s["label"].alias("label"), (s["start"] + F.col("start")).alias("start"), (s["end"] + F.col("start")).alias("end"),
        F.array(F.lit("human")).alias("sources"), F.array(F.lit(f"annotator:{annotator}")).alias("source_ids"), F.lit(1.0).alias("priority_score"),
        F.lit("human_review").alias("method"), F.lit("checked").alias("review_status"), F.lit(annotator).alias("annotator"))
    return df.select(
        "sid", "text", "status", count((~had & has).cast("int")).alias("added"), count((had & ~has).cast("int")).alias("removed"),
        count(F.coalesce(differs, F.lit(False)).cast("int")).alias("updated"), count((F.size("spans") == 0).cast("int")).alias("checked_empty"),
        count(F.size("conflicts")).alias("resolved"), F.when(ok, F.transform("spans", entity)).alias("gold"),
        F.when(ok, F.lit(gold_version)).alias("gold_version"))


def import_review(annotated: DataFrame, review: DataFrame, strict: bool = False, annotator: str = "human", gold_version: str = "1") -> DataFrame:
    """apply_review behind its gates: problems of the review, changed texts and, if strict, missing sentences are errors."""
    for df, key in ((review_problems(review), "code"), (apply_review(annotated, review).where(
            F.col("status").isin("text_mismatch", *(["missing"] if strict else []))), "status")):
        bad = df.select("sid", F.col(key).alias("why")).limit(5).collect()
        if bad:
            raise ValueError("review cannot be imported: " + ", ".join(f"{r['sid']} {r['why']}" for r in bad))
    return apply_review(annotated, review, annotator, gold_version)


def review_statistics(applied: DataFrame) -> DataFrame:
    on = lambda s: F.count(F.when(F.col("status") == s, 1))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return applied.agg(on("checked").alias("reviewed"), on("missing").alias("missing"), on("text_mismatch").alias("text_mismatch"),
                       *[total(c) for c in ("added", "removed", "updated", "checked_empty", "resolved")])
