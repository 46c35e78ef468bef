"""Validators: each rule is a filter that emits an issue row (code, id). Reports aggregate them."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T


def _issues(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _emit(df: DataFrame, rulebook: list[tuple[str, Column]], *keep: str) -> DataFrame:
    """One row per broken rule in one pass over df."""
    codes = F.array(*[F.when(test, F.lit(code)) for code, test in rulebook])
    return df.select(*keep, F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code"))


def offset_issues(records: DataFrame, sentences: DataFrame, entities: DataFrame) -> DataFrame:
    """records(id, text), sentences(id, sid, pos, start, end, text), entities(id, eid, sentence_id, start, end, text) -> id, item, code."""
    base = records.select("id", F.col("text").alias("__t"))
    cut = lambda: F.col("__t").substr(F.col("start") + 1, F.col("end") - F.col("start"))
    s = sentences.join(base, "id")
    valid = F.coalesce((F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("__t")), F.lit(False))
    earlier = Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("__ok", valid).withColumn("__prev", F.coalesce(F.last(F.when(F.col("__ok"), F.col("end")), ignorenulls=True).over(earlier), F.lit(0)))
    gap = F.when(F.col("start") > F.col("__prev"), F.col("__t").substr(F.col("__prev") + 1, F.col("start") - F.col("__prev"))).otherwise(F.lit(""))
    first = _emit(s, [("invalid_sentence_span", ~F.col("__ok")), ("sentence_text_mismatch", F.col("__ok") & ~cut().eqNullSafe(F.col("text"))),
                      ("non_whitespace_sentence_gap", F.col("__ok") & (T.strip(gap) != ""))], "id", F.col("sid").alias("item"))
    home = sentences.select(F.col("id").alias("__i"), F.col("sid").alias("__s"), F.col("start").alias("__a"), F.col("end").alias("__b"))
    e = entities.join(base, "id").join(home, (F.col("id") == F.col("__i")) & (F.col("sentence_id") == F.col("__s")), "left")
    e = e.withColumn("__ok", valid)
    inside = F.coalesce((F.col("start") >= F.col("__a")) & (F.col("end") <= F.col("__b")), F.lit(False))
    second = _emit(e, [("invalid_entity_span", ~F.col("__ok")), ("entity_text_mismatch", F.col("__ok") & ~cut().eqNullSafe(F.col("text"))),
                       ("entity_outside_sentence", F.col("__ok") & ~inside)], "id", F.col("eid").alias("item"))
    return first.unionByName(second)


def json_issues(lines: DataFrame) -> DataFrame:
    """Lines(value) that are no JSON object, blank ones included."""
    parsed = F.try_parse_json("value")
    return lines.where(parsed.isNull() | ~F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))).select(
        F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("item"), F.lit("invalid_json").alias("code"))


def strict_issues(records: DataFrame, sentences: DataFrame, entities: DataFrame, scope: str = "full", pilot: DataFrame | None = None,
                  mapping: rules.LabelMapping | None = None) -> DataFrame:
    """Review-grade rules -> id, item, code. scope: full, pilot (sentences of pilot(sentence_id)) or final.

    Record-level rules run in scope full, and in pilot scope for records that hold a sentence of the pilot; without a pilot's
    ids, pilot scope looks at all sentences and at no record. A cleaning status other than kept or checked, or none, needs
    review. Overlaps are looked for between neighbours of one sentence, in order of start, end, label and sentence, invalid spans left out.
    """
    if scope not in ("full", "pilot", "final"):
        raise ValueError("scope is full, pilot or final")
    parts = []
    if scope == "final" and not (mapping or rules.LabelMapping()).confirmed:
        parts.append(records.sparkSession.createDataFrame([(None, None, "mapping_unconfirmed")], "id string, item string, code string"))
    inside = records
    if scope == "pilot" and pilot is not None:
        ids = pilot.select("sentence_id").distinct()
        sentences_in = sentences.join(ids.withColumnRenamed("sentence_id", "sid"), "sid", "left_semi")
        entities = entities.join(ids, "sentence_id", "left_semi")
        inside = records.join(sentences_in.select("id"), "id", "left_semi")
    else:
        sentences_in = sentences
    parts.append(_emit(sentences_in, [("unchecked_sentence", ~F.coalesce(F.col("review_status") == "checked", F.lit(False)))], "id", F.col("sid").alias("item")))
    if scope == "full" or scope == "pilot" and pilot is not None:
        clean = F.coalesce(F.col("cleaning_status").isin("kept", "checked"), F.lit(False))
        parts.append(_emit(inside, [("cleaning_needs_review", ~clean), ("unresolved_conflicts", F.col("n_conflicts") > 0)],
                           "id", F.lit(None).cast("string").alias("item")))
    base = records.select("id", F.col("text").alias("__t"))
    home = sentences.select(F.col("id").alias("__i"), F.col("sid").alias("__s"), F.col("start").alias("__a"), F.col("end").alias("__b"))
    e = entities.join(base, "id").join(home, (F.col("id") == F.col("__i")) & (F.col("sentence_id") == F.col("__s")), "left")
    ok = F.coalesce((F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("__t")), F.lit(False))
    e = e.withColumn("__ok", ok)
    cut = F.col("__t").substr(F.col("start") + 1, F.col("end") - F.col("start"))
    inside_s = F.coalesce((F.col("start") >= F.col("__a")) & (F.col("end") <= F.col("__b")), F.lit(False))
    good = F.col("__ok")
    parts.append(_emit(e, [
        ("invalid_entity_span", ~good), ("entity_text_mismatch", good & ~cut.eqNullSafe(F.col("text"))), ("entity_orphan_sentence", good & F.col("__s").isNull()),
        ("entity_outside_sentence", good & F.col("__s").isNotNull() & ~inside_s), ("invalid_internal_label", good & ~F.col("label").isin(*rules.INTERNAL_LABELS)),
        ("unchecked_entity", good & ~F.coalesce(F.col("review_status") == "checked", F.lit(False))),
        ("missing_provenance", good & (F.coalesce(F.size("sources"), F.lit(0)) <= 0))], "id", F.col("eid").alias("item")))
    order = Window.partitionBy("id").orderBy("start", "end", "label", "sentence_id", "eid")  # a record's entities
    near = e.where("__ok").select("id", "eid", "start", "sentence_id", F.lag("end").over(order).alias("__e"), F.lag("sentence_id").over(order).alias("__p"))
    parts.append(_emit(near, [("entity_overlap", F.col("__p").eqNullSafe(F.col("sentence_id")) & (F.col("__e") > F.col("start")))], "id", F.col("eid").alias("item")))
    return _issues(parts)


def compliance_issues(seg: DataFrame, ner: DataFrame, declared: int | None = None, mode: str = "draft") -> DataFrame:
    """Rules of a delivered tree -> volume, item, code. seg(volume, pos, sentence_id), ner(volume, pos, sentence_id, entities JSON strings)."""
    ids = lambda df, name: df.groupBy("volume").agg(F.array_sort(F.collect_list(F.struct("pos", "sentence_id")))["sentence_id"].alias(name))
    both = ids(seg, "a").join(ids(ner, "b"), "volume", "full_outer")
    none = F.lit(None).cast("string")
    parts = [_emit(both, [("folder_file_pairing", F.col("a").isNull() | F.col("b").isNull()),
                          ("seg_ner_mismatch", F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))], "volume", none.alias("item"))]
    seen = ner.groupBy("sentence_id").agg(F.count("*").alias("n"), F.max("volume").alias("volume")).where("n > 1")
    parts.append(seen.select("volume", F.col("sentence_id").alias("item"), F.lit("duplicate_sentence_id").alias("code")))
    if declared is not None:
        total = seg.agg(F.count("*").alias("n")).where(F.col("n") != declared)
        parts.append(total.select(none.alias("volume"), none.alias("item"), F.lit("sentence_count_mismatch").alias("code")))
    keys = F.map_keys(F.from_json("j", "map<string,string>"))
    allowed = F.array(*[F.lit(k) for k in ("end", "label", "start", "text")])
    each = ner.select("volume", "sentence_id", F.posexplode("entities").alias("k", "j")).select(
        "*", F.from_json("j", "label string, start int, end int").alias("e"), keys.alias("keys"))
    rulebook = [("invalid_label", ~F.coalesce(F.col("e.label").isin(*rules.SUBMISSION_LABELS), F.lit(False))),
                ("invalid_entity_span", ~F.coalesce((F.col("e.start") >= 0) & (F.col("e.start") < F.col("e.end")), F.lit(False)))]
    if mode == "final":
        rulebook += [("extra_provenance_fields", F.size(F.array_except("keys", allowed)) > 0), ("missing_required_field", F.size(F.array_except(allowed, F.col("keys"))) > 0)]
    parts.append(_emit(each, rulebook, "volume", F.col("sentence_id").alias("item")))
    spans = F.transform("entities", lambda j: F.from_json(j, "start int, end int"))
    crossing = F.flatten(F.transform("s", lambda x, i: F.filter(F.slice("s", i + 2, F.size("s")), lambda y: T.overlaps(x, y))))
    clash = ner.withColumn("s", spans).withColumn("n", F.size(crossing)).where("n > 0")
    parts.append(clash.select("volume", F.col("sentence_id").alias("item"), F.explode(F.array_repeat(F.lit("entity_overlap"), F.col("n"))).alias("code")))
    return _issues(parts)


def manifest_issues(spark: SparkSession, manifest: str | None, expected: int | None = None, corpus_sha256: str | None = None,
                    report_sha256: str | None = None) -> DataFrame:
    """Rules of a delivery's manifest (its text, null if there is none) -> volume, item, code."""
    codes = []
    try:
        body = json.loads(manifest) if manifest is not None else None
    except ValueError:
        body, codes = None, ["invalid_manifest_json"]
    if manifest is None:
        codes = ["missing_manifest"]
    elif body is not None:
        count = body.get("sentences", body.get("n_sentences"))
        codes = [code for code, bad in (
            ("sentence_count_mismatch", expected is not None and count != expected),
            ("source_corpus_hash_mismatch", bool(corpus_sha256) and body.get("source_corpus_sha256") != corpus_sha256),
            ("source_report_hash_mismatch", bool(report_sha256) and body.get("source_validation_report_sha256") != report_sha256)) if bad]
    return spark.createDataFrame([(None, None, c) for c in codes], "volume string, item string, code string")


def unreadable_volumes(raw: DataFrame) -> DataFrame:
    """raw(volume, value): entity files that are no JSON list -> volume, item, code."""
    parsed = F.try_parse_json("value")
    bad = parsed.isNull() | ~F.coalesce(F.schema_of_variant(parsed).startswith("ARRAY"), F.lit(False))
    return raw.where(bad).select("volume", F.lit(None).cast("string").alias("item"), F.lit("invalid_ner_json").alias("code"))


def invariant_issues(rows: DataFrame) -> DataFrame:
    """Rules of delivered rows(sentence_id, entities(label, start, end)) -> item, code: label, span, and each overlapping pair of valid spans."""
    valid = lambda e: F.coalesce((e["start"] >= 0) & (e["end"] > e["start"]), F.lit(False))
    known = lambda e: F.coalesce(e["label"].isin(*rules.SUBMISSION_LABELS), F.lit(False))
    spans = F.filter("entities", valid)
    pairs = F.flatten(F.transform(spans, lambda x, i: F.filter(F.slice(spans, i + 2, F.greatest(F.size(spans), F.lit(1))), lambda y: T.overlaps(x, y))))
    times = lambda code, n: F.array_repeat(F.lit(code), n)
    codes = F.concat(times("invalid_label", F.size(F.filter("entities", lambda e: ~known(e)))),
                     times("invalid_entity_span", F.size(F.filter("entities", lambda e: ~valid(e)))), times("entity_overlap", F.size(pairs)))
    return rows.select(F.col("sentence_id").alias("item"), F.explode(codes).alias("code"))


def raise_on(issues: DataFrame, what: str, top: int = 5) -> None:
    """An error that counts the issues and names the most frequent codes, if there is any."""
    found = report(issues).limit(top).collect()
    if found:
        total = issues.count()
        raise ValueError(f"{what}: {total} issues, most frequent: " + ", ".join(f"{r['code']} {r['issues']}" for r in found))


def report(issues: DataFrame) -> DataFrame:
    """Issues per code, most frequent first."""
    return issues.groupBy("code").agg(F.count("*").alias("issues")).orderBy(F.desc("issues"), "code")
