"""From raw documents to packed training sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import decontam, fm_classifier, line_dedup, near_copies, packing
from scriptorium.llm.common import stage, unused
from scriptorium.llm.queries import vocabulary
from scriptorium.session import ship

#: Texts that share this part of their distinct 5-word shingles (Jaccard) are near copies.
NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the texts of at most fm_classifier.SAMPLE labelled doc_ids.

    Null and empty texts are scored like any other; repeated rows and null doc_ids are kept or go by their text.
    """
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fm_classifier.fit(docs, fm_classifier.marks_of(labels))
    (score,) = unused(docs, "score")
    return fm_classifier.score(docs, model, score).where(F.col(score) >= 0.5).drop(score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from texts; a document that loses all its lines goes.

    Null, empty and wordless texts stay as they are. Of repeated rows the first stays, if it has 50 words or more the others go.
    """
    ship(spark)
    clash = [c for c in docs.columns if c.lower() in ("n_lines", "n_removed", "removed", "left")]
    names = dict(zip(clash, unused(docs, *clash)))
    out = line_dedup.dedup_lines(docs.withColumnsRenamed(names)).where("left IS NULL OR left > 0")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop("n_lines", "n_removed", "removed", "left").withColumnsRenamed({b: a for a, b in names.items()}).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id (nulls first) stays, once; null and empty texts are copies."""
    return near_copies.thinned(ship(spark) and docs, NEAR_WORDS, NEAR_SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, with all rows of their doc_id. Texts without words hold none."""
    ship(spark)
    found = decontam.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    (d,) = unused(docs, "d")
    bad = stage(found.select(F.col("doc_id").alias(d)).distinct(), "leaking")
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(d)), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids; null and empty texts are one end id, repeated rows separate documents."""
    ship(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=2, length=1024)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("decontaminate", decontaminate), ("pack", pack)]

#: No stage but the joins is expressible in SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
