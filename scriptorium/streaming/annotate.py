"""Streaming annotation: sentence splitting, patterns and gazetteer are row-local, so they run on a stream unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import candidates, segment


def stream_candidates(spark: SparkSession, path: str, schema: str = "id string, text string") -> DataFrame:
    """Candidates of JSON records as they arrive in a folder; write with writeStream in append mode."""
    records = spark.readStream.schema(schema).json(path)
    rows = segment.sentences(records.select("id", "text")).select("sid", F.col("text"))
    return candidates.pattern_candidates(rows).unionByName(candidates.seed_candidates(rows, candidates.seed_terms(spark)))
