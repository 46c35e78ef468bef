"""Corpus-shaped views of the driver's tables, each as a DataFrame and as SQL.

The tables hold no Han text, so letters are mapped to Han characters, which makes offices, polities,
reign years and places appear. `source` plays the work, `doc_id` the volume, lines are the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATIN, HAN = "thanreodsi.,", "太守漢朝元州年唐初入。，"


def documents(spark: SparkSession, d: str) -> DataFrame:
    """A table of fewer splits than cores (one row group) is dealt out first; a large one never is."""
    docs, cores = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "source"), spark.sparkContext.defaultParallelism
    return docs.repartition(cores, "doc_id") if docs.rdd.getNumPartitions() < cores else docs


def raw_lines(spark: SparkSession, d: str) -> DataFrame:
    """file, line_no, line: a volume heading before each document, then its lines; volumes ascend within a file."""
    docs = documents(spark, d)
    body = F.concat(F.array(F.concat(F.lit("# 卷"), F.col("doc_id").cast("string"))), F.split("text", "\n", -1))
    return docs.select(F.col("source").alias("file"), "doc_id", F.posexplode(body).alias("pos", "line")).select(
        "file", (F.col("doc_id") * 1_000_000 + F.col("pos")).alias("line_no"), "line")


RAW_LINES = """
raw_lines AS (
  SELECT source AS file, doc_id * 1000000 + i AS line_no, CASE WHEN i = 0 THEN '# 卷' || doc_id ELSE parts[i] END AS line
  FROM (SELECT source, doc_id, string_split(text, chr(10)) AS parts FROM documents), unnest(range(0, len(parts) + 1)) u(i))"""


def sentences(spark: SparkSession, d: str) -> DataFrame:
    """sid, id (doc_id), idx, title (source), text in Han: the lines that are not blank."""
    return documents(spark, d).select(
        "doc_id", "source", F.posexplode(F.split(F.translate("text", LATIN, HAN), "\n", -1)).alias("pos", "text")).where("trim(text) <> ''").select(
        F.concat_ws("-", F.col("doc_id").cast("string"), F.col("pos").cast("string")).alias("sid"), F.col("doc_id").cast("string").alias("id"),
        F.col("doc_id"), F.col("pos").cast("long").alias("idx"), F.col("source").alias("title"), "text")


def records(spark: SparkSession, d: str) -> DataFrame:
    """id, text, title, sentences: the sentences of `sentences` nested by document; documents without one are left out."""
    one = lambda x, i: F.struct(
        F.concat_ws("-", F.col("doc_id").cast("string"), i.cast("string")).alias("sid"), F.lit(0).alias("start"), F.length(x).alias("end"), x.alias("text"),
        F.lit("rule").alias("method"), F.lit("auto").alias("review_status"))
    lines = F.transform(F.split(F.translate("text", LATIN, HAN), "\n", -1), one)
    return documents(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.lit("").alias("text"), F.col("source").alias("title"),
                                      F.filter(lines, lambda s: F.trim(s["text"]) != "").alias("sentences")).where("size(sentences) > 0")


SENTENCES = f"""
sentences AS (
  SELECT doc_id || '-' || (i - 1) AS sid, CAST(doc_id AS VARCHAR) AS id, doc_id, CAST(i - 1 AS BIGINT) AS idx, source AS title, parts[i] AS text
  FROM (SELECT source, doc_id, string_split(translate(text, '{LATIN}', '{HAN}'), chr(10)) AS parts FROM documents),
       unnest(range(1, len(parts) + 1)) u(i) WHERE trim(parts[i]) <> '')"""
