"""From raw lines to records: headings carried forward, audit, statistics, guards.

Lines come as (file, line_no, line). Windows partition by file, as a heading governs what follows it in its
file; they carry structural columns, and what reads the line text is found before them, where the line is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files, line numbers from 1; any newline convention."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    body = F.regexp_replace("value", "\r\n|\r", "\n")
    # a final newline ends the last line, it does not start another
    parts = F.split(F.regexp_replace(body, "\n$", ""), "\n", -1)
    return whole.where("value <> ''").select("file", F.posexplode(parts).alias("n", "line")).select(
        F.url_decode("file").alias("file"), (F.col("n") + 1).alias("line_no"), "line")


def works(spark: SparkSession) -> DataFrame:
    """The work dimension: eight rows."""
    return spark.createDataFrame(rules.WORKS, "file string, title string, title_vi string, period string, genre string, work_id string")


def with_works(lines: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left join on the file name; an unknown file gets its stem as title."""
    known = F.broadcast(dimension.select("file", "title", "title_vi", "period", "genre"))  # one row per work, listed in rules
    stem = F.regexp_replace("file", "(_full)?\\.txt$", "")
    return lines.join(known, "file", "left").withColumn("title", F.coalesce("title", stem))


def structure(lines: DataFrame) -> DataFrame:
    """Adds kind (volume, section, empty_heading, line), volume and section in force, the audit, whether a record, characters of the
    text and a preview of a line that may go. A caller that does not take `line` moves no texts."""
    order = Window.partitionBy("file").orderBy("line_no")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    title = F.col("title") if "title" in lines.columns else F.lit(None).cast("string")
    heading = F.when(T.is_heading(F.col("line")), T.heading_text(F.col("line")))
    df = lines.withColumn("heading", heading).withColumn("vol", T.volume(F.col("heading")))
    kind = (F.when(F.col("heading").isNull(), "line").when(F.col("vol").isNotNull(), "volume")
            .when(F.col("heading") != "", "section").otherwise("empty_heading"))
    df = df.withColumn("kind", kind).withColumn("audit", T.audit(F.col("line"))).withColumn("is_title", F.coalesce(T.strip(F.col("line")) == title, F.lit(False)))
    stays = (F.col("kind") == "line") & (F.col("audit.decision") != "drop")
    may_go = (F.col("kind") == "line") & (~stays | F.col("is_title"))
    df = df.withColumn("stays", stays).withColumn("preview", F.when(may_go, F.substring("line", 1, 80))).withColumn("characters", F.length(T.normalize(F.col("line"))))
    stays, is_title = F.col("stays"), F.col("is_title")
    df = df.withColumn("volume", F.last("vol", ignorenulls=True).over(so_far))
    # a volume heading resets the section, an empty heading changes nothing
    mark = F.when(F.col("kind") == "volume", F.struct(F.lit(None).cast("string").alias("s"))).when(
        F.col("kind") == "section", F.struct(F.col("heading").alias("s")))
    df = df.withColumn("section", F.last(mark, ignorenulls=True).over(so_far)["s"])
    first = F.min(F.when(stays & ~is_title, F.col("line_no"))).over(Window.partitionBy("file"))
    dropped_title = stays & is_title & (first.isNull() | (F.col("line_no") < first))
    reason = F.when(F.col("kind") != "line", "heading").when(dropped_title, "work_title").when(
        F.col("audit.decision") == "drop", F.col("audit.reasons")[0])
    df = df.withColumn("removed", reason)
    # a heading event repeats only right after a heading that set the same volume
    before_kind = F.lag("kind").over(order)
    before_vol = F.last("vol", ignorenulls=True).over(earlier)
    same = before_kind.isin("volume", "section") & (before_vol["number"] == F.col("vol.number")) & (before_vol["part"] == F.col("vol.part"))
    return df.withColumn("event", (F.col("kind") == "volume") & ~F.coalesce(same, F.lit(False)))


def records(structured: DataFrame) -> DataFrame:
    """Kept lines as records with ids per file."""
    kept = structured.where("removed IS NULL")
    number = F.row_number().over(Window.partitionBy("file").orderBy("line_no"))
    stem = F.regexp_replace("file", "\\.txt$", "")
    base = [c for c in ("title", "title_vi", "period", "genre") if c in structured.columns]
    return kept.select(
        F.format_string("%s-%06d", stem, number).alias("id"), *base, "file", "line_no", T.normalize(F.col("line")).alias("text"), "section",
        F.col("volume.raw").alias("volume_raw"), T.volume_id(F.col("volume.number"), F.col("volume.part")).alias("volume_id"),
        F.col("volume.number").alias("volume_number"), F.col("volume.part").alias("volume_part"),
        F.when(F.col("audit.decision") == "needs_review", "needs_review").otherwise("kept").alias("cleaning_status"),
        F.col("audit.reasons").alias("cleaning_reasons"))


def audit_rows(structured: DataFrame) -> DataFrame:
    """One row per dropped line."""
    return structured.where("kind = 'line' AND removed IS NOT NULL").select(
        "file", "line_no", F.lit("drop").alias("decision"), F.col("removed").alias("reason"), F.col("preview").alias("raw_preview"))


def removed_counts(structured: DataFrame) -> DataFrame:
    return structured.where("removed IS NOT NULL").groupBy("file", F.col("removed").alias("reason")).agg(F.count("*").alias("lines"))


def work_statistics(structured: DataFrame) -> DataFrame:
    kept = F.col("removed").isNull()
    return structured.groupBy("file").agg(
        F.count(F.when(kept, 1)).alias("records"),
        F.coalesce(F.sum(F.when(kept, F.col("characters"))), F.lit(0)).alias("characters"),
        F.count(F.when((F.col("kind") == "line") & ~kept, 1)).alias("audit_decisions"),
        F.count(F.when(F.col("event"), 1)).alias("heading_events"))


def repeated_headings(structured: DataFrame) -> DataFrame:
    """Volume keys that more than one heading event of a file sets."""
    return structured.where("event").groupBy("file", F.col("vol.number").alias("number"), F.col("vol.part").alias("part")).agg(
        F.count("*").alias("events")).where("events > 1")


def clashing_paths(volumes: DataFrame) -> DataFrame:
    """Output ids that stand for several volumes of (number, part)."""
    return volumes.select(T.volume_id(F.col("number"), F.col("part")).alias("path"), "number", "part").distinct().groupBy("path").agg(
        F.count("*").alias("volumes")).where("volumes > 1")
