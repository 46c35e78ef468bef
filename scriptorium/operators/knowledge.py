"""Reference knowledge: persons, aliases and era names to name tables and surfaces; manifests."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T


def require_columns(df: DataFrame, names: list[str], table: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")


def sqlite_tables(path: str) -> dict[str, list[str]]:
    """Tables and their columns, read-only."""
    import sqlite3
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        names = [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type IN ('table', 'view') ORDER BY name")]
        quote = lambda n: '"' + n.replace('"', '""') + '"'
        return {n: [r[1] for r in db.execute(f"PRAGMA table_info({quote(n)})")] for n in names}


def sqlite_frame(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """A table of a SQLite file (a single-machine source), its missing columns null."""
    import sqlite3
    have = sqlite_tables(path).get(table)
    if have is None:
        raise ValueError(f"no table {table}")
    names = [part.split()[0] for part in schema.split(",")]
    columns = ", ".join(f'"{n}"' if n in have else f'NULL AS "{n}"' for n in names)
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        return spark.createDataFrame(db.execute(f'SELECT {columns} FROM "{table}"').fetchall(), schema)


def clean_persons(persons: DataFrame, low: int = 2, high: int = 6) -> DataFrame:
    """persons(person_id, name, surname, dynasty, birth, death) with usable names, in normal form C."""
    return persons.withColumn("primary_name", T.person_name(T.nfc(F.col("name")), low, high)).where("primary_name IS NOT NULL").drop("name")


def era_surfaces(eras: DataFrame, low: int = 2, high: int = 6) -> DataFrame:
    """Era names and dynasty plus era, as surfaces that are no persons. eras(dynasty, era)."""
    both = eras.select(T.person_name(T.nfc(F.col("era")), low, high).alias("name")).union(
        eras.select(T.person_name(T.nfc(F.concat("dynasty", "era")), low, high).alias("name")))
    return both.where("name IS NOT NULL").distinct()


def build_names(persons: DataFrame, aliases: DataFrame | None, eras: DataFrame, low: int = 2, high: int = 6) -> tuple[DataFrame, DataFrame]:
    """(names(name, person_id, kind), counts) from persons, aliases(person_id, alias[, type]) and eras.

    A person whose name is an era's is no person: it is counted as blocked, and its aliases do not count. Aliases without a
    type column are all allowed; without a table there are none.
    """
    usable = clean_persons(persons, low, high)
    blocked = era_surfaces(eras, low, high).withColumn("blocked", F.lit(True))
    marked = usable.join(blocked.withColumnRenamed("name", "primary_name"), "primary_name", "left")
    kept = marked.where("blocked IS NULL").drop("blocked")
    primary = kept.select(F.col("primary_name").alias("name"), "person_id", F.lit("primary").alias("kind"))
    if aliases is None:
        aliases = persons.sparkSession.createDataFrame([], f"person_id {persons.schema['person_id'].dataType.simpleString()}, alias string")
    allowed = aliases.where(F.col("type").isin(*rules.PERSONAL_ALIAS_TYPES)) if "type" in aliases.columns else aliases
    named = allowed.join(kept.select("person_id").distinct(), "person_id", "left_semi").select(
        T.person_name(T.nfc(F.col("alias")), low, high).alias("name"), "person_id", F.lit("alias").alias("kind")).where("name IS NOT NULL").join(blocked, "name", "left")
    also = named.where("blocked IS NULL").drop("blocked").distinct()
    names = primary.unionByName(also).distinct()
    counts = None
    for df, what, name in (
            (persons, "count(*)", "person_total"), (kept, "count(*)", "person_kept"), (kept, "count(*)", "primary_names"), (aliases, "count(*)", "alias_total"),
            (allowed, "count(*)", "alias_allowed_type"), (also, "count(*)", "alias_names"), (names, "count(distinct name)", "unique_names"),
            (marked.where("blocked").select("blocked").unionByName(named.where("blocked").select("blocked")), "count(*)", "blocked_nonperson")):
        one = df.agg(F.expr(what).alias(name))
        counts = one if counts is None else counts.crossJoin(one)  # one row each
    return names, counts


def surfaces(names: DataFrame, persons: DataFrame, max_people: int = 10) -> DataFrame:
    """name, people (sorted distinct person and dynasty), kinds; names that more than max_people share are left out."""
    joined = names.join(persons.select("person_id", "dynasty"), "person_id")
    return joined.groupBy("name").agg(
        F.array_sort(F.collect_set(F.struct("person_id", "dynasty"))).alias("people"),
        F.array_sort(F.collect_set("kind")).alias("kinds")).where(F.size("people") <= max_people)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """places(place_id, name, begin, end, type, parent) from CSV in any known header; rows without whole years are skipped."""
    raw = spark.read.option("header", True).csv(path)
    by_upper = {c.upper(): c for c in raw.columns}
    for names in rules.PLACE_HEADERS:
        if all(n.upper() in by_upper for n in names):
            own = [F.col(f"`{by_upper[n.upper()]}`") for n in names]
            df = raw.select(*[c.alias(a) for c, a in zip(own, ("place_id", "name", "begin", "end", "type", "parent"))])
            whole = lambda c: T.strip(F.col(c)).try_cast("int")
            return df.withColumn("begin", whole("begin")).withColumn("end", whole("end")).where("begin IS NOT NULL AND `end` IS NOT NULL")
    raise ValueError(f"unknown place header: {raw.columns}")


def write_table(df: DataFrame, path: str, name: str, version: str, licence: str, source_url: str | None = None) -> dict:
    """A knowledge table as Parquet, with a manifest of its files' digests beside it. Digests are taken by the executors."""
    df.write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    body = {"name": name, "version": version, "source_url": source_url, "license": licence, "files": table_digests(spark, path),
            "row_counts": {name: spark.read.parquet(path).count()}}
    spark.createDataFrame([(json.dumps(body, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path + ".manifest")
    return body


def table_digests(spark: SparkSession, path: str) -> dict[str, str]:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    got = files.select(F.element_at(F.split("path", "/"), -1).alias("f"), F.sha2("content", 256).alias("h")).collect()  # one row per file
    return {r["f"]: r["h"] for r in sorted(got)}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table that write_table wrote; one that differs from its manifest is an error."""
    body = json.loads(spark.read.text(path + ".manifest").first()[0])
    if body["files"] != table_digests(spark, path):
        raise ValueError(f"{path} differs from its manifest")
    return spark.read.parquet(path)


def file_digest(path: str) -> tuple[str, int]:
    h, size = hashlib.sha256(), 0
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
            size += len(block)
    return h.hexdigest(), size


def write_manifest(path: str, name: str, version: str, licence: str, row_counts: dict[str, int], source_url: str | None = None) -> dict:
    """Manifest beside a file: no time stamp, keys in order, so equal inputs give equal bytes."""
    sha, size = file_digest(path)
    body = {"name": name, "version": version, "source_url": source_url, "license": licence, "file_sha256": sha, "file_size": size, "row_counts": row_counts}
    Path(path + ".manifest.json").write_text(json.dumps(body, ensure_ascii=False, indent=2, sort_keys=True) + "\n", "utf-8")
    return body


def check_manifest(path: str) -> dict:
    body = json.loads(Path(path + ".manifest.json").read_text("utf-8"))
    if (body["file_sha256"], body["file_size"]) != file_digest(path):
        raise ValueError(f"{path} differs from its manifest")
    return body


def write_seeds(path: str, entries: list[tuple[str, str]], version: str, licence: str) -> dict:
    """Gazetteer as sorted JSON lines, gzip without a time."""
    import gzip
    rows = sorted(set(entries), key=lambda e: (e[1], e[0]))
    data = "".join(json.dumps({"term": t, "label": x, "alias": None}, ensure_ascii=False) + "\n" for t, x in rows).encode()
    with open(path, "wb") as raw, gzip.GzipFile(fileobj=raw, mode="wb", filename="", mtime=0) as f:
        f.write(data)
    counts: dict[str, int] = {}
    for _, x in rows:
        counts[x] = counts.get(x, 0) + 1
    return write_manifest(path, "seed", version, licence, counts)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    check_manifest(path)
    return spark.read.schema("term string, label string, alias string").json(path)
