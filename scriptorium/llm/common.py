"""Shared plumbing: staging tables, files on shared storage, let-binding, components."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch

#: ASCII white space that separates words.
SPACE = "\\x20\\x09-\\x0D"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder all executors share (spark.checkpoint.dir); an error on a cluster that names none."""
    return scratch(spark, label)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and fixes nondeterministic columns."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(*frames: DataFrame | None) -> None:
    """Delete staged tables that no live plan reads any more."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path:
            remove(df.sparkSession, path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished stages: its cleaner waits for collected references."""
    import gc
    import time

    for _ in range(2):  # the first pass lets go of Python's handles, the second of what they held
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


#: By owner: how to drop what it keeps in this process after a task.
_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, drop: Callable[[], None] | None = None) -> None:
    """What outlives a task, such as word caches, belongs to one owner at a time in a process: Spark hands workers from stage to
    stage, so the next owner drops what others kept and gives the memory back to the system."""
    others = [x for x in _HELD if x != owner]
    if drop:
        _HELD[owner] = drop
    if others:
        import ctypes
        import gc

        import pyarrow as pa

        for x in others:
            _HELD.pop(x)()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)


def hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def open_fs(uri: str):
    """(filesystem, path) for a URI, usable inside executor tasks."""
    from pyarrow import fs as pafs

    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


#: Bits of a sieve: 8 MB, whatever it holds.
SIEVE_BITS = 1 << 26


def sieve(keys: DataFrame, name: str):
    """A test on columns of longs that holds for every value of keys[name] and for few others.

    A bitset of fixed size, built from per-range bitmaps and broadcast: rows that fail it need not be
    shuffled to be joined with keys. Beyond its size more rows pass, and the join still decides.
    """
    spark = keys.sparkSession
    at = keys.where(F.col(name).isNotNull()).select((F.pmod(F.col(name), F.lit(SIEVE_BITS)) + 1).alias("p"))  # bitmaps count from 1
    maps = at.groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    each = 32_768  # bits per bitmap
    bits = np.zeros(SIEVE_BITS // 8, np.uint8)
    for r in maps.toLocalIterator():  # at most SIEVE_BITS / 32768 bitmaps of 4 KB
        k = (r["b"] - 1) * each // 8
        bits[k : k + each // 8] = np.frombuffer(bytes(r["m"]), np.uint8)
    held = spark.sparkContext.broadcast(bits.tobytes())
    size = SIEVE_BITS

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        own = np.frombuffer(held.value, np.uint8)
        p = values.to_numpy().astype(np.int64) % size
        return pd.Series((own[p >> 3] >> (p & 7)).astype(np.uint8) & 1 == 1)

    return test


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of df has them."""
    own, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in own:
            n = "_" + n
        own.add(n.lower())
        out.append(n)
    return out


def text_hash(column: str = "text") -> Column:
    """Null and empty texts alike."""
    return F.xxhash64(F.coalesce(column, F.lit("")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs less the rows whose doc_id and text hash are in gone(doc_id, th); only rows that a sieve holds back are joined."""
    h, d, t = unused(docs, "h", "d", "t")
    keyed = docs.withColumn(h, text_hash())
    held = sieve(gone, "th")
    gone = gone.select(F.col("doc_id").alias(d), F.col("th").alias(t)).distinct()
    left = keyed.where(held(F.col(h))).join(gone, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(h) == F.col(t)), "left_anti")
    return keyed.where(~held(F.col(h))).unionByName(left).select(*docs.columns)


def let(value: Column, body) -> Column:
    """Evaluate value once and use it several times inside body (a one-element transform)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_array(text: Column) -> Column:
    """Words of `[^\\x20\\x09-\\x0D]+`; null text gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def byte_words(text: str | None) -> list[bytes]:
    """The same words as UTF-8 bytes, A-Z lower-cased: bytes.split() and bytes.lower() know ASCII only."""
    return text.encode("utf-8").lower().split() if text else []


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge list; component is the smallest node reachable.

    Contraction: each round every node points at its smallest neighbour if that is smaller, edges are
    relabelled and thinned to distinct ones; labels compose. Nodes that still have edges at least halve
    within two rounds, so rounds are logarithmic. All tables stay distributed and are staged per round.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    live = stage(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    labels = stage(live.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct(), "cc-labels")
    while live.limit(1).count():
        up = live.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("p"))
        parent = stage(up, "cc-parent")
        new_live = stage(
            live.join(parent, "u").select(F.col("p").alias("pu"), F.col("v"))
            .join(parent.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v")
            .where("pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "cc-edges")
        new_labels = stage(
            labels.join(parent.select(F.col("u").alias("component"), "p"), "component", "left")
            .select("node", F.coalesce("p", "component").alias("component")), "cc-labels")
        unstage(live, labels, parent)
        live, labels = new_live, new_labels
    unstage(live)
    return labels
