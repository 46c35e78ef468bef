"""Operator 9: repeated line runs by a suffix array over line ids, built by distributed prefix doubling.

Lines with a word get ids by rank of a 128-bit content key. Round k ranks every position by the pair
(rank of the 2^k lines from it, rank of the 2^k lines after those): sorted pairs, hence the order of
the suffixes to that depth. Only positions whose rank is shared go on; a unique suffix stays unique.
A run counts from `min_words` words on, so a run's shortest cores have at most `min_words` lines, and
doubling stops at that depth, whatever the corpus.

Equal ranks at a depth are a longest-common-prefix interval of the suffix array. For each position the
shortest run of `min_words` words that starts there, and the one that ends there, is named by two
overlapping ranks; suffixes with one name form the interval of that depth. The first member in
document order stays and all later members' lines are deleted. Every line of a maximal repeated run
lies in such a core, so exactly the later copies of maximal runs go. A run that overlaps its own
copy loses the lines of the later one: of a long line four times over, the first stays.

Lines without a word are not part of the sequence; they stay, but a document all of whose worded lines
go is left empty. Null text has no line and stays null. Documents are ordered by doc_id (nulls first),
tied ones in the order of reading; repeated rows are later copies. Extra columns pass through, except
that those named like an output column are replaced. An empty table stays empty.

Texts are read three times in place (line hashes, then rows to change and rows to leave) and not
staged; only rows that a sieve of changed documents holds back are shuffled with their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, hold, release_shuffles, sieve, stage, text_hash, unstage, unused, word_array

MIN_WORDS = 50
#: Rows of an Arrow batch.
BATCH_ROWS = 50_000
_SEQUENCE = "uid long, doc_id {}, th long, i int, stop int, begin int, h1 long, h2 long"


def _sequence(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per worded line: uid of its document, place i in the sequence, 128-bit key, last line (stop) of the shortest run of
    min_words words from here, and first line (begin) of the one that ends here where no line starts that very run. Row-local."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hold("lines")
        uid = TaskContext.get().partitionId() << 33
        keys, names = [], ["uid", "doc_id", "th", "i", "stop", "begin", "h1", "h2"]
        found: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            each = [len(f[0]) for f in found]
            ids = pa.array([k[0] for k in keys], kind).take(pa.array(np.repeat(np.arange(len(keys)), each)))
            spread = lambda j: pa.array(np.repeat(np.array([k[j] for k in keys], np.int64), each))
            i, stop, begin, h = (np.concatenate(x) for x in zip(*found))
            optional = lambda x: pa.array(x.astype(np.int32), mask=x < 0)
            out = pa.RecordBatch.from_arrays([spread(2), ids, spread(1), pa.array(i.astype(np.int32)), optional(stop), optional(begin),
                                              pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1]))], names=names)
            keys.clear(), found.clear()
            return out

        for batch in batches:
            kind = batch.column(0).type
            for doc_id, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                uid += 1
                lines = text.encode("utf-8").split(b"\n") if text else []
                counts = [len(x.split()) for x in lines]  # bytes know ASCII white space only
                w = np.array([c for c in counts if c], np.int64)
                if not len(w):
                    continue
                digests = b"".join([xxhash.xxh3_128_digest(x) for x, c in zip(lines, counts) if c])
                upto = np.cumsum(w)
                before, n = upto - w, np.arange(len(w))
                stop = np.searchsorted(upto, before + min_words)
                stop[stop == len(w)] = -1
                begin = np.searchsorted(before, upto - min_words, side="right") - 1
                begin[(begin >= 0) & (stop[begin] == n)] = -1
                keys.append((doc_id, th, uid))
                found.append((n, stop, begin, np.frombuffer(digests, "<i8").reshape(-1, 2)))
                rows += len(w)
                if rows >= BATCH_ROWS:
                    yield flush(kind)
                    rows = 0
        if found:
            yield flush(kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_hash().alias("th"), "text").mapInArrow(make, _SEQUENCE.format(kind))


def _rank(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """rows of shared keys with a column r: an id that grows with the sorted keys."""
    shared = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    ids = stage(shared.select(*keys).sort(*keys).withColumn("r", F.monotonically_increasing_id()), f"{label}-ids")
    out = stage(rows.join(ids, keys).select("uid", "i", "r"), label)
    unstage(ids)
    return out


def later_copies(seq: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(uid, doc_id, th, gone): places of deleted lines among the worded lines of a document. seq: a staged sequence."""
    where = ["uid", "doc_id", "th"]
    cores = seq.where("stop IS NOT NULL").select(*where, F.col("i").alias("a"), (F.col("stop") - F.col("i") + 1).alias("len")).union(
        seq.where("begin IS NOT NULL").select(*where, F.col("begin").alias("a"), (F.col("i") - F.col("begin") + 1).alias("len")))
    cores = cores.withColumn("level", (F.length(F.bin("len")) - 1).cast("int"))
    rank = _rank(seq.select("uid", "i", "h1", "h2"), ["h1", "h2"], "line-rank")
    named = []
    level = 0
    while True:
        due = cores.where(F.col("level") == level)
        step = 1 << level
        found = (
            due.withColumn("b", F.col("a") + F.col("len") - step)
            .join(rank.select("uid", F.col("i").alias("a"), F.col("r").alias("ra")), ["uid", "a"])
            .join(rank.select("uid", F.col("i").alias("b"), F.col("r").alias("rb")), ["uid", "b"]))
        named.append(stage(found.select(*where, "a", "len", "ra", "rb"), "line-named"))
        if step * 2 > min_words:
            break
        pairs = rank.join(rank.select("uid", (F.col("i") - step).alias("i"), F.col("r").alias("r2")), ["uid", "i"])
        following = _rank(pairs.withColumnRenamed("r", "r1"), ["r1", "r2"], "line-rank")
        unstage(rank)
        rank, level = following, level + 1
    unstage(rank)
    every = named[0]
    for x in named[1:]:
        every = every.union(x)
    key = F.struct("doc_id", "uid", "a")
    # written first: then both sides of the join are plain exchanges, and one hot name can be split
    first = stage(every.groupBy("len", "ra", "rb").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "line-first")
    later = every.join(first, ["len", "ra", "rb"]).where(key > F.col("first"))
    places = later.select(*where, F.explode(F.sequence(F.col("a"), F.col("a") + F.col("len") - 1)).alias("i"))
    gone = stage(places.groupBy(*where).agg(F.sort_array(F.collect_set("i")).alias("gone")), "line-gone")
    unstage(first, *named)
    return gone


def _rewritten(docs: DataFrame, gone: str, whole: str, min_words: int) -> DataFrame:
    """The output columns; gone: array of places, whole: whether the row repeats another one, so that all its runs go."""
    parts, worded, drop = unused(docs, "parts", "worded", "drop")
    rows = docs.withColumn(parts, F.split("text", "\n", -1))
    has_word = lambda s: s.rlike(f"[^{SPACE}]")
    at = F.filter(F.transform(parts, lambda s, k: F.when(has_word(s), k)), lambda k: k.isNotNull())
    rows = rows.withColumn(worded, F.coalesce(at, F.array().cast("array<int>")))
    long = F.col(whole) & (F.size(word_array(F.col("text"))) >= min_words)
    mine = F.transform(gone, lambda i: F.get(F.col(worded), i))
    rows = rows.withColumn(drop, F.when(long, F.col(worded)).otherwise(F.coalesce(mine, F.array().cast("array<int>"))))
    left = F.size(F.array_except(worded, drop)).cast("long")
    none = F.size(drop) == 0
    kept = F.transform(F.array_except(F.transform(parts, lambda s, k: k), drop), lambda k: F.get(F.col(parts), k))
    text = F.when(none, F.col("text")).when(left == 0, F.lit("")).otherwise(F.array_join(kept, "\n"))
    return rows.select(
        *[text.alias("text") if c == "text" else F.col(c) for c in docs.columns if c not in (gone, whole)],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"), F.size(drop).cast("long").alias("n_removed"),
        F.col(drop).alias("removed"), F.when(~none, left).alias("left"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with text rewritten, plus n_lines, n_removed, removed (line numbers from 0) and left (worded lines kept)."""
    docs = docs.drop("n_lines", "n_removed", "removed", "left")
    seq = stage(_sequence(docs, min_words), "line-seq")
    gone = later_copies(seq, min_words)
    # repeated rows (doc_id and text): the sequence of the first stands for all; the others are whole copies
    again = seq.where("i = 0").groupBy("doc_id", "th").agg(F.min("uid").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = stage(again, "line-again")
    unstage(seq)
    h, whole, places, d, t = unused(docs, "h", "whole", "gone", "d", "t")
    repeated = again.limit(1).count() > 0
    if repeated:
        own = again.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "first")
        gone = gone.join(own, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left").where("first IS NULL OR uid = first")
    gone = gone.select(F.col("doc_id").alias(d), F.col("th").alias(t), F.col("gone").alias(places))
    release_shuffles(docs.sparkSession)
    keyed = docs.withColumn(h, text_hash()).withColumn(whole, F.lit(False))
    held = sieve(gone.select(F.col(t).alias("th")).union(again.select("th")), "th")
    same = F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(h) == F.col(t))
    rest = keyed.where(~held(F.col(h))).withColumn(places, F.lit(None).cast("array<int>"))
    touched = keyed.where(held(F.col(h)))
    if repeated:
        keys = again.select(F.col("doc_id").alias(d), F.col("th").alias(t))
        copies = touched.join(keys, same, "left_semi").groupBy(*[F.col(c) for c in keyed.columns]).agg(F.count("*").alias(places))
        order = Window.partitionBy("doc_id", h).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
        copies = copies.withColumn(d, F.row_number().over(order)).withColumn(t, F.explode(F.sequence(F.lit(1), F.col(places))))
        copies = copies.withColumn(whole, (F.col(d) > 1) | (F.col(t) > 1)).select(*keyed.columns)
        touched = touched.join(keys, same, "left_anti").unionByName(copies)
    touched = touched.join(gone, same, "left").select(*keyed.columns, places)
    return _rewritten(touched.unionByName(rest).drop(h), places, whole, min_words)
