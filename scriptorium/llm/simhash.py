"""Operator 8: SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into `radius // 2 + 1` segments: two fingerprints within the radius then agree
on at least one segment but for one bit. The index holds each segment as it is and with each single
bit as a wildcard. Two equality joins find candidates: whole segments with each other, and variants whose
wildcard is 0 with those whose wildcard is 1, so a pair does not meet once per wildcard. The
join condition verifies the distance. Copies collapse to one distinct fingerprint before the index, and
connected components run on fingerprints, never on all documents.

Null and empty texts have no word: fingerprint zero, linked like any other. Repeated rows each give a
row. Fewer words than a shingle make one shingle. An empty table gives no rows. Other columns
are kept out of the way: only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, connected_components, stage, text_hash

WORDS, SEED, RADIUS = 3, 42, 2


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Bits set in over half of the XXH64 of the text's shingles, repeats included."""
    w = byte_words(text)
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = np.concatenate([[0], ends[:-1]])
    k = min(words, len(w))
    h = xxhash.xxh64_intdigest
    spans = zip(starts[: len(w) - k + 1].tolist(), (ends[k - 1 :] - 1).tolist())
    hashes = np.array([h(joined[a:b], SEED) for a, b in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, th (hash of the text), fp (the fingerprint's bits as a signed long); row-local, no shuffle."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = np.array([fingerprint(t, words) for t in batch["text"].tolist()], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "th": batch["th"], "fp": fp.view(np.int64)})

    keyed = docs.select("doc_id", text_hash().alias("th"), "text")
    return keyed.mapInPandas(make, "doc_id long, th long, fp long")


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in 1 to radius bits; fps has a column fp without repeats.

    Both joins are sort-merge joins: Spark takes the exploded index to be as small as the fingerprints and would broadcast it.
    """
    parts = radius // 2 + 1
    width = -(-64 // parts)
    masks = []
    for k in range(parts):
        mask = sum(1 << i for i in range(k * width, min(64, (k + 1) * width)))
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    segment = F.element_at(F.array(*[F.lit(m).cast("long") for m in masks]), F.col("s") + 1).bitwiseAND(F.col("fp"))
    same = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("s")).select("fp", "s", segment.alias("v"))
    exact = same.withColumnRenamed("fp", "a").hint("merge").join(same.withColumnRenamed("fp", "b"), ["s", "v"]).where(
        (F.col("a") < F.col("b")) & near).select("a", "b")
    bit = F.expr("shiftleft(1L, at)")
    variants = (
        fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("at"))
        .withColumn("s", F.expr(f"at div {width}").cast("int"))
        .select("fp", "at", bit.bitwiseAND(F.col("fp")).alias("bit"), segment.bitwiseAND(F.bitwise_not(bit)).alias("v")))
    zero = variants.where("bit = 0").select(F.col("fp").alias("a"), "at", "v")
    one = variants.where("bit <> 0").select(F.col("fp").alias("b"), "at", "v")
    wild = zero.hint("merge").join(one, ["at", "v"]).where(near).select("a", "b")
    return exact.union(wild).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (smallest doc_id of the group) for every row."""
    rows = stage(fingerprints(docs, words), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fp")
    comps = connected_components(stage(links(distinct.select("fp"), radius), "fp-links"))
    named = distinct.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    linked = named.join(comps.select(F.col("node").alias("fp")), "fp", "left_semi")
    ids = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
