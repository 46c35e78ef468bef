"""Near copies: all pairs of texts whose sets of word shingles have a Jaccard similarity of at least t, exactly.

Texts with equal shingle sets collapse to one set first (exact copies, other case or white space). SimHash comes next, as in
operator 8: fingerprints, segments with one-bit wildcards, distance at most RADIUS. Of the texts of one fingerprint each is
held against one, its centre, and the centres of linked fingerprints against each other; shingle sets decide, so equal
fingerprints alone lose no text. What that makes one component is not looked at again.

The radius cannot reach every pair, so the rest is found exactly: for a set of n shingles in any order common to all sets,
a partner must share one of the first n - ceil(t n) + 1 (prefix filter). The order puts shingles that are frequent in a sample of 1 / SAMPLE of the sets last, rarest
first; the sample decides only the order, never which pairs are found. Two bounds that lose no pair thin
the candidates: the sizes, and the distance of parity maps, which is at most the size of the symmetric difference
(512 bits inside the join, 8192 after it). Shingle sets of the remaining pairs are compared.

Each group that shares a prefix shingle is first held against one member, its centre, where SimHash has not joined them.
Pairs that are then in one component are not looked at again; all others are. Groups whose members are similar, but below t, still
compare all pairs in the join.

Null, empty and blank texts have one empty shingle and are copies of each other; fewer words than a shingle
make one shingle. Sets and shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_words, connected_components, hold, release_shuffles, sieve, stage, text_hash, unstage, unused, without
from .simhash import fingerprint, links

SAMPLE, COMMON_ROWS, MAPS, WIDE = 32, 500_000, 8, 8192
#: Two segments reach three bits as they reach operator 8's two.
RADIUS = 3


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    w = byte_words(text)
    h = xxhash.xxh64_intdigest
    if len(w) < words:
        return np.array([h(b" ".join(w), 1)], np.uint64)
    each = np.array([h(x) for x in w], np.uint64)
    n = len(each) - words + 1
    out = each[:n].copy()
    for j in range(1, words):
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[j : n + j]
    return np.unique(out)


def _parity(s: np.ndarray, bits: int) -> np.ndarray:
    """Bit i: whether an odd number of shingles has the remainder i."""
    odd = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, th, g (hash of the set), fp (SimHash fingerprint), sample: the shingles of sampled sets, else null."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("near")
        for batch in batches:
            g, fp, sample = np.zeros(len(batch), np.uint64), np.zeros(len(batch), np.uint64), []
            for i, t in enumerate(batch["text"].tolist()):
                s = shingle_set(t, words)
                g[i], fp[i] = xxhash.xxh64_intdigest(s.tobytes()), fingerprint(t)
                sample.append(s.view(np.int64) if g[i] % np.uint64(SAMPLE) == 0 else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "th": batch["th"], "g": g.view(np.int64), "fp": fp.view(np.int64), "sample": sample})

    return docs.select("doc_id", text_hash().alias("th"), "text").mapInPandas(make, "doc_id long, th long, g long, fp long, sample array<long>")


def _common(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in two or more sampled sets, sorted, with their counts; at most the COMMON_ROWS most frequent."""
    each = sets.where("sample is not null").select("g", F.explode("sample").alias("h")).distinct()
    top = each.groupBy("h").count().where("count > 1").orderBy(F.desc("count"), "h").limit(COMMON_ROWS).toArrow()
    h, n = top["h"].to_numpy().astype(np.int64).view(np.uint64), top["count"].to_numpy().astype(np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def _prefixes(docs: DataFrame, words: int, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """g, n (size of the set), m0.. (parity map), prefix."""
    known, counts = common

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("near")
        for batch in batches:
            g, n, prefix = np.zeros(len(batch), np.uint64), np.zeros(len(batch), np.int64), []
            maps = np.zeros((len(batch), MAPS), np.int64)
            for i, t in enumerate(batch["text"].tolist()):
                s = shingle_set(t, words)
                g[i], n[i] = xxhash.xxh64_intdigest(s.tobytes()), len(s)
                maps[i] = _parity(s, 64 * MAPS)
                p = len(s) - ceil(similarity * len(s) - 1e-6) + 1
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    s = s[np.lexsort((s, np.where(known[at] == s, counts[at], 0)))]
                prefix.append(s[:p].view(np.int64))
            yield pd.DataFrame({"g": g.view(np.int64), "n": n, **{f"m{k}": maps[:, k] for k in range(MAPS)}, "prefix": prefix})

    return docs.select("text").mapInPandas(
        make, "g long, n long, " + ", ".join(f"m{k} long" for k in range(MAPS)) + ", prefix array<long>")


def _ends(pairs: DataFrame, docs: DataFrame, distinct: DataFrame, words: int, whole: bool, broadcast_rows: int) -> DataFrame:
    """g, n (size of the set), v: the whole set or its parity map of WIDE bits, for the ends of pairs."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("near")
        for batch in batches:
            n, values = [], []
            for t in batch["text"].tolist():
                s = shingle_set(t, words)
                n.append(len(s))
                values.append(s.view(np.int64) if whole else _parity(s, WIDE))
            yield pd.DataFrame({"g": batch["g"], "n": n, "v": values})

    ends = stage(pairs.select(F.col("a").alias("g")).union(pairs.select(F.col("b").alias("g"))).distinct(), "near-ends")
    wanted = distinct.join(ends, "g").select("g", F.col("rep.doc_id").alias("d"), F.col("rep.th").alias("t"))
    wanted = F.broadcast(wanted) if ends.count() <= broadcast_rows else wanted
    texts = docs.select("doc_id", text_hash().alias("th"), "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))).select("g", "text")
    return stage(texts.mapInPandas(make, "g long, n long, v array<long>").dropDuplicates(["g"]), "near-values")


def _possible(n: Column, m: Column, apart: Column, similarity: float) -> Column:
    """Whether sets of n and m shingles whose parity maps differ in `apart` bits can have the similarity."""
    return (F.least(n, m) >= F.greatest(n, m) * F.lit(similarity) - 1e-6) & (
        apart <= (n + m) * F.lit((1 - similarity) / (1 + similarity)) + 1e-6)


def _verified(pairs: DataFrame, docs: DataFrame, distinct: DataFrame, words: int, similarity: float, broadcast_rows: int) -> DataFrame:
    """Pairs (a, b) whose sets have the similarity: wide parity maps thin them before whole sets are compared."""

    def with_ends(rows: DataFrame, ends: DataFrame) -> DataFrame:
        return rows.join(ends.toDF("a", "na", "va"), "a").join(ends.toDF("b", "nb", "vb"), "b")

    maps = _ends(pairs, docs, distinct, words, False, broadcast_rows)
    apart = F.aggregate(F.zip_with("va", "vb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    likely = stage(with_ends(pairs, maps).where(_possible(F.col("na"), F.col("nb"), apart, similarity)).select("a", "b"), "near-likely")
    sets = _ends(likely, docs, distinct, words, True, broadcast_rows)
    common = F.size(F.array_intersect("va", "vb"))
    sure = with_ends(likely, sets).where(common / (F.col("na") + F.col("nb") - common) >= similarity).select("a", "b")
    sure = stage(sure, "near-sure")
    unstage(maps, likely, sets)
    return sure


def by_fingerprint(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs a < b of sets of distinct(g, fp) that SimHash proposes: a star for each fingerprint, and the centres of linked ones."""
    each = distinct.select("fp", "g")
    stars = stage(each.groupBy("fp").agg(F.min("g").alias("centre")), "near-fp")
    far = stage(links(stars.select("fp"), radius), "near-fp-links")
    one, two = stars.toDF("a", "x"), stars.toDF("b", "y")
    linked = far.join(one, "a").join(two, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    same = each.join(stars, "fp").where("g <> centre").select(F.col("centre").alias("a"), F.col("g").alias("b"))
    return linked.union(same)


def superfluous(docs: DataFrame, words: int, similarity: float, broadcast_rows: int = 200_000) -> DataFrame:
    """(doc_id, th) of documents that a near copy with a smaller (doc_id, th) replaces.

    Near copies are the connected components of the pairs with at least the similarity.
    """
    spark = docs.sparkSession
    full = stage(_sets(docs, words), "near-sets")
    rows = stage(full.drop("sample", "fp"), "near-rows")
    common = _common(full)
    distinct = full.groupBy("g").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.min("fp").alias("fp"))
    distinct = stage(distinct, "near-distinct")
    unstage(full)
    alike = stage(by_fingerprint(distinct), "near-alike")
    alike = _verified(alike, docs, distinct, words, similarity, broadcast_rows)
    joined = connected_components(alike).withColumnRenamed("node", "g")
    release_shuffles(spark)
    firsts = stage(_prefixes(docs, words, similarity, common), "near-prefixes")
    each = firsts.select("g", F.explode("prefix").alias("h"))
    shared = each.groupBy("h").agg(F.min("g").alias("centre"), F.max("g").alias("last")).where("centre < last").select("h", "centre")
    shared = stage(shared, "near-shared")
    release_shuffles(spark)
    keys = each.join(shared.select("h"), "h").distinct().join(joined, "g", "left")
    keys = stage(keys.withColumn("component", F.coalesce("component", "g")), "near-keys")
    about = stage(firsts.drop("prefix").join(keys.select("g").distinct(), "g").distinct(), "near-about")
    unstage(firsts)
    release_shuffles(spark)

    def pairs_of(x: DataFrame, y: DataFrame, other: Column, label: str) -> DataFrame:
        x, y = x.alias("x"), y.alias("y")
        apart = sum((F.bit_count(F.col(f"x.m{k}").bitwiseXOR(F.col(f"y.m{k}"))) for k in range(MAPS)), F.lit(0))
        near = _possible(F.col("x.n"), F.col("y.n"), apart, similarity)
        found = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.g") < F.col("y.g")) & other & near)
        return stage(found.select(F.col("x.g").alias("a"), F.col("y.g").alias("b")).distinct(), label)

    unjoined = F.col("x.component") != F.col("y.component")
    centres = shared.withColumnRenamed("centre", "g").join(about, "g").join(joined, "g", "left")
    stars = pairs_of(centres.withColumn("component", F.coalesce("component", "g")), keys.join(about, "g"), unjoined, "near-stars")
    sure = alike.union(_verified(stars, docs, distinct, words, similarity, broadcast_rows))
    comps = connected_components(sure).withColumnRenamed("node", "g")
    named = keys.drop("component").join(comps, "g", "left").withColumn("component", F.coalesce("component", "g"))
    open_keys = named.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("h")
    members = stage(named.join(open_keys, "h").join(about, "g"), "near-open")
    unstage(keys, about, shared)
    release_shuffles(spark)
    pairs = pairs_of(members, members, unjoined, "near-pairs")
    unstage(members)
    pairs = pairs.join(stars, ["a", "b"], "left_anti")
    more = _verified(stage(pairs, "near-rest"), docs, distinct, words, similarity, broadcast_rows)
    comps = connected_components(sure.union(more)).withColumnRenamed("node", "g")
    release_shuffles(spark)

    named = distinct.join(comps, "g", "left").select("g", "rep", F.coalesce("component", "g").alias("component"))
    keeper = named.groupBy("component").agg(F.min("rep").alias("keep"))
    named = named.join(keeper, "component").select("g", "keep")
    return rows.join(named, "g").where(~F.struct("doc_id", "th").eqNullSafe(F.col("keep"))).select("doc_id", "th").distinct()


def thinned(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Of each group of near copies the row with the smallest (doc_id, text hash), once. Texts of rows that stay are not shuffled."""
    gone = stage(superfluous(docs, words, similarity), "near-gone")
    kept = without(docs, gone)
    keys = docs.select("doc_id", text_hash().alias("th"))
    again = stage(keys.groupBy("doc_id", "th").agg(F.count("*").alias("n")).where("n > 1"), "near-again")
    if not again.limit(1).count():
        return kept
    (h,) = unused(docs, "h")
    held = sieve(again, "th")
    kept = kept.withColumn(h, text_hash())
    return kept.where(~held(F.col(h))).unionByName(kept.where(held(F.col(h))).dropDuplicates(["doc_id", h])).drop(h)
