"""Operator 6: benchmark decontamination by SimHash windows, in DataFrame functions only.

An item of w words is compared with windows of w words of a document. Both are multisets of 5-word
shingles (items below five words: one shingle of all their words). The similarity is the weighted
Jaccard of the multisets: sum of smaller counts over sum of larger counts; a leak has 0.8 or more.

Windows have the sizes of items. Two exact bounds keep those that can reach the similarity, without regard to which
item they resemble. A window of m and an item of n shingles need s(m+n)/(1+s) shared ones for a similarity s; m is n,
or all shingles of a document that has fewer. So a window needs that many places whose shingle occurs in some item of
its size. And sliding a window right past a shingle that no item of its size has cannot lower a similarity, so the
best window starts at a shared shingle or is the last one.

Which windows and items meet is found by fingerprints (SimHash over shingle hashes) and multi-index blocks: eight
blocks of eight bits, of which one differs by at most `RADIUS // 8` bits between fingerprints within the
radius. Items are indexed under all block values that near; windows of equal size probe the eight blocks
with an equality join, which finds every pair within the radius. Similarity then verifies exactly.

Texts lower-case A-Z. Null and empty texts have no shingle. Repeated rows (doc_id and text equal)
give one row per item. Items without words match nothing; repeated items each count by item_id.
Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, stage, word_array

WORDS, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 20, 8
#: Rows up to which a side may be broadcast; beyond, Spark joins by shuffle.
BROADCAST_ROWS = 200_000


def _small(df: DataFrame) -> DataFrame:
    """Broadcast hint behind a check of the size."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _shingles(words: Column, k: int) -> Column:
    """Hashes of k-word shingles of an array, repeats included, in order; the array is evaluated once."""
    def cut(w: Column) -> Column:
        return F.when(F.size(w) >= k, F.transform(
            F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))).otherwise(
            F.array().cast("array<long>"))
    return let(words, cut)


def items_of(benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """item_id, w words, k words per shingle, sh: shingle hashes."""
    split = benchmark.select("item_id", word_array(ascii_lower(F.col("text"))).alias("x")).where(F.size("x") > 0)
    sized = split.select("item_id", "x", F.size("x").alias("w"), F.least(F.size("x"), F.lit(words)).alias("k"))
    sh = F.coalesce(*[F.when(F.col("k") == k, _shingles(F.col("x"), k)) for k in range(1, words + 1)])
    return sized.select("item_id", "w", "k", sh.alias("sh"))


def _need(size: Column, n: Column, similarity: float) -> Column:
    """Shared shingles that the best window of a document of `size` shingles needs for an item of n."""
    return F.ceil((F.least(size, n) + n) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9)).cast("int")


def _fingerprints(rows: DataFrame, keys: list[str], array: str) -> DataFrame:
    """keys, fp: bits set in over half of the hashes. Sixteen sums hold four 16-bit counters each; they count to
    65,535 shingles, beyond which (items longer than that) counts are taken bit by bit."""
    lane = 0x0001000100010001
    each = rows.select(*keys, F.explode(array).alias("h"))
    if (rows.agg(F.max(F.size(array))).first()[0] or 0) > 65_535:
        sums = each.groupBy(*keys).agg(F.count("*").alias("n"), *[
            F.sum(F.shiftrightunsigned("h", b).bitwiseAND(1)).alias(f"s{b}") for b in range(64)])
        count = {b: F.col(f"s{b}") for b in range(64)}
    else:
        sums = each.groupBy(*keys).agg(F.count("*").alias("n"), *[
            F.sum(F.shiftrightunsigned("h", b).bitwiseAND(lane)).alias(f"s{b}") for b in range(16)])
        count = {b: F.shiftrightunsigned(f"s{b % 16}", 16 * (b // 16)).bitwiseAND(0xFFFF) for b in range(64)}
    one = [F.when(count[b] * 2 > F.col("n"), F.lit((1 << b) - (1 << 64) if b == 63 else 1 << b).cast("long")).otherwise(
        F.lit(0).cast("long")) for b in range(64)]
    fp = one[0]
    for x in one[1:]:
        fp = fp.bitwiseOR(x)
    return sums.select(*keys, fp.alias("fp"))


def _common(a: str, b: str) -> Column:
    """Size of the multiset intersection: occurrences are numbered where an array repeats itself."""
    def numbered(x: str) -> Column:
        plain = F.size(F.array_distinct(x)) == F.size(x)
        tagged = F.transform(x, lambda v, i: F.xxhash64(v, F.size(F.filter(F.slice(x, F.lit(1), i), lambda y: y == v))))
        first = F.transform(x, lambda v: F.xxhash64(v, F.lit(0)))
        return F.when(plain, first).otherwise(tagged)
    return F.size(F.array_intersect(numbered(a), numbered(b)))


def _windows(part: DataFrame, has: DataFrame, k: int, similarity: float) -> DataFrame:
    """doc_id, th, w, start, win: the windows of w words that hold as many shingles of w-word items as similarity needs.

    Places of such shingles come in order, so a window from one of them holds enough if the place `need - 1` further
    on is still inside: work is linear in the places."""
    place = part.select("doc_id", "th", F.posexplode("ds").alias("p", "h")).join(has.select("h", "ws"), "h")
    place = place.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "p", F.explode("ws").alias("w"))
    hit = place.groupBy("d", "t", "w").agg(F.sort_array(F.collect_list("p")).alias("hit"))
    both = hit.join(part, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
    both = both.withColumn("n", F.col("w") - (k - 1)).withColumn("need", _need(F.size("ds"), F.col("n"), similarity))
    both = both.where(F.size("hit") >= F.col("need")).withColumn("last", F.greatest(F.lit(0), F.size("ds") - F.col("n")))
    full = F.transform("hit", lambda p, j: F.when((p < F.col("last")) & (F.get(F.col("hit"), j + F.col("need") - 1) < p + F.col("n")), p))
    end = F.when(F.get(F.col("hit"), F.size("hit") - F.col("need")) >= F.col("last"), F.array("last"))
    starts = F.concat(F.array_compact(full), F.coalesce(end, F.array().cast("array<int>")))
    return both.select("doc_id", "th", "w", "n", "ds", F.explode(starts).alias("start")).select(
        "doc_id", "th", "w", "start", F.slice("ds", F.col("start") + 1, F.col("n")).alias("win"))


def leaks(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, start (word), words, distance, similarity: the best window per document and leaked item."""
    items = stage(items_of(benchmark, words), "bench-items")
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # at most `words` values
    text = docs.select("doc_id", "text").where("text is not null")
    # per shingle the sizes in words of items that have it: no more values than items have sizes
    has = items.select("k", "w", F.explode("sh").alias("h")).groupBy("k", "h").agg(F.collect_set("w").alias("ws"))
    has = _small(stage(has, "bench-has"))
    found = None
    for k in sizes or [words]:
        split = text.select("doc_id", F.xxhash64("text").alias("th"), word_array(ascii_lower(F.col("text"))).alias("x"))
        at = split.select("doc_id", "th", (F.size("x") - (k - 1)).alias("m"), F.explode(_shingles(F.col("x"), k)).alias("h"))
        hits = at.join(has.where(F.col("k") == k).select("h", "ws"), "h").select("doc_id", "th", "m", F.explode("ws").alias("w"))
        hits = hits.groupBy("doc_id", "th", "w", "m").agg(F.count("*").alias("held"))
        hits = hits.where(F.col("held") >= _need(F.col("m"), F.col("w") - (k - 1), similarity)).select("doc_id", "th")
        found = hits if found is None else found.union(hits)
    keys = _small(stage(found.select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct(), "bench-candidates"))
    rows = text.select("doc_id", F.xxhash64("text").alias("th"), "text").join(
        keys, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left_semi").dropDuplicates(["doc_id", "th"])
    rows = stage(rows.select("doc_id", "th", word_array(ascii_lower(F.col("text"))).alias("x")), "bench-docs")
    held = None
    for k in sizes or [words]:
        part = stage(rows.select("doc_id", "th", _shingles(F.col("x"), k).alias("ds")), "bench-shingles")
        win = _windows(part, has.where(F.col("k") == k), k, similarity)
        held = win if held is None else held.union(win)
    windows = stage(held, "bench-windows")
    prints = _fingerprints(windows, ["doc_id", "th", "w", "start"], "win")
    index = _fingerprints(items, ["item_id", "w"], "sh")
    near = [sum(1 << b for b in c) for d in range(radius // BLOCKS + 1) for c in combinations(range(8), d)]
    blocks = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    index = index.select("item_id", "w", "fp", blocks.alias("block")).select(
        "item_id", F.col("w").alias("iw"), F.col("fp").alias("ifp"), F.col("block").alias("ib"),
        F.explode(F.array(*[F.lit(m) for m in near])).alias("flip")).select(
        "item_id", "iw", "ifp", "ib", F.expr("(shiftrightunsigned(ifp, ib * 8) & 255) ^ flip").alias("iv"))
    probe = prints.select("doc_id", "th", "w", "start", "fp", blocks.alias("block")).select(
        "*", F.expr("shiftrightunsigned(fp, block * 8) & 255").alias("v"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp")))
    pairs = probe.join(_small(stage(index, "bench-index")), (F.col("w") == F.col("iw")) & (F.col("block") == F.col("ib")) & (F.col("v") == F.col("iv"))).where(
        distance <= radius).select("doc_id", "th", "w", "start", "item_id", distance.alias("distance")).distinct()
    one = windows.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), F.col("w").alias("ww"), F.col("start").alias("s"), "win")
    full = pairs.join(one, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")) & (F.col("w") == F.col("ww")) & (F.col("start") == F.col("s")))
    full = full.join(items.select("item_id", "sh"), "item_id").withColumn("common", _common("win", "sh"))
    alike = F.col("common") / (F.size("win") + F.size("sh") - F.col("common"))
    good = full.select("doc_id", "th", "item_id", "start", "w", "distance", alike.alias("similarity")).where(F.col("similarity") >= similarity)
    return good.groupBy("doc_id", "th", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("s"), (-F.col("distance")).alias("d"), "w")).alias("best")).select(
        "doc_id", "item_id", (-F.col("best.s")).cast("long").alias("start"), F.col("best.w").cast("long").alias("words"),
        (-F.col("best.d")).cast("long").alias("distance"), F.col("best.similarity").alias("similarity"))
