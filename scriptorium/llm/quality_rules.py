"""Operator 2: quality rules with risk-controlled thresholds, in DataFrame functions only.

Four rules bound a ratio of a document from above: symbols per word, duplicate lines per worded line,
words in repeated windows per word, and mean word length. Labelled documents are dealt by a hash of doc_id
into a tuning third and a holdout. The tuning part lays out a path of rule sets per stratum, from loose
to strict: set t takes, for each rule, the strictest cutoff that rejects at most a quarter of the share BUDGETS[t]
of good tuning documents and pays (rejects a larger share of bad ones than four times that of good ones).
The holdout then tests the sets in that order: a set that rejects k of n good holdout documents has the
exact binomial tail P(X <= k), X ~ Binomial(n, risk), as p-value of "false rejection exceeds risk", and testing
stops at the first set whose p-value is above delta / strata (fixed-sequence testing within a stratum, Bonferroni
over strata). So with confidence 1 - delta no stratum loses more than `risk` of its good documents to all rules
together. The certified set that pays most is used; a stratum without one rejects by the base rule only. With
no rejected good document a stratum needs ln(strata / delta) / -ln(1 - risk) good holdout documents (86 at four strata).

Null and empty texts have no word and fail the base rule. Null strata form one stratum. Labels other
than 0 and 1 count nowhere; repeated labels of a doc_id are good if any is. Repeated rows each get a row. Empty
tables give none, missing labels certify nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, stage, word_array

RULES = ("symbols", "dup_lines", "repeats", "word_length")
#: Cutoffs tried per rule, loosest first.
GRID = {
    "symbols": (3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.3, 0.2, 0.1, 0.05),
    "dup_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeats": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "word_length": (40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 9.0, 8.0, 7.0),
}
RISK, DELTA = 0.05, 0.05
#: Shares of good tuning documents that the rule sets of a path may reject together, loosest first.
BUDGETS = (0.0, 0.004, 0.008, 0.012, 0.016, 0.02, 0.025, 0.03, 0.035, 0.04, 0.045)


def features(docs: DataFrame, *keep: str) -> DataFrame:
    """keep columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines; row-local."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(f"[^{SPACE}]"))

    def measured(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), F.when(F.size(w) >= 4, _cover(w)).otherwise(F.lit(0).cast("long")).alias("rep"))

    def line_counts(x: Column) -> Column:
        return F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))

    step = docs.select(*keep, text.alias("__t"), let(word_array(F.col("text")), measured).alias("__m"), let(lines, line_counts).alias("__l"))
    return step.select(
        *keep,
        F.col("__m.n").alias("n_words"),
        F.length(F.translate("__t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.col("__l.dup").cast("long").alias("n_dup_lines"),
        F.col("__l.n").cast("long").alias("n_lines"),
        F.col("__m.rep").alias("n_repeat_words"))


def _cover(w: Column) -> Column:
    """Words covered by 3-word windows found twice or more in the text.

    A window's 64-bit hash gives its low bits for its position, so one sort of longs brings equal windows
    together. Windows with an equal neighbour are hashed and sorted once more with another hash, as the
    bits left may be few for a long text; positions of those that still have one are sorted and their cover is summed.
    """
    bits = F.length(F.bin(F.size(w)))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def key(at: Column, *salt: Column) -> Column:
        h = F.xxhash64(*salt, F.get(w, at), F.get(w, at + 1), F.get(w, at + 2))
        return F.call_function("shiftleft", h, bits).bitwiseOR(at.cast("long"))

    def twins(keys: Column) -> Column:
        group = lambda x: F.call_function("shiftright", x, bits)
        return F.filter(keys, lambda x, i: (
            F.coalesce(group(F.get(keys, i - 1)) == group(x), F.lit(False))
            | F.coalesce(group(F.get(keys, i + 1)) == group(x), F.lit(False))))

    place = lambda x: x.bitwiseAND(mask).cast("int")
    first = let(F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: key(i))), twins)
    sure = let(F.sort_array(F.transform(first, lambda x: key(place(x), F.lit("again")))), twins)
    at = F.sort_array(F.transform(sure, lambda x: x.bitwiseAND(mask)))
    start = F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(at, start, lambda s, q: F.struct(
        q.alias("last"), (s["sum"] + F.least(F.lit(3).cast("long"), q - s["last"])).alias("sum")), lambda s: s["sum"])


#: Ratio of each rule, as SQL: one string parses faster than hundreds of column calls.
RATIOS = {"symbols": "n_symbols / greatest(n_words, 1)", "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
          "repeats": "n_repeat_words / greatest(n_words, 1)", "word_length": "word_chars / greatest(n_words, 1)"}


def ratios() -> dict[str, Column]:
    return {r: F.expr(x) for r, x in RATIOS.items()}


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly from the largest term down in log space."""
    from math import log

    odds = log(p) - log(1 - p)
    # log of the terms 0..k by recurrence, then log-sum-exp over a running (log term, max, sum)
    first = n * F.lit(log(1 - p))
    start = F.struct(first.alias("t"), first.alias("m"), F.lit(1.0).alias("s"))
    def step(a: Column, j: Column) -> Column:
        t = a["t"] + F.ln((n - j + 1) / j) + F.lit(odds)
        m = F.greatest(a["m"], t)
        return F.struct(t.alias("t"), m.alias("m"), (a["s"] * F.exp(a["m"] - m) + F.exp(t - m)).alias("s"))
    tail = F.aggregate(F.filter(F.sequence(F.lit(0).cast("long"), k), lambda j: j > 0), start, step,
                       lambda a: F.exp(a["m"]) * a["s"])
    return F.when(k >= n, F.lit(1.0)).otherwise(F.least(tail, F.lit(1.0)))


def _paths(tuning: DataFrame, stratum: str, grid: dict[str, tuple[float, ...]]) -> DataFrame:
    """stratum, path: per budget a struct of one cutoff per rule (null: none); stricter as the budget grows."""
    counts = [F.expr(f"count_if(quality = {y} AND {RATIOS[r]} > {c}D) AS {k}_{r}{j}") for r in RULES for j, c in enumerate(grid[r]) for k, y in (("k", 1), ("b", 0))]
    counted = tuning.groupBy(stratum).agg(F.expr("greatest(count_if(quality = 1), 1) AS n"), F.expr("greatest(count_if(quality = 0), 1) AS m"), *counts)

    def paying(r: str) -> str:
        tried = ", ".join(f"named_struct('c', {c}D, 'lost', k_{r}{j} / n, 'won', b_{r}{j} / m)" for j, c in enumerate(grid[r]))
        return f"filter(array({tried}), x -> x.won > 4 * x.lost)"

    cut = ", ".join(f"'{r}', array_min(transform(filter(pay_{r}, x -> x.lost <= budget / {len(RULES)}), x -> x.c))" for r in RULES)
    budgets = ", ".join(f"{b}D" for b in BUDGETS)
    return counted.select(F.col(stratum), *[F.expr(f"{paying(r)} AS pay_{r}") for r in RULES]).select(
        F.col(stratum), F.expr(f"transform(array({budgets}), budget -> named_struct({cut}))").alias("path"))


def thresholds(measured: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA,
               grid: dict[str, tuple[float, ...]] = GRID) -> DataFrame:
    """One row per stratum of the holdout: certified cutoff of each rule (null: none), good holdout documents and good ones rejected."""
    marks = labels.groupBy("doc_id").agg(F.max(F.when(F.col("quality").isin(0, 1), F.col("quality"))).alias("quality")).where("quality is not null")
    held = measured.where("not base_failed").join(marks, "doc_id").withColumn("__tune", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    paths = _paths(held.where("__tune"), stratum, grid).withColumnRenamed(stratum, "__s")
    broken = " OR ".join(f"coalesce({RATIOS[r]} > cut.{r}, false)" for r in RULES)
    tested = held.where("not __tune").join(paths, F.col(stratum).eqNullSafe(F.col("__s"))).select(
        stratum, "quality", "path", F.expr(f"transform(path, cut -> {broken})").alias("hit"))
    share = lambda q: F.expr("array(" + ", ".join(f"count_if(quality = {q} AND hit[{t}])" for t in range(len(BUDGETS))) + ")")
    sums = tested.groupBy(stratum).agg(F.first("path").alias("path"), F.expr("count_if(quality = 1) AS n"), F.expr("count_if(quality = 0) AS m"),
                                       share(1).alias("k"), share(0).alias("b"))
    sums = sums.withColumn("__m", F.expr("count(*) over ()"))  # one row per stratum
    # from n * risk rejected on, the tail is about a half or more and need not be summed
    passes = F.transform("k", lambda k: F.when((k < F.col("n") * risk) & (F.col("n") > 0), binomial_tail(k, F.col("n"), risk)).otherwise(F.lit(1.0)) <= F.lit(delta) / F.col("__m"))
    sums = sums.withColumn("passes", passes)
    until = F.coalesce(F.array_position("passes", False) - 1, F.lit(0))
    until = F.when(until < 0, F.size("passes")).otherwise(until).cast("int")
    gain = lambda t: F.get("b", t) / F.greatest("m", F.lit(1)) - 4 * F.get("k", t) / F.greatest("n", F.lit(1))
    rated = F.transform(F.filter(F.sequence(F.lit(0), F.lit(len(BUDGETS) - 1)), lambda t: t < F.col("until")), lambda t: F.struct(
        gain(t).alias("gain"), (-t).alias("loosest"), F.get("path", t).alias("cut"), F.get("k", t).alias("k")))
    best = sums.withColumn("until", until).withColumn("best", F.array_max(rated))
    return best.select(F.col(stratum), *[F.col(f"best.cut.{r}").alias(f"max_{r}") for r in RULES], "n", F.col("best.k").alias("rejected"))


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, counts, base_failed, kept and the first rule that rejects, for every row.

    Texts are read once, in place: their counts are written, labels meet counts by doc_id, and the table of cutoffs, one row
    per stratum, is broadcast only while the optimizer sees it small.
    """
    counts = features(docs.select("doc_id", stratum, "text"), "doc_id", stratum)
    counts = counts.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    counts = stage(counts, "rule-counts")
    cut = stage(thresholds(counts, labels, stratum, risk, delta).withColumnRenamed(stratum, "__s"), "rule-cutoffs")
    rows = counts.join(cut, F.col(stratum).eqNullSafe(F.col("__s")), "left")
    value = ratios()
    broken = F.lit(None).cast("string")
    for r in reversed(RULES):
        broken = F.when(F.col(f"max_{r}").isNotNull() & (value[r] > F.col(f"max_{r}")), F.lit(r)).otherwise(broken)
    rows = rows.withColumn("rule", F.when(F.col("base_failed"), F.lit("base")).otherwise(broken))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       F.col("rule").isNull().alias("kept"), "rule")
