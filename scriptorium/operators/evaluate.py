"""Span metrics: strict, boundary, per label, and confusion of labels on equal boundaries.

Gold and predictions are spans (sentence_id, start, end, label), or one table of sentences that holds both sides as arrays
(sentence_id, gold, pred). Spans meet in one shuffle of spans, arrays in one shuffle of sentences, and are then counted by the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = ["sentence_id", "start", "end"]


def _unique(df: DataFrame, *more: str) -> DataFrame:
    return df.select(F.coalesce("sentence_id", F.lit("global")).alias("sentence_id"), "start", "end", *more).distinct()


def rates(tp: Column, fp: Column, fn: Column) -> list[Column]:
    part = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    p, r = part(tp, tp + fp), part(tp, tp + fn)
    return [p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1")]


def _rated(sums: DataFrame, by: list[str]) -> DataFrame:
    return sums.select(*by, "tp", "fp", "fn", *rates(F.col("tp"), F.col("fp"), F.col("fn")))


def _counted(gold: DataFrame, pred: DataFrame | None, labels: bool, by: list[str]) -> DataFrame:
    if pred is None:
        found = _by_batch(gold, "label string, tp long, fp long, fn long", lambda b: _counts(b, labels)).where("tp + fp + fn > 0")
        return _rated(found.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")]), by)
    keys = [*SPAN, *(["label"] if labels else [])]
    side = lambda df, g, p: _unique_keys(df, keys).select("*", F.lit(g).alias("g"), F.lit(p).alias("p"))
    each = side(gold, 1, 0).unionByName(side(pred, 0, 1)).groupBy(*keys).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    whole = F.lit(True)
    for k in keys:  # a span with a null equals none
        whole = whole & F.col(k).isNotNull()
    tp = whole & (F.col("g") + F.col("p") == 2)
    return _rated(each.groupBy(*by).agg(F.count(F.when(tp, 1)).alias("tp"), F.count(F.when((F.col("p") == 1) & ~tp, 1)).alias("fp"),
                                        F.count(F.when((F.col("g") == 1) & ~tp, 1)).alias("fn")), by)


def _unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn("sentence_id", F.coalesce("sentence_id", F.lit("global"))).select(*keys)


def strict(gold: DataFrame, pred: DataFrame | None = None) -> DataFrame:
    return _counted(gold, pred, True, [])


def boundary(gold: DataFrame, pred: DataFrame | None = None) -> DataFrame:
    return _counted(gold, pred, False, [])


def per_label(gold: DataFrame, pred: DataFrame | None = None) -> DataFrame:
    return _counted(gold, pred, True, ["label"])


def _matched(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Equal boundaries with the least label of either side, where a side has several."""
    least = lambda df, name: _unique(df, "label").groupBy(*SPAN).agg(F.min("label").alias(name))
    return least(gold, "gold").join(least(pred, "pred"), SPAN)


def confusion(gold: DataFrame, pred: DataFrame | None = None) -> DataFrame:
    if pred is None:
        return _by_batch(gold, "pred string, gold string, spans long", _pairs).groupBy("pred", "gold").agg(F.sum("spans").alias("spans"))
    return _matched(gold, pred).groupBy("pred", "gold").agg(F.count("*").alias("spans"))


# --- sentences that hold both sides -------------------------------------------------------------------------------------

#: Groups over which the spans without a sentence are dealt; labels that a batch of packed spans names at most.
PARTS, NAMES = 4096, 64


def _by_batch(rows: DataFrame, schema: str, count: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """What count finds in batches of whole sentences; rows of one id are one sentence. Spans without an id are one sentence,
    too, but dealt by their place, as only spans of one place meet. Spans are packed into bytes where they are, and so shuffled."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _packed(batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict(count(batch))

    each = rows.select("sentence_id", "gold", "pred").mapInArrow(pack, "sentence_id string, part int, spans binary, names array<string>")
    return each.groupBy("sentence_id", "part").agg(*[F.collect_list(c).alias(c) for c in ("spans", "names")]).select("spans", "names").mapInArrow(run, schema)


def _packed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(sentence_id, part, spans, names): a span is three numbers, start, end, and 8 times its place in names with what is null
    of it (2: start, 4: end) and 1 for a prediction."""
    sides = [batch.column(c) for c in ("gold", "pred")]
    flat = [c.flatten() for c in sides]
    start, end, label = (pa.concat_arrays([f.field(k) for f in flat]) for k in ("start", "end", "label"))
    names = pc.unique(label).to_pylist()
    if len(names) > NAMES and batch.num_rows > 1:
        half = batch.num_rows // 2
        yield from _packed(batch.slice(0, half))
        yield from _packed(batch.slice(half))
        return
    ids = pc.fill_null(batch.column("sentence_id").cast(pa.string()), "global")
    row = np.concatenate([np.repeat(np.arange(len(c)), pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False)) for c in sides])
    spans = np.empty((len(row), 3), np.int64)
    spans[:, 2] = pc.index_in(label, value_set=pa.array(names, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64) * 8 + np.repeat([0, 1], [len(f) for f in flat])
    for k, x in ((0, start), (1, end)):
        spans[:, k] = pc.fill_null(x, 0).to_numpy(zero_copy_only=False)
        spans[:, 2] += (2 << k) * x.is_null().to_numpy(zero_copy_only=False)
    lone = pc.equal(ids, "global").to_numpy(zero_copy_only=False)
    group = row * PARTS + np.where(lone[row], (spans[:, 0] * 1_000_003 + spans[:, 1]) % PARTS, 0)
    order = np.argsort(group, kind="stable")
    group, size = np.unique(group[order], return_counts=True)
    offsets = np.append(0, np.cumsum(size * 24)).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), len(group), [None, pa.py_buffer(offsets), pa.py_buffer(spans[order])])
    named = pa.ListArray.from_arrays(pa.array(np.arange(len(group) + 1, dtype=np.int32) * len(names)), pa.array(names * len(group), pa.string()))
    yield pa.RecordBatch.from_arrays([ids.take(pa.array(group // PARTS)), pa.array((group % PARTS).astype(np.int32)), blobs, named], names=["sentence_id", "part", "spans", "names"])


def _spans(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(number of the place, label, is a prediction, has a place, names, row and numbers) of the spans of sentences; equal
    places of a sentence have one number, labels number their names, in order, and the last, None."""
    held, named = batch.column("spans"), batch.column("names").flatten()
    each = held.flatten()
    spans = np.frombuffer(b"".join(each.to_pylist()), np.int64).reshape(-1, 3)
    n = pc.binary_length(each).to_numpy(zero_copy_only=False) // 24
    row = np.repeat(np.repeat(np.arange(len(held)), pc.list_value_length(held).to_numpy(zero_copy_only=False)), n)
    words = named.flatten()
    names = sorted(pc.unique(words).drop_null().to_pylist())
    known = pc.fill_null(pc.index_in(words, value_set=pa.array(names, pa.string()), skip_nulls=True), len(names)).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.append(0, np.cumsum(pc.list_value_length(named).to_numpy(zero_copy_only=False)))[:-1]
    code = known[np.repeat(first, n) + (spans[:, 2] >> 3)]
    pred, placed = spans[:, 2] & 1, spans[:, 2] & 6 == 0
    a, b = spans[:, 0], spans[:, 1]
    place = row
    for x in (a, b):
        x = x - x.min(initial=0)
        wide = int(x.max(initial=0)) + 1
        if (int(place.max(initial=0)) + 1) * wide * 2 * (len(names) + 1) >= 1 << 62:  # numbers grow too long: count them anew
            place, x = (np.unique(v, return_inverse=True)[1] for v in (place, x))
            wide = int(x.max(initial=0)) + 1
        place = place * wide + x
    return place, code, pred, placed, [*names, None], row, spans


def _counts(batch: pa.RecordBatch, labels: bool) -> dict:
    place, code, pred, placed, names, row, spans = _spans(batch)
    if labels:
        placed = placed & (code < len(names) - 1)
    else:
        code, names = np.zeros_like(code), [None]
    n = len(names)
    whole = np.unique(((place * n + code) * 2 + pred)[placed])
    span, side = whole >> 1, whole & 1
    twice = np.flatnonzero(span[1:] == span[:-1])
    by = lambda k: np.bincount(k % n, minlength=n)
    tp = by(span[twice])
    gold, guess = by(span[side == 0]), by(span[side == 1])
    for p, out in ((0, gold), (1, guess)):  # a span with a null equals none of the other side
        at = np.flatnonzero(~placed & (pred == p))
        if len(at):
            lost = np.unique(np.stack([row[at], spans[at, 0], spans[at, 1], spans[at, 2] & 6, code[at]]), axis=1)[4]
            out += np.bincount(lost, minlength=n)
    return {"label": pa.array(names, pa.string()), "tp": pa.array(tp), "fp": pa.array(guess - tp), "fn": pa.array(gold - tp)}


def _pairs(batch: pa.RecordBatch) -> dict:
    place, code, pred, placed, names, *_ = _spans(batch)
    n = len(names)
    each = np.unique(((place * 2 + pred) * n + code)[placed])
    least = each[np.append(True, each[1:] // n != each[:-1] // n)] if len(each) else each
    at = least // n  # place and side
    both = np.flatnonzero((at[1:] == at[:-1] + 1) & (at[1:] % 2 == 1))
    pairs, spans = np.unique(least[both] % n * n + least[both + 1] % n, return_counts=True)
    named = pa.array(names, pa.string())
    return {"pred": named.take(pa.array(pairs % n)), "gold": named.take(pa.array(pairs // n)), "spans": pa.array(spans)}


def label_accuracy(gold: DataFrame, pred: DataFrame) -> DataFrame:
    return _matched(gold, pred).agg(F.count("*").alias("matched"), F.coalesce(F.avg((F.col("gold") == F.col("pred")).cast("double")), F.lit(0.0)).alias("accuracy"))


def regressed(before_f1: float, now_f1: float) -> bool:
    """The gate: a strict F1 below the baseline fails."""
    return now_f1 < before_f1


def entities_of(rows: DataFrame) -> DataFrame:
    """(sentence_id, start, end, label) of rows in any of three shapes: records with sentences and entities, sentences with entities, entities."""
    if "entities" not in rows.columns:
        return rows.select(*SPAN, "label")
    each = rows.withColumn("__e", F.explode("entities"))
    if "sentences" in rows.columns:
        return each.select("__e.sentence_id", "__e.start", "__e.end", "__e.label")
    return each.select(sentence_key(rows).alias("sentence_id"), "__e.start", "__e.end", "__e.label")


def sentence_key(rows: DataFrame) -> Column:
    """sentence_id, or sid where it is missing or empty."""
    return F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("sentence_id", "sid") if c in rows.columns], F.lit(None).cast("string"))


def pilot_ids(rows: DataFrame, missing: str = "raise") -> DataFrame:
    """(sentence_id), distinct; rows without one are an error or, with missing="ignore", left out."""
    ids = rows.select(sentence_key(rows).alias("sentence_id"))
    if missing == "raise" and ids.where("sentence_id IS NULL").limit(1).count():
        raise ValueError("a pilot row has no sentence id")
    return ids.where("sentence_id IS NOT NULL").distinct()
