"""Operator 10: a factorisation machine for document quality.

Features of a text: hashed lower-cased words (weights log1p of the count, scaled to unit length) and
structure statistics (shares of symbols, capitals, digits, punctuation; word and line lengths; repeats),
in bins, and the length as metadata. A pair of features interacts through the product of two low-rank
vectors; the sum over all pairs is scored in linear time as half the difference between the squared sum
and the sum of squares.

Training takes the texts of at most `sample` labelled doc_ids, the first by a hash of doc_id and label (a bounded
sample, whatever the corpus). Their ids go to the documents, so no text is shuffled; only their sparse
features reach the driver. Scoring reads every text in place.

Null and empty texts have structure features only and get a score. Null labels are not learnt from;
several labels of one doc_id count once each,
several texts of one doc_id as the one whose features sort first. Without both classes among the labels the score is the
prior (0.5 without labels). Repeated rows each get a row; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hold

WORD_BITS = 15
SAMPLE = 6000
RANK, EPOCHS, RATE, BATCH = 8, 12, 0.08, 64
_BINS = 12
#: Words whose bucket a process remembers.
KEPT_WORDS = 300_000
_STATS = ("length", "symbols", "capitals", "digits", "marks", "pipes", "bang", "word length", "short", "line length",
          "repeated lines", "distinct words", "non-ascii", "blanks")
N_WORDS = 1 << WORD_BITS
N_FEATURES = N_WORDS + _BINS * len(_STATS) + len(_STATS)

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_TABLE = {}


class _Buckets(dict):
    """Word to bucket; forgets nothing it kept but stops keeping at a bound."""

    def __missing__(self, word: bytes) -> int:
        b = zlib.crc32(word) & (N_WORDS - 1)
        if len(self) < KEPT_WORDS:
            self[word] = b
        return b


_BUCKETS = _Buckets()


def _own() -> None:
    """This module's tasks share the buckets. Workers get tasks' functions by value, and this one by name."""
    hold("buckets", _BUCKETS.clear)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a text: indices and values."""
    raw = (text or "").encode("utf-8")
    words = raw.lower().split()
    n, size = len(words), max(1, len(raw))
    counts = np.bincount(np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, n), minlength=0) if n else np.zeros(0, np.int64)
    at = np.flatnonzero(counts)
    value = np.log1p(counts[at].astype(np.float64))
    if len(at):
        value /= np.sqrt((value**2).sum())
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = lambda a, b: min(1.0, a / max(1, b))
    symbols = int(byte[[35, 42, 36, 37, 38, 124, 60, 62]].sum())
    letters = int(byte[65:91].sum() + byte[97:123].sum())
    stats = np.array([
        min(1.0, np.log1p(n) / 12), share(4 * symbols, size), share(int(byte[65:91].sum()), letters), share(4 * int(byte[48:58].sum()), size),
        share(4 * int(byte[[33, 44, 46, 58, 59, 63]].sum()), size), share(8 * int(byte[124]), size), share(8 * int(byte[33]), size),
        min(1.0, size / max(1, n) / 20), share(n, 50), min(1.0, np.log1p(n / max(1, len(lines))) / 8),
        1 - share(len(set(lines)), len(lines)) if lines else 0.0, share(len(at), n), share(int(byte[128:].sum()), size), share(int(byte[32]), size)])
    own = np.minimum((stats * _BINS).astype(np.int64), _BINS - 1) + N_WORDS + _BINS * np.arange(len(_STATS))
    direct = N_WORDS + _BINS * len(_STATS) + np.arange(len(_STATS))
    return np.concatenate([at, own, direct]), np.concatenate([value, np.full(len(own), 0.3), stats])


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[at]
        s = x @ v
        pairs = 0.5 * float(s @ s - ((x[:, None] * v) ** 2).sum())
        z = self.bias + float(self.weights[at] @ x) + pairs
        return 1.0 / (1.0 + np.exp(-min(30.0, max(-30.0, z))))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Model:
    """AdaGrad on the logistic loss; classes weigh the same."""
    rng = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(N_FEATURES), rng.normal(0, 0.02, (N_FEATURES, RANK)))
    n, ones = len(labels), int(labels.sum())
    if not n or ones in (0, n):
        p = (ones + 1) / (n + 2) if n else 0.5
        model.bias = float(np.log(p / (1 - p)))
        model.factors[:] = 0
        return model
    weight = np.where(labels == 1, 0.5 * n / ones, 0.5 * n / (n - ones))
    gb, gw, gv = 1e-6, np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, RANK), 1e-6)
    for epoch in range(EPOCHS):
        order = rng.permutation(n)
        for start in range(0, n, BATCH):
            pick = order[start : start + BATCH]
            at = np.concatenate([rows[k][0] for k in pick])
            x = np.concatenate([rows[k][1] for k in pick])
            sizes = np.array([len(rows[k][0]) for k in pick])
            begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            v = model.factors[at]
            xv = x[:, None] * v
            s = np.add.reduceat(xv, begin)
            z = model.bias + np.add.reduceat(model.weights[at] * x, begin) + 0.5 * (s**2 - np.add.reduceat(xv**2, begin)).sum(axis=1)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) * weight[pick] / len(pick)
            each = np.repeat(g, sizes)
            uniq, back = np.unique(at, return_inverse=True)
            dw = np.bincount(back, each * x, len(uniq)) + 1e-6 * model.weights[uniq]
            part = each[:, None] * (x[:, None] * np.repeat(s, sizes, axis=0) - (x**2)[:, None] * v)
            dv = np.stack([np.bincount(back, part[:, f], len(uniq)) for f in range(RANK)], axis=1) + 1e-5 * model.factors[uniq]
            db = float(g.sum())
            gb += db * db
            gw[uniq] += dw**2
            gv[uniq] += dv**2
            model.bias -= RATE * db / gb**0.5
            model.weights[uniq] -= RATE * dw / np.sqrt(gw[uniq])
            model.factors[uniq] -= 0.3 * RATE * dv / np.sqrt(gv[uniq])
    return model


def sample_features(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> tuple[list, np.ndarray]:
    """Features and labels of the texts of at most `sample` rows of marks(doc_id, label), the least by a hash: fit bound of the model."""
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _own()
        for batch in batches:
            got = [features(t) for t in batch["text"].tolist()]
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "at": [g[0].astype("<i4").tobytes() for g in got],
                                "x": [g[1].astype("<f4").tobytes() for g in got]})

    chosen = marks.where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id", "label"), "doc_id", "label").limit(sample)
    ids = F.broadcast(chosen.select(F.col("doc_id").alias("id"), "label"))  # at most `sample` pairs
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("id")).select(F.col("id").cast("string").alias("id"), "label", "text")
    found = texts.mapInPandas(make, "id string, label int, at binary, x binary")
    # one row per pair leaves each task, however often a row repeats
    got = found.groupBy("id", "label").agg(F.min(F.struct("at", "x")).alias("f")).select("label", "f.at", "f.x").collect()
    got.sort(key=lambda r: (bytes(r["at"]), bytes(r["x"]), r["label"]))
    return ([(np.frombuffer(r["at"], "<i4").astype(np.int64), np.frombuffer(r["x"], "<f4").astype(np.float64)) for r in got],
            np.array([r["label"] for r in got], np.float64))


def fit(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> Model:
    return train(*sample_features(docs, marks, sample))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with a column of scores from 0 to 1."""
    held = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights.astype(np.float32), model.factors.astype(np.float32)))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        _own()
        m = Model(*held.value)
        return pd.Series([m.score(*features(t)) for t in texts.tolist()], dtype="float64")

    return docs.withColumn(name, scored("text"))


def marks_of(labels: DataFrame, learnt=None) -> DataFrame:
    """doc_id, label of the usable labels that `learnt`, a column of doc_id, admits."""
    marks = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("label"))
    return marks if learnt is None else marks.where(learnt)
