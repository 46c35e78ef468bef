"""Operator 7: a trigram language model with deleted interpolation.

P(w | h) mixes maximum-likelihood estimates of orders 3, 2 and 1 with a uniform floor. The weights depend
on the bucket (log2 of the frequency) of the longest context seen; expectation-maximisation learns them on
a deleted fold of the training documents, whose tokens are predicted by counts of the others. The
final model then uses the counts of all training documents with those weights.

Counting is a distributed dictionary. Documents are cut into chunks of bounded size; a chunk lists
each n-gram it holds once (so frequent n-grams shrink before any shuffle), as sorted 52-bit keys,
delta-coded and compressed, cut by key range. A bucket of keys sums the counts of all chunks and
answers each chunk with the counts of its own keys, in its order. Nothing is pruned or sampled, all
sides are balanced by hashing, and no task holds more than a chunk or a bucket. A message is one chunk's
keys in one bucket; empty ones are not sent, so there are never more messages than keys of chunks, but
messages get shorter as the corpus grows. With K distinct n-grams the expected share of keys that clash is K / 2**52.

Null and empty texts are one end token. A null doc_id counts as the empty string in folds. Repeated rows
are separate documents. Without training documents all counts are zero and scores come from the
floor; without a deleted fold the weights stay uniform. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, release_shuffles, stage, unstage

#: Tokens of a chunk, keys of a bucket, EM rounds; one of FOLDS training documents is deleted.
CHUNK, BUCKET_KEYS, ROUNDS, FOLDS = 1_000_000, 2_000_000, 10, 12
#: Tokens whose estimates are held at once.
SLICE = 100_000
KEY_BITS = 52
N_BUCKETS = 33
_END, _BOS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _squeeze(a: np.ndarray) -> bytes:
    """Integers, byte planes apart, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _expand(data: bytes, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = zstandard.ZstdDecompressor().decompress(bytes(data), max_output_size=max(1, n * size))
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).ravel()


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9FB21C651E98DF25)) ^ (b + np.uint64(0xA0761D6478BD642F) + (a >> np.uint64(31)))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xE7037ED1A0B428DB)
    return x ^ (x >> np.uint64(29))


def _key(h: np.ndarray, order: int) -> np.ndarray:
    """Order in the two low bits, so that orders share one key space."""
    return (h >> np.uint64(64 - KEY_BITS)) << np.uint64(2) | np.uint64(order)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 11)
        if len(self) < 500_000:
            self[word] = h
        return h


_HASHES = _Hashes()


def fold(doc_id) -> int:
    """0 counted, 1 deleted (EM), 2 held out."""
    c = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    return 2 if c % 7 == 2 else 1 if c // 7 % FOLDS == 0 else 0


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk: its documents and token hashes, the deleted fold in chunks of its own."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple[list, list, list, list]] = [([], [], [], []), ([], [], [], [])]
        size = [0, 0]

        def flush(which: int) -> pd.DataFrame:
            nonlocal seq
            ids, folds, counts, tokens = held[which]
            uni, inverse = np.unique(np.concatenate(tokens), return_inverse=True)
            trained = int(sum(c for c, f in zip(counts, folds) if f < 2))
            counted = int(sum(c for c, f in zip(counts, folds) if f == 0))
            row = pd.DataFrame({
                "chunk": [(part << 24) + seq], "deleted": [bool(which)], "n": [size[which]], "trained": [trained], "counted": [counted],
                "docs": [len(ids)], "trained_docs": [sum(f < 2 for f in folds)], "counted_docs": [sum(f == 0 for f in folds)], "words": [len(uni)],
                "ids": [np.array([0 if i is None else i for i in ids], "<i8").tobytes()], "nulls": [np.array([i is None for i in ids], "u1").tobytes()],
                "folds": [np.array(folds, "u1").tobytes()], "counts": [np.array(counts, "<u4").tobytes()],
                "uni": [_squeeze(np.diff(uni, prepend=np.uint64(0)).astype("<u8"))], "tokens": [_squeeze(inverse.astype("<u4"))]})
            seq += 1
            held[which], size[which] = ([], [], [], []), 0
            return row

        for batch in batches:
            for key, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                key = None if key is None or key != key else int(key)
                words = byte_words(text)
                tokens = np.empty(len(words) + 1, np.uint64)
                tokens[:-1] = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
                tokens[-1] = _END
                f = fold(key)
                which = int(f == 1)
                for to, x in zip(held[which], (key, f, len(tokens), tokens)):
                    to.append(x)
                size[which] += len(tokens)
                if size[which] >= CHUNK:
                    yield flush(which)
        for which in (0, 1):
            if size[which]:
                yield flush(which)

    return docs.select("doc_id", "text").mapInPandas(make, (
        "chunk long, deleted boolean, n long, trained long, counted long, docs long, trained_docs long, counted_docs long, words long, ids binary, nulls binary, "
        "folds binary, counts binary, uni binary, tokens binary"))


class _Chunk:
    """n-grams of a chunk: keys per token and order, sorted distinct keys, and where each token's key is."""

    def __init__(self, row):
        n = int(row["n"])
        uni = np.cumsum(_expand(row["uni"], "<u8", int(row["words"])), dtype=np.uint64)
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.folds = np.frombuffer(row["folds"], "u1")
        self.begin = np.cumsum(self.counts) - self.counts
        h1 = uni[_expand(row["tokens"], "<u4", n)]
        self.first = np.zeros(n, bool)
        self.first[self.begin] = True
        self.has3 = ~self.first
        prev = np.concatenate([[_BOS], h1[:-1]])
        prev[self.first] = _BOS
        h2 = _mix(prev, h1)
        del prev
        u1, self.i1 = _distinct(_key(h1, 1))
        u2, self.i2 = _distinct(_key(h2, 2))
        h2[1:] = h2[:-1].copy()  # the bigram that ends at the previous token
        h2[:1] = 0
        h2 ^= np.uint64(0x8EBC6AF09C88C6E3)
        u3, self.i3 = _distinct(_key(_mix(h2[self.has3], h1[self.has3]), 3))  # of tokens that have a bigram before them
        del h1, h2
        self.sizes = (len(u1), len(u2), len(u3))
        merged = np.concatenate([u1, u2, u3])
        del u1, u2, u3
        self.order = np.argsort(merged, kind="stable").astype(np.uint32)
        self.keys = merged[self.order]

    def local(self, folds: tuple[int, ...]) -> np.ndarray:
        """Count of each key in documents of these folds, in key order."""
        use = np.repeat(np.isin(self.folds, folds), self.counts)
        a, b, c = self.sizes
        got = np.concatenate([np.bincount(self.i1[use], minlength=a), np.bincount(self.i2[use], minlength=b),
                              np.bincount(self.i3[use[self.has3]], minlength=c)])
        return got[self.order].astype(np.uint32)

    def per_token(self, counts: np.ndarray, docs: int) -> dict[str, np.ndarray]:
        """Counts of each token's n-grams and contexts from counts in key order; docs: documents counted."""
        back = np.empty(len(counts), np.uint32)
        back[self.order] = counts
        a, b, _ = self.sizes
        c1, c2 = back[:a][self.i1], back[a : a + b][self.i2]
        c3 = np.zeros(len(c1), np.uint32)
        c3[self.has3] = back[a + b :][self.i3]
        x2 = np.concatenate([np.zeros(1, np.int64), c1[:-1]])
        x2[self.first] = docs
        x3 = np.concatenate([np.zeros(1, np.uint32), c2[:-1]])
        x3[self.first] = 0
        return {"c1": c1, "c2": c2, "c3": c3, "x2": x2, "x3": x3}


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and where each key is among them."""
    found, at = np.unique(keys, return_inverse=True)
    return found, at.astype(np.uint32)


def _slices(t: dict[str, np.ndarray]) -> Iterator[tuple[slice, dict[str, np.ndarray]]]:
    for a in range(0, len(t["c1"]), SLICE):
        cut = slice(a, a + SLICE)
        yield cut, {k: x[cut].astype(np.float64) for k, x in t.items()}


def _estimates(t: dict[str, np.ndarray], total: float, types: float) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, estimates of order 0 to 3) per token."""
    p = np.zeros((4, len(t["c1"])))
    p[0] = 1 / (types + 1)
    if total:
        p[1] = t["c1"] / total
    np.divide(t["c2"], t["x2"], out=p[2], where=t["x2"] > 0)
    np.divide(t["c3"], t["x3"], out=p[3], where=t["x3"] > 0)
    level = lambda x: np.minimum(np.log2(np.maximum(x, 1)).astype(np.int64), 15)
    bucket = np.where(t["x3"] > 0, 17 + level(t["x3"]), np.where(t["x2"] > 0, 1 + level(t["x2"]), 0))
    return bucket, p


def _allowed() -> np.ndarray:
    """Orders that can have an estimate, by bucket."""
    ok = np.ones((N_BUCKETS, 4))
    ok[:17, 3] = 0
    ok[0, 2] = 0
    return ok


def exchange(prepared: DataFrame, buckets: int) -> DataFrame:
    """(chunk, deleted, bucket, n, total, counted, types): global counts of each chunk's keys, bucket by bucket.

    A chunk is deleted as a whole or not at all, so its own counts serve for the total and, if it is not, for the counted fold.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                c = _Chunk(row)
                keys, total = c.keys, c.local((0, 1))
                del c
                cut = np.searchsorted(keys, (np.arange(buckets + 1, dtype=np.float64) / buckets * 2.0 ** (KEY_BITS + 2)).astype(np.uint64))
                cut[-1] = len(keys)
                out = []
                for k in range(buckets):
                    a, b = int(cut[k]), int(cut[k + 1])
                    if a < b:
                        out.append((k, row["chunk"], row["deleted"], b - a, _squeeze(np.diff(keys[a:b], prepend=np.uint64(0)).astype("<u8")), _squeeze(total[a:b])))
                yield pd.DataFrame(out, columns=["bucket", "chunk", "deleted", "n", "keys", "total"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        sizes = group["n"].tolist()
        uniq, back = _distinct(np.concatenate([np.cumsum(_expand(k, "<u8", n)) for k, n in zip(group["keys"], sizes)]))
        each = np.concatenate([_expand(x, "<u4", n) for x, n in zip(group["total"], sizes)])
        total = np.bincount(back, each, len(uniq)).astype("<u4")
        each[np.repeat(group["deleted"].to_numpy(bool), sizes)] = 0
        counted = np.bincount(back, each, len(uniq)).astype("<u4")
        del each
        single = (uniq & np.uint64(3)) == 1
        types, types_counted = int((single & (total > 0)).sum()), int((single & (counted > 0)).sum())
        ends = np.cumsum(sizes)
        rows = []
        for k, (end, n, chunk, deleted) in enumerate(zip(ends, sizes, group["chunk"], group["deleted"])):
            mine = back[end - n : end]
            rows.append((chunk, deleted, group["bucket"].iloc[0], n, _squeeze(total[mine]),
                         _squeeze(counted[mine]) if deleted else b"", 0 if k else types, 0 if k else types_counted))
        return pd.DataFrame(rows, columns=["chunk", "deleted", "bucket", "n", "total", "counted", "types", "types_counted"])

    rows = prepared.mapInPandas(send, "bucket int, chunk long, deleted boolean, n long, keys binary, total binary")
    return rows.groupBy("bucket").applyInPandas(
        add, "chunk long, deleted boolean, bucket int, n long, total binary, counted binary, types long, types_counted long")


def _joined(name: str):
    def read(row, answers: pd.DataFrame) -> tuple[_Chunk, np.ndarray]:
        answers = answers.sort_values("bucket")
        return _Chunk(row), np.concatenate([_expand(x, "<u4", n) for x, n in zip(answers[name], answers["n"])])
    return read


def learn_weights(prepared: DataFrame, answers: DataFrame, total: int, docs: int, types: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights [bucket, order] by EM over the tokens of the deleted fold."""
    read = _joined("counted")

    def gather(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"n": [], "b": [], "p": []})
        chunk, counts = read(left.iloc[0], right)
        rows = []
        for _, part in _slices(chunk.per_token(counts, docs)):
            b, p = _estimates(part, total, types)
            rows.append((len(b), _squeeze(b.astype("u1")), zstandard.ZstdCompressor(level=1).compress(p[1:].astype("<f4").tobytes())))
        return pd.DataFrame(rows, columns=["n", "b", "p"])

    held = stage(prepared.where("deleted").groupBy("chunk").cogroup(answers.where("deleted").groupBy("chunk")).applyInPandas(
        gather, "n long, b binary, p binary"), "lm-heldout")
    ok = _allowed()
    weights = ok / ok.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        now = weights

        def expect(batches: Iterator[pd.DataFrame], now: np.ndarray = now) -> Iterator[pd.DataFrame]:
            sums = np.zeros((N_BUCKETS, 4))
            for batch in batches:
                for n, b, p in zip(batch["n"], batch["b"], batch["p"]):
                    bucket = _expand(b, "u1", n)
                    e = np.empty((4, n))
                    e[0] = 1 / (types + 1)
                    e[1:] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(p)), "<f4").reshape(3, n)
                    e *= now[bucket].T
                    e /= e.sum(axis=0)
                    for j in range(4):
                        sums[:, j] += np.bincount(bucket, e[j], N_BUCKETS)
            yield pd.DataFrame({"bucket": np.repeat(np.arange(N_BUCKETS), 4), "ord": np.tile(np.arange(4), N_BUCKETS), "mass": sums.ravel()})

        got = held.mapInPandas(expect, "bucket int, ord int, mass double").groupBy("bucket", "ord").agg(F.sum("mass").alias("mass"))
        mass = ok * 0.5
        for r in got.collect():  # N_BUCKETS times 4 sums
            mass[r["bucket"], r["ord"]] += r["mass"] * ok[r["bucket"], r["ord"]]
        weights = mass / mass.sum(axis=1, keepdims=True)
    unstage(held)
    return weights


def score_corpus(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    prepared = stage(chunks(docs), "lm-chunks")
    sums = prepared.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "trained", "counted", "trained_docs", "counted_docs")]).first()
    answers = stage(exchange(prepared, max(1, -(-2 * sums["n"] // BUCKET_KEYS))), "lm-counts")
    release_shuffles(docs.sparkSession)
    t = answers.agg(F.coalesce(F.sum("types"), F.lit(0)).alias("t"), F.coalesce(F.sum("types_counted"), F.lit(0)).alias("c")).first()
    types, train_tokens, train_docs = t["t"], sums["trained"], sums["trained_docs"]
    weights = learn_weights(prepared, answers, sums["counted"], sums["counted_docs"], t["c"])
    read = _joined("total")
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in names})
        row = left.iloc[0]
        chunk, counts = read(row, right)
        tokens = chunk.per_token(counts, train_docs)
        mixed, base = np.empty(len(tokens["c1"])), np.empty(len(tokens["c1"]))
        for cut, part in _slices(tokens):
            bucket, p = _estimates(part, train_tokens, types)
            mixed[cut] = np.log10((p * weights[bucket].T).sum(axis=0))
            base[cut] = np.log10((part["c1"] + 1) / (train_tokens + types + 1))
        add = lambda x: np.add.reduceat(x, chunk.begin)
        ids = np.frombuffer(row["ids"], "<i8").astype(object)
        ids[np.frombuffer(row["nulls"], "u1") == 1] = None
        return pd.DataFrame({
            "doc_id": pd.array(ids, dtype="Int64"), "held_out": chunk.folds == 2, "n_tokens": chunk.counts,
            "n_known": add((tokens["c1"] > 0).astype(np.int64)), "train_tokens": train_tokens, "base_score": add(base), "score": add(mixed)})

    return prepared.groupBy("chunk").cogroup(answers.drop("counted").groupBy("chunk")).applyInPandas(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
