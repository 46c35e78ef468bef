"""Operator 1: token ids in binary files, packed by an adaptive context-mixing range coder.

A shard is cut into blocks of `BLOCK` ids. Blocks are coded independently: each starts from the same
empty model and carries a crc32 of its ids. All blocks of a shard run in lockstep, one numpy lane per
block, so the coder works on vectors.

Model of a lane. Ids are numbered in the order in which the block first uses them:
* order 0 predicts an id by its count in the block, and a new id by the adaptive rate of new ids; counts are taken
  in whenever the block has grown by a quarter, at every step of the first eight; until then ids first used since count 1;
* order 1 and order 2 put an adaptive part of their probability, which goes by how sure they are, on the id
  that followed the last id, or a hash of the last two, and the rest on order 0;
* the three distributions are mixed linearly; weights follow how well each predicted so far (Bayesian
  mixing with a floor).
The mixture gives the probabilities of the two guessed ids, of a new id, and of all others. A 62-bit
range coder with 32-bit words, whose carries are added at the end, codes which of them it is, then another id by its count, or a new one by
a fixed prior that falls with the id, as merges are listed by frequency.

File: header, table of documents (doc_id, null flag, ids), table of blocks (words, crc32), words.

Nulls and empty texts encode to the end id alone. A null doc_id sorts first and is kept. Repeated rows
are kept, tied doc_ids ordered by text. An empty table gives an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, open_fs, stage
from .tokenizing import encoder

BLOCK = 2048
#: Ids in a shard: 4096 lanes, whose model tables take 34 MB, and those of order 0 what their distinct ids need.
SHARD_IDS = 4096 * BLOCK
MAGIC = b"CMRC3\0\0\0"
_SLOTS = 11  # log2 of the slots of a lane in the tables of order 1, one for each id of a block, and of order 2
_ID_BITS = 20
_MASK = (1 << _ID_BITS) - 1
#: A table entry is the number of an id and, above these bits, how sure it is (0: empty, to 7).
_NUMBER_BITS = 11
_NUMBER = (1 << _NUMBER_BITS) - 1
#: What an entry gains by a wrong guess (rows 0 to 7, by how sure it is; it halves) and by a right one (8 to 15).
_GAIN = np.array([k // 2 - k for k in range(8)] + [1, 1, 1, 1, 1, 1, 1, 0], np.int16) << _NUMBER_BITS
#: Order 0 takes in what was coded since, when the block has grown by this part (a power of two).
_REFRESH = 2


class _Lanes:
    """Model state of all lanes. Ids are numbers in the block (see _numbered); update() and predict() serve coder and decoder.

    Arrays of two rows hold order 2 and order 1. Classes of an id: 0 order 2 guessed it, 1 order 1 did and order 2 did not,
    2 it is new, 3 any other.
    """

    def __init__(self, lanes: int, find: bool = False):
        """find: the lanes will have to find() ids."""
        self.lanes, self.lane, self.finds = lanes, np.arange(lanes), find
        self.tables = np.zeros(lanes * 2 << _SLOTS, np.int16)
        both = np.arange(2 * lanes).reshape(2, lanes)
        self.at, self.by8 = both << _SLOTS, both * 8
        self.adaptive = np.repeat(np.array([0.4, 0.3], np.float32), lanes * 8)
        self.weights = np.repeat(np.array([[0.4], [0.3]], np.float32), lanes, axis=1)
        self.weight0 = np.full(lanes, 0.3, np.float32)
        self.new = np.full(lanes, 0.95, np.float32)
        self.slots = np.zeros((2, lanes), np.int64)
        self.seen = np.zeros(lanes, np.int64)
        self.steps = 0
        self.count = np.zeros((lanes, 0), np.int16)
        self.since: list[np.ndarray] = []
        #: Ends of the classes 0 to 3 in 65536, from row 1 on; order-0 probabilities of what classes 0 and 1 hold, else 1.
        self.ends = np.zeros((5, lanes), np.int32)
        self.ends[4] = 65536
        self.flat_ends = self.ends.reshape(-1)
        self.zero = np.ones((4, lanes), np.float32)
        self.flat_zero = self.zero.reshape(-1)
        self.sums = np.empty((3, lanes), np.float32)
        self._refresh()

    def _refresh(self) -> None:
        """Order 0 anew: ids hold as much as they were used, those to come in the block 1 each."""
        after = min(self.steps + max(1, self.steps >> _REFRESH), BLOCK)
        top = min(int(self.seen.max()) + after - self.steps, BLOCK) + 1
        count = np.zeros((self.lanes, top), np.int16)
        count[:, : self.count.shape[1]] = self.count[:, :top]
        if self.since:
            np.add.at(count.reshape(-1), (np.array(self.since) + self.lane * top).reshape(-1), np.int16(1))
            self.since.clear()
        self.count, self.after, self.at0 = count, after, self.lane * top
        width = np.maximum(count, 1)
        starts = np.zeros((self.lanes, top), np.int16)
        np.cumsum(width[:, :-1], axis=1, dtype=np.int16, out=starts[:, 1:])
        self.starts, self.width = starts.reshape(-1), width.reshape(-1)
        if self.finds:  # the id at every place before the next refresh
            ends = np.minimum(starts + width, after)
            ends[:, 1:] -= np.minimum(starts[:, 1:], after)
            self.places = np.repeat(np.tile(np.arange(top, dtype=np.int16), self.lanes), ends.reshape(-1))
        self.total = np.full(self.lanes, max(self.steps, 1), np.float32)  # of order 0

    def place(self, at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, width) of ids x in order 0 of lanes at."""
        k = self.at0[at] + x
        return self.starts[k].astype(np.int64), self.width[k].astype(np.int64)

    def find(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Ids that hold value in order 0 of lanes at."""
        return self.places[at * self.after + value]

    def predict(self) -> None:
        if self.steps == self.after:
            self._refresh()
        self.index = self.at + self.slots
        self.entry = self.tables.take(self.index, mode="clip")
        self.guess, self.sure = self.entry & _NUMBER, self.entry >> _NUMBER_BITS
        self.state = self.by8 + self.sure
        e = self.right = self.adaptive.take(self.state, mode="clip")
        share = (1 - self.new) / self.total
        m = np.multiply(self.width.take(self.at0 + self.guess, mode="clip"), share, out=self.zero[:2])
        g = self.weights * e
        rest = 1 - g[0] - g[1]
        apart = (self.guess[0] != self.guess[1]).astype(np.float32)
        alone = g[1] * apart
        a, b, c = self.sums
        np.add(g[0] + (g[1] - alone), rest * m[0], out=a)
        np.add(a, alone + rest * m[1] * apart, out=b)
        np.add(b, rest * self.new, out=c)
        np.multiply(self.sums, 65300, out=self.sums)
        np.add(self.sums, _LEAST, out=self.ends[1:4], casting="unsafe")

    def update(self, x: np.ndarray, new: np.ndarray, at: np.ndarray) -> None:
        """x: ids; new: lanes whose id is new; at: places of the classes of x in a table of a row per class."""
        x16 = x.astype(np.int16)
        hit = self.guess == x16
        zero, to = self.flat_zero.take(at, mode="clip"), hit.astype(np.float32)
        e = self.right
        s = self.weights * ((1 - e) * zero + to * e)
        scale = np.float32(0.97) / (s[0] + s[1] + self.weight0 * zero)
        self.weights = s * scale + np.float32(0.01)
        self.weight0 = 1 - self.weights[0] - self.weights[1]
        self.adaptive[self.state.reshape(-1)] = (e * np.float32(0.94) + (to * np.float32(0.05988) + np.float32(0.00006))).reshape(-1)
        rate = max(0.02, 1 / (self.steps + 4))
        self.new = self.new * np.float32(1 - rate) + np.float32(0.001 * rate)
        self.new[new] += np.float32(0.998 * rate)
        case = self.sure + (hit.view(np.int8) << 3)
        # a wrong guess of an entry that is not sure makes room
        entry = np.where(case > 2, self.entry + _GAIN.take(case, mode="clip"), x16 | 1 << _NUMBER_BITS)
        self.tables[self.index.reshape(-1)] = entry.reshape(-1)
        self.since.append(x)
        np.bitwise_and(self.slots[1] * 45 + x, (1 << _SLOTS) - 1, out=self.slots[0])
        self.slots[1] = x
        self.seen[new] += 1
        self.total[new] += 1
        self.steps += 1


#: log2 of the total of the prior of new ids.
_TOTAL = 24


def _prior(ids: int) -> np.ndarray:
    """Starts of the ids in [0, 2**24), and the end, of the prior of new ids: it falls as 1 / (id + 512)."""
    weight = (1 << 31) // (np.arange(ids, dtype=np.int64) + 512)
    width = weight * ((1 << _TOTAL) - ids) // int(weight.sum()) + 1
    width[0] += (1 << _TOTAL) - int(width.sum())
    return np.concatenate([[0], np.cumsum(width)])


def _numbered(grid: np.ndarray) -> np.ndarray:
    """Ids of blocks (one block a row) as numbers in the order in which their block first uses them."""
    key = grid.astype(np.uint32) << 11 | np.arange(BLOCK, dtype=np.uint32)  # BLOCK is 2 ** 11
    key.sort(axis=1)  # equal ids together, the first use first
    ids = key >> 11
    begins = np.ones(grid.shape, bool)
    np.not_equal(ids[:, 1:], ids[:, :-1], out=begins[:, 1:])
    order = ((key & BLOCK - 1) + np.arange(len(grid), dtype=np.int64)[:, None] * BLOCK).reshape(-1)
    begins = begins.reshape(-1)
    firsts = order[begins]
    is_first = np.zeros(grid.size, np.int16)
    is_first[firsts] = 1
    number = np.cumsum(is_first.reshape(grid.shape), axis=1, dtype=np.int16).reshape(-1) - np.int16(1)
    out = np.empty(grid.size, np.int16)
    out[order] = np.repeat(number[firsts], np.diff(np.append(np.nonzero(begins)[0], grid.size)))
    return out.reshape(grid.shape)


#: Every class has at least 16 of 65536.
_LEAST = np.array([[16], [32], [48]], np.float32)
#: The class by (order 2 is right) + 2 (order 1 is right).
_KIND = np.array([3, 0, 1, 0])
#: low and range are of 62 bits, so that a carry is bit 32 of the word that leaves; a lane whose range is short gives one off.
_BITS = 62
#: The range that a new id needs, and how far apart values are whose id is looked up.
_SCANT, _COARSE = 1 << _TOTAL + 2, 7
_WORD, _LOW, _SHORT = (1 << 32) - 1, (1 << _BITS - 32) - 1, 1 << _BITS - 32


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a // b of numbers that are not negative; numpy divides unsigned ones faster."""
    return (a.view(np.uint64) // b.view(np.uint64)).view(np.int64)


class _Writer:
    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, (1 << _BITS) - 1, np.int64)
        self.lanes: list[np.ndarray] = []
        self.words: list[np.ndarray] = []

    def renew(self, at: np.ndarray) -> None:
        """A word leaves the lanes at."""
        low = self.low[at]
        self.lanes.append(at.astype(np.int32))
        self.words.append(low >> _BITS - 32)
        self.low[at] = (low & _LOW) << 32
        self.range[at] <<= 32

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        """Words of all lanes, lane by lane, and how many each has."""
        self.lanes.append(np.arange(len(self.low), dtype=np.int32))
        self.words.append((self.low + _LOW) >> _BITS - 32)
        lane = np.concatenate(self.lanes)
        words = np.concatenate(self.words)[np.argsort(lane.astype(np.uint16) if len(self.low) <= 1 << 16 else lane, kind="stable")]
        while (carry := words >> 32).any():
            words &= _WORD
            words[:-1] += carry[1:]
        return words.astype(np.uint32), np.bincount(lane, minlength=len(self.low))


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int], int]:
    """(words, words per block, crc32 per block, number above all ids) of a one-dimensional id array."""
    if not len(ids):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), [], 0
    if int(ids.max()) > _MASK:
        raise ValueError("an id is beyond 20 bits")
    n, above = -(-len(ids) // BLOCK), int(ids.max()) + 1
    checks = [zlib.crc32(ids[k * BLOCK : (k + 1) * BLOCK].astype("<u4").tobytes()) for k in range(n)]
    prior = _prior(above)
    flat = np.zeros(n * BLOCK, np.uint32)  # the padding of the last block is coded and dropped on reading
    flat[: len(ids)] = ids
    blocks = flat.reshape(n, BLOCK)
    steps = min(BLOCK, len(ids))
    numbers = np.empty((steps, n), np.int16)
    for k in range(0, n, 128):  # few blocks at a time, which stay at hand
        numbers[:, k : k + 128] = _numbered(blocks[k : k + 128]).T[:steps]
    model, out = _Lanes(n), _Writer(n)
    for step, x16 in enumerate(numbers):
        x = x16.astype(np.int64)
        model.predict()
        right = (model.guess == x16).view(np.int8)
        kind = _KIND.take(right[0] + (right[1] << 1), mode="clip")
        new = np.nonzero(x == model.seen)[0]
        kind[new] = 2
        at = kind * n + model.lane
        start = model.flat_ends.take(at, mode="clip").astype(np.int64)
        unit = out.range >> 16
        out.low += unit * start
        out.range = unit * (model.flat_ends.take(at + n, mode="clip") - start)
        if len(new):
            out.renew(new[out.range[new] < _SCANT])
            raw = flat[new * BLOCK + step].astype(np.int64)
            begin = prior[raw]
            unit = out.range[new] >> _TOTAL
            out.low[new] += unit * begin
            out.range[new] = unit * (prior[raw + 1] - begin)
        other = np.nonzero(kind == 3)[0]
        if len(other):
            begin, width = model.place(other, x[other])
            unit = _ratio(out.range[other], model.total[other].astype(np.int64))
            out.low[other] += unit * begin
            out.range[other] = unit * width
        out.renew(np.nonzero(out.range < _SHORT)[0])
        model.update(x, new, at)
    words, sizes = out.done()
    return words, sizes, checks, above


def unpack(words, sizes, checks, above: int, count: int) -> np.ndarray:
    """The ids that pack() got; a block that fails its checksum is an error."""
    if not count:
        return np.zeros(0, np.uint32)
    n = len(sizes)
    prior = _prior(above)
    at = np.cumsum(sizes) - sizes + 2 * np.arange(n)  # two words of zero after each lane
    stream = np.zeros(len(words) + 2 * n + 1, np.int64)
    stream[np.arange(len(words)) + 2 * np.repeat(np.arange(n), sizes)] = words
    stream = (stream[:-1] << _BITS - 32) | (stream[1:] >> 64 - _BITS)  # 62 bits from each word on
    rest, span = stream[at], np.full(n, (1 << _BITS) - 1, np.int64)  # what the code is above low
    stream &= _WORD
    at += 1

    def renew(w) -> None:
        rest[w] = rest[w] << 32 | stream.take(at[w], mode="clip")
        span[w] <<= 32
        at[w] += 1

    coarse = np.searchsorted(prior, np.arange(0, 1 << _TOTAL, 1 << _COARSE), side="right") - 1  # the id at these values
    model = _Lanes(n, find=True)
    names = np.zeros((n, BLOCK), np.uint32)  # ids by block and number
    grid = np.zeros((min(BLOCK, count), n), np.int16)
    for row in grid:
        model.predict()
        unit = span >> 16
        below = (model.ends[1:4] <= np.minimum(_ratio(rest, unit), 65535).astype(np.int32)).view(np.int8)
        kind = below[0] + below[1] + below[2]
        place = kind.astype(np.int64) * n + model.lane
        start = model.flat_ends.take(place, mode="clip").astype(np.int64)
        rest -= unit * start
        span = unit * (model.flat_ends.take(place + n, mode="clip") - start)
        x = np.where(below[0], model.guess[1], model.guess[0]).astype(np.int64)
        new = np.nonzero(kind == 2)[0]
        if len(new):
            x[new] = model.seen[new]
            renew(new[span[new] < _SCANT])
            unit = span[new] >> _TOTAL
            left = rest[new]
            value = np.minimum(_ratio(left, unit), (1 << _TOTAL) - 1)
            k = coarse[value >> _COARSE]
            while (more := prior[k + 1] <= value).any():
                k += more
            names[new, x[new]] = k
            begin = prior[k]
            rest[new] = left - unit * begin
            span[new] = unit * (prior[k + 1] - begin)
        other = np.nonzero(kind == 3)[0]
        if len(other):
            total = model.total[other].astype(np.int64)
            unit = _ratio(span[other], total)
            left = rest[other]
            y = x[other] = model.find(other, np.minimum(_ratio(left, unit), total - 1))
            begin, width = model.place(other, y)
            rest[other] = left - unit * begin
            span[other] = unit * width
        renew(np.nonzero(span < _SHORT)[0])
        row[:] = x
        model.update(x, new, place)
    ids = np.zeros((n, BLOCK), np.uint32)
    for k in range(0, n, 64):  # some lanes at a time, whose names stay at hand
        ids[k : k + 64, : len(grid)] = np.take_along_axis(names[k : k + 64], grid[:, k : k + 64].T.astype(np.int64), axis=1)
    ids = ids.reshape(-1)[:count]
    for k, check in enumerate(checks):
        if zlib.crc32(ids[k * BLOCK : (k + 1) * BLOCK].astype("<u4").tobytes()) != check:
            raise ValueError(f"block {k} fails its checksum")
    return ids


def write_shard(out, doc_ids: list, counts: list[int], ids: np.ndarray) -> None:
    words, sizes, checks, above = pack(ids)
    out.write(MAGIC + struct.pack("<IQQIIQ", above, len(doc_ids), len(ids), len(sizes), BLOCK, len(words)))
    out.write(np.asarray([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    out.write(np.asarray([d is None for d in doc_ids], "u1").tobytes())
    out.write(np.asarray(counts, "<u8").tobytes())
    out.write(np.asarray(sizes, "<u4").tobytes() + np.asarray(checks, "<u4").tobytes() + words.astype("<u4").tobytes())


def read_shard(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc_ids, ids per document, all ids)"""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    above, docs, count, blocks, block, n_words = struct.unpack_from("<IQQIIQ", data, 8)
    if block != BLOCK:
        raise ValueError("another block size")
    at = 8 + struct.calcsize("<IQQIIQ")
    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(data, kind, n, at)
        at += got.nbytes
        return got
    keys, nulls, counts = take("<i8", docs), take("u1", docs), take("<u8", docs)
    sizes, checks, words = take("<u4", blocks), take("<u4", blocks), take("<u4", n_words)
    ids = unpack(words, sizes.astype(np.int64), [int(c) for c in checks], above, count)
    return [None if z else int(k) for k, z in zip(keys, nulls)], counts.astype(np.int64), ids


def write_token_files(docs: DataFrame, out_dir: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode docs(doc_id, text) in ascending doc_id order to shard files below out_dir.

    Returns the manifest (part, seq, path, n_docs, n_ids, start), start being the ids before the shard.
    A retried or speculative task writes other names; only files of the manifest count. Range partitions
    follow doc_id, so no task sees more than its share however many rows a source has.
    """
    spark = docs.sparkSession
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        fs, base = open_fs(out_dir)
        fs.create_dir(base, recursive=True)
        keys: list = []
        counts: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def flush():
            nonlocal seq, size
            ids = np.concatenate(held)
            held.clear()
            path = f"{out_dir}/ids-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.cmrc"
            with fs.open_output_stream(open_fs(path)[1]) as out:
                write_shard(out, keys, counts, ids)
            row = pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "path": [path], "n_docs": [len(keys)], "n_ids": [len(ids)]})
            keys.clear(), counts.clear()
            seq, size = seq + 1, 0
            return row

        for batch in batches:
            ids, sizes = enc.batch(batch.column("text"), end_id)
            batch_keys, ends, done, used = batch.column("doc_id").to_pylist(), np.cumsum(sizes), 0, 0
            while done < len(sizes):
                upto = min(int(np.searchsorted(ends, used + SHARD_IDS - size)) + 1, len(sizes))  # documents until the shard is full
                held.append(ids[used : ends[upto - 1]])
                keys += batch_keys[done:upto]
                counts += sizes[done:upto].tolist()
                size += len(held[-1])
                done, used = upto, int(ends[upto - 1])
                if size >= SHARD_IDS:
                    yield flush()
        if keys:
            yield flush()

    rows = ordered.mapInArrow(write, "part long, seq long, path string, n_docs long, n_ids long")
    rows = stage(rows, "token-manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32. One task per few shards, one shard in memory."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                fs, name = open_fs(path)
                with fs.open_input_stream(name) as f:
                    keys, counts, ids = read_shard(f.read())
                data = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(counts)
                yield pd.DataFrame({
                    "doc_id": pd.array(keys, dtype="Int64"), "start": start + ends - counts, "n_tokens": counts,
                    "ids_crc32": [zlib.crc32(data[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]})

    shards = max(1, manifest.count())
    return manifest.select("path", "start").repartition(min(shards, 20_000)).mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_corpus(docs: DataFrame, tokenizer: str, end_id: int = 1, out_dir: str | None = None) -> DataFrame:
    """Write docs as token files and return what reading them back gives."""
    out = out_dir or fresh_path(docs.sparkSession, "token-files")
    return read_token_files(stage(write_token_files(docs, out, tokenizer, end_id), "token-starts"))
