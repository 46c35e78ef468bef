"""Operator 4: a deterministic sharded WARC writer, and its reader.

Records are range-sorted by page_id into shards whose bounds depend on the data alone (a histogram of
ids, not a sample, whose heavy cells are split until they are light or one id). Each shard rolls to a new file when its compressed size passes a limit. Headers,
record ids, lengths and digests are regenerated, and the date is a parameter, so equal input gives
equal bytes. Files are written under temporary names that no other attempt uses; the driver renames
those the manifest lists and then writes the manifest. A reader trusts the manifest only.

Of records with equal payloads of at least `revisit_from` bytes, that with the largest page_id is a
response and the others are revisits of it; smaller payloads are all responses. Rows that repeat
the largest page_id itself are all responses. Payloads are compared by SHA-1, groups are reduced to
one row per digest before any join, and payloads travel compressed. Record ids follow from page_id,
digest and, of rows equal in both, the place among them.

Null html is an empty payload, a null url an empty target. A null page_id sorts first; it is a response
only where all ids of its group are null. An empty table writes no file. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, hadoop, open_fs, stage, unstage

DATE = "2020-01-01T00:00:00Z"
ROLL_BYTES = 64 << 20
#: Uncompressed payload bytes per shard, and cells of the histogram that bounds shards.
SHARD_BYTES = 32 << 20
CELLS = 4096
#: Parts of a heavy cell.
SPLIT = 64


def decide(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Rows (page_id, sha1, keeper) of the revisits: those whose payload a larger page_id holds too."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keys = pages.select("page_id", F.sha1(body).alias("sha1"), F.length(body).alias("size")).where(F.col("size") >= revisit_from)
    groups = keys.groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    return keys.select("page_id", "sha1").join(groups, "sha1").where(
        ~F.col("page_id").eqNullSafe(F.col("keeper"))).select("page_id", "sha1", "keeper").distinct()


def _split(sizes: DataFrame, wide: list[tuple[int, int, int]], parts: int) -> list[tuple[int, int, int]]:
    """(first id, last id, bytes) of the parts that hold rows, of the cells in wide, which ascend."""
    first, last = (np.array([c[k] for c in wide], np.int64) for k in (0, 1))
    step = np.array([-(-(c[1] - c[0] + 1) // parts) for c in wide], np.uint64)

    @F.pandas_udf("long")
    def part(ids: pd.Series) -> pd.Series:
        v = ids.to_numpy().astype(np.int64)
        k = np.searchsorted(first, v, side="right") - 1
        inside = (k >= 0) & (v <= last[k])
        at = first[k].astype(np.uint64)
        begin = at + (v.astype(np.uint64) - at) // step[k] * step[k]
        return pd.Series(pd.arrays.IntegerArray(begin.astype(np.int64), ~inside))

    found = sizes.select(part("page_id").alias("c"), "b").where("c IS NOT NULL").groupBy("c").agg(F.sum("b").alias("b")).collect()
    out = []
    for c, b in sorted((r["c"], r["b"]) for r in found):  # at most parts rows a cell
        k = int(np.searchsorted(first, c, side="right")) - 1
        out.append((c, min(c + int(step[k]) - 1, int(last[k])), b))
    return out


def _bounds(pages: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[list[int], int]:
    """Upper bounds of the shards but the last, and how many shards. No shard is twice the goal but for rows of one id."""
    sizes = pages.where("page_id IS NOT NULL").select("page_id", (F.coalesce(F.length("html"), F.lit(0)) + 600).cast("long").alias("b"))
    sizes = stage(sizes, "warc-sizes")
    low, high, total = sizes.agg(F.min("page_id"), F.max("page_id"), F.sum("b")).first()
    if low is None:
        return [], 1
    goal = max(shard_bytes, -(-total // CELLS))
    cells, parts = [(low, high, total)], CELLS
    while wide := [c for c in cells if c[2] >= goal and c[1] > c[0]]:  # at most total / goal of them
        heavy = set(wide)
        cells = sorted([c for c in cells if c not in heavy] + _split(sizes, wide, parts))
        parts = SPLIT
    unstage(sizes)
    bounds, held = [], 0
    for k, (_, last, b) in enumerate(cells):
        if held and b >= goal:
            bounds.append(cells[k - 1][1])
            held = 0
        held += b
        if held >= goal:
            bounds.append(last)
            held = 0
    return bounds, len(bounds) + 1


def record(page_id, url, payload: bytes, sha1: str, keeper, revisit: bool, copy: int = 0) -> bytes:
    """One gzip member holding one WARC record; copy counts rows of the same page_id and digest."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()

    def name(p, k=0) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{p}:{sha1}:{k}')}>"

    body = b"" if revisit else payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id, copy)}",
             f"WARC-Date: {DATE}", "WARC-Target-URI: " + " ".join((url or "").split()),
             f"WARC-Payload-Digest: {digest}", "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode(),
             f"X-Page-ID: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {name(keeper)}", f"X-Refers-To-Page: {keeper}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    data = "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_warc(pages: DataFrame, out_dir: str, revisit_from: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write archives below out_dir, commit them, return the manifest (shard, seq, name, records, bytes, sha256)."""
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", "html")
    bounds, shards = _bounds(pages)

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import bisect

        for batch in batches:
            raw = [(h or "").encode("utf-8") for h in batch["html"].tolist()]
            ids = [None if p is None or p != p else int(p) for p in batch["page_id"].tolist()]
            yield pd.DataFrame({
                "page_id": pd.array(ids, dtype="Int64"), "url": batch["url"], "sha1": [hashlib.sha1(b).hexdigest() for b in raw],
                "body": [zlib.compress(b, 1) for b in raw],
                "shard": [0 if p is None else bisect.bisect_left(bounds, p) for p in ids]})

    small = pages.mapInPandas(shrink, "page_id long, url string, sha1 string, body binary, shard int")
    seen = decide(pages, revisit_from)
    rows = small.join(seen.select("page_id", "sha1", "keeper", F.lit(True).alias("revisit")).withColumnRenamed("page_id", "p").withColumnRenamed("sha1", "s"),
                      F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha1") == F.col("s")), "left").drop("p", "s")
    rows = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "page_id", "sha1", "url")
    temporary = f"{out_dir}/_temporary"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = open_fs(temporary)
        fs.create_dir(base, recursive=True)
        now, before, copy = None, None, 0

        def shut() -> pd.DataFrame:
            now["out"].close()
            return pd.DataFrame([(now["shard"], now["seq"], now["temp"], now["records"], now["bytes"], now["sha"].hexdigest())],
                                columns=["shard", "seq", "temp", "records", "bytes", "sha256"])

        for batch in batches:
            for shard, page, url, sha1, body, keeper, revisit in zip(*(batch[c].tolist() for c in (
                    "shard", "page_id", "url", "sha1", "body", "keeper", "revisit"))):
                if now and (now["shard"] != shard or now["bytes"] >= roll_bytes):
                    seq = now["seq"] + 1 if now["shard"] == shard else 0
                    yield shut()
                    now = None
                else:
                    seq = 0
                if now is None:
                    temp = f"{shard:06d}-{seq:05d}-{uuid.uuid4().hex}.warc.gz"
                    now = {"shard": shard, "seq": seq, "temp": temp, "records": 0, "bytes": 0, "sha": hashlib.sha256(),
                           "out": fs.open_output_stream(f"{base}/{temp}", compression=None)}
                page = None if page is None or page != page else int(page)
                keeper = None if keeper is None or keeper != keeper else int(keeper)
                copy = copy + 1 if before == (page, sha1) else 0
                before = (page, sha1)
                data = record(page, url, zlib.decompress(body), sha1, keeper, revisit is True or revisit == 1, copy)
                now["out"].write(data)
                now["sha"].update(data)
                now["records"] += 1
                now["bytes"] += len(data)
        if now:
            yield shut()

    manifest = stage(rows.mapInPandas(write, "shard int, seq int, temp string, records long, bytes long, sha256 string"), "warc-manifest")
    name = F.format_string("part-%06d-%05d.warc.gz", "shard", "seq")
    fs, _ = hadoop(spark, out_dir)
    path = spark._jvm.org.apache.hadoop.fs.Path

    def commit(r) -> None:
        if not fs.rename(path(f"{temporary}/{r['temp']}"), path(f"{out_dir}/{r['name']}")):
            raise OSError(f"cannot commit {r['name']}")

    files = manifest.select("temp", name.alias("name")).toLocalIterator()  # one row per file
    with ThreadPoolExecutor(16) as pool:
        while some := list(islice(files, 1000)):
            list(pool.map(commit, some))
    fs.delete(path(temporary), True)
    done = manifest.select("shard", "seq", name.alias("name"), "records", "bytes", "sha256")
    done.write.parquet(f"{out_dir}/_manifest")
    return spark.read.schema(done.schema).parquet(f"{out_dir}/_manifest")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of each gzip member."""
    z, held = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            held.append(z.decompress(chunk))
            if not z.eof:
                break
            chunk = z.unused_data
            head, _, body = b"".join(held).partition(b"\r\n\r\n")
            pairs = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
            yield pairs, body[: int(pairs["Content-Length"])]
            z, held = zlib.decompressobj(31), []


def read_warc(out_dir: str, manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record; digests of responses are verified."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for name in batch["name"]:
                fs, path = open_fs(f"{out_dir}/{name}")
                rows = []
                with fs.open_input_stream(path, compression=None) as f:
                    for h, body in read_records(f):
                        digest, kind = h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"]
                        if kind == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                            raise ValueError(f"{name}: a payload fails its digest")
                        size = len(body) if kind == "response" else int(h["X-Payload-Length"])
                        rows.append((int(h["X-Page-ID"]) if h.get("X-Page-ID") else None, size, digest, kind,
                                     int(h["X-Refers-To-Page"]) if "X-Refers-To-Page" in h else None))
                        if len(rows) >= 10_000:
                            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
                            rows = []
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    files = max(1, manifest.count())
    return manifest.select("name").repartition(min(files, 20_000)).mapInPandas(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive(pages: DataFrame, revisit_from: int = 0, out_dir: str | None = None) -> DataFrame:
    """Write all pages as WARC files and return what the files hold."""
    out = out_dir or fresh_path(pages.sparkSession, "warc")
    return read_warc(out, write_warc(pages, out, revisit_from))
