"""Entity candidates of sentences: patterns, and dictionaries of any size. Every source gives the same columns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa

try:
    import ahocorasick
except ModuleNotFoundError:  # dictionaries then always join
    ahocorasick = None
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T
from . import scan as A

COLUMNS = ("sid", "text", "label", "start", "end", "source", "source_id", "priority_score", "matched_alias", "linking_candidates", "linking_status")
#: Rows up to which a dictionary is broadcast; a larger one joins by shuffle.
BROADCAST_TERMS = 500_000
#: Characters of a text per dictionary block, characters kept before a match, matches per Arrow batch.
BLOCK, BEFORE, BATCH_ROWS = 4096, 3, 50_000


class Source(Protocol):
    """A plug-in that finds candidates in sentences(sid, text, ...)."""

    name: str
    kind: str

    def available(self) -> bool: ...

    def candidates(self, sentences: DataFrame) -> DataFrame: ...


def _shape(df: DataFrame, source: str, source_id: Column | None = None, alias: Column | None = None,
           links: Column | None = None, status: Column | None = None) -> DataFrame:
    null = lambda kind: F.lit(None).cast(kind)
    return df.select(
        "sid", F.col("match").alias("text"), "label", "start", "end", F.lit(source).alias("source"),
        (source_id if source_id is not None else null("string")).alias("source_id"),
        F.lit(rules.PRIORITY.get({"cbdb": "kb", "chgis": "kb"}.get(source, source), rules.UNKNOWN_PRIORITY)).alias("priority_score"),
        (alias if alias is not None else null("string")).alias("matched_alias"),
        (links if links is not None else F.array().cast("array<string>")).alias("linking_candidates"),
        (status if status is not None else null("string")).alias("linking_status"))


def _compiled(patterns: tuple[tuple[str, str], ...]) -> list[tuple[str, re.Pattern]]:
    """Patterns are written for the JVM; code points as \\x{...} become characters."""
    plain = lambda p: re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), p)
    return [(label, re.compile(plain(p))) for label, p in patterns]


def spans(text: str, compiled: list[tuple[str, re.Pattern]]) -> Iterator[tuple[str, int, int]]:
    """(label, start, end) in order of precedence; a match that meets an accepted one is dropped. Linear in the text."""
    taken = bytearray(len(text))
    for label, p in compiled:
        for m in p.finditer(text):
            a, b = m.span()
            if a < b and taken.find(1, a, b) < 0:
                taken[a:b] = b"\1" * (b - a)
                yield label, a, b


def pattern_candidates(sentences: DataFrame, patterns: tuple[tuple[str, str], ...] = rules.PATTERNS) -> DataFrame:
    """Matches in order of precedence; a match that overlaps an accepted one is dropped. Row-local, null texts have none.

    Array expressions for this are quadratic in the matches of a text (offsets by `locate`, overlaps by `exists`); a
    sentence without punctuation can be a whole document, so the texts of Arrow batches are read at once (scan), in linear time.
    """
    compiled = _compiled(patterns)
    names = pa.array([label for label, _ in compiled], pa.string())
    reader = sentences.sparkSession.sparkContext.broadcast(A.Patterns([p for _, p in compiled], list(range(len(compiled)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches, lambda b: A.text_bytes(b.column(1))):
            texts = A.Texts(batch.column(1))
            (start, end, code), _ = reader.value.found(texts)
            row = texts.rows(start)
            at = texts.first[row]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), names.take(pa.array(code)), pa.array((start - at).astype("int32")), pa.array((end - at).astype("int32")),
                 texts.cut(start, end)], names=["sid", "label", "start", "end", "match"])

    kind = sentences.schema["sid"].dataType.simpleString()
    hits = sentences.select("sid", F.col("text")).mapInArrow(run, f"sid {kind}, label string, start int, end int, match string")
    return _shape(hits, "regex")


def dictionary_matches(sentences: DataFrame, terms: DataFrame, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """All occurrences of terms(term, ...) in sentences, overlaps included; repeated terms match repeatedly.

    Instead of the text a match carries `near`, the match with BEFORE characters before it and one after it, and `pos`, its
    place there. A dictionary of at most broadcast_terms distinct terms goes to every worker as an automaton that reads a text
    once; a larger one meets the texts' substrings in a shuffle join (see _by_join).
    """
    own = terms.where("term <> ''")
    words = own.select("term").distinct()
    few = words.limit(broadcast_terms + 1).toArrow()["term"].to_pylist()  # bounded
    if ahocorasick is None or len(few) > broadcast_terms:
        return _by_join(sentences, own, broadcast_terms)
    hits = _by_automaton(sentences, sorted(few))
    return hits.join(F.broadcast(own), F.col("match") == F.col("term")).drop("term")


def _by_automaton(sentences: DataFrame, words: list[str]) -> DataFrame:
    keep = [c for c in sentences.columns if c != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in sentences.select(*keep).schema] + ["start int", "end int", "pos int", "near string", "match string"])
    held = sentences.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for w in held.value:
            machine.add_word(w, len(w))
        machine.make_automaton()

        def flush(batch: pa.RecordBatch, rows: list[int], found: list[tuple]) -> pa.RecordBatch:
            at = pa.array(rows, pa.int32())
            start, end, pos, near, match = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [batch.column(k).take(at) for k in range(len(keep))] + [pa.array(x, pa.int32()) for x in (start, end, pos)]
                + [pa.array(near, pa.string()), pa.array(match, pa.string())], names=[*keep, "start", "end", "pos", "near", "match"])

        for batch in batches:
            rows, found = [], []
            for k, text in enumerate(batch.column(len(keep)).to_pylist()):
                if not text or not held.value:
                    continue
                for last, n in machine.iter(text):
                    b = last + 1
                    a = b - n
                    lead = min(a, BEFORE)
                    rows.append(k)
                    found.append((a, b, lead, text[a - lead : b + 1], text[a:b]))
                    if len(rows) >= BATCH_ROWS:
                        yield flush(batch, rows, found)
                        rows, found = [], []
            if rows:
                yield flush(batch, rows, found)

    return sentences.select(*keep, "text").mapInArrow(run, schema)


def _by_join(sentences: DataFrame, own: DataFrame, broadcast_terms: int) -> DataFrame:
    """Texts are cut into blocks of characters, blocks into substrings of the lengths that terms have, and these are joined by
    equality: linear in the text, and no row holds more than a block."""
    sizes = sorted(r[0] for r in own.select(F.length("term")).distinct().collect())  # lengths, not terms
    side = F.broadcast(own) if own.count() <= broadcast_terms else own
    keep = [c for c in sentences.columns if c != "text"]
    reach = BLOCK + BEFORE + max(sizes, default=0)
    blocks = T.let(F.split("text", ""), lambda ch: F.transform(
        F.sequence(F.lit(0), F.size(ch) - 1, F.lit(BLOCK)),
        lambda at: F.struct(at.alias("__at"), F.slice(ch, F.greatest(at - BEFORE, F.lit(0)) + 1, F.lit(reach)).alias("__ch"))))
    none = F.array().cast("array<struct<start:int,end:int,pos:int,near:string>>")
    cuts = F.flatten(F.array(*[_cut(n) for n in sizes])) if sizes else none
    pieces = sentences.where(F.length("text") > 0).select(*keep, F.inline(blocks)).select(*keep, F.inline(cuts))
    return pieces.withColumn("match", F.substring("near", F.col("pos") + 1, F.col("end") - F.col("start"))).join(
        side, F.col("match") == F.col("term")).drop("term")


def _cut(n: int) -> Column:
    """Substrings of n characters that start in the block itself (what is before belongs to the block before)."""
    ch, at = F.col("__ch"), F.col("__at")
    lead = F.least(at, F.lit(BEFORE))
    last = F.least(lead + BLOCK - 1, F.size(ch) - n)

    def one(i: Column) -> Column:
        pos = F.least(i, F.lit(BEFORE))
        start = at - lead + i
        return F.struct(start.alias("start"), (start + n).alias("end"), pos.alias("pos"),
                        F.array_join(F.slice(ch, i - pos + 1, pos + n + 1), "").alias("near"))

    none = F.array().cast("array<struct<start:int,end:int,pos:int,near:string>>")
    return F.when(last >= lead, F.transform(F.sequence(lead, F.greatest(last, lead)), one)).otherwise(none)


def seed_terms(spark: SparkSession, extra: list[tuple[str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame([*rules.seeds(), *(extra or [])], "term string, label string")


def _place() -> tuple[Column, Column, Column]:
    """A match inside its surroundings."""
    return F.col("near"), F.col("pos"), F.col("pos") + F.length("match")


def seed_candidates(sentences: DataFrame, terms: DataFrame) -> DataFrame:
    """Gazetteer matches; a one-character dynasty or polity needs its context."""
    hits = dictionary_matches(sentences.select("sid", F.col("text")), terms)
    short = F.col("label").isin("DYNASTY", "POLITY") & (F.length("match") == 1)
    hits = hits.where(~short | T.dynasty_context(*_place()))
    return _shape(hits, "seed", F.concat(F.lit("seed:"), F.col("match")))


def period_people(people: Column, period: Column, policy: str, context: Column) -> Column:
    """People that a period admits. people: array of struct(person_id, dynasty)."""
    if policy not in ("off", "prefer", "strict"):
        raise ValueError("period policy is off, prefer or strict")
    if policy == "off":
        return people
    table = F.create_map(*[x for k, v in rules.PERIOD_CODES.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in v]))])
    codes = F.try_element_at(table, period)
    fits = F.filter(people, lambda p: F.array_contains(codes, p["dynasty"]))
    none = F.filter(people, lambda p: F.lit(False))
    other = none if policy == "strict" else F.when(context, people).otherwise(none)
    return F.when(codes.isNull(), people).when(F.size(fits) > 0, fits).otherwise(other)


def person_candidates(sentences: DataFrame, surfaces: DataFrame, short_names: str = "exclude", period_policy: str = "strict") -> DataFrame:
    """Persons by surface(name, people). Two-character names are excluded, kept in context, or all kept."""
    if short_names not in ("exclude", "context", "all"):
        raise ValueError("short names are exclude, context or all")
    base = sentences.select("sid", "text", *(["period"] if "period" in sentences.columns else [F.lit(None).cast("string").alias("period")]))
    hits = dictionary_matches(base, surfaces.select(F.col("name").alias("term"), "people"))
    place = _place()
    if short_names != "all":
        hits = hits.where((F.length("match") != 2) | (T.short_name_context(*place) if short_names == "context" else F.lit(False)))
    hits = hits.withColumn("people", period_people(F.col("people"), F.col("period"), period_policy, T.person_context(*place))).where("size(people) > 0")
    ids = F.transform(F.array_sort(F.transform("people", lambda p: p["person_id"])), lambda i: F.concat(F.lit("cbdb:"), i.cast("string")))
    hits = hits.withColumn("ids", ids).withColumn("label", F.lit("PERSON"))
    return _shape(hits, "cbdb", F.when(F.size("ids") == 1, F.col("ids")[0]), F.col("match"), F.col("ids"),
                  F.when(F.size("ids") == 1, "linked").otherwise("ambiguous"))


def place_candidates(sentences: DataFrame, places: DataFrame) -> DataFrame:
    """Places(place_id, name) by surface, grouped per span."""
    grouped = places.groupBy(F.col("name").alias("term")).agg(F.array_sort(F.collect_set("place_id")).alias("ids"))
    hits = dictionary_matches(sentences.select("sid", "text"), grouped).withColumn("label", F.lit("LOCATION"))
    return _shape(hits, "chgis", F.col("ids")[0], F.col("match"), F.col("ids"), F.when(F.size("ids") > 1, "ambiguous").otherwise("resolved"))
