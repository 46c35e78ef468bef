"""Deliverables: numbered sentences per work and volume, entity rows, a tree of files with a checksum manifest."""

from __future__ import annotations

import hashlib
import html
import json
import os
import shutil
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T
from . import validate as V


def numbered(sentences: DataFrame, order: list[str]) -> DataFrame:
    """sentence_id {work}_{volume}_{n} per work and volume, in corpus order; numbers count excluded sentences too."""
    n = F.row_number().over(Window.partitionBy("work_id", "volume").orderBy(*order))
    return sentences.withColumn("number", n).withColumn("sentence_id", F.format_string("%s_%s_%06d", "work_id", "volume", "number"))


def delivered_entities(mapping: rules.LabelMapping, provenance: bool = False):
    """Entities with delivered labels and offsets in the sentence, by start and end."""
    base = lambda e: [e["text"].alias("text"), T.submission_label(e["label"], mapping).alias("label"),
                      (e["start"] - F.col("start")).alias("start"), (e["end"] - F.col("start")).alias("end")]
    more = lambda e: [e[k].alias(k) for k in ("sources", "source_ids", "priority_score", "linking_candidates", "linking_status", "review_status")]
    return F.transform("entities", lambda e: F.struct(*base(e), *(more(e) if provenance else [])))


def export_rows(annotated: DataFrame, order: list[str], mode: str = "draft", mapping: rules.LabelMapping | None = None,
                pilot: DataFrame | None = None, provenance: bool = False) -> DataFrame:
    """Rows to deliver: work_id, volume, sentence_id, number, text, entities. draft takes all, pilot the pilot's sids, final the checked ones."""
    mapping = mapping or rules.LabelMapping()
    if mode not in ("draft", "pilot", "final"):
        raise ValueError("mode is draft, pilot or final")
    if mode == "final" and not mapping.confirmed:
        raise ValueError("a final delivery needs a confirmed mapping")
    if mode == "pilot" and pilot is None:
        raise ValueError("a pilot delivery needs its ids")
    rows = numbered(annotated, order)
    if mode == "pilot":
        rows = rows.join(pilot.select(F.col("sentence_id").alias("sid")).distinct(), "sid", "left_semi")
    if mode == "final":
        rows = rows.where("review_status = 'checked'").withColumn("entities", F.filter(
            "entities", lambda e: (e["review_status"] == "checked") & ~F.coalesce(e["linking_status"] == "unresolved", F.lit(False))))
    return rows.select("work_id", "volume", "sentence_id", "number", "text", delivered_entities(mapping, provenance).alias("entities"))


def with_work_ids(records: DataFrame, dimension: DataFrame) -> DataFrame:
    """Adds work_id by title; a title without one is an error."""
    known = F.broadcast(dimension.select("title", "work_id"))  # one row per work, listed in rules
    out = records.join(known, "title", "left")
    lost = out.where("work_id IS NULL").select("title").distinct().limit(5).collect()
    if lost:
        raise ValueError("no work id for " + ", ".join(repr(r["title"]) for r in lost))
    return out


def final_rows(annotated: DataFrame, order: list[str], records: DataFrame, sentences: DataFrame, entities: DataFrame,
               mapping: rules.LabelMapping, pilot: DataFrame | None = None) -> DataFrame:
    """Rows of a final delivery behind its gates: strict rules of the corpus before, rules of delivered entities after."""
    V.raise_on(V.strict_issues(records, sentences, entities, "final" if pilot is None else "pilot", pilot, mapping), "the corpus fails validation")
    rows = export_rows(annotated, order, "final", mapping)
    V.raise_on(V.invariant_issues(rows), "delivered entities break their rules")
    return rows


def manifest_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("work_id").agg(F.count_distinct("volume").alias("volumes"), F.count("*").alias("sentences"), F.sum(F.size("entities")).alias("entities"))


def built_at() -> str:
    """ISO time of SOURCE_DATE_EPOCH, or nothing: a build does not read the clock."""
    epoch = os.environ.get("SOURCE_DATE_EPOCH", "")
    return datetime.fromtimestamp(int(epoch), timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") if epoch.isdigit() else ""


def write_tree(rows: DataFrame, out_dir: str, source_sha256: str = "", mode: str = "draft") -> dict:
    """{work}/{work}_{vol}/…_seg.tsv and …_ner.json, staged and swapped in whole. Rows stream volume by volume to this machine's disk."""
    target, staging, old = Path(out_dir), Path(out_dir + ".staging"), Path(out_dir + ".old")
    shutil.rmtree(staging, ignore_errors=True)
    staging.mkdir(parents=True)
    ordered = rows.repartitionByRange("work_id", "volume").sortWithinPartitions("work_id", "volume", "number").select(
        "work_id", "volume", "sentence_id", "text", F.to_json("entities").alias("e"))
    now, seg, ner, count, volumes = None, None, None, 0, 0

    def shut() -> None:
        if seg:
            ner.write("\n]\n")
            seg.close(), ner.close()

    for r in ordered.toLocalIterator():
        key = (r["work_id"], r["volume"])
        if key != now:
            shut()
            now, volumes = key, volumes + 1
            name = f"{key[0]}_{key[1]}"
            folder = staging / key[0] / name
            folder.mkdir(parents=True)
            seg, ner, sep = (folder / f"{name}_seg.tsv").open("w", encoding="utf-8"), (folder / f"{name}_ner.json").open("w", encoding="utf-8"), "[\n"
        seg.write(f"{r['sentence_id']}\t{r['text']}\n")
        ner.write(sep + json.dumps({"sentence_id": r["sentence_id"], "sentence": r["text"], "entities": json.loads(r["e"])}, ensure_ascii=False))
        sep, count = ",\n", count + 1
    shut()
    files = {str(p.relative_to(staging)): hashlib.sha256(p.read_bytes()).hexdigest() for p in sorted(staging.rglob("*")) if p.is_file()}
    body = {"mode": mode, "built_at": built_at(), "source_corpus_sha256": source_sha256, "n_sentences": count, "n_volumes": volumes, "files": files}
    (staging / "manifest.json").write_text(json.dumps(body, ensure_ascii=False, indent=2, sort_keys=True) + "\n", "utf-8")
    shutil.rmtree(old, ignore_errors=True)
    if target.exists():
        target.rename(old)
    try:
        staging.rename(target)
    except OSError:
        if old.exists():
            old.rename(target)
        raise
    shutil.rmtree(old, ignore_errors=True)
    return body


def read_tree(spark, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """(seg(volume, pos, sentence_id, text), ner(volume, pos, sentence_id, entities as JSON strings)) of a delivered tree."""
    name = F.regexp_extract(F.url_decode("_metadata.file_name"), "^(.*)_(seg|ner)\\.", 1)
    opts = spark.read.option("recursiveFileLookup", True)
    seg = opts.option("pathGlobFilter", "*_seg.tsv").text(out_dir, wholetext=True).select(
        name.alias("volume"), F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("pos", "l")).where(F.col("l").contains("\t"))
    seg = seg.select("volume", "pos", F.split("l", "\t", 2)[0].alias("sentence_id"), F.split("l", "\t", 2)[1].alias("text"))
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_ner.json").text(out_dir, wholetext=True).select(
        name.alias("volume"), F.from_json("value", "array<struct<sentence_id:string,entities:array<string>>>").alias("x"))
    ner = raw.select("volume", F.posexplode("x").alias("pos", "s")).select("volume", "pos", "s.sentence_id", "s.entities")
    return seg, ner


def marked(text: str, entities: list[dict]) -> str:
    """A sentence as HTML with its entities marked; spans out of range or into the one before are left plain."""
    out, at = [], 0
    for e in sorted(entities, key=lambda e: (e["start"], e["end"])):
        if e["start"] < at or not 0 <= e["start"] < e["end"] <= len(text):
            continue
        out.append(html.escape(text[at : e["start"]]))
        out.append(f'<mark class="{html.escape(e["label"])}">{html.escape(text[e["start"] : e["end"]])}<sub>{html.escape(e["label"])}</sub></mark>')
        at = e["end"]
    return "".join([*out, html.escape(text[at:])])


def conflict_panel(conflicts: list[dict]) -> str:
    """Conflicts of a sentence as HTML: kind, and label, span and source of each side."""
    if not conflicts:
        return ""
    side = lambda c: html.escape(f"{c['label']} [{c['start']}, {c['end']}) {c.get('source') or '|'.join(c.get('sources') or [])}")
    rows = "".join(f"<li><b>{html.escape(c['kind'])}</b> " + " / ".join(side(x) for x in c["candidates"]) + "</li>" for c in conflicts)
    return f"<ul>{rows}</ul>"


def label_panel(present: set[str]) -> str:
    """Internal labels, in their order, marked as present or absent."""
    return "<p>" + " ".join(f'<span class="{"on" if x in present else "off"}">{x}</span>' for x in rules.INTERNAL_LABELS) + "</p>"


def page(cards: list[dict]) -> str:
    body = "".join(f"<article><h2>{html.escape(c['title'])} · {html.escape(c['sid'])}</h2><p>{marked(c['text'], c['entities'])}</p>{conflict_panel(c.get('conflicts') or [])}</article>" for c in cards)
    panel = label_panel({e["label"] for c in cards for e in c["entities"]})
    return f'<!doctype html><meta charset="utf-8"><title>Samples</title>{panel}{body}'


def snapshot(records: DataFrame, n: int = 100) -> tuple[list[str], str]:
    """Canonical JSON of the first n records by id and the digest of them."""
    rows = [r[0] for r in records.orderBy("id").limit(n).select(F.to_json(F.struct(*sorted(records.columns)))).collect()]
    return rows, hashlib.sha256("\n".join(rows).encode()).hexdigest()
