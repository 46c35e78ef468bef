"""Sentence spans: cut after a sentence end while no bracket is open."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from .. import rules

SPANS = ArrayType(StructType().add("start", IntegerType()).add("end", IntegerType()))
_SIGNS = re.compile("[" + re.escape("".join([*rules.BRACKETS, *rules.BRACKETS.values(), *rules.SENTENCE_ENDS])) + "]")


def spans(text: str) -> list[tuple[int, int]]:
    """Trimmed (start, end) of sentences. A closer deeper in the stack closes what was opened after it; an unmatched
    closer means nothing; an open bracket holds the sentence."""
    cuts, waiting = [], []
    for m in _SIGNS.finditer(text):
        sign = m[0]
        if sign in rules.BRACKETS:
            waiting.append(rules.BRACKETS[sign])
        elif sign in waiting:
            while waiting.pop() != sign:
                pass
        elif sign in rules.SENTENCE_ENDS and not waiting:
            cuts.append(m.end())
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(text)]):
        part = text[a:b]
        body = part.strip()
        if body:
            a += len(part) - len(part.lstrip())
            out.append((a, a + len(body)))
    return out


@F.pandas_udf(SPANS)
def segment(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [{"start": a, "end": b} for a, b in spans(t)] if t else [])


def sentences(records: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """One row per sentence: sid `{id}-s{n}`, idx from 1, offsets in the record, text."""
    cut = records.withColumn("__s", segment(text_col))
    return cut.select("*", F.posexplode("__s").alias("idx", "span")).drop("__s").select(
        *[F.col(c) if c != text_col else F.col(c).alias("record_text") for c in records.columns],
        F.concat(F.col(id_col).cast("string"), F.lit("-s"), F.col("idx") + 1).alias("sid"), (F.col("idx") + 1).alias("idx"),
        F.col("span.start").alias("start"), F.col("span.end").alias("end"),
        F.col(text_col).substr(F.col("span.start") + 1, F.col("span.end") - F.col("span.start")).alias("text"))
