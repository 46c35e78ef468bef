"""Column functions on lines, headings and names. All are built-in expressions; offsets are code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import rules

#: Unicode white space and the separators 1c to 1f.
SPACE = "".join(map(chr, (*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_HEADING = "(?Us)^\\s*#+\\s*(.*?)\\s*$"
_VOLUME = "^卷\\s*([0-9０-９]+|[零〇一二三四五六七八九十百千万兩]+)?([上中下abc])?$"


def let(value: Column, body) -> Column:
    """Evaluate value once and use it several times inside body (a one-element transform)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """Trim all Unicode white space."""
    return F.trim(c, F.lit(SPACE))


def normalize(c: Column) -> Column:
    """Trim, and squeeze blanks, tabs and no-break spaces."""
    line = strip(c)
    many = line.contains("  ") | line.contains("\t") | line.contains("\xa0")  # else nothing changes
    return F.when(many, F.regexp_replace(line, "[ \\t\\x{a0}]+", " ")).otherwise(line)


def is_heading(c: Column) -> Column:
    return c.rlike(_HEADING)


def heading_text(c: Column) -> Column:
    return normalize(F.regexp_extract(c, _HEADING, 1))


def is_boilerplate(c: Column) -> Column:
    line = strip(c)
    out = line == ""
    for p in rules.BOILERPLATE:
        out = out | line.startswith(p)
    return out


def review_reasons(c: Column) -> Column:
    """Reasons for review in fixed order: ocr_placeholder, url, wiki_footer, ellipsis. What a match cannot lack is looked for first."""
    line, han = strip(c), f"[{rules.HAN}]"
    placed = f"(?=[A-Z])(?:(?<={han})|^)(?:[A-F][0-9A-F]{{2,7}}|[A-Z]{{2,8}})(?:(?={han})|$)"
    dots = line.contains("…" * 5)
    found = [
        ("ocr_placeholder", (line.contains("[") & line.rlike("\\[[0-9A-F]{2,8}\\]")) | line.rlike(placed)),
        ("url", (line.contains("://") & line.rlike("https?://\\S+")) | (line.contains(":") & line.rlike("(?i)\\bReferenced:\\s*"))),
        ("wiki_footer", line.contains("{{") & line.rlike("(?i)\\{\\{footer\\b")),
        ("ellipsis", dots & ~line.rlike(han)),
    ]
    return F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in found]), lambda x: x.isNotNull())


def audit(c: Column, title: Column | None = None) -> Column:
    """struct(decision, reasons): drop, needs_review or keep. A title drops lines equal to it."""
    line = strip(c)
    boilerplate = F.lit(False)
    for p in rules.BOILERPLATE:
        boilerplate = boilerplate | line.startswith(p)
    reasons = review_reasons(c)
    pair = lambda d, r: F.struct(F.lit(d).alias("decision"), r.alias("reasons"))
    out = F.when(line == "", pair("drop", F.array(F.lit("blank")))).when(boilerplate, pair("drop", F.array(F.lit("boilerplate"))))
    if title is not None:
        out = out.when(line == title, pair("drop", F.array(F.lit("work_title"))))
    return out.when(F.size(reasons) > 0, pair("needs_review", reasons)).otherwise(pair("keep", reasons))


def numeral(c: Column) -> Column:
    """Han numeral to int: a unit without a digit counts once, digits do not concatenate, anything else is null."""
    values = F.create_map(*[F.lit(x) for kv in rules.NUMERALS.items() for x in kv])
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("digit"))

    def step(s: Column, ch: Column) -> Column:
        v = F.element_at(values, ch)
        unit = v >= 10
        total = F.when(unit, s["total"] + F.greatest(s["digit"], F.lit(1)) * v).otherwise(s["total"])
        digit = F.when(unit, F.lit(0)).otherwise(v)
        return F.struct(total.alias("total"), digit.alias("digit"))

    known = c.rlike(f"^[{''.join(rules.NUMERALS)}]+$")
    return F.when(known, F.aggregate(F.array_remove(F.split(c, ""), ""), start, step, lambda s: s["total"] + s["digit"]))


def number(c: Column) -> Column:
    """Arabic (also full-width) or Han number."""
    plain = F.translate(c, "０１２３４５６７８９", "0123456789")
    return F.when(plain.rlike("^[0-9]+$"), plain.try_cast("int")).otherwise(numeral(c))


def volume(c: Column) -> Column:
    """struct(number, part, raw) of a volume heading, or null."""
    raw = strip(c)
    n, p = F.regexp_extract(raw, _VOLUME, 1), F.regexp_extract(raw, _VOLUME, 2)
    value = F.when(n == "", F.lit(0)).otherwise(number(n))
    ok = raw.rlike(_VOLUME) & ((n != "") | (p != "")) & value.isNotNull()
    return F.when(ok, F.struct(value.alias("number"), F.translate(p, "上中下", "abc").alias("part"), raw.alias("raw")))


def volume_id(number_: Column, part: Column) -> Column:
    return F.format_string("%03d%s", number_, part)


def volume_key(v: Column) -> Column:
    """A volume as records carry it: struct(volume_number, volume_part, volume_id, volume_raw)."""
    return F.when(v.isNotNull(), F.struct(v["number"].alias("volume_number"), v["part"].alias("volume_part"),
                                          volume_id(v["number"], v["part"]).alias("volume_id"), v["raw"].alias("volume_raw")))


def volume_from_key(number_: Column, part: Column, raw: Column) -> Column:
    """The inverse of volume_key; null without a number or with an unknown part."""
    known = F.coalesce(part, F.lit(""))
    return F.when(number_.isNotNull() & known.isin("", "a", "b", "c"), F.struct(
        number_.cast("int").alias("number"), known.alias("part"), F.coalesce(raw, F.lit("")).alias("raw")))


def export_volume(c: Column) -> Column:
    """Volume as it names folders: "00" for none, digits with a part as they are, else the first digits, else parts spelled a b c."""
    digits = F.regexp_extract(c, "[0-9]+", 0)
    return (F.when(c.isNull() | (c == ""), F.lit("00")).when(c.rlike("^[0-9]+[abc]?$"), c)
            .when(digits != "", F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits))
            .otherwise(F.translate(c, "上中下", "abc")))


def person_name(c: Column, low: int = 2, high: int = 6) -> Column:
    """A usable personal name or null. Names are expected in NFC (see nfc)."""
    name = strip(c)
    bad = name.isin(*rules.PLACEHOLDERS) | name.rlike(f"^[{rules.NAME_NUMERALS}]+$")
    for s in rules.TITLE_SUFFIXES:
        bad = bad | name.endswith(s)
    return F.when(name.rlike(f"^[{rules.NAME_HAN}]{{{low},{high}}}$") & ~bad, name)


@F.pandas_udf(StringType())
def nfc(values):
    """Unicode normal form C, which Spark has no function for."""
    import unicodedata

    return values.map(lambda v: unicodedata.normalize("NFC", v) if v is not None else None)


def char_before(text: Column, start: Column) -> Column:
    return F.when(start > 0, text.substr(start, F.lit(1))).otherwise(F.lit(""))


def chars_after(text: Column, end: Column, n: int = 1) -> Column:
    return text.substr(end + 1, F.lit(n))


def _one_of(c: Column, chars: str) -> Column:
    return c.isin(*chars)


def dynasty_context(text: Column, start: Column, end: Column) -> Column:
    """A one-character dynasty needs a following cue, or a preceding one when it is not first."""
    return _one_of(chars_after(text, end), rules.DYNASTY_AFTER) | _one_of(char_before(text, start), rules.DYNASTY_BEFORE)


def short_name_context(text: Column, start: Column, end: Column) -> Column:
    """Cue before, cue after, or punctuation on both sides; an edge of the text counts as punctuation."""
    before, after = char_before(text, start), chars_after(text, end)
    marks = lambda c: _one_of(c, rules.NAME_MARKS) | (c == "")
    return _one_of(before, rules.NAME_BEFORE) | _one_of(after, rules.NAME_AFTER) | (marks(before) & marks(after))


def person_context(text: Column, start: Column, end: Column) -> Column:
    left = text.substr(F.greatest(start - 2, F.lit(1)), F.least(start, F.lit(3)))
    titled = left.rlike(f"(?:{'|'.join(rules.TITLE_BEFORE)})$")
    return short_name_context(text, start, end) | titled | _one_of(chars_after(text, end), rules.VERB_AFTER)


def priority(source: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in rules.PRIORITY.items() for x in kv])
    return F.coalesce(F.try_element_at(table, source), F.lit(rules.UNKNOWN_PRIORITY))


def submission_label(label: Column, mapping: rules.LabelMapping) -> Column:
    """The delivered label; one that the mapping lacks ends the job."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.to_submission.items() for x in kv]), label)
    miss = F.raise_error(F.concat(F.lit("no delivered label for "), F.coalesce(label, F.lit("null"))))
    return F.when(found.isNotNull(), found).otherwise(miss.cast("string"))


def sentence_features(text: Column) -> dict[str, Column]:
    return {"has_punct_end": text.rlike("[。！？!?.｡]$"), "is_long": F.length(text) > 80, "has_note": text.rlike("〈案[^〉]*〉")}


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])
