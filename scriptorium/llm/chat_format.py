"""Operator 3: chat formatting by a finite-state machine over roles and a declarative template.

The template names the states, the roles each admits, and the marks around a turn. Control strings
inside texts are escaped reversibly: one backslash goes between `<` (and backslashes after it) and
`|`, so no text can open or close a turn. Output is one row per segment: head, body, tail; the loss
mask covers the bodies of the roles the template trains on.

Conversations stream through sorted partitions; the machine keeps one state and one hash per
conversation, so a conversation of any length takes bounded memory.

Null texts are empty, null roles an empty role, null turns come first; a null conv_id is a conversation
of its own. Rows tied on turn are ordered by role and text and all kept. Turn order is validated, never
repaired: `valid` says whether the machine accepted every turn. An empty table formats to nothing;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


@dataclass(frozen=True)
class Template:
    """Declarative chat template. transitions: state -> role -> next state; a missing role is an error."""

    head: str = "<|im_start|>{role}\n"
    tail: str = "<|im_end|>\n"
    start: str = "start"
    transitions: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "opened", "user": "asked"},
        "opened": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked", "tool": "used"},
        "used": {"assistant": "answered", "tool": "used"},
    })
    final: tuple[str, ...] = ("answered",)
    loss_roles: tuple[str, ...] = ("assistant",)


_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role ends at the first newline, so its own newlines and backslashes are spelled out."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


_SEGMENTS = "conv_id long, turn_no long, segment int, text string, loss boolean, state string"


def format_segments(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, turn_no (from 0), segment (0 head, 1 body, 2 tail), text, loss, state after the turn (null: refused)."""
    ordered = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state, number = object(), None, 0
        for batch in batches:
            out = []
            for conv, role, text in zip(batch["conv_id"].tolist(), batch["role"].tolist(), batch["text"].tolist()):
                conv = None if conv is None or conv != conv else int(conv)
                if conv != last:
                    last, state, number = conv, template.start, 0
                role, text = role or "", text or ""
                state = template.transitions.get(state, {}).get(role) if state is not None else None
                out.append((conv, number, 0, template.head.format(role=escape_role(role)), False, state))
                out.append((conv, number, 1, escape(text), role in template.loss_roles, state))
                out.append((conv, number, 2, template.tail, False, state))
                number += 1
            yield pd.DataFrame(out, columns=["conv_id", "turn_no", "segment", "text", "loss", "state"]).astype({"conv_id": "Int64"})

    return ordered.mapInPandas(run, _SEGMENTS)


def read_segments(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, parsed back from its segments: turns, digests, loss text, validity."""
    before, after = template.head.split("{role}")
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no", "segment")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, row = object(), None
        for batch in batches:
            out = []
            for conv, part, text, loss, state in zip(*(batch[c].tolist() for c in ("conv_id", "segment", "text", "loss", "state"))):
                conv = None if conv is None or conv != conv else int(conv)
                if conv != last:
                    if row is not None:
                        out.append(_close(row, template))
                    last, row = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, template.start]
                row[5] += len(text)
                if part == 0:
                    role = unescape_role(text[len(before) : len(text) - len(after)])
                    row[1] += 1
                    row[6] = state
                    row[2].update(role.encode() + b"\n")
                elif part == 1:
                    plain = unescape(text)
                    row[2].update(plain.encode() + b"\n")
                    if loss:
                        row[3] += len(plain)
                        row[4].update(plain.encode())
            yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
        if row is not None:
            yield pd.DataFrame([_close(row, template)], columns=names).astype({"conv_id": "Int64"})

    return ordered.mapInPandas(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


def _close(row: list, template: Template) -> tuple:
    return (row[0], row[1], row[2].hexdigest(), row[3], row[4].hexdigest(), row[5], row[6] in template.final)


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Write the segments to shared storage and return the digests read back from there."""
    return read_segments(stage(format_segments(conversations, template), "chat-segments"), template)
