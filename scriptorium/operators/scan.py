"""Texts of an Arrow batch read at once: patterns, dictionaries and the ordered fold of what they find, on arrays.

The texts of a batch lie end to end; places are code points from the first of them. What a row-wise reader finds match by match
(candidates.spans, an automaton, merge.fold) is found here by whole arrays, in time linear in the texts and the matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

try:
    from re import _constants as _sre
    from re import _parser
except ImportError:  # then every pattern is read by Python
    _parser = None

#: Bytes of text that are read at once, and clusters under which a fold goes on one by one.
CHUNK, FEW = 1 << 20, 24
KINDS = ("same_span_label", "partial_overlap", "nested_critical", "nested_label")


def chunks(batches: Iterable[pa.RecordBatch], sizes) -> Iterator[pa.RecordBatch]:
    """Batches cut between rows so that few hold more than CHUNK bytes of text; sizes gives the bytes of a batch's rows."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        group = np.cumsum(sizes(batch)) // CHUNK
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


class Texts:
    """A column of texts end to end. first: the place of each text and the end of all; cp: their code points. Nulls are empty."""

    def __init__(self, column: pa.Array):
        self.column = column.cast(pa.string()).fill_null("")
        offsets = np.frombuffer(self.column.buffers()[1], np.int32)[self.column.offset : self.column.offset + len(column) + 1]
        raw = self.column.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        lead = (self.data & 0xC0) != 0x80
        self.before = np.zeros(len(lead) + 1, np.int32)  # characters before a byte
        np.cumsum(lead, out=self.before[1:])
        self.byte = np.append(np.flatnonzero(lead), len(lead))  # byte of a character
        self.first = self.before[offsets - offsets[0]].astype(np.int64)
        self.cp = np.frombuffer(self.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        self.quiet = not ((self.data - np.uint8(1)) < 2).any()  # no text holds the marks that patterns set
        self.row = np.repeat(np.arange(len(column), dtype=np.int32), np.diff(self.first))  # text of a character

    def rows(self, start: np.ndarray) -> np.ndarray:
        return self.row[start] if len(start) else np.zeros(0, np.int32)

    def offsets(self, start: np.ndarray) -> np.ndarray:
        """Where each text's part of sorted places begins."""
        return np.searchsorted(start, self.first, "left").astype(np.int32)

    def cut(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        """The texts of spans."""
        a, b = self.byte[start], self.byte[end]
        offsets = np.zeros(len(a) + 1, np.int32)
        np.cumsum(b - a, out=offsets[1:])
        at = np.arange(offsets[-1]) + np.repeat(a - offsets[:-1], b - a)
        return pa.StringArray.from_buffers(len(a), pa.py_buffer(offsets), pa.py_buffer(self.data[at]))


# --- patterns -----------------------------------------------------------------------------------------------------------

def _plain(parsed) -> bool:
    """Literals, classes of them, branches, groups, and repeats of what is not empty: RE2 and Python then find the same matches."""
    for op, av in parsed:
        if op in (_sre.LITERAL, _sre.NOT_LITERAL):
            ok = True
        elif op is _sre.IN:
            ok = all(x in (_sre.LITERAL, _sre.RANGE, _sre.NEGATE) for x, _ in av)
        elif op is _sre.BRANCH:
            ok = all(_plain(x) for x in av[1])
        elif op is _sre.SUBPATTERN:
            ok = not av[1] and not av[2] and _plain(av[3])
        elif op in (_sre.MAX_REPEAT, _sre.MIN_REPEAT):
            ok = (av[1] is _sre.MAXREPEAT or av[1] <= 1000) and av[2].getwidth()[0] > 0 and _plain(av[2])
        else:
            ok = False
        if not ok:
            return False
    return True


def _literals(parsed, most: int = 2000) -> list[str] | None:
    """All texts that a pattern of literals, small classes, groups and branches matches, in the order a reader prefers them."""
    out = [""]
    for op, av in parsed:
        if op is _sre.LITERAL:
            more = [chr(av)]
        elif op is _sre.IN and all(x in (_sre.LITERAL, _sre.RANGE) for x, _ in av):
            spans = [(y, y) if x is _sre.LITERAL else y for x, y in av]
            if sum(b - a + 1 for a, b in spans) > most:
                return None
            more = [chr(c) for a, b in spans for c in range(a, b + 1)]
        elif op is _sre.BRANCH:
            parts = [_literals(x, most) for x in av[1]]
            more = None if None in parts else [x for part in parts for x in part]
        elif op is _sre.SUBPATTERN and not av[1] and not av[2]:
            more = _literals(av[3], most)
        else:
            more = None
        if more is None or len(out) * len(more) > most:
            return None
        out = [x + y for x in out for y in more]
    return out


def _first(parsed) -> list[int] | None:
    """The characters that a match can begin with, if the pattern begins with a literal."""
    return [parsed[0][1]] if len(parsed) and parsed[0][0] is _sre.LITERAL else None


class Pattern:
    """A pattern. words: what it matches, if that is a short list; else RE2 reads it by the batch, where it finds what Python
    finds, and Python reads the others text by text."""

    def __init__(self, compiled: re.Pattern):
        self.compiled, self.words, self.fast, self.first = compiled, None, False, None
        if _parser is not None and compiled.flags == re.UNICODE.value:
            parsed = _parser.parse(compiled.pattern)
            words = _literals(parsed)
            self.words = list(dict.fromkeys(words)) if words and "" not in words else None
            self.fast, self.first = _plain(parsed), _first(parsed)

    def found(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of its matches, left to right; empty ones are left out."""
        if self.first is not None and not np.isin(texts.cp, self.first).any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.fast and texts.quiet:
            try:
                marked = pc.replace_substring_regex(texts.column, pattern=self.compiled.pattern, replacement="\x01\\0\x02")
            except pa.ArrowInvalid:  # RE2 does not take it
                self.fast = False
                return self.found(texts)
            raw = marked.buffers()[2]
            ends = np.frombuffer(marked.buffers()[1], np.int32)[marked.offset : marked.offset + len(marked) + 1]
            data = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None else texts.data
            at = np.flatnonzero((data - np.uint8(1)) < 2)  # marks, opening and closing by turns
            place = texts.before[at - np.arange(len(at))].astype(np.int64)
            start, end = place[::2], place[1::2]
            if (end > start).all():
                return start, end
        out = [(f + m.start(), f + m.end()) for f, t in zip(texts.first.tolist(), texts.column.to_pylist()) for m in self.compiled.finditer(t) if m.end() > m.start()]
        both = np.array(out, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


def leftmost(start: np.ndarray, end: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of occurrences those that a reader from left to right takes: the best rank at a place, none into the one before."""
    order = np.lexsort((rank, start))
    start, end = start[order], end[order]
    if len(start):
        best = np.append(True, start[1:] != start[:-1])
        start, end = start[best], end[best]
        meets = np.append(False, start[1:] < np.maximum.accumulate(end)[:-1])
        if meets.any():
            keep = np.ones(len(start), bool)
            for k in np.flatnonzero(meets).tolist():  # the last one kept is near: what it skips is in its span
                j = k - 1
                while not keep[j]:
                    j -= 1
                keep[k] = end[j] <= start[k]
            start, end = start[keep], end[keep]
    return start, end


def by_precedence(found: Iterable[tuple[np.ndarray, np.ndarray]], codes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, code) by start: matches of all patterns, in order of precedence, without those that meet an accepted match of an earlier one."""
    start, end, code = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for (a, b), c in zip(found, codes, strict=True):
        if len(start) and len(a):
            k = np.minimum(np.searchsorted(end, a, "right"), len(end) - 1)
            free = ~((end[k] > a) & (start[k] < b))
            a, b = a[free], b[free]
        if len(a):
            start, end, code = np.concatenate([start, a]), np.concatenate([end, b]), np.concatenate([code, np.full(len(a), c)])
            order = np.argsort(start, kind="stable")
            start, end, code = start[order], end[order], code[order]
    return start, end, code


# --- dictionaries -------------------------------------------------------------------------------------------------------

class Words:
    """A dictionary as arrays: states by (state, character), read for all places of the texts at once."""

    def __init__(self, words: list[str]):
        chars = sorted({c for w in words for c in w})
        known = {c: k + 1 for k, c in enumerate(chars)}
        width = len(chars) + 1
        steps: dict[int, int] = {}
        final = [0]
        for k, w in enumerate(words):
            state = 0
            for c in w:
                key = state * width + known[c]
                state = steps.get(key, 0)
                if not state:
                    state = steps[key] = len(final)
                    final.append(0)
            final[state] = k + 1
        self.width, self.final = width, np.array(final, np.int32)
        self.keys = np.array(sorted(steps), np.int64)
        self.next = np.array([steps[k] for k in self.keys.tolist()], np.int32)
        self.chars = np.array([ord(c) for c in chars], np.int64)

    def ready(self) -> None:
        """Tables that are made where they are used."""
        if hasattr(self, "table"):
            return
        top = int(self.chars.max(initial=-1)) + 2
        self.table = np.zeros(top, np.int32)
        self.table[self.chars] = np.arange(1, len(self.chars) + 1)
        self.root = np.zeros(self.width, np.int32)
        low = self.keys < self.width
        self.root[self.keys[low]] = self.next[low]
        self.dense = None
        if self.width * len(self.final) <= 1 << 20:
            self.dense = np.zeros(self.width * len(self.final), np.int32)
            self.dense[self.keys] = self.next

    def step(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        key = state.astype(np.int64) * self.width + kind
        if self.dense is not None:
            return self.dense[key]
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[k] == key, self.next[k], 0)

    def found(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, word) of all occurrences."""
        none = np.zeros(0, np.int64)
        if not len(self.keys):
            return none, none, none
        self.ready()
        kind = np.append(np.take(self.table, texts.cp, mode="clip"), 0)
        state = self.root[kind]
        at = np.flatnonzero(state)
        state, n, out = state[at], 1, []
        while len(at):
            word = self.final[state]
            hit = np.flatnonzero(word)
            if len(hit):
                a = at[hit]
                b = a + n
                inside = texts.row[a] == texts.row[b - 1]
                out.append((a[inside], b[inside], word[hit][inside] - 1))
            state = self.step(state, kind[np.minimum(at + n, len(kind) - 1)])
            on = np.flatnonzero(state)
            at, state, n = at[on], state[on], n + 1
        if not out:
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*out))


class Patterns:
    """Patterns in order of precedence and a dictionary, read together."""

    def __init__(self, compiled: list[re.Pattern], codes: list[int], more: Iterable[str] = ()):
        self.patterns, self.codes = [Pattern(p) for p in compiled], codes
        self.known = {w: k for k, w in enumerate(dict.fromkeys([w for p in self.patterns for w in p.words or ()] + list(more)))}
        self.words = Words(list(self.known))
        self.ranks = [self._rank(p.words) for p in self.patterns]

    def _rank(self, words: list[str] | None) -> np.ndarray | None:
        """The rank of each known word in a pattern's own list, -1 for others."""
        if words is None:
            return None
        out = np.full(len(self.known), -1, np.int64)
        out[[self.known[w] for w in words]] = np.arange(len(words))
        return out

    def found(self, texts: Texts) -> tuple[tuple, tuple]:
        """(start, end, code) of patterns by start, and (start, end, word) of all known words."""
        start, end, word = hits = self.words.found(texts)

        def one(p: Pattern, rank: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
            if rank is None:
                return p.found(texts)
            own = np.flatnonzero(rank[word] >= 0)
            return leftmost(start[own], end[own], rank[word[own]])

        return by_precedence((one(p, r) for p, r in zip(self.patterns, self.ranks)), self.codes), hits


# --- the fold -----------------------------------------------------------------------------------------------------------

def in_order(start: np.ndarray, end: np.ndarray, label: np.ndarray, source: np.ndarray) -> np.ndarray:
    """The order of a fold: start, longer first, label, source."""
    size = end - start
    if len(start) and start.max() < 1 << 30 and size.max() < 1 << 16 and label.max() < 1 << 8 and source.max() < 1 << 8:
        return np.argsort((start << 32) | (((1 << 16) - 1 - size) << 16) | (label << 8) | source, kind="stable")
    return np.lexsort((source, label, -size, start))


def fold(start: np.ndarray, end: np.ndarray, label: np.ndarray, fits: np.ndarray, prefers: np.ndarray, critical: np.ndarray):
    """merge.fold of many texts at once, on candidates in order at places that no two texts share.

    Gives owner (the candidate that founded the entity a candidate is part of, -1 for none), the last label and the fate
    (lives) of what each candidate founded, and conflicts as (candidate, founder, kind). A candidate that begins at or behind
    all ends before it is free whatever was accepted, so clusters of candidates that reach into each other fold side by side.
    """
    n = len(start)
    owner, final, lives = np.arange(n), label.copy(), np.ones(n, bool)
    none = np.zeros(0, np.int64)
    if n == 0:
        return owner, final, lives, (none, none, none)
    head = np.flatnonzero(np.append(True, start[1:] >= np.maximum.accumulate(end)[:-1]))
    size = np.diff(np.append(head, n))
    order = np.argsort(-size, kind="stable")
    order = order[: np.searchsorted(-size[order], -1, "left")]  # clusters of two or more
    head, size = head[order], size[order]
    last, now = head.copy(), label[head]
    clashes, r = [], 1
    while True:
        k = int(np.searchsorted(-size, -r, "left"))  # of more than r
        if k < FEW:
            break
        c, e, lc, le = head[:k] + r, last[:k], label[head[:k] + r], now[:k]
        free = (e < 0) | (start[c] >= end[e])
        same = (start[c] == start[e]) & (end[c] == end[e])
        nested = end[c] <= end[e]
        join = ~free & same & fits[lc, le]
        drop = ~free & ~join & nested & ~same & (lc == le) & ~critical[c]
        clash = ~(free | join | drop)
        owner[c] = np.where(free, c, np.where(join, e, -1))
        lb = np.where(free, lc, np.where(join, prefers[lc, le], le))
        final[e[join]] = lb[join]
        if clash.any():
            kind = np.where(same, 0, np.where(~nested, 1, np.where(lc == le, 2, 3)))[clash]
            clashes.append((c[clash], e[clash], kind))
            lives[e[clash]] = False
        last[:k] = np.where(free, c, np.where(clash, -1, e))
        now[:k] = lb
        r += 1
    rest = []
    for j in range(k):
        e, le = int(last[j]), int(now[j])
        for c in range(int(head[j]) + r, int(head[j] + size[j])):
            lc = int(label[c])
            if e < 0 or start[c] >= end[e]:
                e, le = c, lc
                continue
            same, nested = start[c] == start[e] and end[c] == end[e], end[c] <= end[e]
            if same and fits[lc, le]:
                owner[c], le = e, int(prefers[lc, le])
                final[e] = le
                continue
            owner[c] = -1
            if nested and not same and lc == le and not critical[c]:
                continue
            rest.append((c, e, 0 if same else 1 if not nested else 2 if lc == le else 3))
            lives[e] = False
            e = -1
    if rest:
        clashes.append(tuple(np.array(rest, np.int64).T))
    if not clashes:
        return owner, final, lives, (none, none, none)
    c, e, kind = (np.concatenate(x) for x in zip(*clashes))
    by = np.argsort(c, kind="stable")
    return owner, final, lives, (c[by], e[by], kind[by])
