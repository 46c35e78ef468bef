"""Encoding with the `tokenizers` library through a per-process cache of words.

Both public vocabularies split text at white space before they merge, so the ids of a text are the
ids of its words in order. The cache asks the library once per distinct word. Words outside plain
Latin script, texts with unusual white space and texts that may hold a special token's string go to the
library whole. As the library does unless told otherwise, such a string in a text becomes the special id.
"""

from __future__ import annotations

import re
import struct
from operator import itemgetter

import numpy as np

from .common import hold

#: Entries of a cache before new words are encoded without being kept.
CACHE_WORDS = 500_000


def _byte_alphabet() -> dict[int, str]:
    """Byte to printable character of byte-level BPE: printable Latin-1 stands for itself, others follow from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        ids = self.make(word)
        if len(self) < CACHE_WORDS:
            self[word] = ids
        return ids

    def join(self, words: list[str]) -> bytes:
        if len(words) > 1:
            return b"".join(itemgetter(*words)(self))
        return self[words[0]] if words else b""


class Encoder:
    """ids(text) gives little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        alphabet = _byte_alphabet()
        self.alphabet = [alphabet[b] for b in range(256)]
        #: A vocabulary with word ends ignores white space; the other keeps one blank before a word.
        self.word_ends = bool(getattr(self.model, "end_of_word_suffix", None))
        self.easy = re.compile(r"[!-~¡-¬®-įı-ɏ]*")
        # Where letters and numbers mean the same to `re` as to the library: no superscript or fraction.
        self.same = re.compile(r"[!-~¡-¬®-±´-¸º»¿-įı-ɏ]*")
        if self.word_ends:
            self.units = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            self.quick = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
        else:
            self.units = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
            self.quick = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+")
        self.plain = _Cache(self._plain)
        self.after_blank = _Cache(self._after)
        self.pieces = _Cache(self._piece)

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, unit: str) -> bytes:
        mapped = unit if unit.isascii() and unit.isprintable() and " " not in unit else "".join(
            [self.alphabet[b] for b in unit.encode("utf-8")])
        ids = [t.id for t in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, word: str) -> bytes:
        bare = word[1:] if word[:1] == " " else word
        if not self.easy.fullmatch(bare):
            return self._whole(word)
        if self.word_ends:
            word = bare = word.lower()
        units = (self.quick if self.same.fullmatch(bare) else self.units).findall(word)
        pieces = self.pieces
        return pieces[units[0]] if len(units) == 1 else b"".join([pieces[u] for u in units])

    def _after(self, word: str) -> bytes:
        """A word after a blank; one that starts a line carries the newline instead."""
        if word[:1] == "\n":
            return self.pieces["\n"] + self.plain[word[1:]]
        return self._plain(" " + word)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text:
            return self._whole(text)
        odd = _odd(text)
        if self.word_ends:
            # Only ASCII white space separates here; other spaces stay inside a word, which then goes to the library.
            return self.plain.join([str(w, "utf-8") for w in text.encode("utf-8").split()] if odd else text.split())
        if odd:
            return self._whole(text)
        if text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return self._whole(text) if len(text) < 200 else b"".join(
                [self._unit(u) for u in self.units.findall(text)])
        first, *words = text.replace("\n", " \n").split(" ")
        return self.plain[first] + self.after_blank.join(words)

    def batch(self, texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of an Arrow array, end_id behind each text, and how many each has), ids as of ids().

        With word ends, words are split at ASCII's white space and each distinct word of the batch is looked up once; letters
        with at most one other character behind them, which most words are, are looked up as these two units.
        """
        import pyarrow.compute as pc

        end = struct.pack("<I", end_id)
        if not self.word_ends:
            got = [self.ids(t) + end for t in texts.to_pylist()]
            return np.frombuffer(b"".join(got), "<u4"), np.fromiter(map(len, got), np.int64, len(got)) // 4
        listed = lambda a: a.to_numpy(zero_copy_only=False).tolist()
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring(texts, "<|")
        words = pc.ascii_split_whitespace(pc.if_else(whole, "", texts))
        coded, ends = words.flatten().dictionary_encode(), words.offsets.to_numpy()[1:]
        simple = pc.match_substring_regex(coded.dictionary, _SIMPLE)
        low = pc.utf8_lower(coded.dictionary.filter(simple))
        letters = pc.utf8_rtrim(low, characters=_MARKS)
        heads = letters.dictionary_encode()
        tail = pc.utf8_slice_codeunits(low, -1).dictionary_encode()
        got = [b"", end]
        whole_texts = texts.filter(whole).to_pylist()
        first = len(coded.dictionary)
        unit = np.zeros((first + len(whole_texts) + 1, 2), np.int32)  # of each distinct word, as places in got
        simple = np.append(simple.to_numpy(zero_copy_only=False), np.zeros(len(whole_texts) + 1, bool))
        unit[simple, 0] = heads.indices.to_numpy() + len(got)
        got += [self.pieces[u] for u in listed(heads.dictionary)]
        ended = pc.not_equal(pc.binary_length(low), pc.binary_length(letters)).to_numpy(zero_copy_only=False)
        unit[simple, 1] = np.where(ended, tail.indices.to_numpy() + len(got), 0)
        got += [self.pieces[u] for u in listed(tail.dictionary)]
        others = listed(coded.dictionary.filter(~simple[:first]))
        # texts taken whole are words of their own, the last one is the end
        unit[~simple, 0] = np.append(np.arange(len(others) + len(whole_texts)) + len(got), 1)
        got += [self.plain[w] if w else b"" for w in others]
        got += [self._whole(t) for t in whole_texts]
        is_whole = whole.to_numpy(zero_copy_only=False)
        last = np.cumsum(1 + is_whole) - 1
        more = np.full(len(texts) + len(whole_texts), len(unit) - 1, np.int32)
        more[last[is_whole] - 1] = np.arange(first, len(unit) - 1)
        words = np.insert(coded.indices.to_numpy(), np.repeat(ends, 1 + is_whole), more)
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        begin, table = np.cumsum(size) - size, np.frombuffer(b"".join(got), "<u4")
        ids, upto, total = [], np.zeros(len(words), np.int64), 0
        for k in range(0, len(words), 1 << 18):  # what a word takes here is several times what it takes elsewhere
            units = unit[words[k : k + (1 << 18)]].reshape(-1)
            sizes = size[units]
            sums = np.cumsum(sizes)
            at = np.repeat(begin[units] - sums + sizes, sizes)
            at += np.arange(len(at))
            ids.append(table[at])
            np.add(sums[1::2], total, out=upto[k : k + len(sums) // 2])
            total += len(at)
        return np.concatenate(ids or [table[:0]]), np.diff(upto[ends + last], prepend=0)

    def _unit(self, unit: str) -> bytes:
        if unit.isspace():
            return self.pieces[unit]
        return self.after_blank[unit[1:]] if unit[0] == " " else self.plain[unit]


#: Printing ASCII that is no letter, and words of letters of the easy range with at most one of these behind them.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalpha())
_SIMPLE = r"^[A-Za-zÀ-ÖØ-öø-įı-ɏ]+[!-@\[-`{-~]?$"

#: White space, or characters some engines count as such, beyond blank and newline.
_ODD = re.compile(r"[^\S \n]|[\x00-\x09\x0b-\x1f\x7f-\xa0̀-￿\U00010000-\U0010ffff]")
#: Blank, newline and the printing part of Latin-1.
_LATIN = bytes([10, *range(32, 127), *range(161, 256)])


def _odd(text: str) -> bool:
    try:
        if not text.encode("latin-1").translate(None, _LATIN):
            return False
    except UnicodeEncodeError:
        pass
    return _ODD.search(text) is not None


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and process, until another operator's tasks come."""
    hold("encoders", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
