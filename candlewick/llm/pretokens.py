"""Byte-level vocabularies and the cut of texts into the pieces that merges never cross.

A tokenizer file is read on the driver and broadcast as it is (a few MB whatever the corpus); each Python worker parses
it once. The cut follows the public byte-level pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

but works on whole arrays of code points: a character's kind comes from a table, pieces begin where the kind changes,
and three corrections move a start (a single space joins the next piece, the last white space before a word stands
alone, contractions keep their apostrophe).
"""

from __future__ import annotations

import functools
import itertools
import json
import sys
from collections.abc import Callable

import numpy as np
import regex

from candlewick.llm.arrow import ranges

LETTER, NUMBER, OTHER, SPACE = range(4)
# Code points with the White_Space property.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What may follow an apostrophe in a contraction, one letter and two letters.
ONE, TWO = "stmd", ("re", "ve", "ll")
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)  # odd multipliers


@functools.cache
def kinds() -> np.ndarray:
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(pattern, points):
            table[ord(points[run.start()]) : ord(points[run.end() - 1]) + 1] = kind
    table[WHITE] = SPACE
    return table


def starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """True where a piece begins. `first` is True at the first code point of each text."""
    n = len(codes)
    kind = kinds()[codes]
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    before_word = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:])
    start[before_word] = True
    start[before_word[codes[before_word] == 32] + 1] = False
    quote = np.flatnonzero(codes[:-1] == 39)
    quote = quote[start[quote] & (kind[quote + 1] == LETTER) & ~first[quote + 1]]
    if len(quote):
        after = codes[quote + 1]
        at = np.minimum(quote + 2, n - 1)
        second = np.where((quote + 2 < n) & ~first[at], codes[at], 0)
        one = np.isin(after, [ord(c) for c in ONE])
        two = np.zeros(len(quote), bool)
        for a, b in TWO:
            two |= (after == ord(a)) & (second == ord(b))
        start[quote[one | two] + 1] = False
        ends = np.concatenate([quote[one] + 2, quote[two & ~one] + 3])
        start[ends[ends < n]] = True
    return start


class Pieces:
    """Ids of texts: cuts them, looks every piece up in a bounded memory, has new pieces encoded in one call.

    `encode` gets a list of distinct pieces as bytes and returns their ids end to end and the number of ids of each.
    `added` are special strings with their ids, which are cut out of a text before anything else.
    """

    LIMIT = 250_000  # remembered pieces

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], added: dict[str, int]):
        self.encode, self.added = encode, {k.encode(): v for k, v in added.items()}
        self.cut = regex.compile(b"|".join(regex.escape(k) for k in sorted(self.added, key=len, reverse=True)))
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids, self.at, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, pieces: list[bytes], ids: np.ndarray, count: np.ndarray) -> None:
        self.index.update(zip(pieces, range(len(self.index), len(self.index) + len(pieces))))
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(count) - count])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.count = np.concatenate([self.count, count.astype(np.int64)])

    def __call__(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end as unsigned 32-bit integers, and the offset of each text in them."""
        segments, special = offsets, {}
        if self.added and any(s in data for s in self.added):
            cuts = set(offsets.tolist())
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                for found in self.cut.finditer(data[a:b]):
                    special[a + found.start()] = found.group()
                    cuts |= {a + found.start(), a + found.end()}
            segments = np.array(sorted(cuts), np.int64)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        raw = np.frombuffer(data, np.uint8)
        codes = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
        byte_at = np.flatnonzero((raw & 0xC0) != 0x80)  # where each code point begins
        first = np.zeros(len(codes), bool)
        first[np.searchsorted(byte_at, segments[segments < len(data)])] = True
        start = starts(codes, first)
        for at, text in special.items():  # a special string is one piece
            a, b = np.searchsorted(byte_at, [at, at + len(text)])
            start[a + 1 : b] = False
        begin = byte_at[start]
        end = np.append(begin[1:], len(data))
        sample, which = distinct(data, begin, end - begin)
        number = self.look_up([data[a:b] for a, b in zip(begin[sample].tolist(), end[sample].tolist())])[which]
        count = self.count[number]
        ids = self.ids[ranges(self.at[number], count)]
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[np.searchsorted(begin, offsets)]

    def look_up(self, pieces: list[bytes]) -> np.ndarray:
        if len(self.index) > self.LIMIT:
            self.clear()
        number = np.fromiter(map(self.index.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            own = np.fromiter(map(self.added.__contains__, new), bool, len(new))
            order = np.argsort(own, kind="stable")  # special strings last
            number[missing[order]] = len(self.index) + np.arange(len(new))
            plain = list(itertools.compress(new, ~own))
            self.learn(plain, *self.encode(plain))
            special = list(itertools.compress(new, own))
            self.learn(special, np.array([self.added[p] for p in special], np.uint32), np.ones(len(special), np.int64))
        return number


def distinct(data: bytes, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of each distinct piece, and for every piece the place of its own in that list.

    Pieces of up to 16 bytes are compared as two integers, after a sort by a mixture of both; longer ones, and all
    should two different pieces have the same mixture, go through a dictionary.
    """
    padded = data + bytes(16)
    word = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    short = np.flatnonzero(length <= 16)
    at, size = begin[short], length[short]
    low = word[at] & _MASK[np.minimum(size, 8)]
    high = word[np.minimum(at + 8, len(data) + 8)] & _MASK[np.maximum(size - 8, 0)]
    mixed = (low ^ (high * _MIX[0] + size.astype(np.uint64))) * _MIX[1]
    mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    key, low, high, size = mixed[order], low[order], high[order], size[order]
    same_key = key[1:] == key[:-1]
    same = same_key & (low[1:] == low[:-1]) & (high[1:] == high[:-1]) & (size[1:] == size[:-1])
    if not np.array_equal(same, same_key):
        short, order, same = short[:0], order[:0], same[:0]
    lead = np.append(np.ones(min(1, len(order)), bool), ~same)
    which = np.full(len(begin), -1)
    which[short[order]] = np.cumsum(lead) - 1
    sample = short[order[lead]]
    rest = np.flatnonzero(which < 0)
    own: dict[bytes, int] = {}
    for i, a, n in zip(rest.tolist(), begin[rest].tolist(), length[rest].tolist()):
        which[i] = len(sample) + own.setdefault(data[a : a + n], len(own))
    extra = rest[np.unique(which[rest], return_index=True)[1]]
    return np.concatenate([sample, extra]), which


def added_tokens(spec: dict) -> dict[str, int]:
    """Special strings of a tokenizer file; only those that match as they stand are supported."""
    added = {}
    for token in spec.get("added_tokens") or []:
        if token["lstrip"] or token["rstrip"] or token["single_word"]:
            raise ValueError(f"unsupported special string {token['content']!r}")
        added[token["content"]] = token["id"]
    return added


def read_spec(content: bytes) -> dict:
    """The tokenizer file, checked to be byte-level BPE without a normalizer or a prefix space."""
    spec = json.loads(content)
    cut = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space"):
        raise ValueError("a byte-level BPE tokenizer file without prefix space is needed")
    if spec.get("normalizer") or not cut.get("use_regex", True):
        raise ValueError("normalizers and a missing cut pattern are not supported")
    return spec


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
