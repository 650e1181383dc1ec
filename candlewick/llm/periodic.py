"""Periodic runs of words, found with string synchronising sets.

Words are `[^\\x20\\x09-\\x0D]+` of the whole text, numbered from 0. A run is a stretch with smallest period q whose
length is at least `EXPONENT` periods and `SHORTEST` words, and which no neighbouring word extends keeping that period.

Periods below `SMALL` come from regions that are highly periodic, seen by comparing the words with themselves, moved by
each small period. Larger ones come from dyadic scales t = 8, 16, ...: a window of t words is highly periodic if it lies
in a run, found at a smaller scale, with a period of t / 4 at most. The synchronising set of scale t holds the position i
if the smallest hash of the not highly periodic windows that start in [i, i + t] belongs to the window at i or at i + t.
That depends on the 2t words from i only (consistency), and every t neighbouring positions hold one unless all windows
there are highly periodic (density). A run with period q, t <= q < 2t, has 4q words, so one of its first t positions is in
the set, and the next position with the same 2t words is the one q words later: neighbouring positions with equal
contexts at a distance of t to 2t propose all periods of the scale. Proposals are stretched word by word, so a clash of
hashes cannot make a run.

Rows do not need each other, and nothing is shuffled. Many documents are handled side by side in one flat array of word
codes, apart from each other by codes that occur once. Null and empty texts have no words and no runs; a null doc_id is
carried; repeated rows each get a row; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.arrow import blocks, utf8
from candlewick.llm.frames import column

EXPONENT = 4
SHORTEST = 6
SMALL = 8  # periods below are looked for directly; the first scale
_BLOCK = 1 << 20  # bytes of text handled side by side; a longer text alone
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
Words = Callable[[object, list[bytes]], list[bytes]]


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _twice(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of windows twice as wide."""
    return _mix(h[:-width] * np.uint64(0x9E3779B97F4A7C15) + h[width:])


def _least(length: int) -> int:
    return max(SHORTEST, EXPONENT * length)


def _small_periods(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs with a period below SMALL."""
    found, known = [], {}
    for period in range(1, min(SMALL, len(codes))):
        same = np.zeros(len(codes) - period + 2, np.int8)
        same[1:-1] = codes[:-period] == codes[period:]
        turn = np.diff(same)
        start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1) + period
        long = end - start >= _least(period)
        for s, e in zip(start[long].tolist(), end[long].tolist()):
            if all(period % p for p in known.get((s, e), ())):
                known.setdefault((s, e), []).append(period)
                found.append((s, e, period))
    return found


def _highly_periodic(size: int, runs: list[tuple[int, int, int]], scale: int) -> np.ndarray:
    """Whether the window of `scale` words at each position lies in a run with a period of scale / EXPONENT at most."""
    turn = np.zeros(size + 1, np.int32)
    for start, end, period in runs:
        if EXPONENT * period <= scale <= end - start:
            turn[start] += 1
            turn[end - scale + 1] -= 1
    return np.cumsum(turn[:-1]) > 0


def synchronising_set(window: np.ndarray, periodic: np.ndarray, scale: int) -> np.ndarray:
    """Positions of the set, from the hash of the window of `scale` words at each position."""
    ids = np.where(periodic, _NONE, window)
    low, width = ids, 1
    while width < scale:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:-1], low[1:])  # the smallest of scale + 1 neighbouring windows
    return np.flatnonzero((low != _NONE) & ((ids[:-scale] == low) | (ids[scale:] == low)))


def _stretch(codes: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch with this period around the word at `at`, which equals the word one period later."""
    i, size = at + 1, 64
    while i + period < len(codes):
        other = codes[i + period : i + period + size]
        apart = np.flatnonzero(codes[i : i + len(other)] != other)
        if len(apart):
            i += int(apart[0])
            break
        i, size = i + len(other), min(2 * size, 1 << 16)
    end = min(i + period, len(codes))
    i, size = at, 64
    while i > 0:
        first = max(0, i - size)
        apart = np.flatnonzero(codes[first:i] != codes[first + period : i + period])
        if len(apart):
            i = first + int(apart[-1]) + 1
            break
        i, size = first, min(2 * size, 1 << 16)
    return i, end


def runs(codes: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs; `longest` is the size of the longest part that a run can lie in."""
    longest = len(codes) if longest is None else longest
    found = _small_periods(codes)
    known = {(s, e): p for s, e, p in found}
    window, scale = _mix(codes.astype(np.int64).view(np.uint64) + np.uint64(1)), 1
    while scale < SMALL and len(window) > scale:
        window, scale = _twice(window, scale), 2 * scale
    while EXPONENT * scale <= longest:
        context = _twice(window, scale)
        chosen = synchronising_set(window, _highly_periodic(len(window), found, scale), scale)
        order = np.argsort(context[chosen], kind="stable")
        place, shown = chosen[order], context[chosen][order]
        apart = np.diff(place)
        near = (shown[1:] == shown[:-1]) & (apart >= scale) & (apart < 2 * scale)
        proposed = np.stack([apart[near], place[:-1][near]])
        last, last_end = 0, 0
        for period, at in proposed[:, np.lexsort((proposed[1], proposed[0]))].T.tolist():
            if (period == last and at < last_end - period) or codes[at] != codes[at + period]:
                continue
            start, end = _stretch(codes, at, period)
            last, last_end = period, end
            smaller = known.get((start, end))
            if end - start >= _least(period) and (smaller is None or period % smaller):
                known[start, end] = period
                found.append((start, end, period))
        window, scale = context, 2 * scale
    return sorted((s, e, p) for s, e, p in found)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of one document in ten with a repeated end, where and how by crc32 of the doc_id; none for a null one."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return words[:first] + list(itertools.islice(itertools.cycle(words[first : first + period]), n - first))


def _detected(ids: list, texts: list[bytes], words_of: Words | None) -> tuple[list[list[dict]], list[str]]:
    """Runs and collapsed text of each document."""
    words = [t.split() for t in texts]  # for bytes: white space is \x20 and \x09-\x0D
    if words_of:
        words = [words_of(i, w) for i, w in zip(ids, words)]
    size = np.array([len(w) for w in words], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    codes = np.empty(int((size + 1).sum()), np.int64)
    codes[begin + size] = -1 - np.arange(len(words))  # each occurs once
    inside = np.ones(len(codes), bool)
    inside[begin + size] = False
    codes[inside] = np.fromiter(map(_Codes().__getitem__, itertools.chain.from_iterable(words)), np.int64, int(size.sum()))
    found: list[list[dict]] = [[] for _ in words]
    dropped = np.zeros(len(codes) + 1, np.int64)
    for start, end, period in runs(codes, int(size.max(initial=0))):
        doc = int(np.searchsorted(begin, start, side="right")) - 1
        found[doc].append({"start": start - int(begin[doc]), "length": end - start, "period": period})
        dropped[start + period] += 1
        dropped[end] -= 1
    gone = np.cumsum(dropped[:-1]) > 0
    collapsed = []
    for own, runs_, first in zip(words, found, begin.tolist()):
        if runs_:
            own = list(itertools.compress(own, (~gone[first : first + len(own)]).tolist()))
        collapsed.append(b" ".join(own).decode())
    return found, collapsed


def detect(docs: DataFrame, words_of: Words | None = None) -> DataFrame:
    """doc_id, runs (array of start, length, period by start and period), collapsed.

    `collapsed` holds the words that stay, joined by one space: a word goes if a run holds it after its first period.
    `words_of(doc_id, words)` may give other words for a document.
    """
    picked = docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "text").alias("text"))
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType(
        [picked.schema["doc_id"], T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in blocks(offsets, _BLOCK):
                ids = batch.column(0).slice(first, last - first)
                at = offsets[first : last + 1].tolist()
                found, collapsed = _detected(ids.to_pylist(), [data[a:b] for a, b in zip(at, at[1:])], words_of)
                columns = [ids, pa.array(found, pa.list_(RUN)), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    return picked.mapInArrow(task, schema)


def digests(found: DataFrame) -> DataFrame:
    """Per document: doc_id, n_runs, the run with the greatest exponent, hashes of all runs and of the collapsed text."""
    empty = F.struct(*(F.lit(None).cast("long").alias(n) for n in ("start", "length", "period")))
    # runs come by start and period, so the first of equal exponents is the one wanted
    above = lambda best, r: best["length"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", empty, lambda best, r: F.when(above(best, r), r).otherwise(best))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    shown = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return shown.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
