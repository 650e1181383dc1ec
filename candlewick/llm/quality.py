"""Quality rules: n-gram logistic regression on labelled rows, calibrated, with fixed thresholds.

Statistics of a whole text, all exact: words `[^\x20\x09-\x0D]+`, code points in words, symbols `[#*$%&|<>]`, lines
with a word that equal an earlier line, words in three-word windows that occur twice or more. A text fails the base
rules with under 50 words or over half of its words in repeated windows.

Model: word 1- and 2-grams and character 2- to 4-grams are hashed into `BUCKETS` weights for each kind; a kind's value
for a text is the mean weight of its n-grams, so long and short texts compare. Weights are fitted with numpy on at most
`SAMPLE` labelled rows (the smallest hashes of doc_id, half from each class), on four of five rows; a logistic curve
fitted to the held-out scores of the fifth turns scores into probabilities. Only the sample's n-gram counts
come to the driver, and only the weights go to the executors; both are bounded by the parameters. Texts are scored in
Arrow batches, and a row is kept if it passes the base rules and its probability of good quality reaches `THRESHOLD`.

Null text has no words and fails the base rules. Rows of null doc_id are scored, but never serve as labelled rows;
conflicting labels of one doc_id count as bad. Without labels of both classes the base rules decide alone. Repeated
rows each get their result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.arrow import blocks, sums, utf8
from candlewick.llm.frames import column
from candlewick.llm.pretokens import distinct

BUCKETS = 1 << 15  # weights of each kind of n-gram
KINDS = 5
SAMPLE = 1200  # labelled rows to fit on, at most
THRESHOLD = 0.5  # probability of good quality from which a row is kept
MIN_WORDS, MOST_REPEATED = 50, 50  # words; percent of words in repeated windows
BLOCK = 1 << 20  # bytes of text in one numpy batch
SYMBOLS = "#*$%&|<>"
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)  # odd multipliers
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Block:
    """Texts end to end: words, their owners, and what the statistics and the features need of them."""

    def __init__(self, data: bytes, offsets: np.ndarray):
        self.data, self.offsets, self.rows = data, offsets, len(offsets) - 1
        raw = np.frombuffer(data, np.uint8)
        white = _WHITE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        inside = ~white
        begins = inside.copy()
        begins[1:] &= white[:-1] | edge[1:-1]
        ends = inside.copy()
        ends[:-1] &= white[1:] | edge[1:-1]
        self.begin, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.raw, self.inside = raw, inside
        self.word_at = np.searchsorted(self.begin, offsets)  # first word of each text
        self.owner = np.repeat(np.arange(self.rows), np.diff(self.word_at))
        self.same, self.word = distinct(data, self.begin, self.end - self.begin)

    def repeated(self) -> np.ndarray:
        """Words of each text in three-word windows found twice or more in it."""
        n = len(self.word)
        marked = np.zeros(n, bool)
        if n >= 3:
            at = np.flatnonzero(self.owner[2:] == self.owner[:-2])
            kinds = len(self.same)
            pair = self.word[at] * kinds + self.word[at + 1]
            if kinds >= 1 << 21:  # three numbers would not fit: number the pairs first
                pair = np.unique(pair, return_inverse=True)[1]
            order = np.argsort(pair * kinds + self.word[at + 2], kind="stable")
            key, place = (pair * kinds + self.word[at + 2])[order], at[order]
            equal = (key[1:] == key[:-1]) & (self.owner[place[1:]] == self.owner[place[:-1]])
            hit = np.append(equal, False) | np.append(False, equal)
            for step in range(3):
                marked[place[hit] + step] = True
        return sums(marked, self.word_at)

    def dup_lines(self) -> list[int]:
        found = []
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            lines = [line for line in self.data[a:b].split(b"\n") if line.strip()]
            found.append(len(lines) - len(set(lines)))
        return found

    def statistics(self) -> dict[str, np.ndarray]:
        point = (self.raw & 0xC0) != 0x80
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS.encode())] = True
        return {
            "n_words": np.diff(self.word_at),
            "word_chars": sums(point & self.inside, self.offsets),
            "n_symbols": sums(symbol[self.raw], self.offsets),
            "n_dup_lines": np.array(self.dup_lines(), np.int64),
            "n_repeat_words": self.repeated(),
        }

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each kind of n-gram: its number, the bucket of the n-gram at each place (those that would cross into
        the next text included), and the place of each text's first n-gram and their number."""
        codes = np.frombuffer(self.data.decode("utf-8").encode("utf-32-le"), np.uint32)
        point = np.flatnonzero((self.raw & 0xC0) != 0x80)
        word = np.zeros(0, np.uint32)
        if len(self.begin):
            first, last = np.searchsorted(point, self.begin), np.searchsorted(point, self.end)
            length = np.diff(np.append(np.append(0, first), len(codes)))
            within = np.arange(len(codes)) - np.repeat(np.append(0, first), length)
            power = np.cumprod(np.full(int((last - first).max()) + 1, _ODD[0], np.uint32), dtype=np.uint32)
            term = codes * power[np.minimum(within, len(power) - 1)]
            total = np.concatenate([np.zeros(1, np.uint32), np.cumsum(term, dtype=np.uint32)])
            word = total[last] - total[first]
        yield from self._windows(0, word, self.word_at, (1, 2))
        yield from self._windows(2, codes, np.searchsorted(point, self.offsets), (2, 3, 4))

    def _windows(self, kind: int, values: np.ndarray, at: np.ndarray, sizes: tuple[int, ...]):
        hashed = np.zeros(len(values), np.uint32)
        for step in range(sizes[-1]):
            n = max(len(values) - step, 0)
            hashed = hashed[:n] + (values[step:] + np.uint32(1)) * _ODD[step]
            if step + 1 in sizes:
                bucket = (hashed ^ (hashed >> np.uint32(15))) * _ODD[-1] >> np.uint32(33 - BUCKETS.bit_length())
                yield kind + sizes.index(step + 1), bucket, np.minimum(at[:-1], n), np.maximum(np.diff(at) - step, 0)


class Model:
    """Weights by kind and bucket, and the calibration of their sum."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def scores(self, block: Block) -> np.ndarray:
        score = np.full(block.rows, self.bias)
        for kind, bucket, at, count in block.grams():
            total = np.concatenate([[0.0], np.cumsum(self.weights[kind][bucket], dtype=float)])
            score += (total[at + count] - total[at]) / np.maximum(count, 1)
        return score

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -60, 60)))


def _fit_line(score: np.ndarray, label: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Logistic regression on one value by Newton steps, towards smoothed labels so that it stays finite."""
    good, bad = label.sum(), (1 - label).sum()
    aim = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([score, np.ones(len(score))], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hessian, x.T @ (p - aim)), -5, 5)
    return float(w[0]), float(w[1])


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], steps: int = 120, rate: float = 0.5, decay: float = 1e-4) -> Model | None:
    """`rows`: feature numbers, their values and the label of each labelled text."""
    label = np.array([y for _, _, y in rows], float)
    if len(set(label)) < 2:
        return None
    at = np.concatenate([[0], np.cumsum([len(i) for i, _, _ in rows])])
    index = np.concatenate([i for i, _, _ in rows])
    value = np.concatenate([v for _, v, _ in rows])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(at))
    held = np.arange(len(rows)) % 5 == 4
    if len(set(label[held])) < 2 or len(set(label[~held])) < 2:
        held = np.zeros(len(rows), bool)
    share = np.where(label > 0, 1 / label.sum(), 1 / (1 - label).sum()) * ~held  # both classes weigh the same
    share /= share.sum()
    weight, bias, seen, seen_bias = np.zeros(KINDS * BUCKETS), 0.0, np.full(KINDS * BUCKETS, 1e-8), 1e-8
    linear = lambda: np.bincount(owner, weight[index] * value, len(rows)) + bias
    for _ in range(steps):  # full-batch steps with a rate of its own for each weight
        error = share * (1 / (1 + np.exp(-np.clip(linear(), -30, 30))) - label)
        slope = np.bincount(index, error[owner] * value, len(weight)) + decay * weight / len(rows)
        seen += slope**2
        weight -= rate * slope / np.sqrt(seen)
        seen_bias += error.sum() ** 2
        bias -= rate * error.sum() / np.sqrt(seen_bias)
    score = linear()
    test = held if held.any() else np.ones(len(rows), bool)
    return Model(weight.reshape(KINDS, BUCKETS).astype(np.float32), bias, *_fit_line(score[test], label[test]))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, label, text) -> (key, label, feature numbers, values): the n-gram counts of each text as shares."""
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        for first, last in blocks(offsets, BLOCK):
            block = Block(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            index, value = [[] for _ in range(block.rows)], [[] for _ in range(block.rows)]
            for kind, bucket, at, number in block.grams():
                for row, (a, n) in enumerate(zip(at.tolist(), number.tolist())):
                    count = np.bincount(bucket[a : a + n], minlength=1)
                    found = np.flatnonzero(count)
                    index[row].append(found.astype(np.int32) + kind * BUCKETS)
                    value[row].append((count[found] / max(n, 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.slice(first, last - first).columns[:2],
                    pa.array([np.concatenate(i).tobytes() for i in index], pa.binary()),
                    pa.array([np.concatenate(v).tobytes() for v in value], pa.binary()),
                ],
                names=["key", "label", "features", "shares"],
            )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model from a bounded sample of the labelled rows among `docs`."""
    judged = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    judged = judged.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    known = judged.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("key", F.md5(F.col("doc_id").cast("string")))
    parts = [known.where(F.col("label") == y).orderBy("key").limit(sample // 2) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    # rows of one doc_id are one labelled text, the smallest, so that repeats push nobody out
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("key", "label").agg(F.min("text").alias("text"))
    made = texts.mapInArrow(_features, "key string, label int, features binary, shares binary")
    rows = made.orderBy("key").collect()  # `sample` rows at most
    return fit([(np.frombuffer(r.features, np.int32), np.frombuffer(r.shares, np.float32), r.label) for r in rows])


def _verdicts(docs: DataFrame, model: Model | None, threshold: float, keep: list[str], drop_rejected: bool) -> DataFrame:
    """Columns `keep` of `docs` under numbered names; then the verdict columns, or only the rows that are kept."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # weights of a fixed number
    sources = [*keep, *(["text"] if "text" not in keep else [])]
    picked = docs.select(*(column(docs, c).alias(f"_{i}") for i, c in enumerate(sources)))
    place, own = sources.index("text"), picked.columns[: len(keep)]
    names = [*own, *STATISTICS, "base_failed", "probability", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(place))
            for first, last in blocks(offsets, BLOCK):
                block = Block(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                found = block.statistics()
                failed = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])
                chance = sent.value.probability(sent.value.scores(block)) if sent.value else None
                kept = ~failed if chance is None else ~failed & (chance >= threshold)
                rows = pa.RecordBatch.from_arrays(batch.slice(first, last - first).columns[: len(own)], names=own)
                if drop_rejected:
                    yield rows.filter(pa.array(kept))
                    continue
                shown = pa.nulls(block.rows, pa.float64()) if chance is None else pa.array(chance)
                columns = [pa.array(found[c].astype(np.int64)) for c in STATISTICS]
                columns += [pa.array(failed), shown, pa.array(kept)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], names=names)

    kinds = [*[T.LongType()] * len(STATISTICS), T.BooleanType(), T.DoubleType(), T.BooleanType()]
    extra = [] if drop_rejected else [T.StructField(c, t) for c, t in zip(names[len(own) :], kinds)]
    made = picked.mapInArrow(run, T.StructType([*picked.schema.fields[: len(own)], *extra]))
    return made.select(*(F.col(o).alias(c) for c, o in zip(keep, own)), *(f.name for f in extra))


def rate(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, statistics, base_failed, probability (null without a model) and kept for every row of `docs`."""
    return _verdicts(docs, train(docs, labels), threshold, ["doc_id"], False)


def kept_rows(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    return _verdicts(docs, train(docs, labels), threshold, docs.columns, True)
