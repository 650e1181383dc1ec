"""Language-model scores from a log-bilinear neural model trained with noise-contrastive estimation.

Tokens: A-Z lower-cased words `[^\\x20\\x09-\\x0D]+`, then one end. Counts of all training tokens are gathered from the
whole corpus. The model's outputs are the most frequent words, the end, and `CLASSES` classes of all other words (by
the hash of their last two bytes); a word of a class has its share of the class by counts plus one, with one unknown
word for each class, so the probabilities over all known words and one unknown word of each class add up to one.

The score of output w after the tokens u, v is (A[v] + B[u]) . Q[w] + b[w]. Training in numpy: a hash deals all training
texts to learners, one for `SHARD_TOKENS` tokens, and to `ROUNDS` rounds; so what a learner reads, and in what order,
does not depend on files or partitions. In a round every learner starts from the same parameters, learns from its texts
(noise drawn from the unigram distribution, shared within a batch), and the learners' parameters are averaged with their
token counts as weights; nothing but these sums reaches the driver, a fixed number of rows. Then batched matrix products
over all pairs of context tokens give the normaliser of every context, so each token's log-probability is normalised
exactly.

Words that make up 1 / `RARE` of all training tokens are at most `RARE` in number and, up to `LONGEST` bytes, go to the
executors with their counts; all others meet their counts in a join. No word is left out of any sum.

Null text is the end alone. A null doc_id is not held out. Repeated rows each get a score; an empty table gives an
empty result; with nothing to learn from every count is zero and the model is even.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.arrow import binaries, texts
from candlewick.sources.scratch import materialise

FOLDS, HELD_OUT = 7, 2
CLASSES = 127  # outputs 0 to 126; 127 is the end, the most frequent words follow
OUTPUTS = 1024
DIMS = 24
RARE, LONGEST = 200_000, 64
NOISE, SHARED = 16.0, 64  # noise samples for each token, and words drawn for each batch
BATCH = 4096
SHARD_TOKENS, SHARDS = 8_000_000, 4096  # training tokens of a learner, and learners at most (they then read more)
ROUNDS = 2
RATE = 0.15
END_ID = CLASSES
_BLOCK = 1 << 18  # tokens handled at a time
_DISTINCT = 300_000  # words counted in a task before their counts are passed on


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


@dataclass
class Lexicon:
    """Frequent words with counts and outputs, and what the probabilities of the rest need."""

    index: dict[bytes, int]
    count: np.ndarray  # by index
    output: np.ndarray  # by index
    ends: int
    tokens: int
    words: int
    class_total: np.ndarray  # of counts plus one, by class
    unigram: np.ndarray  # of outputs


@dataclass
class Parameters:
    near: np.ndarray  # A: of the token before
    far: np.ndarray  # B: of the one before that
    target: np.ndarray  # Q
    bias: np.ndarray

    def rows(self) -> np.ndarray:
        return np.concatenate([self.near, self.far, self.target, np.tile(self.bias[:, None], (1, DIMS))])

    @staticmethod
    def of(rows: np.ndarray) -> Parameters:
        near, far, target, bias = np.split(rows, 4)
        return Parameters(near.copy(), far.copy(), target.copy(), bias[:, 0].copy())


def first_parameters(lexicon: Lexicon) -> Parameters:
    rng = np.random.default_rng(8)
    small = lambda: rng.normal(0, 0.1, (OUTPUTS, DIMS)).astype(np.float32)
    return Parameters(small(), small(), small(), np.log(lexicon.unigram).astype(np.float32))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts, the end not counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array(list(found.keys()), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], names=["word", "c"])

        for batch in batches:
            for text in texts(batch.column(0)):
                found.update(text.lower().split())
                if len(found) > _DISTINCT:
                    yield out()
                    found.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def lexicon(counts: DataFrame, ends: int) -> Lexicon:
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, words = (totals.n or 0) + ends, totals.v + (ends > 0)
    frequent = counts.where((F.col("c") * RARE >= F.lit(tokens)) & (F.octet_length("word") <= LONGEST))
    rows = sorted(((-r.c, r.word.encode()) for r in frequent.collect()))  # at most RARE words of at most LONGEST bytes
    own = OUTPUTS - CLASSES - 1
    listed = F.crc32(F.expr("right_bytes")) % CLASSES
    others = counts.withColumn("bytes", F.col("word").cast("binary"))
    last = F.substring(F.col("bytes"), F.greatest(F.octet_length("bytes") - 1, F.lit(1)), F.lit(2))
    others = others.withColumn("right_bytes", last).groupBy(listed.cast("int").alias("k")).agg(
        F.sum("c").alias("c"), F.count("*").alias("n")
    )
    mass, total = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in others.collect():  # one row for each class
        mass[r.k], total[r.k] = r.c, r.c + r.n
    output = np.array([CLASSES + 1 + i if i < own else class_of(w) for i, (_, w) in enumerate(rows)], np.int64)
    top = np.zeros(OUTPUTS)
    for c, w in rows[:own]:
        mass[class_of(w)] += c
        total[class_of(w)] += c - 1
    top[CLASSES + 1 : CLASSES + 1 + min(own, len(rows))] = [-c for c, _ in rows[:own]]
    top[:CLASSES], top[END_ID] = mass, ends
    unigram = (top + 0.5) / (top + 0.5).sum()
    index = {w: i for i, (_, w) in enumerate(rows)}
    return Lexicon(index, np.array([-c for c, _ in rows], np.int64), output, ends, tokens, words, total, unigram)


class Reader:
    """Token numbers of texts: place in the lexicon (-1: the end, -2: a word that is not listed) and output."""

    def __init__(self, known: Lexicon):
        self.known = known
        self.output = np.concatenate([known.output, [0, END_ID]]).astype(np.int64)  # -1 is the end

    def __call__(self, batch: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        get, numbers, size, rest = self.known.index.get, [], [], []
        for text in batch:
            words = text.lower().split()
            own = [get(w, -2) for w in words]
            rest.append([w for w, i in zip(words, own) if i == -2])
            numbers += own
            numbers.append(-1)
            size.append(len(words) + 1)
        number = np.array(numbers, np.int64)
        output = self.output[number]
        output[number == -2] = [class_of(w) for own in rest for w in own]
        return number, output, np.array(size, np.int64), rest

    @staticmethod
    def contexts(output: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Outputs of the token before and of the one before that; before a text there are only ends."""
        near = np.concatenate([[END_ID], output[:-1]])
        far = np.concatenate([[END_ID, END_ID], output[:-2]])[: len(output)]
        far[np.cumsum(size) - size] = END_ID
        return near, far


def _batched(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows whose texts have about _BLOCK tokens; a longer text is a block of its own."""
    for batch in batches:
        own, first, size = [], 0, 0
        for row, text in enumerate(texts(batch.column(column))):
            own.append(text)
            size += len(text) // 5
            if size >= _BLOCK:
                yield batch.slice(first, len(own)), own
                own, first, size = [], row + 1, 0
        if own:
            yield batch.slice(first, len(own)), own


def _add_rows(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, change: np.ndarray) -> None:
    """A step against the summed changes of each row, shorter the more the row has changed before."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    total = np.add.reduceat(change[order], first, axis=0)
    own = rows[first]
    squares[own] += total**2
    table[own] -= RATE * total / np.sqrt(squares[own])


def learn(p: Parameters, squares: Parameters, near, far, target, unigram: np.ndarray, rng) -> None:
    """One pass of noise-contrastive estimation over the tokens, in batches of random order."""
    offset = np.log(NOISE * unigram).astype(np.float32)
    cumulative = np.cumsum(unigram)
    order = rng.permutation(len(target))
    for at in range(0, len(order), BATCH):
        own = order[at : at + BATCH]
        u, v, w = far[own], near[own], target[own]
        noise = np.minimum(np.searchsorted(cumulative, rng.random(SHARED)), OUTPUTS - 1)
        q = p.near[v] + p.far[u]
        truth = (q * p.target[w]).sum(axis=1) + p.bias[w] - offset[w]
        false = q @ p.target[noise].T + (p.bias[noise] - offset[noise])
        up = (-1 / (1 + np.exp(np.clip(truth, -30, 30)))) / len(own)  # slope of the loss by the score
        down = (NOISE / SHARED / len(own)) / (1 + np.exp(-np.clip(false, -30, 30)))
        dq = up[:, None] * p.target[w] + down @ p.target[noise]
        rows = np.concatenate([w, noise])
        by_target = np.concatenate([up[:, None] * q, down.T @ q])
        by_bias = np.concatenate([up, down.sum(axis=0)])
        _add_rows(p.target, squares.target, rows, by_target)
        _add_rows(p.bias, squares.bias, rows, by_bias)
        _add_rows(p.near, squares.near, v, dq)
        _add_rows(p.far, squares.far, u, dq)


def shards(tokens: int) -> int:
    """How many learners share the training tokens: a number that follows the corpus, not how its files are cut."""
    return max(1, min(SHARDS, -(-tokens // SHARD_TOKENS)))


def _encoded(docs: DataFrame, known: Broadcast, count: int) -> DataFrame:
    """shard, place in the shard, and the outputs of each text's tokens as unsigned 16-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(known.value)
        for batch, own in _batched(batches, 1):
            _, output, size, _ = read(own)
            outputs = binaries(output.astype("<u2").view(np.uint8), np.concatenate([[0], np.cumsum(size)]) * 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), outputs], names=["place", "outputs"])

    texts_ = docs.select("place", "text").mapInArrow(run, "place long, outputs binary")
    shard = F.pmod(F.shiftrightunsigned("place", 8), F.lit(count)).cast("int").alias("shard")
    return texts_.select(shard, "place", "outputs")


def train(docs: DataFrame, known: Broadcast, start: Broadcast, rounds: int = ROUNDS) -> Parameters:
    """Parameters learned from all texts of `docs`, each of them read in one of the rounds.

    A hash of doc_id and text says in which round and by which learner a text is read and in what order. After a round
    the learners' parameters, and the squares that set their step lengths, are averaged with token counts as weights, and
    the next round starts from there.
    """
    spark, count = docs.sparkSession, shards(known.value.tokens)
    placed = docs.select(F.xxhash64("doc_id", "text").alias("place"), "text")
    dims = [f"d{i}" for i in range(DIMS)]
    names = ["row", "seen", *dims]
    rows = start.value.rows().astype(float)
    state = np.concatenate([rows, np.full_like(rows, 1e-6)])

    for turn in range(rounds):
        begin = spark.sparkContext.broadcast(state.astype(np.float32))

        def run(batches: Iterator[pa.RecordBatch], begin=begin, turn=turn) -> Iterator[pa.RecordBatch]:
            def learner(shard: int, blocks_: Iterator[list[np.ndarray]]) -> pa.RecordBatch:
                half = len(begin.value) // 2
                p, squares = Parameters.of(begin.value[:half]), Parameters.of(begin.value[half:])
                seen, rng = 0, np.random.default_rng((88, turn, shard))
                for own in blocks_:
                    output, size = np.concatenate(own), np.array([len(o) for o in own], np.int64)
                    near, far = Reader.contexts(output, size)
                    learn(p, squares, near, far, output, known.value.unigram, rng)
                    seen += len(output)
                found = np.concatenate([p.rows(), squares.rows()]).astype(float) * seen
                columns = [pa.array(np.arange(len(found), dtype=np.int32)), pa.array(np.full(len(found), float(seen)))]
                return pa.RecordBatch.from_arrays([*columns, *(pa.array(np.ascontiguousarray(c)) for c in found.T)], names=names)

            texts_ = (
                (shard, np.frombuffer(outputs, "<u2").astype(np.int64))
                for batch in batches
                for shard, outputs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            )
            for shard, own in itertools.groupby(texts_, key=lambda t: t[0]):
                yield learner(shard, _gathered(o for _, o in own))

        encoded = _encoded(placed.where(F.pmod("place", F.lit(rounds)) == turn), known, count)
        dealt = encoded.repartition(count, "shard").sortWithinPartitions("shard", "place").select("shard", "outputs")
        learned = dealt.mapInArrow(run, "row int, seen double, " + ", ".join(f"{d} double" for d in dims))
        summed = learned.groupBy("row").agg(F.sum("seen").alias("seen"), *(F.sum(d).alias(d) for d in dims)).collect()
        for r in summed:  # a fixed number of parameter rows
            state[r.row] = [r[d] / r.seen for d in dims]
        begin.unpersist()
    return Parameters.of(state[: len(rows)].astype(np.float32))


def _gathered(outputs: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Texts of about _BLOCK tokens together; a longer text is cut, each part a text of its own."""
    own, size = [], 0
    for text in outputs:
        for at in range(0, len(text), _BLOCK):
            own.append(text[at : at + _BLOCK])
            size += len(own[-1])
            if size >= _BLOCK:
                yield own
                own, size = [], 0
    if own:
        yield own


def normalisers(spark: SparkSession, p: Broadcast) -> np.ndarray:
    """log of the sum over all outputs, for every pair (token before, token before that)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = p.value
        for batch in batches:
            for near in batch.column(0).to_pylist():
                score = (own.near[near] + own.far) @ own.target.T + own.bias
                top = score.max(axis=1)
                total = (top + np.log(np.exp(score - top[:, None]).sum(axis=1))).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([near]), pa.array([total.tobytes()], pa.binary())], names=["near", "z"])

    table = np.zeros((OUTPUTS, OUTPUTS), np.float32)
    for row in spark.range(OUTPUTS).mapInArrow(run, "near long, z binary").collect():  # OUTPUTS squared numbers
        table[row.near] = np.frombuffer(row.z, np.float32)
    return table


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(size) - size) if len(size) else np.zeros(0)


def token_scores(docs: DataFrame, known: Broadcast, p: Broadcast, z: Broadcast) -> DataFrame:
    """What each text has without the counts of unlisted words, which follow as a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, own = known.value, p.value
        read = Reader(lex)
        counts = np.concatenate([lex.count, [0, lex.ends]]).astype(float)  # -2: unlisted, -1: the end
        share = np.log10(lex.class_total + 1)
        for batch, block in _batched(batches, 2):
            number, output, size, rest = read(block)
            near, far = Reader.contexts(output, size)
            logp = np.empty(len(output))
            for at in range(0, len(output), _BLOCK // 4):
                s = slice(at, at + _BLOCK // 4)
                q = own.near[near[s]] + own.far[far[s]]
                logp[s] = (q * own.target[output[s]]).sum(axis=1) + own.bias[output[s]] - z.value[near[s], far[s]]
            count = np.log10(counts[number] + 1)
            classed = output < CLASSES
            score = logp / np.log(10) + np.where(classed, count - share[np.minimum(output, CLASSES - 1)], 0)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(size),
                    pa.array(_sums((counts[number] > 0).astype(np.int64), size)),
                    pa.array(_sums(count, size)),
                    pa.array(_sums(score, size)),
                    pa.array(rest, pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "counted", "score", "rest"],
            )

    picked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = dict(picked.dtypes)["doc_id"]
    return picked.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, counted double, score double, rest array<string>"
    )


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of `docs`."""
    spark = docs.sparkSession
    taught = docs.where(~held_out(F.col("doc_id")))
    counts = materialise(word_counts(taught), "word-counts")
    lex = lexicon(counts, taught.count())
    known = spark.sparkContext.broadcast(lex)
    p = train(taught, known, spark.sparkContext.broadcast(first_parameters(lex)))
    model = spark.sparkContext.broadcast(p)
    z = spark.sparkContext.broadcast(normalisers(spark, model))
    rows = materialise(
        token_scores(docs, known, model, z).withColumn("row", F.monotonically_increasing_id()), "token-scores"
    )
    rest = rows.select("row", F.explode("rest").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
    met = rest.join(counts, "word", "left").select("row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    found = met.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0))).alias("more_known"),
    )
    more = F.coalesce("more", F.lit(0.0))
    even = float(np.log10(lex.tokens + lex.words + 1))
    return rows.drop("rest").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("counted") + more - F.col("n_tokens") * F.lit(even)).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
