"""Nearest neighbours by inner product from a hash-prefix forest.

A tree gives each vector a long hash string (64 signs of random projections, the same in every run) and keeps the
strings as a sorted array. A query descends in every tree to the longest prefixes that it shares with any string, then
all trees ascend together, one bit at a time, until their prefix classes hold enough candidates; classes are always
taken whole, so copies of one vector stay together whatever their number. Candidates get their exact inner product.

The vectors are dealt into blocks of bounded size by a hash of their id, each with a forest of its own, and every query
searches every block: a stated query set against all rows, in blocks. A task holds one block and streams the queries
through it; the best of all blocks are merged by the score's rank. A search looks at `SHARE` of a block and
`LEAST` vectors of it at least (all, if it has fewer); the README has the recall measured against brute force.

Vectors that are null, zero or hold null or non-finite components take no part, as candidate or as query; rows of null
vec_id neither. Rows that repeat a vec_id are candidates of their own, but never of their own query, which is asked once
with the smallest of their vectors. Vectors of another length than the most common one raise ValueError. Fewer candidates than asked for are all returned; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

TREES = 32
BITS = 64
SHARE, LEAST = 0.5, 1000
BLOCK_ROWS = 16_384  # vectors in a block, about
EVERY = 20  # rows with an id divisible by this are queries
BEST = 20
_BATCH = 256  # queries that descend together


def planes(tree: int, dims: int) -> np.ndarray:
    return np.random.default_rng([7, tree]).standard_normal((dims, BITS))


def strings(vectors: np.ndarray, tree: int) -> np.ndarray:
    """Hash strings as integers, the first sign in the highest bit."""
    bits = (vectors @ planes(tree, vectors.shape[1])) > 0
    return np.packbits(bits, axis=1).view(">u8").astype(np.uint64).ravel()


class Forest:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, trees: int = TREES, share: float = SHARE, least: int = LEAST):
        order = np.argsort(ids, kind="stable")
        self.ids, vectors = ids[order], vectors[order]
        self.columns = np.ascontiguousarray(vectors.T)
        self.trees, self.wanted = [], max(least, int(np.ceil(share * len(ids))))
        for tree in range(trees if len(ids) else 0):
            hashed = strings(vectors, tree)
            place = np.argsort(hashed, kind="stable")
            self.trees.append((hashed[place], place))

    def classes(self, hashed: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Bounds [tree, query] of the prefix classes after ascending together until enough strings are in them."""
        n = len(hashed[0])
        low, high = np.zeros((len(hashed), n), np.int64), np.zeros((len(hashed), n), np.int64)
        open_ = np.arange(n)
        for length in range(BITS, -1, -1):
            tail = np.uint64((1 << (BITS - length)) - 1)
            for tree, (sorted_, _) in enumerate(self.trees):
                own = hashed[tree][open_]
                low[tree, open_] = np.searchsorted(sorted_, own & ~tail, side="left")
                high[tree, open_] = np.searchsorted(sorted_, own | tail, side="right")
            # trees overlap, so the number of different candidates is at most their sum and at least the largest
            held = (high - low)[:, open_]
            enough = held.sum(axis=0) >= self.wanted
            if enough.any():
                done = [q for q in open_[enough].tolist() if length == 0 or self.members(low[:, q], high[:, q]).sum() >= self.wanted]
                open_ = np.setdiff1d(open_, done)
            if not len(open_):
                break
        return low, high

    def members(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        marked = np.zeros(len(self.ids), bool)
        for (_, place), a, b in zip(self.trees, low.tolist(), high.tolist()):
            marked[place[a:b]] = True
        return marked

    def search(self, query_ids: np.ndarray, queries: np.ndarray, best: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, candidate ids, scores): the best of the block, nearest first, ties to the smaller id."""
        if not len(self.ids) or not len(queries):
            return
        hashed = [strings(queries, tree) for tree in range(len(self.trees))]
        low, high = self.classes(hashed)
        for q, (name, vector) in enumerate(zip(query_ids.tolist(), queries)):
            found = np.flatnonzero(self.members(low[:, q], high[:, q]) & (self.ids != name))
            score = inner(self.columns, found, vector)
            if len(found) > best:
                kth = np.partition(score, len(score) - best)[len(score) - best]
                some = score >= kth
                found, score = found[some], score[some]
            order = np.lexsort((self.ids[found], -score))[:best]
            yield name, self.ids[found[order]], score[order]


def inner(columns: np.ndarray, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed component after component, so equal vectors have equal scores."""
    total = np.zeros(len(rows))
    for column, value in zip(columns, query.tolist()):
        total += column[rows] * value
    return total


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector of doubles) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return embeddings.select("vec_id", vector.alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", bad)
        & F.exists("vector", lambda x: x != 0)
    )


def _search_task(best: int):
    """Rows (block, is_query, id, vector) sorted so that a block's vectors come before the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, forest, ids, vectors = None, None, [], []
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            names = batch.column(2).to_numpy()
            flat = batch.column(3).flatten().to_numpy()
            size = len(flat) // max(1, len(names))
            if len(flat) != size * len(names) or (np.diff(batch.column(3).offsets.to_numpy()) != size).any():
                raise ValueError("vectors differ in length")
            rows = flat.reshape(len(names), size)
            cut = np.flatnonzero(np.append(True, (blocks[1:] != blocks[:-1]) | (asks[1:] != asks[:-1])))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(names)]):
                if blocks[a] != block:
                    block, forest, ids, vectors = blocks[a], None, [], []
                if not asks[a]:
                    ids.append(names[a:b])
                    vectors.append(rows[a:b])
                    continue
                if forest is None and ids:
                    forest = Forest(np.concatenate(ids), np.concatenate(vectors))
                for at in range(a, b, _BATCH) if forest else ():
                    end = min(at + _BATCH, b)
                    found = list(forest.search(names[at:end], rows[at:end], best))
                    count = [len(i) for _, i, _ in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([q for q, _, _ in found], count).astype(np.int64)),
                            pa.array(np.concatenate([i for _, i, _ in found]).astype(np.int64)),
                            pa.array(np.concatenate([s for _, _, s in found])),
                        ],
                        names=["query_id", "vec_id", "score"],
                    )

    return run


def nearest(embeddings: DataFrame, every: int = EVERY, best: int = BEST, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the `best` nearest found for each row whose vec_id is divisible by `every`."""
    rows = materialise(usable(embeddings), "vectors")
    n_blocks = max(1, -(-rows.count() // block_rows))
    key = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    held = rows.select(key.alias("block"), F.lit(False).alias("asks"), "vec_id", "vector")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(True).alias("asks"), "vec_id", "vector"
    )
    found = (
        held.unionByName(queries)
        .repartition(F.col("block"))
        .sortWithinPartitions("block", "asks", "vec_id")
        .mapInArrow(_search_task(best), "query_id long, vec_id long, score double")
    )
    nearest_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest_first))
    return ranked.where(F.col("rank") <= best).select("query_id", "rank", "vec_id", "score")
