"""MinHash near-dedup with circulant signatures.

A document's set: A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`, distinct shingles of `SHINGLE` words (fewer words: the
whole sequence as one), each as a 64-bit number of the ring 0 .. 2^64 - 1. One permutation of the ring is applied to the
set, a second one, shifted by k places round the ring, gives coordinate k of the signature as the smallest image: two
permutations make all `BANDS` times `ROWS` coordinates. Equal sets are folded by a 128-bit digest first.

Sets that agree in all rows of a band are joined through the first of their band, and the components of these joins are
neighbourhoods: a link of similarity 0.85 lies outside all bands with a probability below 4e-7, and sets need not meet in
a band themselves as long as a chain of bands leads from one to the other. Texts travel to their neighbourhood once,
where every two full sets are compared: shingles that two of them share become bits, and intersections are counted on
these, column block by column block. A neighbourhood of over `CELL` sets is dealt to cells, one for every two of its
blocks of `CELL` sets by hash; if comparing within each of its bands' buckets takes fewer comparisons (neighbourhoods
that chance has chained together), its buckets are compared instead, large ones by cells again. So a task holds
2 * CELL sets at most, no candidate is left out, and every confirmed link of a cell is kept as an edge to the smallest
member it leads to. Components over the edges come from rounds of joins.

Null, empty and white-space-only texts have an empty set, are linked with nothing and are their own component. Documents
of null doc_id belong to the component of their set; a component without any doc_id has a null component_id, and its
documents are kept. Repeated rows each get a row; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.arrow import binaries, texts
from candlewick.llm.frames import column
from candlewick.llm.simhash import components, smallest_linked
from candlewick.sources.scratch import materialise, passing

SHINGLE = 3
PERCENT = 85  # links: 100 * intersection >= PERCENT * union
BANDS, ROWS = 20, 4
CELL = 256  # sets in a block
_WORDS = 1 << 20  # remembered words
_CHUNK = 4096  # elements whose coordinates are computed together
_COLUMNS = 1 << 15  # shingles compared together


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _first(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _second(x: np.ndarray) -> np.ndarray:
    """Another permutation; works in place."""
    spare = x >> np.uint64(30)
    x ^= spare
    x *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(x, np.uint64(27), out=spare)
    x ^= spare
    x *= np.uint64(0x94D049BB133111EB)
    np.right_shift(x, np.uint64(31), out=spare)
    x ^= spare
    return x


def shingle_set(text: bytes, hashes: dict, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles in ascending order."""
    words = text.lower().split()  # for bytes: ASCII letters, and white space is \x20 and \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(h))
    count = len(h) - size + 1
    mixed = np.full(count, size, np.uint64)
    for i in range(size):
        mixed = _first(mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + count])
    return np.unique(mixed)


def signature(elements: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k: the smallest image of the permuted set under the second permutation shifted by k."""
    moved = _first(elements)
    shift = np.arange(coordinates, dtype=np.uint64)[:, None]
    low = np.full(coordinates, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(0, len(moved), _CHUNK):
        np.minimum(low, _second(moved[at : at + _CHUNK] + shift).min(axis=1), out=low)
    return low


def _digest(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def band_keys(low: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One number for each band and its coordinates."""
    low = low.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(low.shape[1]):
        key = _first(key * np.uint64(0x9E3779B97F4A7C15) + low[:, i])
    return key.view(np.int64)


def _named(docs: DataFrame) -> DataFrame:
    """doc_id and text, with two hashes that find a row again whether or not its doc_id is null or repeated."""
    doc_id, text = column(docs, "doc_id"), column(docs, "text")
    row, check = F.xxhash64(doc_id, text).alias("row"), F.crc32(text.cast("binary")).alias("check")
    return docs.select(doc_id.alias("doc_id"), row, check, text.alias("text"))


def signed(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row, check, n_shingles, digest (null for an empty set), bands."""
    picked = _named(docs)
    schema = T.StructType(
        [
            *picked.schema.fields[:3],
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            size, digest, bands = [], [], []
            for text in texts(batch.column(3)):
                elements = shingle_set(text, hashes, shingle)
                size.append(len(elements))
                digest.append(_digest(elements) if len(elements) else None)
                bands.append(band_keys(signature(elements)) if len(elements) else None)
            made = [pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=schema.names)

    return picked.mapInArrow(task, schema)


def neighbourhoods(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, key) of all bands that hold two sets or more, with their size; (node, root) of the neighbourhoods."""
    banded = sets.select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("size")).where("size > 1")
    shared = materialise(banded.join(buckets, "key"), "shared-bands")
    heads = shared.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    roots = components(heads)
    return shared.select("node", "key", "size"), roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _cells(members: DataFrame, size: str, cell: int) -> DataFrame:
    """(cell, node, block): groups of `size` sets are dealt to a cell for every two of their blocks.

    `members` has group, node and the size of the group (null: one block holds it). A pair of blocks is named by the smaller one first; a set goes
    to the pairs that its block is in, once for each block of the group.
    """
    blocks = F.ceil(F.coalesce(F.col(size), F.lit(1)) / F.lit(cell)).cast("long")
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))
    each = members.withColumn("blocks", blocks).withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    paired = each.select("group", "node", "block", other)
    name = F.concat_ws("-", "group", F.least("block", "other"), F.greatest("block", "other"))
    return paired.select(name.alias("cell"), "node", "block")


def cells(shared: DataFrame, roots: DataFrame, cell: int = CELL) -> DataFrame:
    """(cell, node, block): every two sets of a band meet in a cell."""
    roots = materialise(roots, "neighbourhoods")
    # only the large ones, which are few, are told their size
    large = roots.groupBy("root").agg(F.count("*").alias("whole")).where(F.col("whole") > cell)
    # comparisons within the buckets of a large neighbourhood; each bucket gives its size once for every member
    spread = shared.join(roots, "node").join(large, "root")
    cost = spread.groupBy("root", "whole").agg(F.sum("size").alias("pairs"))
    apart = materialise(cost.where(F.col("pairs") < F.col("whole") * F.col("whole")).select("root"), "spread-neighbourhoods")
    whole = roots.join(apart, "root", "left_anti").join(large, "root", "left")
    whole = whole.select(F.concat(F.lit("n"), F.col("root").cast("string")).alias("group"), "node", "whole")
    dealt = _cells(whole, "whole", cell)
    if apart.isEmpty():
        return dealt
    in_buckets = shared.join(roots.join(apart, "root", "left_semi"), "node")
    in_buckets = in_buckets.select(F.concat(F.lit("b"), F.col("key").cast("string")).alias("group"), "node", "size")
    return dealt.unionByName(_cells(in_buckets, "size", cell))


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all `left` sets with all `right` ones."""
    size = np.array([len(s) for s in sets], np.int64)
    found, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1  # shingles of a single set cannot be shared
    row, col = np.repeat(np.arange(len(sets)), size), number[place]
    held = count[place] > 1
    row, col = row[held], col[held]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    total = np.zeros((len(left), len(right)), np.int32)
    for first in range(0, int(col[-1]) + 1 if len(col) else 0, _COLUMNS):
        a, b = np.searchsorted(col, [first, first + _COLUMNS])
        bits = np.zeros((len(sets), _COLUMNS), bool)
        bits[row[a:b], col[a:b] - first] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        used = -(-(min(int(col[b - 1]) - first + 1, _COLUMNS)) // 64)
        packed = packed[:, :used]
        others = packed[right]
        for i, own in enumerate(left.tolist()):
            total[i] += np.bitwise_count(others & packed[own]).sum(axis=1, dtype=np.int32)
    return total


def _compare(shingle: int, percent: int):
    """A cell's rows (cell, node, block, digest, text) -> edges (a, b), b the smallest node that a's links lead to."""

    def task(table: pa.Table) -> pa.Table:
        hashes, sets, nodes, blocks = _Hashes(), [], [], []
        seen = set()
        columns = [table.column(c).combine_chunks() for c in ("node", "block", "digest", "text")]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        for node, block, digest, text in zip(*(c.to_pylist() for c in columns[:3]), texts(columns[3])):
            if node in seen:
                continue  # a repeated row
            elements = shingle_set(text, hashes, shingle)
            if _digest(elements) != digest:
                continue  # another text with the same hashes
            seen.add(node)
            sets.append(elements)
            nodes.append(node)
            blocks.append(block)
        a = b = np.zeros(0, np.int64)
        if sets:
            order = np.argsort(nodes)
            node, block = np.array(nodes, np.int64)[order], np.array(blocks, np.int64)[order]
            sets = [sets[i] for i in order.tolist()]
            left = np.flatnonzero(block == block.min())
            right = np.flatnonzero(block == block.max())  # the same ones where a block is compared with itself
            size = np.array([len(s) for s in sets], np.int64)
            common = intersections(sets, left, right).astype(np.int64)
            either = size[left][:, None] + size[right] - common
            i, j = np.nonzero(100 * common >= percent * either)
            i, j = left[i], right[j]
            low = smallest_linked(len(sets), i, j)
            moved = np.flatnonzero(low != np.arange(len(sets)))
            a, b = node[moved], node[low[moved]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return task


def links(docs: DataFrame, sets: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, cell: int = CELL) -> DataFrame:
    """Edges (a, b) between nodes with the same components as all links between the sets."""
    dealt = cells(*neighbourhoods(sets), cell)
    wanted = dealt.join(sets.select("node", "row", "check", "digest"), "node")
    met = wanted.join(_named(docs).drop("doc_id"), ["row", "check"])
    met = met.dropDuplicates(["row", "check", "cell"]).drop("row", "check")  # rows that repeat as a whole
    return met.groupBy("cell").applyInArrow(_compare(shingle, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, cell: int = CELL) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach), kept (whether that is the document itself)."""
    found = materialise(signed(docs, shingle), "shingle-sets")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), "row", "check")).alias("first")
    folded = found.where("digest IS NOT NULL").groupBy("digest").agg(first, F.first("bands").alias("bands"))
    folded = folded.select("digest", "first.id", "first.row", "first.check", "bands")
    sets = materialise(folded.withColumn("node", F.monotonically_increasing_id()), "distinct-sets")
    with passing(docs.sparkSession) as keep:
        roots = keep(components(links(docs, sets, shingle, percent, cell)))
    member = sets.select("node", "id", "digest").join(roots, "node", "left")
    member = member.select("digest", "id", F.coalesce("root", "node").alias("root"))
    least = member.groupBy("root").agg(F.min("id").alias("component_id"))
    labelled = member.join(least, "root").select("digest", "component_id")
    linked = found.where("digest IS NOT NULL").join(labelled, "digest")
    alone = found.where("digest IS NULL").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    every = linked.select(*columns).unionByName(alone.select(*columns))
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
