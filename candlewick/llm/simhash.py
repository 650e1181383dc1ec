"""SimHash near-dedup with BK-trees.

Fingerprint: A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`, shingles of three words (fewer: the whole sequence; none:
fingerprint zero), XXH64 of each with seed 42; a bit is 1 if set in over half of the hashes, repeats counted.

Search: equal fingerprints are folded first. Fingerprints within two bits of each other agree in two of four 16-bit
parts at least, so each goes to the six shards that are named by two parts, and every link lies within one shard. A
shard above `TREE` nodes is divided the same way by the parts of the remaining 32 bits, then of the remaining 16 bits,
where at most 256 fingerprints are left: trees have a proven size bound, and nothing is left out or capped. A shard's
fingerprints become a BK-tree, children keyed by their integer Hamming distance to the parent; every member is looked
up in it, following only the edges within the radius. A tree reaches its queries through the shuffle of its shard and
is dropped after them: the trees together grow with the corpus, so they are not sent to every executor.

Links within a shard are reduced to one edge per fingerprint there, and components over the edges come from rounds of
large-star and small-star joins, checkpointed in the shared folder until nothing changes.

Null text has no words (fingerprint zero, linked like any other). Documents of null doc_id get the component of their
fingerprint, null if no document in it has an id. Repeated rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.arrow import texts
from candlewick.llm.frames import column, every
from candlewick.sources.scratch import discard, folder_of, materialise, passing, written_at

SHINGLE = 3
RADIUS = 2
SEED = 42
TREE = 2048  # nodes of a tree at most
_BLOCK = 1 << 16  # hashes, queries or shard members handled at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # for bytes: ASCII letters, and white space is \x20 and \x09-\x0D
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    begin = (end - length)[: len(words) - size + 1].tolist()
    hashed, seed = xxhash.xxh64_intdigest, SEED
    ends = end[size - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(begin), _BLOCK):
        own = zip(begin[at : at + _BLOCK], ends[at : at + _BLOCK])
        h = np.array([hashed(joined[a:b], seed) for a, b in own], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """All columns of `docs` but the text, with `out`, the fingerprint as a signed 64-bit integer."""
    others = [c for c in docs.columns if c != text]
    own = [f"_{i}" for i in range(len(others))]  # plain names on the way through Arrow

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in texts(batch.column(len(own)))], np.uint64)
            columns = [*batch.columns[:-1], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*own, "_fp"])

    picked = docs.select(*(column(docs, c).alias(o) for c, o in zip(others, own)), column(docs, text).alias("_text"))
    made = picked.mapInArrow(run, T.StructType([*picked.schema.fields[:-1], T.StructField("_fp", T.LongType())]))
    return made.select(*(F.col(o).alias(c) for c, o in zip(others, own)), F.col("_fp").alias(out))


def bk_trees(values: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (parent, distance, child) of one BK-tree per value of `tree`, all grown level by level.

    Members of a tree lie together; the first is the root. On each level the first member that comes to a parent at a
    distance becomes its child, the others of that distance go on to the child.
    """
    active = np.flatnonzero(np.append(False, tree[1:] == tree[:-1]))
    at = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))[np.cumsum(np.append(True, tree[1:] != tree[:-1])) - 1]
    at = at[active]
    parents, distances, children = [], [], []
    while len(active):
        distance = np.bitwise_count(values[active] ^ values[at]).astype(np.int64)
        slot = at * 65 + distance
        order = np.argsort(slot, kind="stable")
        lead = np.append(True, slot[order][1:] != slot[order][:-1])
        child = active[order[lead]]
        parents.append(at[order[lead]])
        distances.append(distance[order[lead]])
        children.append(child)
        rest = ~lead
        at = child[np.cumsum(lead) - 1][rest]
        active = active[order[rest]]
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    parent, distance, child = join(parents), join(distances), join(children)
    order = np.argsort(parent * 65 + distance, kind="stable")
    return parent[order], distance[order], child[order]


def search(values: np.ndarray, edges: tuple, queries: np.ndarray, root: np.ndarray, radius: int) -> tuple:
    """Pairs (query, node) within the radius; a query starts at the root of its tree."""
    parent, distance, child = edges
    key = parent * 65 + distance
    query, node = queries, root
    hits_q, hits_n = [], []
    while len(query):
        d = np.bitwise_count(values[query] ^ values[node]).astype(np.int64)
        near = (d <= radius) & (query != node)
        hits_q.append(query[near])
        hits_n.append(node[near])
        low = np.searchsorted(key, node * 65 + np.maximum(d - radius, 0))
        count = np.searchsorted(key, node * 65 + np.minimum(d + radius, 64), side="right") - low
        total = np.cumsum(count)
        step = np.arange(int(total[-1])) + np.repeat(low - (total - count), count)
        query, node = np.repeat(query, count), child[step]
    return (np.concatenate(hits_q), np.concatenate(hits_n)) if hits_q else (queries[:0], queries[:0])


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component under the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _links_of(values: np.ndarray, shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest fingerprint linked to it in its shard), without those that are their own."""
    edges = bk_trees(values, shard)
    first = np.append(True, shard[1:] != shard[:-1])
    root = np.flatnonzero(first)[np.cumsum(first) - 1]
    label = np.arange(len(values))
    for at in range(0, len(values), _BLOCK // 8):
        queries = np.arange(at, min(at + _BLOCK // 8, len(values)))
        a, b = search(values, edges, queries, root[queries], radius)
        low = smallest_linked(len(values), np.concatenate([a, np.arange(len(values))]), np.concatenate([b, label]))
        label = low
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def _tree_task(radius: int):
    """Rows (shard, fp) sorted by shard and fp -> edges; a shard that a batch cuts waits for the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_shard, kept_value = np.zeros(0, object), np.zeros(0, np.uint64)

        def edges(shard, value):
            number = np.cumsum(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, np.int64)
            return _links_of(value, number, radius)

        for batch in batches:
            shard = np.concatenate([kept_shard, batch.column(0).to_numpy(zero_copy_only=False)])
            value = np.concatenate([kept_value, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            cut = int(np.argmax(shard == shard[-1])) if len(shard) else 0
            kept_shard, kept_value = shard[cut:], value[cut:]
            a, b = edges(shard[:cut], value[:cut])
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
        a, b = edges(kept_shard, kept_value)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def _keys(value: Column, shard: Column, bits: int) -> Column:
    """Six shard names: the name so far, which two of the four parts of `bits` bits, and their value."""
    part = lambda i: F.shiftrightunsigned(value, i * bits).bitwiseAND((1 << bits) - 1)
    named = [
        F.concat_ws(".", shard, F.lit(f"{i}{j}"), F.hex(part(i) * (1 << bits) + part(j))) for i, j in combinations(range(4), 2)
    ]
    return F.array(*named)


def _others(value: Column, pair: Column, bits: int) -> Column:
    """The two parts that the pair does not name, as one number of 2 * bits bits."""
    part = lambda i: F.shiftrightunsigned(value, i * bits).bitwiseAND((1 << bits) - 1)
    found = None
    for i, j in combinations(range(4), 2):
        k, m = (x for x in range(4) if x not in (i, j))
        rest = part(k) * (1 << bits) + part(m)
        found = F.when(pair == f"{i}{j}", rest) if found is None else found.when(pair == f"{i}{j}", rest)
    return found


def shards(distinct: DataFrame, largest: int = TREE) -> DataFrame:
    """(shard, fp): every two fingerprints within two bits meet in a shard; no shard has over max(largest, 256)."""
    level = distinct.select("fp", F.lit("").alias("shard"), F.col("fp").alias("rest"))
    done = None
    for bits in (16, 8, 4):
        named = level.withColumn("next", F.explode(_keys(F.col("rest"), F.col("shard"), bits)))
        pair = F.substring(F.substring_index("next", ".", -2), 1, 2)
        named = named.select("fp", F.col("next").alias("shard"), _others(F.col("rest"), pair, bits).alias("rest"))
        named = materialise(named, "fp-shards")
        size = materialise(named.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "fp-shard-sizes")
        small = named.join(size.where(F.col("n") <= largest) if bits > 4 else size, "shard", "left_semi")
        small = small.select("shard", "fp")
        done = small if done is None else done.unionByName(small)
        if bits == 4 or size.where(F.col("n") > largest).isEmpty():
            return done
        level = named.join(size.where(F.col("n") > largest), "shard", "left_semi")
    return done


def links(distinct: DataFrame, radius: int = RADIUS, largest: int = TREE) -> DataFrame:
    """Edges (a, b) between fingerprints with the same components as all pairs within the radius."""
    if radius != 2:
        raise ValueError("the shards are built for a radius of two bits")
    return (
        shards(distinct, largest)
        .repartition("shard")
        .sortWithinPartitions("shard", "fp")
        .mapInArrow(_tree_task(radius), "a long, b long")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component. Only aggregates and joins, one round per step."""
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # large star: larger neighbours go to the smallest of the neighbourhood
        large = both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialise(large.where("a <> b").distinct(), "large-star")
        # small star: smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b"))
        )
        newer = materialise(small.where("a <> b").distinct(), "small-star")
        discard(large)
        discard(edges)
        edges = newer
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == state:
            return written_at(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), folder_of(edges))
        state = tuple(now)


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, fp, root (smallest fingerprint of the component), component_id."""
    found = materialise(fingerprints(docs.select("doc_id", "text")), "fingerprints")
    distinct = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct-fingerprints")
    with passing(docs.sparkSession) as keep:
        roots = keep(components(links(distinct.select("fp"))))
    member = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    member = member.select("fp", "id", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("id").alias("component_id"))
    return found.join(member.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id that links reach)."""
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return labelled(docs).select("doc_id", shown, "component_id")


def first_of_each(docs: DataFrame) -> DataFrame:
    """Rows of `docs` with all their columns, one of each component: the one with the smallest doc_id.

    Of several rows with that doc_id the one with the smallest fingerprint in the component stays. A component without
    any doc_id keeps one row that has its smallest fingerprint.
    """
    found = materialise(labelled(docs), "labelled")
    first = F.col("doc_id") == F.col("component_id")
    chosen = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    chosen = chosen.agg(F.count("*").alias("n"), F.max(first).alias("first")).where("first").drop("first")
    chosen = materialise(chosen, "chosen")
    # the chosen ids grow with the corpus, so they are never broadcast: one plan for every size
    kept = docs.join(chosen.where("n = 1").hint("merge"), "doc_id", "left_semi").select(*every(docs))
    repeated = chosen.where("n > 1").select("doc_id")
    if not repeated.isEmpty():  # the id alone does not say which text was chosen
        pairs = found.where(first).join(repeated, "doc_id", "left_semi").groupBy("root")
        pairs = pairs.agg(F.min("fp").alias("_simhash_fp"), F.min("doc_id").alias("_simhash_id"))
        held = docs.join(repeated, "doc_id", "left_semi").select(*every(docs), F.col("text").alias("_simhash_text"))
        held = fingerprints(held, "_simhash_text", out="_simhash_fp")
        same = (held["_simhash_fp"] == pairs["_simhash_fp"]) & (held["doc_id"] == pairs["_simhash_id"])
        held = held.join(pairs, same, "left_semi").dropDuplicates(["doc_id", "_simhash_fp"])
        kept = kept.union(held.select(*(f"`{c}`" for c in docs.columns)))
    nameless = found.where(F.col("component_id").isNull()).select(F.col("root").alias("_simhash_fp")).distinct()
    if not nameless.isEmpty():
        held = docs.where(F.col("doc_id").isNull()).withColumn("_simhash_text", F.col("text"))
        held = fingerprints(held, "_simhash_text", out="_simhash_fp").join(nameless, "_simhash_fp", "left_semi")
        kept = kept.union(held.dropDuplicates(["_simhash_fp"]).select(*(f"`{c}`" for c in docs.columns)))
    return kept
