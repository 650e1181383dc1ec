"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many pieces lie in one flat array. In each round every neighbouring pair is looked up by binary search
over the sorted pair keys; in each piece the occurrences of its lowest-rank pair are merged, leftmost first where they
overlap. Pieces without a mergeable pair are done and leave the array. Pieces seen before come from a bounded memory,
so frequent ones are merged once per worker. Texts are cut at code points and never shortened.

Null text is encoded as empty (no ids); repeated rows each get their result; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm.arrow import binaries, blocks, ranges, utf8
from candlewick.llm.pretokens import Pieces, added_tokens, byte_letters, read_spec

BLOCK = 1 << 20  # bytes of text in one numpy batch
_BITS = 20  # a pair key is (left << 20) | right


class MergeTable:
    """Merges as sorted pair keys with the rank and the new symbol of each, and the bytes of every id."""

    def __init__(self, spec: dict):
        vocab: dict[str, int] = spec["model"]["vocab"]
        if max(vocab.values()) >= 1 << _BITS:
            raise ValueError("vocabulary too large for the pair keys")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << _BITS) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        letters = byte_letters()
        self.symbol = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.first_rank, self.first_found = self.search(np.repeat(self.symbol, 256), np.tile(self.symbol, 256))
        self.added = added_tokens(spec)
        of_letter = {c: b for b, c in letters.items()}
        content = {i: bytes(of_letter[c] for c in text) for text, i in vocab.items()}
        content |= {i: text.encode() for text, i in self.added.items()}
        spelled = [content.get(i, b"") for i in range(max(content) + 1)]
        self.length = np.array([len(s) for s in spelled], np.int64)
        self.at = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def search(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (the number of merges if it is none) and its place among the sorted keys."""
        key = (left << _BITS) | right
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[found] == key, self.rank[found], len(self.keys)), found

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces end to end, and the number of ids of each."""
        length = np.array([len(p) for p in pieces], np.int64)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self.symbol[raw]
        piece = np.repeat(np.arange(len(pieces)), length)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = len(self.keys)
        rank, found = np.full(len(raw), none), np.zeros(len(raw), np.int64)
        if len(raw):
            pair = raw[:-1] * np.int64(256) + raw[1:]
            rank[:-1], found[:-1] = self.first_rank[pair], self.first_found[pair]
            rank[:-1][piece[1:] != piece[:-1]] = none
        while len(symbols):
            begin = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.append(begin, len(piece))))
            over = best == none
            if over.any():
                done.append((symbols[over], piece[over]))
            here = np.flatnonzero((rank == best) & ~over)
            if not len(here):
                break
            run = np.append(True, here[1:] != here[:-1] + 1)  # neighbouring occurrences overlap: every second counts
            since = here - here[np.maximum.accumulate(np.where(run, np.arange(len(here)), 0))]
            here = here[since % 2 == 0]
            symbols[here] = self.merged[found[here]]
            keep, fresh = ~over, np.zeros(len(symbols), bool)
            keep[here + 1], fresh[here] = False, True
            symbols, piece, rank, found = symbols[keep], piece[keep], rank[keep], found[keep]
            fresh = fresh[keep]
            fresh[:-1] |= fresh[1:]  # the pairs to the left and to the right of a new symbol
            rank[fresh] = none
            fresh[-1:] = False
            fresh[:-1] &= piece[1:] == piece[:-1]
            stale = np.flatnonzero(fresh)
            rank[stale], found[stale] = self.search(symbols[stale], symbols[stale + 1])
        ids = np.concatenate([s for s, _ in done]) if done else np.zeros(0, np.int64)
        owner = np.concatenate([p for _, p in done]) if done else np.zeros(0, np.int64)
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(pieces))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all sequences end to end, and the offset of each sequence in them."""
        known = np.where(ids < len(self.length), ids, 0)
        count = np.where(ids < len(self.length), self.length[known], 0)
        total = np.concatenate([[0], np.cumsum(count)])
        return self.bytes[ranges(self.at[known], count)], total[offsets]


@functools.lru_cache(maxsize=4)
def _table(content: bytes) -> MergeTable:
    return MergeTable(read_spec(content))


@functools.lru_cache(maxsize=4)
def _encoder(content: bytes) -> Pieces:
    table = _table(content)
    return Pieces(table.encode, table.added)


def tokenizer_file(spark: SparkSession, path: str) -> Broadcast:
    """The file's content for all executors: read once on the driver, so its path need exist only there."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


Batches = Iterator[pa.RecordBatch]


def _with(rows: pa.RecordBatch, extra: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns, *extra.values()], names=[*rows.schema.names, *extra])


def _encoded(batches: Batches, content: bytes, text: str, ids: str, n_tokens: str) -> Batches:
    encoder = _encoder(content)
    for batch in batches:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
        for first, last in blocks(offsets, BLOCK):
            found, at = encoder(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            extra = {ids: binaries(found.view(np.uint8), at * 4), n_tokens: pa.array(np.diff(at))}
            yield _with(batch.slice(first, last - first), extra)


def _decoded(batches: Batches, content: bytes, ids: str, decoded: str) -> Batches:
    table = _table(content)
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(ids)).fill_null(b"")
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in column.to_pylist()])]).astype(np.int64)
        for first, last in blocks(offsets, BLOCK):
            own = np.frombuffer(b"".join(column.slice(first, last - first).to_pylist()), np.uint32)
            data, at = table.decode(own, (offsets[first : last + 1] - offsets[first]) // 4)
            whole = data.tobytes()
            out = [whole[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield _with(batch.slice(first, last - first), {decoded: pa.array(out, pa.string())})


def _plus(df: DataFrame, **kinds: T.DataType) -> T.StructType:
    return T.StructType([*df.schema, *(T.StructField(name, kind) for name, kind in kinds.items())])


def encode(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", n_tokens: str = "n_tokens") -> DataFrame:
    """`df` with the ids of `text` (little-endian unsigned 32-bit integers) and their number."""
    content = tokenizer_file(df.sparkSession, tokenizer)
    run = lambda batches: _encoded(batches, content.value, text, ids, n_tokens)
    return df.mapInArrow(run, _plus(df, **{ids: T.BinaryType(), n_tokens: T.LongType()}))


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`df` with the text of `ids`, special strings included; bytes that are no UTF-8 become U+FFFD."""
    content = tokenizer_file(df.sparkSession, tokenizer)
    run = lambda batches: _decoded(batches, content.value, ids, decoded)
    return df.mapInArrow(run, _plus(df, **{decoded: T.StringType()}))


def round_trip(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """`df` with ids, n_tokens and decoded: both ways in one pass, with one Python worker for a task."""
    content = tokenizer_file(df.sparkSession, tokenizer)

    def run(batches: Batches) -> Batches:
        return _decoded(_encoded(batches, content.value, text, "ids", "n_tokens"), content.value, "ids", "decoded")

    return df.mapInArrow(run, _plus(df, ids=T.BinaryType(), n_tokens=T.LongType(), decoded=T.StringType()))


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids and of the decoded text."""
    return round_trip(docs.select("doc_id", "text"), tokenizer).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
