"""Token ids as length-delimited binary records with a separate offset index.

A record is framed as in the public TFRecord layout: length (unsigned 64-bit), masked CRC-32C of the length, payload,
masked CRC-32C of the payload, all little-endian. The payload is one serialized sequence: a flag and the doc_id, the
number of ids, the bytes per id (2 while every id fits), the ids.

Texts are range-partitioned by doc_id (null first) and, where it repeats, by a hash of the text: a partition is a slice
and becomes one file in ascending order. Its task encodes and writes block by block, under a name that no other attempt
uses, and returns one index row per record; the index is committed by Spark as Parquet and names the files that count,
so a lost or repeated task leaves no wrong record. Readers take any order of index rows: a task reads neighbouring
records together, checks both checksums and unpacks the ids, block by block.

Null text is an empty sequence with only the end id; repeated rows are records of their own; an empty table gives an
empty index and no file. Paths go through pyarrow's file systems, so the folder may be local, HDFS or an object store.
"""

from __future__ import annotations

import functools
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.llm import pieces
from candlewick.llm.arrow import binaries, blocks, ranges, utf8
from candlewick.llm.bpe import BLOCK, tokenizer_file
from candlewick.sources.scratch import materialise, new_folder

HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
PAYLOAD = struct.Struct("<?qIB")
END = 2  # the id appended to each document
SLICE_BYTES = 32 << 20  # text in a file, about
SLICES = 50_000  # files at most
_LANE = 64  # bytes that a CRC step handles in one block
_TOGETHER = 1 << 19  # bytes of payloads whose checksums are computed together
_READ = 1 << 20  # bytes of records read and checked together
_POLYNOMIAL = 0x82F63B78  # CRC-32C, reflected
INDEX = "slice int, file string, number long, doc_id long, offset long, length long, first long, n_tokens long"


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _byte_table()


def _shifted(register: np.ndarray, zeros: int) -> np.ndarray:
    """CRC registers after `zeros` more zero bytes."""
    for _ in range(zeros):
        register = _TABLE[register & np.uint32(255)] ^ (register >> np.uint32(8))
    return register


# the register after four more bytes, by its lower and its upper half
_LOW, _HIGH = (_shifted(np.arange(1 << 16, dtype=np.uint32) << np.uint32(at), 4) for at in (0, 16))


@functools.cache
def _skip_tables(level: int) -> np.ndarray:
    """Four tables, one for each byte of a CRC register: the register after _LANE << level more zero bytes."""
    if level:
        half = _skip_tables(level - 1)
        return _skipped(half.ravel(), half).reshape(4, 256)
    return np.stack([_shifted(np.arange(256, dtype=np.uint32) << np.uint32(8 * i), _LANE) for i in range(4)])


def _skipped(r: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return tables[0][r & 255] ^ tables[1][(r >> 8) & 255] ^ tables[2][(r >> 16) & 255] ^ tables[3][r >> 24]


def crc32c(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32C of the bytes between neighbouring offsets, for all of them together.

    Blocks of 64 bytes, filled up with zeros in front (which do not change an empty register), are worked off
    side by side, four bytes in a step; then neighbouring blocks of each range are joined, twice as many in each round,
    again for all ranges side by side.
    """
    length = np.diff(offsets)
    n_blocks = -(-length // _LANE)
    total = int(n_blocks.sum())
    first = np.cumsum(n_blocks) - n_blocks
    front = n_blocks * _LANE - length
    own_bytes = np.ones(total * _LANE, bool)
    own_bytes[ranges(first * _LANE, front)] = False
    filled = np.zeros(total * _LANE, np.uint8)
    filled[own_bytes] = data[offsets[0] : offsets[-1]]
    # the register starts with ones: the same as the first four bytes inverted
    own = np.flatnonzero(length > 0)
    for i in range(4):
        some = own[length[own] > i]
        filled[first[some] * _LANE + front[some] + i] ^= 0xFF
    lanes = filled.view("<u4").reshape(total, _LANE // 4).T.copy()
    block = np.zeros(total, np.uint32)
    for four in lanes:
        block ^= four
        block = _LOW[block & np.uint32(0xFFFF)] ^ _HIGH[block >> np.uint32(16)]
    count, level = n_blocks, 0
    while count.max(initial=0) > 1:  # pairs are counted from the end of a range; the first block may stay alone
        left = (count + 1) // 2
        before_end = np.repeat(np.cumsum(left), left) - 1 - np.arange(int(left.sum()))
        right = np.repeat(np.cumsum(count), left) - 1 - 2 * before_end
        pair = 2 * before_end + 1 < np.repeat(count, left)
        joined = block[right]
        joined[pair] ^= _skipped(block[right[pair] - 1], _skip_tables(level))
        block, count, level = joined, left, level + 1
    register = np.zeros(len(length), np.uint32)
    register[own] = block ^ np.uint32(0xFFFFFFFF)
    for i in own[length[own] < 4].tolist():  # shorter than the register: byte by byte
        value = np.uint32(0xFFFFFFFF)
        for byte in data[offsets[i] : offsets[i + 1]].tolist():
            value = _TABLE[(value ^ np.uint32(byte)) & np.uint32(255)] ^ (value >> np.uint32(8))
        register[i] = value ^ np.uint32(0xFFFFFFFF)
    return register


def masked(crc: np.ndarray) -> np.ndarray:
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def _fields(at: np.ndarray, width: int) -> np.ndarray:
    """Places of the bytes of a field that begins at each of `at`."""
    return at[:, None] + np.arange(width)


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    out[_fields(at, values.dtype.itemsize)] = values.view(np.uint8).reshape(len(values), -1)


def _got(data: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(data[_fields(at, np.dtype(kind).itemsize)]).view(kind).ravel()


def _around(data: np.ndarray, offsets: np.ndarray, head: int, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of `data` with room for a head and a tail around each; the offsets of the wider ranges."""
    wide = offsets + (head + tail) * np.arange(len(offsets))
    out = np.zeros(int(wide[-1]), np.uint8)
    inner = np.ones(len(out), bool)
    inner[_fields(wide[:-1], head)] = False
    inner[_fields(wide[1:] - tail, tail)] = False
    out[inner] = data
    return out, wide


def _within(data: np.ndarray, offsets: np.ndarray, head: int, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of `data` without the head and the tail of each; their offsets."""
    inner = np.ones(len(data), bool)
    inner[_fields(offsets[:-1], head)] = False
    inner[_fields(offsets[1:] - tail, tail)] = False
    return data[inner], offsets - (head + tail) * np.arange(len(offsets))


def _checksums(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Masked checksums, computed for about _TOGETHER bytes side by side."""
    parts = [masked(crc32c(data, offsets[a : b + 1])) for a, b in blocks(offsets, _TOGETHER)]
    return np.concatenate([*parts, np.zeros(0, np.uint32)])


def _length_checksums(length: np.ndarray) -> np.ndarray:
    return masked(crc32c(length.astype("<u8").view(np.uint8), np.arange(len(length) + 1) * 8))


def framed(payloads: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frames of the payloads between neighbouring offsets, end to end, and their offsets."""
    length = np.diff(offsets)
    out, wide = _around(payloads, offsets, HEAD.size, TAIL.size)
    _put(out, wide[:-1], length.astype("<u8"))
    _put(out, wide[:-1] + 8, _length_checksums(length).astype("<u4"))
    _put(out, wide[1:] - TAIL.size, _checksums(payloads, offsets).astype("<u4"))
    return out, wide


def unframed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Payloads of whole frames; a frame whose length or checksums do not hold raises ValueError."""
    length = np.diff(offsets) - HEAD.size - TAIL.size
    if (length < 0).any() or (_got(data, offsets[:-1], "<u8") != length.astype(np.uint64)).any():
        raise ValueError("a record does not have the length that its frame says")
    payloads, inner = _within(data, offsets, HEAD.size, TAIL.size)
    sound = _got(data, offsets[:-1] + 8, "<u4") == _length_checksums(length)
    sound &= _got(data, offsets[1:] - TAIL.size, "<u4") == _checksums(payloads, inner)
    if not sound.all():
        raise ValueError("a record does not match its checksums")
    return payloads, inner


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _parts(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    return [data[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def frame(payloads: list[bytes]) -> list[bytes]:
    return _parts(*framed(*_joined(payloads)))


def unframe(frames: list[bytes]) -> list[bytes]:
    return _parts(*unframed(*_joined(frames)))


def packed(doc_ids: np.ndarray, missing: np.ndarray, ids: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Payloads of the ids between neighbouring offsets, end to end, and their offsets."""
    out, wide = _around(ids.astype(f"<u{width}").view(np.uint8), offsets * width, PAYLOAD.size, 0)
    out[wide[:-1]] = missing
    _put(out, wide[:-1] + 1, doc_ids.astype("<i8"))
    _put(out, wide[:-1] + 9, np.diff(offsets).astype("<u4"))
    out[wide[:-1] + 13] = width
    return out, wide


def unpacked(payloads: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, which of them are null, all ids end to end as unsigned 32-bit numbers, and their offsets."""
    at = offsets[:-1]
    missing, width, count = payloads[at] > 0, payloads[at + 13], _got(payloads, at + 9, "<u4").astype(np.int64)
    data, inner = _within(payloads, offsets, PAYLOAD.size, 0)
    ids = np.empty(int(count.sum()), "<u4")
    place = np.concatenate([[0], np.cumsum(count)])
    for w in np.unique(width).tolist():
        own = width == w
        if own.all():
            ids[:] = data.view(f"<u{w}")
        else:
            some = ranges(inner[:-1][own], np.diff(inner)[own])
            ids[ranges(place[:-1][own], count[own])] = np.ascontiguousarray(data[some]).view(f"<u{w}")
    return _got(payloads, at + 1, "<i8"), missing, ids, place


def pack(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    at = np.array([0, len(ids)], np.int64)
    return packed(np.array([doc_id or 0]), np.array([doc_id is None]), ids, at, width)[0].tobytes()


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_ids, missing, ids, _ = unpacked(np.frombuffer(payload, np.uint8), np.array([0, len(payload)]))
    return None if missing[0] else int(doc_ids[0]), ids


def _slices(docs: DataFrame, slice_bytes: int) -> int:
    """Number of files: about `slice_bytes` of text in each, more in each beyond SLICES files."""
    volume = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    return max(1, min(volume.n, -(-volume.b // slice_bytes), SLICES))


def write(docs: DataFrame, tokenizer: str, folder: str, end: int = END, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Encode whole texts with the tokenizer library, write records below `folder`; returns the committed index."""
    spark = docs.sparkSession
    content = tokenizer_file(spark, tokenizer)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pieces.library_encoder(content.value)
        width = 2 if encoder.largest < 1 << 16 and end < 1 << 16 else 4
        system, base = fs.FileSystem.from_uri(folder)
        out, name, offset, number, first = None, "", 0, 0, 0
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in blocks(offsets, BLOCK):
                if out is None:
                    name = f"{batch.column(0)[0].as_py():08d}-{uuid.uuid4().hex}.records"
                    out = system.open_output_stream(f"{base}/{name}")
                ids, at = encoder(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ids = np.insert(ids, at[1:], end)
                at = at + np.arange(len(at))
                doc_ids = batch.column(1).slice(a, b - a)
                missing = doc_ids.is_null().to_numpy(zero_copy_only=False)
                numbers = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
                frames, place = framed(*packed(numbers, missing, ids, at, width))
                out.write(frames)
                n = b - a
                columns = [
                    batch.column(0).slice(a, n),
                    pa.repeat(name, n),
                    pa.array(number + np.arange(n)),
                    doc_ids,
                    pa.array(offset + place[:-1]),
                    pa.array(np.diff(place)),
                    pa.array(first + at[:-1]),
                    pa.array(np.diff(at)),
                ]
                offset, number, first = offset + len(frames), number + n, first + len(ids)
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in INDEX.split(", ")])
        if out:
            out.close()

    fs_, base_ = fs.FileSystem.from_uri(folder)
    fs_.create_dir(base_, recursive=True)
    # texts of one doc_id are told apart by a hash, so that no doc_id, null included, is one task
    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    dealt = picked.repartitionByRange(_slices(docs, slice_bytes), *order).sortWithinPartitions(*order)
    index = dealt.select(F.spark_partition_id().alias("slice"), "doc_id", "text").mapInArrow(store, INDEX)
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records of `index` rows in any order: all index columns, then record_doc_id and ids (unsigned 32-bit)."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            files, offsets, lengths = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file", "offset", "length"))
            at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            for a, b in blocks(at, _READ):
                parts, i = [], a
                while i < b:
                    if files[i] != name:
                        if source:
                            source.close()
                        name, source = files[i], system.open_input_file(f"{base}/{files[i]}")
                    j = i + 1  # neighbours in the file come in one read
                    while j < b and files[j] == name and offsets[j] == offsets[j - 1] + lengths[j - 1]:
                        j += 1
                    source.seek(offsets[i])
                    parts.append(source.read(offsets[j - 1] + lengths[j - 1] - offsets[i]))
                    i = j
                place = at[a : b + 1] - at[a]
                data = np.frombuffer(b"".join(parts), np.uint8)
                if len(data) != place[-1]:
                    raise ValueError("a file is shorter than the index says")
                doc_ids, missing, ids, within = unpacked(*unframed(data, place))
                found = [pa.array(doc_ids, pa.int64(), mask=missing), binaries(ids.view(np.uint8), within * 4)]
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rows.columns, *found], names=[*rows.schema.names, "record_doc_id", "ids"])
        if source:
            source.close()

    fields = [T.StructField("record_doc_id", T.LongType()), T.StructField("ids", T.BinaryType())]
    return index.mapInArrow(load, T.StructType([*index.schema.fields, *fields]))


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents, read all back: doc_id, start, n_tokens, ids_crc32."""
    folder = new_folder(docs.sparkSession, "token-records")
    index = write(docs, tokenizer, folder)
    sizes = index.groupBy("slice").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    base = materialise(sizes.select("slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "file-starts")
    n = max(1, base.count())  # index rows are small, what they point at is not: a task for each file
    dealt = index.join(base, "slice").repartition(n, "slice").sortWithinPartitions("file", "offset")
    return read(dealt, folder).select(
        F.col("record_doc_id").alias("doc_id"),
        (F.col("base") + F.col("first")).alias("start"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
