"""WARC records in ZIP archives: written with an index, read back by byte ranges without extraction.

Writer: equal payloads are found by their SHA-1; of those the record with the smallest page_id is a response, the
others are revisits that name it. A task puts its records, each a gzip member of its own as usual in `.warc.gz`, into a
member that is stored in a ZIP archive beside a `.cdx` member with offset and length of every record. Archives have names that no other
attempt uses; Spark commits their list as Parquet, so a lost or repeated task leaves no wrong archive.

Reader: for each archive it reads the end of the file, the central directory (ZIP64 where a 32-bit field is full or
its locator is there), the local headers of stored members and the `.cdx` members, and so gets the byte range of every
record in the archive file. Records are then read range by range in tasks of their own. Compressed members are not
read: an index in one raises ValueError.

Null html is an empty payload; a null url gives no target header; null page_id: `-` in the headers, null when read.
Pages that repeat a page_id and payload are all responses if that page_id is the smallest of the payload. An empty
table gives no archive and an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import struct
import urllib.parse
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise, new_folder

ARCHIVE_BYTES = 32 << 20  # records in an archive, about
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RANGES = "archive string, member string, offset long, length long"
# Fixed values of the ZIP format: signatures and layouts of its records.
LOCAL = struct.Struct("<4s5H3L2H")
CENTRAL = struct.Struct("<4s6H3L5H2L")
END = struct.Struct("<4s4H2LH")
LOCATOR = struct.Struct("<4sLQL")
END64 = struct.Struct("<4sQ2H2L4Q")
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def name_of(page_id: int | None) -> str:
    return f"<urn:page:{'-' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, own_digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without the payload if `refers_to` names another page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": name_of(page_id),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{own_digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        fields["WARC-Target-URI"] = urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if refers_to is not None:
        fields |= {"WARC-Refers-To": name_of(refers_to), "WARC-Profile": REVISIT}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a record, plain or gzip; the digest of a payload
    is checked."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no record begins at this offset")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^Content-Length: (\d+)", http)[1])
    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page = lambda v: None if v is None or v == name_of(None) else int(v[len("<urn:page:") : -1])
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": page(fields["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": named,
        "record_type": fields["WARC-Type"],
        "refers_to": page(fields.get("WARC-Refers-To")),
    }


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every page; returns the committed list of archives: (archive, records)."""
    spark = pages.sparkSession
    html = F.coalesce("html", F.lit("")).alias("html")
    sent = pages.select("page_id", "url", html).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    # counts stay small before the shuffle, and copies of one payload are split by the join
    smallest = sent.groupBy(F.col("sha1").alias("of")).agg(F.min("page_id").alias("smallest"))
    joined = sent.join(smallest, sent["sha1"] == smallest["of"])
    other = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("smallest")), F.col("smallest"))
    rows = joined.select("page_id", "url", other.alias("refers_to"), "html")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        parts, size = [], 0

        def close() -> pa.RecordBatch:
            name, out = f"{uuid.uuid4().hex}.zip", io.BytesIO()
            lines, at = [], 0
            for page, part in parts:
                lines.append(f"{page} {at} {len(part)}\n")
                at += len(part)
            with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
                # 64-bit sizes in the local header, as for members of any size
                with archive.open("archive/data.warc.gz", "w", force_zip64=True) as member:
                    for _, part in parts:
                        member.write(part)
                archive.writestr("indexes/index.cdx", " CDX page offset length archive/data.warc.gz\n" + "".join(lines))
            with system.open_output_stream(f"{base}/{name}") as file:
                file.write(out.getbuffer())
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(parts)], pa.int64())], names=["archive", "records"])

        for batch in batches:
            for page, url, refers, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                payload = text.encode()
                made = gzip.compress(record(page, url, payload, digest(payload), refers), mtime=0)
                if parts and size + len(made) > archive_bytes:
                    yield close()
                    parts, size = [], 0
                parts.append(("-" if page is None else page, made))
                size += len(made)
        if parts:
            yield close()

    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    rows.mapInArrow(store, "archive string, records long").write.parquet(f"{folder}/archives")
    return spark.read.schema("archive string, records long").parquet(f"{folder}/archives")


Read = Callable[[int, int], bytes]


def directory(read: Read, size: int) -> list[tuple[str, int, int, int, int]]:
    """(name, method, compressed size, size, offset of the local header) of every member of an archive."""
    tail_at = max(0, size - END.size - FULL16 - LOCATOR.size)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0:  # the signature may also occur in the archive's comment
        end = END.unpack_from(tail, at) if at + END.size <= len(tail) else None
        if end and tail_at + at + END.size + end[7] == size:
            break
        at = tail.rfind(b"PK\x05\x06", 0, at)
    else:
        raise ValueError("no ZIP archive: its end record is missing")
    length, begin = end[5], end[6]
    before = at - LOCATOR.size
    if before >= 0 and tail[before : before + 4] == b"PK\x06\x07":
        end64 = END64.unpack(read(LOCATOR.unpack_from(tail, before)[2], END64.size))
        if end64[0] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is not where its locator says")
        length, begin = end64[8], end64[9]
    data, at, members = read(begin, length), 0, []
    while at < length:
        entry = CENTRAL.unpack_from(data, at)
        if entry[0] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        n_name, n_extra, n_comment = entry[10:13]
        at += CENTRAL.size
        name = data[at : at + n_name].decode("utf-8" if entry[3] & 0x800 else "cp437")
        packed, plain, offset = _wide(data[at + n_name : at + n_name + n_extra], entry[8], entry[9], entry[16])
        members.append((name, entry[4], packed, plain, offset))
        at += n_name + n_extra + n_comment
    return members


def _wide(extra: bytes, packed: int, plain: int, offset: int) -> tuple[int, int, int]:
    """Sizes and offset with the 64-bit values of the extra field (kind 1) for those that are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{min(n, 24) // 8}Q", extra, at + 4))
            plain = next(wide) if plain == FULL32 else plain
            packed = next(wide) if packed == FULL32 else packed
            offset = next(wide) if offset == FULL32 else offset
        at += 4 + n
    return packed, plain, offset


def data_offset(read: Read, header: int) -> int:
    """Where a member's bytes begin: behind its local header, whose name and extra field may differ in length."""
    local = LOCAL.unpack(read(header, LOCAL.size))
    if local[0] != b"PK\x03\x04":
        raise ValueError("no local header where the central directory says")
    return header + LOCAL.size + local[9] + local[10]


def locate(read: Read, size: int) -> Iterator[tuple[str, int, int]]:
    """(member, offset in the archive file, length) of every record that the archive's indexes list."""
    members = {name: rest for name, *rest in directory(read, size)}
    for name, (method, packed, _, header) in members.items():
        if not name.endswith(".cdx"):
            continue
        if method:
            raise ValueError(f"the index {name} is compressed")
        title, *lines = read(data_offset(read, header), packed).decode().splitlines()
        target = title.split()[-1]
        if members[target][0]:
            raise ValueError(f"the member {target} is compressed")
        begin = data_offset(read, members[target][3])
        for line in lines:
            _, at, length = line.rsplit(" ", 2)
            if int(at) + int(length) > members[target][1]:
                raise ValueError(f"the index {name} points behind the end of {target}")
            yield target, begin + int(at), int(length)


def record_ranges(archives: DataFrame, folder: str) -> DataFrame:
    """Byte range of every record; `archives` has the column archive, file names below `folder`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(batch.schema.get_field_index("archive")).to_pylist():
                with system.open_input_file(f"{base}/{name}") as file:
                    found = list(locate(lambda at, n, f=file: f.read_at(n, at), file.size()))
                columns = [pa.array([name] * len(found)), *(pa.array([r[i] for r in found], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64())))]
                yield pa.RecordBatch.from_arrays(columns, names=["archive", "member", "offset", "length"])

    return archives.mapInArrow(run, RANGES)


def read(ranges: DataFrame, folder: str) -> DataFrame:
    """The records at the given ranges: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names, kinds = [c.split()[0] for c in schema.split(", ")], [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        name, file = None, None
        for batch in batches:
            column = lambda c: batch.column(batch.schema.get_field_index(c)).to_pylist()  # noqa: B023, E731
            found = []
            for archive, offset, length in zip(column("archive"), column("offset"), column("length")):
                if archive != name:
                    if file:
                        file.close()
                    name, file = archive, system.open_input_file(f"{base}/{archive}")
                found.append(parse(file.read_at(length, offset)))
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], t) for n, t in zip(names, kinds)], names=names)
        if file:
            file.close()

    return ranges.mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read all records back."""
    folder = new_folder(pages.sparkSession, "warc")
    archives = write(pages, folder)
    n = max(1, archives.count())  # ranges are small, what they point at is not: a task for each archive
    found = materialise(record_ranges(archives.repartition(n, "archive"), folder), "warc-ranges")
    return read(found.repartition(n, "archive").sortWithinPartitions("archive", "offset"), folder)
