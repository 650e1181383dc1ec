"""The message log as a stream source with positions.

    spark.dataSource.register(MessageLog)
    spark.readStream.format("message_log").option("path", ...).option("startingOffsets", "earliest").load()

Options carry the names that the Kafka source gives them:

* `startingOffsets`: `earliest`, `latest`, or JSON {"topic": {"partition": offset}}; partitions that the JSON does not
  name, and those that appear later, start at the beginning. Only a query without a checkpoint starts there; any other
  goes on where its checkpoint stands.
* `subscribe`: topics, separated by commas; none: all.
* `maxOffsetsPerTrigger`: messages in a batch at most.
* `minOffsetsPerTrigger` with `maxTriggerDelay` (seconds): a batch waits until so many messages are there, or the oldest
  of them has waited so long. Set both row limits to the same number and a batch is written after that many rows or
  that many seconds, whichever comes first.
* `position`: a file for the end of the last batch that was offered. Admission goes on from there after a restart; what
  a batch holds is still settled by the checkpoint, so a lost file costs one larger batch and never a message.
* `rowsPerTask`: a partition's share of a batch is cut at its segments into tasks of about that size.

An offset of the stream is the next offset of every (topic, partition).
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from candlewick.schema import MESSAGES

# Executors get the classes themselves, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_TASK = 1_000_000


class Part(InputPartition):
    """Offsets [start, end) of one (topic, partition) in some of its segments."""

    def __init__(self, topic: str, partition: int, start: int, end: int, files: list[str]):
        self.topic, self.partition, self.start, self.end, self.files = topic, partition, start, end, files


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> StructType:
        return MESSAGES

    def streamReader(self, schema: StructType) -> MessageLogReader:
        return MessageLogReader(dict(self.options))


def _place(topic: str, partition: int) -> str:
    return f"{topic}/{partition}"


def shared_out(room: int, waiting: dict[str, int]) -> dict[str, int]:
    """`room` dealt to the places in proportion to what waits there; what rounding leaves goes to the largest rests."""
    total = sum(waiting.values())
    if total <= room:
        return dict(waiting)
    share = {p: n * room // total for p, n in waiting.items()}
    rest = sorted(waiting, key=lambda p: (-(waiting[p] * room % total), p))
    for p in rest[: room - sum(share.values())]:
        share[p] += 1
    return share


class MessageLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.path = options["path"].rstrip("/")
        self.starting = options.get("startingoffsets", "earliest")
        self.topics = {t.strip() for t in options.get("subscribe", "").split(",") if t.strip()}
        self.most = int(options.get("maxoffsetspertrigger", 0)) or None
        self.least = int(options.get("minoffsetspertrigger", 0)) or None
        self.delay = float(options.get("maxtriggerdelay", 0))
        self.position = options.get("position")
        self.rows_per_task = int(options.get("rowspertask", ROWS_PER_TASK))
        self.offered: dict[str, int] | None = None
        self.waiting_since: float | None = None
        self.index: dict[str, list[tuple]] = {}  # of each index file, read once

    # --- the index ---

    def _segments(self) -> dict[str, list[tuple[int, int, int, str]]]:
        """(first, last, rows, file) of the committed segments of every place, in order."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.path)
        listing = system.get_file_info(fs.FileSelector(f"{base}/index", allow_not_found=True))
        for info in listing:
            name = info.base_name
            if name.endswith(".parquet") and not name.startswith(("_", ".")) and name not in self.index:
                table = pq.read_table(info.path, filesystem=system, partitioning=None)
                columns = ("append", "file", "topic", "partition", "first", "last", "rows")
                self.index[name] = list(zip(*(table.column(c).to_pylist() for c in columns)))
        rows = [row for file in self.index.values() for row in file]
        folder: dict[str, str] = {}
        for append, file, *_ in rows:
            own = file.split("/")[1]
            folder[append] = min(folder.get(append, own), own)
        found: dict[str, list] = {}
        for append, file, topic, partition, first, last, n in rows:
            if file.split("/")[1] == folder[append] and (not self.topics or topic in self.topics):
                found.setdefault(_place(topic, partition), []).append((first, last, n, file))
        return {place: sorted(own) for place, own in found.items()}

    # --- positions ---

    def initialOffset(self) -> dict:
        segments = self._segments()
        if self.starting == "latest":
            return {p: own[-1][1] + 1 for p, own in segments.items()}
        start = {p: own[0][0] for p, own in segments.items()}
        if self.starting != "earliest":
            for topic, own in json.loads(self.starting).items():
                start |= {_place(topic, int(partition)): offset for partition, offset in own.items()}
        return start

    def latestOffset(self) -> dict:
        segments = self._segments()
        if self.offered is None:
            self.offered = self._read_position()
        begin = self.offered if self.offered is not None else self.initialOffset()
        begin = {p: own[0][0] for p, own in segments.items()} | begin
        end = dict(begin)
        waiting = {p: n for p, own in segments.items() if (n := self._between(own, begin[p], None))}
        total = sum(waiting.values())
        if not total:
            self.waiting_since = None
        elif self._ripe(total):
            share = shared_out(self.most or total, waiting)
            end |= {p: self._after(segments[p], begin[p], share[p]) for p in waiting if share[p]}
            self.waiting_since = None
        if end != self.offered:
            self.offered = end
            self._write_position(end)
        return end

    def _ripe(self, total: int) -> bool:
        if self.least is None or total >= self.least:
            return True
        now = time.monotonic()
        self.waiting_since = now if self.waiting_since is None else self.waiting_since
        return now - self.waiting_since >= self.delay

    @staticmethod
    def _between(segments: list[tuple], begin: int, end: int | None) -> int:
        """Messages from `begin` on; in a segment that is cut, offsets count as messages."""
        total = 0
        for first, last, n, _ in segments:
            low, high = max(first, begin), last + 1 if end is None else min(last + 1, end)
            if high > low:
                total += n if (low, high) == (first, last + 1) else min(n, high - low)
        return total

    @staticmethod
    def _after(segments: list[tuple], begin: int, count: int) -> int:
        """The offset behind `count` messages from `begin` on."""
        for first, last, n, _ in segments:
            low = max(first, begin)
            held = n if low == first else min(n, max(0, last + 1 - low))
            if not held:
                continue
            if held > count:
                return low + count
            count -= held
            begin = last + 1
            if not count:
                break
        return begin

    def _read_position(self) -> dict[str, int] | None:
        from pyarrow import fs

        if not self.position:
            return None
        system, path = fs.FileSystem.from_uri(self.position)
        if system.get_file_info(path).type != fs.FileType.File:
            return None
        with system.open_input_stream(path) as source:
            return json.loads(source.read().decode())

    def _write_position(self, offset: dict[str, int]) -> None:
        from pyarrow import fs

        if not self.position:
            return
        system, path = fs.FileSystem.from_uri(self.position)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(f"{path}.new") as out:
            out.write(json.dumps(offset).encode())
        system.move(f"{path}.new", path)

    # --- batches ---

    def partitions(self, start: dict, end: dict) -> list[Part]:
        parts = []
        segments = self._segments()
        for place, stop in sorted(end.items()):
            topic, partition = place.rsplit("/", 1)
            own = segments.get(place, [])
            begin = start.get(place, own[0][0] if own else stop)
            files, rows = [], 0
            for first, last, n, file in own:
                if last < begin or first >= stop:
                    continue
                files.append(f"{self.path}/{file}")  # whole, as tasks know no more than this
                rows += n
                if rows >= self.rows_per_task:
                    parts.append(Part(topic, int(partition), begin, stop, files))
                    files, rows = [], 0
            if files:
                parts.append(Part(topic, int(partition), begin, stop, files))
        return parts

    def read(self, partition: Part) -> Iterator:
        import pyarrow as pa
        from pyarrow import dataset, fs

        system, _ = fs.FileSystem.from_uri(partition.files[0])
        paths = [fs.FileSystem.from_uri(f)[1] for f in partition.files]
        field = dataset.field
        wanted = (field("topic") == partition.topic) & (field("partition") == partition.partition)
        wanted &= (field("offset") >= partition.start) & (field("offset") < partition.end)
        # row groups of other places and offsets are passed over by their statistics
        for batch in dataset.dataset(paths, filesystem=system, format="parquet").to_batches(columns=MESSAGES.names, filter=wanted):
            if batch.num_rows:
                time = batch["timestamp"].cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], time], names=MESSAGES.names)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass
