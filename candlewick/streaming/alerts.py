"""Sliding-window price alerts on a stream.

State is kept per symbol and slice of time (`slice_width`, an hour unless told otherwise), so catching up with a hot symbol
is spread over many keys; narrower slices spread more and cost more calls to the state store where ticks are few. A tick
is remembered in its own slice, and its question, which is the first tick not older than the window, is asked where the
window begins: in its own slice, or in the one before. If that one has no tick from there on, the answer is the oldest
tick of the next slice, which the questions coming from there have handed over.The ticks of a slice lie in chunks of some hundred in order, each a value of a map state, with their first ticks listed in
one small value (which holds the ticks themselves as long as they are few): a batch reads and writes only the chunks that
its ticks and questions fall into, whatever the slice holds, and a catch-up writes each chunk once. A timer drops a slice
once the watermark has passed it by a window.

`transformWithState` needs the RocksDB state store: start the stream inside `rocksdb_state`, or set it for the session.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from contextlib import AbstractContextManager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from candlewick.functions.times import micros
from candlewick.plans.alerts import THRESHOLD, WINDOW, alert_message, slice_start
from candlewick.session import ROCKSDB, setting

_OUTPUT = "symbol string, us long, id long, old_price string, new_price string, price_change_pct double"
_TICKS = "us array<long>, id array<long>, price array<string>"
_KNOWN = f"first_us array<long>, first_id array<long>, chunk array<long>, {_TICKS}, next_us long, next_id long, next_price string"
CHUNK = 512  # ticks of a chunk, up to twice as many before it is cut
FEW = 64  # ticks of a slice that need no chunk


# Executors get the class itself, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Tick = tuple[int, int, str]


def _columns(ticks: list[Tick]) -> tuple[list, list, list]:
    return tuple(map(list, zip(*ticks))) if ticks else ([], [], [])


class Chunks:
    """The ticks of a slice in order, cut into chunks that are loaded and stored one by one."""

    def __init__(self, state, firsts: list[tuple[int, int]], numbers: list[int], few: list[Tick]):
        self.state, self.firsts, self.numbers, self.few = state, firsts, numbers, few
        self.loaded: dict[int, list[Tick]] = {}

    def load(self, place: int) -> list[Tick]:
        number = self.numbers[place]
        if number not in self.loaded:
            self.loaded[number] = list(zip(*self.state.getValue((number,))))
        return self.loaded[number]

    def add(self, ticks: list[Tick]) -> None:
        if not self.numbers and len(self.few) + len(ticks) <= FEW:
            self.few = sorted([*self.few, *ticks])
            return
        placed: dict[int, list[Tick]] = {}
        for tick in [*self.few, *ticks]:  # a tick before the first chunk belongs to it
            placed.setdefault(max(0, bisect_right(self.firsts, tick[:2]) - 1), []).append(tick)
        self.few = []
        for place in sorted(placed, reverse=True):  # from behind, as a cut moves what follows
            held = sorted([*(self.load(place) if self.numbers else []), *placed[place]])
            size = len(held) if len(held) <= 2 * CHUNK else CHUNK
            pieces = [held[i : i + size] for i in range(0, len(held), size)]
            fresh = max(self.numbers, default=-1) + 1
            own = [*self.numbers[place : place + 1], *range(fresh, fresh + len(pieces))][: len(pieces)]
            for number, piece in zip(own, pieces):
                self.loaded[number] = piece
                self.state.updateValue((number,), _columns(piece))
            self.numbers[place : place + 1] = own
            self.firsts[place : place + 1] = [piece[0][:2] for piece in pieces]

    def first(self, moment: int) -> Tick | None:
        """The first tick from `moment` on."""
        if self.few:
            at = bisect_left(self.few, (moment,))
            return self.few[at] if at < len(self.few) else None
        place = bisect_left(self.firsts, (moment,))
        if place:
            before = self.load(place - 1)
            at = bisect_left(before, (moment,))
            if at < len(before):
                return before[at]
        return self.load(place)[0] if place < len(self.numbers) else None


class WindowAlerts(StatefulProcessor):
    """Compares each new tick with the oldest tick of its window; a key is (symbol, start of a slice).

    `own` rows are ticks of the slice; `asks` says that the window begins in this slice too.
    """

    def __init__(self, span: int, slice_span: int, threshold: float):
        self.span, self.slice_span, self.threshold = span, slice_span, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ticks = handle.getMapState("ticks", "chunk long", _TICKS)
        # the chunks or the few ticks, and the oldest tick of the next slice that has asked here
        self.known = handle.getValueState("known", _KNOWN)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        symbol, start = key
        told: list[Tick] = []
        asked: list[Tick] = []
        following: list[Tick] = []
        for r in rows:
            tick = (r.us, r.id, r.price)
            (told if r.own else following).append(tick)
            if r.asks:
                asked.append(tick)
        known = self.known.get()  # one value: going through the keys of a map state costs far more
        if known is None:
            self.handle.registerTimer((start + self.slice_span + self.span) // 1000)
            chunks, head = Chunks(self.ticks, [], [], []), None
        else:
            chunks = Chunks(self.ticks, list(zip(known[0], known[1])), list(known[2]), list(zip(*known[3:6])))
            head = None if known[6] is None else tuple(known[6:])
        if told:
            chunks.add(told)
        oldest = min([head, *following] if head else following, default=None)
        if known is None or told or oldest != head:
            us, ids = zip(*chunks.firsts) if chunks.firsts else ((), ())
            self.known.update((list(us), list(ids), chunks.numbers, *_columns(chunks.few), *(oldest or (None, None, None))))
        for us, id_, price in sorted(asked):
            old = chunks.first(us - self.span) or oldest
            before, after = float(old[2]), float(price)
            pct = (after - before) / before * 100 if before else 0.0
            if abs(pct) > self.threshold:
                yield Row(symbol=symbol, us=us, id=id_, old_price=old[2], new_price=price, price_change_pct=pct)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.ticks.clear()
        self.known.clear()
        return iter(())

    def close(self) -> None:
        pass


def rocksdb_state(spark: SparkSession) -> AbstractContextManager:
    """The state store that the alert stream needs, for streams that are started inside."""
    return setting(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB)


def alert_stream(
    ticks: DataFrame,
    window: str = WINDOW,
    threshold: float = THRESHOLD,
    delay: str = "1 minute",
    slice_width: str = "1 hour",
) -> DataFrame:
    """Alerts in event time. A tick is compared with the ticks that arrived before or with it; one later than
    `delay` is left out."""
    span, slice_span = micros(window), micros(slice_width)
    if slice_span < span:
        raise ValueError("a slice must not be shorter than the window")
    us = F.col("us")
    own = slice_start(us, slice_span)
    inside = us - span >= own  # the window begins in the tick's own slice
    told = F.struct(own.alias("slice"), F.lit(True).alias("own"), inside.alias("asks"))
    before = F.when(~inside, F.struct((own - slice_span).alias("slice"), F.lit(False).alias("own"), F.lit(True).alias("asks")))
    targets = F.array_compact(F.array(told, before))
    placed = (
        ticks.withWatermark("time", delay)
        .filter(F.col("symbol").isNotNull() & F.col("price").isNotNull())
        .select("time", "symbol", "id", F.unix_micros("time").alias("us"), F.col("price").cast("string").alias("price"))
        .withColumn("t", F.explode(targets))
        .select("time", "symbol", "id", "us", "price", "t.slice", "t.own", "t.asks")
    )
    alerts = placed.groupBy("symbol", "slice").transformWithState(
        statefulProcessor=WindowAlerts(span, slice_span, threshold),
        outputStructType=_OUTPUT,
        outputMode="Append",
        timeMode="EventTime",
    )
    return alerts.select(
        "symbol",
        F.timestamp_micros("us").alias("time"),
        "id",
        F.col("old_price").cast("decimal(20,8)").alias("old_price"),
        F.col("new_price").cast("decimal(20,8)").alias("new_price"),
        "price_change_pct",
    ).withColumn("message", alert_message(window))
