import time

"""Streams in several micro-batches against their batch twins."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from helpers import TICKS, at, rows, tick, ticks
from pyspark.sql import functions as F

from candlewick.plans import alerts, candles
from candlewick.schema import MESSAGES
from candlewick.streaming import jobs
from candlewick.sources.log import to_log_rows
from candlewick.streaming import late
from candlewick.streaming.alerts import CHUNK, Chunks, WindowAlerts, alert_stream, rocksdb_state


def write_batches(spark, folder, schema, *batches):
    """One file per batch, in reading order."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder, schema=TICKS, max_files=1):
    return jobs.file_stream(spark, folder, spark.createDataFrame([], schema).schema, max_files)


def random_ticks(n=240, seconds=9000):
    rng = random.Random(3)
    moments = sorted(rng.random() * seconds for _ in range(n))
    base = at("2024-01-01 22:30:00")
    return [tick(i, base + dt.timedelta(microseconds=int(s * 1e6)), symbol=rng.choice("AAB"), price=str(90 + rng.randrange(40)))
            for i, s in enumerate(moments)]


@pytest.mark.parametrize("slice_width", ["5 minutes", "1 hour"])
def test_alerts_in_time_order_equal_the_batch(spark, tmp_path, slice_width):
    data = random_ticks()
    write_batches(spark, str(tmp_path / "in"), TICKS, *[data[i : i + 60] for i in range(0, 240, 60)])
    stream = alert_stream(source(spark, str(tmp_path / "in")), slice_width=slice_width)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    with rocksdb_state(spark):
        query = jobs.write_stream(stream, str(tmp_path / "out"))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before  # other streams keep theirs
    jobs.run_bounded(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    got, want = spark.read.parquet(str(tmp_path / "out")), alerts.price_alerts(ticks(spark, *data))
    assert want.count() > 20
    assert rows(got, "id", "old_price", "new_price", "message") == rows(want, "id", "old_price", "new_price", "message")
    kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    # passed slices are forgotten; a row is a slice, or a part of one with many ticks (all ticks have over 150 of them)
    assert kept < (20 if slice_width == "5 minutes" else 80)


def test_alert_slices_cannot_be_shorter_than_the_window(spark, tmp_path):
    write_batches(spark, str(tmp_path / "in"), TICKS, random_ticks(2))
    with pytest.raises(ValueError):
        alert_stream(source(spark, str(tmp_path / "in")), slice_width="1 minute")


class Store:
    """States of one key that count what is read and written."""

    def __init__(self):
        self.map, self.value, self.touched, self.timers = {}, None, 0, []

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return SimpleNamespace(get=lambda: self.value, update=lambda v: setattr(self, "value", v), clear=lambda: None)

    def registerTimer(self, ms):
        self.timers.append(ms)

    def getValue(self, key):
        self.touched += len(self.map.get(key, ((),))[0])
        return self.map.get(key)

    def updateValue(self, key, value):
        self.map[key] = value

    def clear(self):
        self.map.clear()


def test_a_batch_touches_the_chunks_of_its_ticks_only():
    store, processor = Store(), WindowAlerts(300_000_000, 3_600_000_000, 10.0)
    processor.init(store)
    row = lambda us, own, asks: SimpleNamespace(us=us, id=us, price="1", own=own, asks=asks)
    for first in range(0, 30_000, 100):  # ten ticks a second, a batch every ten seconds
        ticks = [row(n * 100_000, True, n >= 3_000) for n in range(first, first + 100)]
        store.touched = 0
        list(processor.handleInputRows(("A", 0), iter(ticks), None))
        assert store.touched <= 4 * CHUNK
    assert 30_000 / (2 * CHUNK) <= len(store.map) <= 30_000 / CHUNK + 1 and set(store.timers) == {3_900_000}
    assert sorted(t for us, *_ in store.map.values() for t in us) == [n * 100_000 for n in range(30_000)]


@pytest.mark.parametrize("batches", [1, 7, 60])
def test_chunks_find_the_first_tick_in_any_order(batches):
    rng = random.Random(batches)
    ticks = [(rng.randrange(4000), i, str(i)) for i in range(6000)]
    store, chunks, told = Store(), None, []
    for n in range(batches):
        chunks = Chunks(store, *([[], [], []] if chunks is None else [chunks.firsts, chunks.numbers, chunks.few]))
        new = ticks[n * len(ticks) // batches : (n + 1) * len(ticks) // batches]
        chunks.add(new)
        told = sorted(told + new)
        for moment in rng.sample(range(-5, 4010), 40):
            assert chunks.first(moment) == next((t for t in told if t[0] >= moment), None)
    assert chunks.firsts == sorted(chunks.firsts) and len(set(chunks.numbers)) == len(store.map)


def test_the_oldest_tick_of_the_next_slice_is_handed_over():
    store, processor = Store(), WindowAlerts(300_000_000, 900_000_000, 10.0)
    processor.init(store)
    ask = lambda us, price: SimpleNamespace(us=us, id=us, price=price, own=False, asks=True)
    assert list(processor.handleInputRows(("A", 0), iter([ask(905_000_000, "100")]), None)) == []
    (alert,) = processor.handleInputRows(("A", 0), iter([ask(910_000_000, "120")]), None)  # a batch later, nothing before it
    assert alert.old_price == "100" and alert.price_change_pct == pytest.approx(20)


def test_append_resumes_from_its_checkpoint(spark, tmp_path):
    inbox, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def message(i, value=None):
        text = value or f'{{"symbol":"A","price":{i + 1},"timestamp":"2024-01-0{1 + i % 2}T00:00:00"}}'
        return (f"k{i}", text, "ticks", 0, i, at("2024-01-01"))

    write_batches(spark, inbox, MESSAGES, [message(0), message(1)], [message(2, "broken")])
    stream = lambda: jobs.file_stream(spark, inbox)
    jobs.run_bounded(jobs.append_ticks(stream(), out, mark))
    write_batches(spark, inbox, MESSAGES, [message(3)])
    query = jobs.run_bounded(jobs.append_ticks(stream(), out, mark), seconds=60)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1  # earlier files are not read again
    jobs.run_bounded(jobs.append_ticks(stream(), out, mark))
    assert rows(spark.read.parquet(out), "price") == [(1,), (2,), (4,)]
    assert spark.read.parquet(out).select("dt").distinct().count() == 2


def test_a_bounded_run_stops_after_its_time(spark, tmp_path):
    write_batches(spark, str(tmp_path / "in"), MESSAGES, [("k", "x", "ticks", 0, 0, at("2024-01-01"))])
    query = jobs.write_stream(jobs.file_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), every=jobs.FLUSH_INTERVAL)
    jobs.run_bounded(query, seconds=8)
    assert not query.isActive and spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_redelivery_across_batches_is_dropped(spark, tmp_path):
    first = [(f"k{i}", "v", "ticks", 0, i, at("2024-01-01")) for i in range(3)]
    again = [(f"k{i}", "v", "ticks", 0, i + 10, at("2024-01-01 00:30:00")) for i in range(1, 5)]
    write_batches(spark, str(tmp_path / "in"), MESSAGES, first, again)
    stream = jobs.first_deliveries(jobs.file_stream(spark, str(tmp_path / "in"), max_files=1))
    jobs.run_bounded(jobs.write_stream(stream, str(tmp_path / "out")))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "key") == [(f"k{i}",) for i in range(5)]


def test_candles_in_update_mode_equal_the_batch(spark, tmp_path):
    data = random_ticks()
    write_batches(spark, str(tmp_path / "in"), TICKS, *[data[i : i + 80] for i in range(0, 240, 80)])
    keys = ["dt", "bucket", "symbol", "exchange"]
    stream = jobs.candle_stream(source(spark, str(tmp_path / "in")))
    jobs.run_bounded(jobs.upsert_stream(stream, str(tmp_path / "out"), keys, "bucket"))
    got, want = spark.read.parquet(str(tmp_path / "out")).drop("dt"), candles.candles_by(ticks(spark, *data))
    exact = ["bucket", "symbol", "open", "high", "low", "close", "volume", "num_trades", "avg_price"]
    assert rows(got, *exact) == rows(want, *exact)


def test_candles_leave_out_ticks_behind_the_watermark(spark, tmp_path):
    batches = ([tick(1, "2024-01-01 00:00:00")], [tick(2, "2024-01-01 06:00:00")], [tick(4, "2024-01-01 05:00:00")],
               [tick(3, "2024-01-01 00:01:00")])
    write_batches(spark, str(tmp_path / "in"), TICKS, *batches)
    stream = jobs.candle_stream(source(spark, str(tmp_path / "in")), "2 hours")
    jobs.run_bounded(jobs.upsert_stream(stream, str(tmp_path / "out"), ["dt", "bucket", "symbol"], "bucket"))
    got = rows(spark.read.parquet(str(tmp_path / "out")).select(F.hour("bucket"), "num_trades"))
    assert got == [(0, 1), (5, 1), (6, 1)]


def test_throughput_numbers(spark, tmp_path):
    write_batches(spark, str(tmp_path / "in"), MESSAGES, [("k", "four", "ticks", 0, 0, at("2024-01-01"))])
    watched = jobs.observed(jobs.file_stream(spark, str(tmp_path / "in")))
    log = jobs.ProgressLog(spark)
    query = jobs.run_bounded(jobs.write_stream(watched, str(tmp_path / "out")))
    for _ in range(100):  # progress reaches listeners a moment later
        if log.throughput(query).count():
            break
        time.sleep(0.1)
    spark.streams.removeListener(log)
    assert rows(log.throughput(query), "batch_id", "input_rows")[0] == (0, 1)
    log.write(str(tmp_path / "progress"))
    assert spark.read.parquet(str(tmp_path / "progress")).filter(F.col("query") == str(query.id)).count() >= 1
    assert log.throughput(query).count() == 0
    seen = [p.observedMetrics for p in query.recentProgress if p.observedMetrics]
    assert tuple(seen[0]["throughput"]) == (1, 4)


def test_late_ticks_are_kept_and_repaired(spark, tmp_path):
    data = random_ticks(120, 40000)
    rng = random.Random(9)
    rng.shuffle(data)
    inbox, path, out = (str(tmp_path / n) for n in ("in", "split", "candles"))
    write_batches(spark, inbox, TICKS, *[data[i : i + 30] for i in range(0, 120, 30)])
    every = to_log_rows(ticks(spark, *data))
    schema = every.schema
    mark = str(tmp_path / "mark")
    jobs.run_bounded(late.split_late(source(spark, inbox), path, "10 minutes", mark))
    found = late.late_ticks(spark, path, schema)
    assert found.filter("batch = 0").count() == 0 and 30 < found.count() < 90
    assert rows(late.on_time(spark, path, schema).unionByName(found.drop("batch")), "id") == rows(every, "id")
    stream = jobs.candle_stream(jobs.file_stream(spark, f"{path}/{late.ON_TIME}/*", schema), "60 days")
    jobs.run_bounded(jobs.upsert_stream(stream, out, ["dt", "bucket", "symbol", "exchange"], "bucket"))
    want = candles.candles_by(every).withColumn("price_stddev", F.round("price_stddev", 6))
    stored = lambda: rows(spark.read.parquet(out).withColumn("price_stddev", F.round("price_stddev", 6)), *want.columns)
    assert stored() != rows(want)
    hit = found.selectExpr("window(time, '15 minutes').start", "symbol", "exchange").distinct().count()
    assert late.repair_candles(spark, path, out, schema) == hit
    assert stored() == rows(want)
    assert late.repair_candles(spark, path, out, schema) == 0  # all repaired


def test_a_repeated_batch_of_the_split_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "split")
    data = random_ticks(40, 40000)
    write_batches(spark, str(tmp_path / "in"), TICKS, data[20:], data[:20])
    for mark in ("one", "two"):  # the second run starts from nothing, as after a lost checkpoint
        jobs.run_bounded(late.split_late(source(spark, str(tmp_path / "in")), path, "10 minutes", str(tmp_path / mark)))
    schema = to_log_rows(ticks(spark, *data)).schema
    counts = late.on_time(spark, path, schema).count(), late.late_ticks(spark, path, schema).count()
    assert sum(counts) == 40 and counts[1] > 0
