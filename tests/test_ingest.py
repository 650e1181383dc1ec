import datetime as dt
import json
import os
import shutil
import time
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import TICKS, at, rows, tick, ticks
from pyspark.sql import functions as F

from candlewick.plans import candles, latest, monitor, refresh
from candlewick.plans.staging import staged_ticks
from candlewick.schema import MESSAGES, TICK_LOG, SchemaDrift, check_same_columns
from candlewick.session import setting
from candlewick.sources import footers, log
from candlewick.sources import messages as wire
from candlewick.sources import scratch


def message(value, offset=0, key="k", topic="ticks", partition=0):
    text = value if isinstance(value, (str, type(None))) else json.dumps(value)
    return (key, text, topic, partition, offset, at("2024-01-01"))


def parse(spark, *values):
    return wire.parse_messages(spark.createDataFrame([message(v, i) for i, v in enumerate(values)], MESSAGES))


GOOD = {"symbol": "BTC-USD", "price": 42000.12345678, "timestamp": "2024-01-01T00:00:01.5", "source": "s"}


def test_fields_and_defaults(spark):
    row = parse(spark, {k: v for k, v in GOOD.items() if k != "source"}).first()
    assert (row.symbol, row.price, row.volume, row.exchange) == ("BTC-USD", Decimal("42000.12345678"), Decimal(0), "coinbase")
    assert row.time == dt.datetime(2024, 1, 1, 0, 0, 1, 500000) and row.problem is None and row.bid is None


def test_explicit_null_is_not_a_missing_field(spark):
    row = parse(spark, {**GOOD, "volume": None, "source": None}).first()
    assert row.volume is None and row.exchange is None


def test_price_as_text_and_quotes(spark):
    row = parse(spark, {**GOOD, "price": "1.5", "bid": 1.4, "ask": "1.6", "volume": "2"}).first()
    assert (row.price, row.bid, row.ask, row.volume) == (Decimal("1.5"), Decimal("1.4"), Decimal("1.6"), Decimal(2))


def test_rejects_keep_the_message_and_the_reason(spark):
    parsed = parse(spark, GOOD, '{"symbol": "A", "pr', None, "[1]", {**GOOD, "price": "abc"}, {**GOOD, "symbol": None},
                   {**GOOD, "timestamp": "yesterday"}, {"price": 1})
    bad = wire.rejected(parsed)
    assert wire.accepted(parsed).count() == 1
    assert bad.columns == [*MESSAGES.names, "problem"]
    assert rows(bad, "offset", "problem") == [
        (1, "malformed json"), (2, "malformed json"), (3, "malformed json"), (4, "no usable price"), (5, "no symbol"),
        (6, "no usable timestamp"), (7, "no usable timestamp"),
    ]


def test_quote_payloads(spark):
    df = spark.createDataFrame([('{"data":{"amount":"43.5","currency":"USD","base":"X"}}',), ("oops",)], "payload string")
    assert rows(wire.normalise_quotes(df)) == [(None, None), (43.5, "USD")]


def test_encode_then_parse(spark):
    source = ticks(spark, tick(1, "2024-01-01 10:00:00.000001", price="12.5")).select("time", "symbol", "price", "volume")
    encoded = wire.encode_messages(source, ["symbol", "price", "volume", "timestamp"])
    row = wire.parse_messages(encoded).first()
    assert row.key == "A_2024-01-01T10:00:00.000001"
    assert (row.time, row.price) == (dt.datetime(2024, 1, 1, 10, 0, 0, 1), Decimal("12.5"))


def test_redelivered_messages(spark):
    data = [message("x", 5, "a"), message("y", 2, "a"), message("z", 9, "b"), message("w", 1, "a", partition=1)]
    kept = wire.drop_redelivered(spark.createDataFrame(data, MESSAGES))
    assert rows(kept, "key", "value") == [("a", "y"), ("b", "z")]


def test_replay_after_committed_offsets(spark):
    data = [message("x", i, partition=p) for p in (0, 1) for i in range(4)]
    committed = spark.createDataFrame([("ticks", 0, 3)], "topic string, partition int, next_offset long")
    got = wire.after_committed(spark.createDataFrame(data, MESSAGES), committed)
    assert rows(got.groupBy("partition").count()) == [(0, 1), (1, 4)]


def test_log_rules(spark):
    source = ticks(spark, tick(1, "2024-01-01", exchange=None), tick(2, "2024-01-01", price=None),
                   tick(3, "2024-01-01", symbol=None))
    filled = log.to_log_rows(source.withColumn("inserted_at", F.lit(None).cast("timestamp")), at("2024-02-01"))
    assert rows(filled, "id", "exchange", "inserted_at") == [(1, "coinbase", at("2024-02-01"))]
    assert rows(log.broken_rows(source), "id", "missing") == [(2, "price"), (3, "symbol")]


def day_log(spark, folder, days=3):
    for d in range(1, days + 1):
        log.append_log(ticks(spark, tick(d, f"2024-01-0{d} 10:00:00"), tick(d + 10, f"2024-01-0{d} 11:00:00", symbol="B")), folder)


def test_log_is_partitioned_sorted_and_append_only(spark, folder):
    day_log(spark, folder)
    first = {f for f in spark.read.parquet(folder).inputFiles()}
    log.append_log(ticks(spark, tick(99, "2024-01-01 12:00:00")), folder)
    assert first < set(spark.read.parquet(folder).inputFiles())
    got = log.read_log(spark, folder)
    assert got.count() == 7 and got.columns == [*TICK_LOG.names, "dt"]
    scan = log.between(got, "2024-01-02", "2024-01-02 23:59:59")
    assert scan.count() == 2
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "GreaterThanOrEqual(time" in plan


def test_compaction_keeps_the_rows(spark, folder):
    for i in range(4):
        log.append_log(ticks(spark, tick(i, "2024-01-01 10:00:00"), tick(i + 10, "2024-01-09 10:00:00")), folder)
    before = rows(log.read_log(spark, folder).select("id", "time", "price"))
    assert log.compact_log(spark, folder, at("2024-01-10"), older_than_days=3) == [dt.date(2024, 1, 1)]
    after = log.read_log(spark, folder)
    assert rows(after.select("id", "time", "price")) == before
    files = after.select("dt", "_metadata.file_path").distinct().groupBy("dt").count()
    assert rows(files) == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 9), 4)]


def test_compaction_repeats_only_days_with_new_files(spark, folder):
    day_log(spark, folder)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    assert log.compact_log(spark, folder, at("2024-02-01")) == days == log.compacted_days(spark, folder)
    assert log.compact_log(spark, folder, at("2024-02-01")) == []
    time.sleep(0.05)
    log.append_log(ticks(spark, tick(50, "2024-01-02 23:00:00")), folder)
    assert rows(log.day_inventory(spark, folder), "row_count", "is_compacted") == [(2, True), (2, True), (3, False)]
    assert log.compact_log(spark, folder, at("2024-02-01")) == [dt.date(2024, 1, 2)]
    assert log.read_log(spark, folder).count() == 7


def test_retention_and_inventory(spark, folder):
    day_log(spark, folder)
    stock = log.day_inventory(spark, folder)
    assert rows(stock, "dt", "row_count", "file_count")[0] == (dt.date(2024, 1, 1), 2, 1)
    live = log.live_rows(log.read_log(spark, folder), at("2024-01-04"), keep_days=2)
    assert live.count() == 4
    assert log.expire_days(spark, folder, at("2024-01-04"), keep_days=2) == ["dt=2024-01-01"]
    assert log.read_log(spark, folder).count() == 4


UPSERT = "k string, v int, dt date"


def test_upsert_touches_only_the_days_of_the_batch(spark, folder):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    log.upsert(spark.createDataFrame([("a", 1, d1), ("b", 1, d1), ("a", 1, d2), (None, 1, d2)], UPSERT), folder, ["dt", "k"])
    untouched = {f for f in spark.read.parquet(folder).inputFiles() if "2024-01-01" in f}
    batch = spark.createDataFrame([("a", 2, d2), ("c", 2, d2), (None, 2, d2)], UPSERT)
    for _ in range(2):  # repeating a batch changes nothing
        log.upsert(batch, folder, ["dt", "k"])
        got = spark.read.parquet(folder)
        assert rows(got, "k", "v", "dt") == [(None, 2, d2), ("a", 1, d1), ("a", 2, d2), ("b", 1, d1), ("c", 2, d2)]
    assert untouched < set(got.inputFiles())
    log.upsert(batch.filter("false"), folder, ["dt", "k"])
    assert spark.read.parquet(folder).count() == 5
    log.upsert(batch, folder, ["dt", "k"], full_refresh=True)
    assert spark.read.parquet(folder).count() == 3


def test_schema_drift_is_refused(spark, folder):
    batch = spark.createDataFrame([("a", 1, dt.date(2024, 1, 1))], UPSERT)
    log.upsert(batch, folder, ["k"])
    with pytest.raises(SchemaDrift, match="extra"):
        log.upsert(batch.withColumn("extra", F.lit(1)), folder, ["k"])
    with pytest.raises(SchemaDrift, match="type changed"):
        log.upsert(batch.withColumn("v", F.lit("1")), folder, ["k"])
    check_same_columns(batch.select("dt", "v", "k").schema, batch.schema)


def test_tick_schema_matches_the_helpers(spark):
    assert spark.createDataFrame([], TICKS).columns == TICK_LOG.names


def test_unusable_numbers_are_rejects(spark):
    parsed = parse(spark, {**GOOD, "volume": "many"}, {**GOOD, "bid": "x"}, {**GOOD, "ask": {}}, {**GOOD, "ask": None})
    assert rows(wire.rejected(parsed), "offset", "problem") == [
        (0, "no usable volume"), (1, "no usable bid"), (2, "no usable ask")
    ]


def test_messages_become_complete_log_rows(spark, folder):
    times = ["2024-01-01T00:00:01"] * 3 + ["2024-01-01T00:00:00"]
    values = [{**GOOD, "price": p, "timestamp": t} for p, t in zip((5, 6, 7, 4), times)]
    parsed = parse(spark, *values, "broken")
    log.append_log(log.to_log_rows(wire.accepted(parsed)), folder)
    stored = log.read_log(spark, folder)
    assert stored.filter("id IS NULL OR inserted_at IS NULL").count() == 0
    assert stored.orderBy("id").select("price").first().price == 5  # ids follow the offsets of a partition
    candle = candles.candles(staged_ticks(stored)).first()
    assert (candle.open, candle.close, candle.trade_count) == (4, 7, 4)


def test_ids_differ_between_partitions_and_topics(spark):
    data = [message(GOOD, o, topic=t, partition=p) for o in range(3) for t in ("a", "b") for p in range(4)]
    ids = [r.id for r in wire.parse_messages(spark.createDataFrame(data, MESSAGES)).collect()]
    assert len(set(ids)) == len(data)


def test_rows_without_id_still_have_open_and_close(spark):
    df = ticks(spark, tick(1, "2024-01-01 00:00:00", price="3")).withColumn("id", F.lit(None).cast("long"))
    assert candles.candles(df).first().open == 3
    assert rows(log.broken_rows(df), "missing") == [("id",)]


def pruned(df):
    """Whether a bound on the day is among the partition filters of the scan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return all("dt" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]) and "PartitionFilters" in plan


def test_time_filters_skip_day_folders(spark, folder):
    log.append_log(log.to_log_rows(ticks(spark, *[tick(i, f"2024-01-0{i} 10:00:00") for i in range(1, 9)])), folder)
    stored = log.read_log(spark, folder)
    stg = staged_ticks(stored)
    now = at("2024-01-08 12:00:00")
    for found in (latest.last_day(stg, now), latest.latest_prices(stg, now), latest.nearest_price(stg, now),
                  latest.last_day(stg), refresh.changed_since(stg, "2024-01-07 00:00:00", "2 hours"),
                  monitor.recent(stored, "time", "1 hour", now), log.between(stored, at("2024-01-05"))):
        assert pruned(found)
    assert latest.last_day(stg, now).count() == 1


def test_empty_first_run(spark, tmp_path):
    data = staged_ticks(log.to_log_rows(ticks(spark, tick(1, "2023-05-01 00:00:00"), tick(2, "2024-01-01 00:20:00"))))
    for name, run, key in (
        ("candles", refresh.refresh_candles, "period_key"),
        ("summary", refresh.refresh_summary, "window_id"),
    ):
        path = str(tmp_path / name)
        run(data.limit(0), path)
        run(data.limit(0), path)
        run(data, path)
        assert spark.read.parquet(path).select(key).distinct().count() == 2
        run(data, path)
        assert spark.read.parquet(path).count() == 2
    path = str(tmp_path / "range")
    refresh.refresh_range(data.limit(0), path, at("2024-01-01 01:00:00"))
    assert refresh.realtime_candles(data, path).count() == 2
    refresh.refresh_range(data, path, at("2024-01-01 01:00:00"))
    assert refresh.realtime_candles(data, path).count() == 1  # buckets before the refreshed range are not stored


def test_staging_goes_after_the_commit(spark, folder):
    rows_ = log.to_log_rows(ticks(spark, *[tick(i, f"2024-01-0{1 + i % 3} 10:00:00") for i in range(9)]))
    log.append_log(rows_, folder)
    before = set(os.listdir(scratch.shared_folder(spark)))
    log.compact_log(spark, folder, at("2024-02-01"))
    log.upsert(rows_.withColumn(log.DAY, F.to_date("time")), folder, [log.DAY, "id"])
    assert set(os.listdir(scratch.shared_folder(spark))) == before and log.read_log(spark, folder).count() == 9
    with pytest.raises(ValueError):
        scratch.remove_folder(spark, folder)


def test_values_that_are_too_long_are_refused(spark):
    df = ticks(spark, tick(1, "2024-01-01"), tick(2, "2024-01-01", symbol="S" * 21), tick(3, "2024-01-01", exchange="e" * 51),
               tick(4, "2024-01-01", symbol="S" * 20, exchange="e" * 50), tick(5, "2024-01-01", exchange=None))
    assert rows(log.to_log_rows(df), "id") == [(1,), (4,), (5,)]
    assert rows(log.broken_rows(df), "id", "missing", "too_long") == [(2, "", "symbol"), (3, "", "exchange")]


def test_inventory_counts_real_files_and_bytes(spark, folder):
    for part in range(3):
        log.append_log(log.to_log_rows(ticks(spark, *[tick(10 * part + d, f"2024-01-0{d} 10:00:00") for d in (1, 2)])), folder)
    log.append_log(log.to_log_rows(ticks(spark, tick(99, "2024-01-02 11:00:00"))), folder)
    want = []
    for day, n in ((1, 3), (2, 4)):
        place = f"{folder}/dt=2024-01-0{day}"
        files = [f for f in os.listdir(place) if f.endswith(".parquet")]
        want.append((dt.date(2024, 1, day), n, len(files), sum(os.path.getsize(f"{place}/{f}") for f in files)))
    assert rows(log.day_inventory(spark, folder), "dt", "row_count", "file_count", "total_bytes") == want
    assert [w[2] for w in want] == [3, 4]


def days_of(spark, path):
    return rows(spark.read.parquet(path), "id", "dt")


def test_a_swap_is_finished_from_wherever_it_died(spark, folder):
    """Every state that a run can leave behind leads to the same table."""
    old = ticks(spark, tick(1, "2024-01-01"), tick(2, "2024-01-02"), tick(3, "2024-01-03"))
    new = ticks(spark, tick(10, "2024-01-01"), tick(20, "2024-01-02")).withColumn("dt", F.to_date("time"))
    want = None
    for state in ("writing", "ready", "aside", "one day done"):
        path = f"{folder}-{state.replace(' ', '-')}"
        log.append_log(old, path)
        swap = Path(path, f"{log.SWAP}x")
        staged = Path(path, f"{log.WRITING}x") if state == "writing" else swap
        new.write.partitionBy("dt").parquet(str(staged))
        if state in ("aside", "one day done"):
            shutil.move(f"{path}/dt=2024-01-01", f"{swap}/{log.OLD}dt=2024-01-01")
        if state == "one day done":
            shutil.move(f"{swap}/dt=2024-01-01", f"{path}/dt=2024-01-01")
        if state == "writing":  # not whole: nothing happens
            assert log.finish_swaps(spark, path) == []
            assert [r[0] for r in days_of(spark, path)] == [1, 2, 3]
            continue
        log.finish_swaps(spark, path)
        found = days_of(spark, path)
        want = want or found
        assert found == want and [r[0] for r in found] == [10, 20, 3]
        assert not [n for n in os.listdir(path) if n.startswith((log.SWAP, log.WRITING))]


def test_upsert_writes_its_days_once_and_drops_a_failed_write(spark, folder):
    table = lambda *r: spark.createDataFrame(list(r), "k int, v string, dt date")
    day = dt.date(2024, 1, 1)
    log.upsert(table((1, "a", day), (2, "b", day), (3, "c", day + dt.timedelta(1))), folder, ["dt", "k"])
    other = os.listdir(f"{folder}/dt=2024-01-02")
    log.upsert(table((2, "B", day), (4, "d", day)), folder, ["dt", "k"])
    assert rows(spark.read.parquet(folder), "k", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert os.listdir(f"{folder}/dt=2024-01-02") == other  # a day that the batch does not touch
    broken = table((5, "x", day)).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        log.replace_days(broken, folder)
    assert not [n for n in os.listdir(folder) if n.startswith((log.SWAP, log.WRITING))]
    assert spark.read.parquet(folder).count() == 4


def test_compacted_files_are_clustered(spark, folder):
    data = [tick(i, f"2024-01-01 00:{i:02d}:00", symbol="AB"[i % 2]) for i in range(20)]
    for part in (data[:10], data[10:]):
        log.append_log(ticks(spark, *part), folder)
    log.compact_log(spark, folder, dt.datetime(2024, 2, 1))
    (file,) = [f for f in os.listdir(f"{folder}/dt=2024-01-01") if f.endswith(".parquet")]
    order = [(r["symbol"], -r["time"].timestamp()) for r in pq.read_table(f"{folder}/dt=2024-01-01/{file}").to_pylist()]
    assert len(order) == 20 and order == sorted(order)


def test_inventory_comes_from_the_footers(spark, folder):
    log.append_log(ticks(spark, tick(1, "2024-01-01 01:00:00"), tick(2, "2024-01-01 02:00:00"), tick(3, "2024-01-02")), folder)
    groups = footers.row_groups(spark, folder, "time", "dt")
    assert rows(groups, "dt", "rows", "first", "codec")[0] == (dt.date(2024, 1, 1), 2, at("2024-01-01 01:00:00"), "SNAPPY")
    assert groups.agg(F.sum("bytes")).first()[0] > 0
    plan = log.day_inventory(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan and "Format: Parquet" not in plan  # no table is scanned
    with setting(spark, spark__sql__parquet__outputTimestampType="INT96"):  # a writer that leaves out ranges
        ticks(spark, tick(4, "2024-01-03 05:00:00")).withColumn("dt", F.to_date("time")).write.mode("append").partitionBy("dt").parquet(folder)
    found = rows(log.day_inventory(spark, folder), "dt", "range_start", "range_end", "row_count", "file_count")
    assert found == [
        (dt.date(2024, 1, 1), at("2024-01-01 01:00:00"), at("2024-01-01 02:00:00"), 2, 1),
        (dt.date(2024, 1, 2), at("2024-01-02"), at("2024-01-02"), 1, 1),
        (dt.date(2024, 1, 3), at("2024-01-03 05:00:00"), at("2024-01-03 05:00:00"), 1, 1),
    ]
