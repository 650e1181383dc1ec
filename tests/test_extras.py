import pytest
from helpers import at, rows, tick, ticks
from pyspark.sql import functions as F

from candlewick.plans import extras
from candlewick.plans.candles import candles
from candlewick.sources import log


def test_rsi_and_momentum(spark):
    closes = [10, 11, 10, 13, 13]
    source = ticks(spark, *[tick(i, f"2024-01-01 0{i}:00:00", price=str(p)) for i, p in enumerate(closes)])
    base = candles(source, "1 hour")
    got = [r.rsi for r in extras.rsi(base, 3).orderBy("period_start").collect()]
    assert got[:3] == [None, None, None] and got[3:] == [80.0, 75.0]
    moved = [r.momentum_pct for r in extras.momentum(base, 2).orderBy("period_start").collect()]
    assert moved[:3] == [None, None, 0.0]


def test_vwap_without_volume(spark):
    source = ticks(spark, tick(1, "2024-01-01", price="10", volume="0"), tick(2, "2024-01-01", "B", "10", "1"),
                   tick(3, "2024-01-01", "B", "40", "2"))
    assert rows(extras.vwap(source), "symbol", "vwap") == [("A", None), ("B", 30.0)]


def test_second_expiry_keeps_earlier_summaries(spark, tmp_path):
    path, kept = str(tmp_path / "log"), str(tmp_path / "kept")
    for d in range(1, 6):
        log.append_log(ticks(spark, tick(d, f"2024-01-0{d} 10:00:00"), tick(d + 9, f"2024-01-0{d} 10:10:00")), path)
    assert extras.downsample_then_expire(spark, path, kept, at("2024-01-04"), 1) == ["dt=2024-01-01", "dt=2024-01-02"]
    assert extras.downsample_then_expire(spark, path, kept, at("2024-01-05"), 1) == ["dt=2024-01-03"]
    assert spark.read.parquet(kept).agg(F.sum("trade_count")).first()[0] == 6
    assert log.read_log(spark, path).count() == 4


def test_nothing_is_dropped_when_totals_differ(spark, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "log"), str(tmp_path / "kept")
    log.append_log(ticks(spark, tick(1, "2024-01-01 10:00:00")), path)
    write = extras.upsert
    wrong = lambda parts, *rest: write(parts.withColumn("trade_count", F.lit(7).cast("long")), *rest)
    monkeypatch.setattr(extras, "upsert", wrong)
    with pytest.raises(RuntimeError):
        extras.downsample_then_expire(spark, path, kept, at("2024-02-01"), 1)
    assert log.read_log(spark, path).count() == 1


def test_late_ticks_join_the_stored_candle(spark, tmp_path):
    path, kept = str(tmp_path / "log"), str(tmp_path / "kept")
    minutes = [10, 11, 12, 13, 14, 15, 16, 17, 18, 19]
    log.append_log(ticks(spark, *[tick(m, f"2024-01-01 10:{m}:00", price=str(m)) for m in minutes]), path)
    assert extras.downsample_then_expire(spark, path, kept, at("2024-02-01"), 1) == ["dt=2024-01-01"]
    log.append_log(ticks(spark, tick(90, "2024-01-01 10:05:00", price="50"), tick(91, "2024-01-01 10:50:00", price="1")), path)
    assert extras.downsample_then_expire(spark, path, kept, at("2024-02-01"), 1) == ["dt=2024-01-01"]
    assert extras.downsample_then_expire(spark, path, kept, at("2024-02-01"), 1) == []
    candle = extras.downsampled(spark, kept).first()
    assert (candle.trade_count, candle.total_volume) == (12, 12)
    assert (candle.open, candle.high, candle.low, candle.close) == (50, 50, 1, 1)


def test_a_run_that_stopped_before_dropping_may_be_repeated(spark, tmp_path, monkeypatch):
    path, kept = str(tmp_path / "log"), str(tmp_path / "kept")
    log.append_log(ticks(spark, tick(1, "2024-01-01 10:00:00"), tick(2, "2024-01-01 10:01:00")), path)
    with monkeypatch.context() as stopped:
        stopped.setattr(extras, "drop_files", lambda *_: [])
        extras.downsample_then_expire(spark, path, kept, at("2024-02-01"), 1)
    log.append_log(ticks(spark, tick(3, "2024-01-01 10:02:00")), path)
    extras.downsample_then_expire(spark, path, kept, at("2024-02-01"), 1)
    assert extras.downsampled(spark, kept).first().trade_count == 3 and not log.day_folders(spark, path)
