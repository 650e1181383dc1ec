import datetime as dt
import random
from decimal import Decimal

import pytest
from helpers import at, rows, tick, ticks
from pyspark.sql import functions as F

from candlewick.operators import ordered
from candlewick.plans import alerts, candles, latest, monitor, refresh, summary
from candlewick.plans.quality import equality
from candlewick.plans.staging import staged_ticks

NOW = at("2024-01-31")


def same(a, b):
    return equality(a, b).count() == 0 and a.count() == b.count()


def test_staging_rules(spark):
    raw = ticks(spark, tick(1, "2024-01-01", price="0"), tick(2, "2024-01-01", price="-1"), tick(3, "2024-01-01", symbol=None),
                tick(4, "2024-01-01", exchange=None, bid="99", ask="100"), tick(5, "2024-01-01", bid="0", ask="100"))
    got = staged_ticks(raw)
    assert rows(got, "id", "exchange", "spread", "spread_pct") == [(4, "coinbase", Decimal("1.00000000"), 1.0), (5, "x", None, None)]
    assert rows(staged_ticks(raw, quotes="null"), "bid", "spread") == [(None, None), (None, None)]
    with pytest.raises(ValueError):
        staged_ticks(raw, quotes="other")


def edge_ticks(spark):
    return ticks(
        spark,
        tick(1, "2024-01-01 00:00:00", price="10", volume=None),
        tick(2, "2024-01-01 00:14:59.999999", price="12"),
        tick(3, "2024-01-01 00:14:59.999999", price="7"),
        tick(4, "2024-01-01 00:15:00", price="8"),
        tick(5, "2024-01-01 00:00:00", price="9"),
        tick(6, "2024-01-01 00:00:00", price="1", symbol="B", exchange=None),
    )


def test_candle_edges_and_ties(spark):
    got = candles.candles(edge_ticks(spark))
    columns = ["symbol", "period_start", "open", "high", "low", "close", "total_volume", "trade_count"]
    a = [r for r in rows(got, *columns) if r[0] == "A"]
    assert [tuple(map(str, r)) for r in a] == [
        ("A", "2024-01-01 00:00:00", "10.00000000", "12.00000000", "7.00000000", "7.00000000", "3.00000000", "4"),
        ("A", "2024-01-01 00:15:00", "8.00000000", "8.00000000", "8.00000000", "8.00000000", "1.00000000", "1"),
    ]


def test_windowed_candles_agree(spark):
    source = edge_ticks(spark)
    assert same(candles.candles(source), candles.candles_windowed(source, salts=3))
    assert candles.candles(source.filter("false")).count() == 0


def test_candles_aggregate_by_hash_before_the_shuffle(spark):
    plan = candles.candles(edge_ticks(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_min_by" in plan and "SortAggregate" not in plan


def test_rollup_equals_candles_of_the_wider_period(spark):
    source = edge_ticks(spark)
    wide = candles.candles(source, "1 hour").drop("period_key")
    assert same(candles.rollup(candles.candles(source), "1 hour").select(*wide.columns), wide)


def test_latest_prices(spark):
    stg = staged_ticks(ticks(
        spark,
        tick(1, "2024-01-30 01:00:00", price="50"),                      # day-old price, an hour late
        tick(2, "2024-01-29 23:00:00", price="40"),                      # an hour early: the earlier one wins the tie
        tick(3, "2024-01-30 23:00:00", price="60", inserted=at("2024-01-30 23:00:09")),
        tick(4, "2024-01-30 23:00:00", price="61", inserted=at("2024-01-30 23:00:08")),
        tick(5, "2024-01-31 00:00:01", price="99"),                      # after as_of
        tick(6, "2024-01-29 23:30:00", price="5", symbol="OLD"),         # nothing in the last day
        tick(7, "2024-01-30 12:00:00", price="5", symbol="NEW"),         # no day-old price
    ))
    got = {r.symbol: r for r in latest.latest_prices(stg, NOW).collect()}
    assert set(got) == {"A", "NEW"} and len(got["A"]) == 19
    a = got["A"]
    assert (a.latest_price, a.price_24h_ago, a.price_change_24h, a.price_change_pct_24h) == (60, 40, 20, 50.0)
    assert (a.min_price_24h, a.max_price_24h, a.updates_24h) == (50, 61, 3)
    assert got["NEW"].price_24h_ago is None and got["NEW"].price_change_pct_24h is None
    assert rows(latest.nearest_price(stg, NOW), "symbol", "price_24h_ago") == [("A", 40), ("OLD", 5)]
    assert rows(latest.stats_24h(stg, NOW), "symbol", "updates_24h") == [("A", 3), ("NEW", 1)]


def test_summary_of_one_tick_and_levels(spark):
    stg = staged_ticks(ticks(spark, tick(1, "2024-01-01"), *[tick(i, f"2024-01-01 01:00:{i % 60:02d}", symbol="B", price=str(i))
                                                            for i in range(1, 121)]))
    got = {r.symbol: r for r in summary.price_summary(stg, NOW).collect()}
    one, many = got["A"], got["B"]
    assert len(one) == 26 and one.price_stddev is None and one.coefficient_of_variation is None
    assert one.period_return_percentage == 0.0 and one.activity_level == "Very Low"
    assert many.activity_level == "Very High" and many.unique_seconds_with_updates == 60
    assert many.update_distribution_pct == 50.0 and many.window_end - many.window_start == dt.timedelta(minutes=15)


def spread_ticks(spark, n=200, start="2024-01-10", step=300):
    base = at(start)
    return staged_ticks(ticks(spark, *[tick(i, base + dt.timedelta(seconds=step * i), symbol="AB"[i % 2], price=str(1 + i % 17))
                                       for i in range(n)]))


def test_incremental_equals_full_refresh_within_the_lookback(spark, folder):
    stg = spread_ticks(spark)
    late = staged_ticks(ticks(spark, tick(900, "2024-01-10 08:50:00", price="33")))
    refresh.refresh_summary(stg.filter("time < '2024-01-10 10:07:00'"), folder, NOW)
    refresh.refresh_summary(stg.unionByName(late), folder, NOW)
    assert same(spark.read.parquet(folder).drop("dt"), summary.price_summary(stg.unionByName(late), NOW))


def test_a_tick_later_than_the_lookback_needs_a_full_refresh(spark, folder):
    stg = spread_ticks(spark)
    late = staged_ticks(ticks(spark, tick(900, "2024-01-10 01:00:00", price="33")))
    whole = candles.candles(stg.unionByName(late))
    refresh.refresh_candles(stg, folder)
    refresh.refresh_candles(stg.unionByName(late), folder)
    assert not same(spark.read.parquet(folder).drop("dt"), whole)
    refresh.refresh_candles(stg.unionByName(late), folder, full_refresh=True)
    assert same(spark.read.parquet(folder).drop("dt"), whole)


def test_refresh_range_takes_whole_buckets_only(spark, folder):
    stg = spread_ticks(spark)
    refresh.refresh_range(stg, folder, at("2024-01-10 12:07:00"), "2 hours", "1 minute")
    buckets = [str(r[0]) for r in rows(spark.read.parquet(folder).select("bucket").distinct())]
    assert (buckets[0], buckets[-1], len(buckets)) == ("2024-01-10 10:15:00", "2024-01-10 11:45:00", 7)


def test_realtime_view_equals_the_full_aggregate(spark, folder):
    stg = spread_ticks(spark)
    refresh.refresh_range(stg, folder, at("2024-01-10 12:07:00"), "1 day")
    assert same(refresh.realtime_candles(stg, folder), candles.candles_by(stg))


def test_alert_rules(spark):
    source = ticks(
        spark,
        tick(1, "2024-01-01 00:00:00", price="100"),
        tick(2, "2024-01-01 00:01:00", price="110"),      # exactly 10 %: silent
        tick(3, "2024-01-01 00:02:00", price="110.01"),   # more: alert
        tick(4, "2024-01-01 00:05:00", price="89"),       # first tick is exactly 5 minutes old: still counts
        tick(5, "2024-01-01 00:06:00.000001", price="98"),  # oldest is now tick 3
        tick(6, "2024-01-01 09:00:00", price="1"),        # alone
        tick(7, "2024-01-01 09:00:00", price="2"),        # same instant: compared with tick 6
        tick(8, "2024-01-01 00:02:00", price="500", symbol="B"),
    )
    got = alerts.price_alerts(source)
    assert [(r[0], float(r[1]), float(r[2])) for r in rows(got, "id", "old_price", "new_price")] == [
        (3, 100, 110.01), (4, 100, 89), (5, 110.01, 98), (7, 1, 2),
    ]
    message = got.filter("id = 3").first().message
    assert message == "ALERT: A price changed by 10.01% in last 5 minutes (100.00000000 -> 110.01000000)"


@pytest.mark.parametrize("window", ["1 second", "7 seconds", "90 seconds"])
def test_oldest_in_window_equals_a_range_frame(spark, window):
    rng = random.Random(7)
    base = at("2024-01-01")
    data = [tick(i, base + dt.timedelta(seconds=rng.choice([rng.random() * 60, rng.randrange(60)])), symbol=rng.choice("AAB"),
                 price=str(1 + rng.randrange(50))) for i in range(400)]
    df = ticks(spark, *data)
    df.createOrReplaceTempView("frame_ticks")
    expected = spark.sql(f"""SELECT id, min(struct(time, id, price)) OVER (PARTITION BY symbol ORDER BY time
        RANGE BETWEEN INTERVAL {window} PRECEDING AND CURRENT ROW).price AS old_price FROM frame_ticks""")
    assert rows(alerts.oldest_in_window(df, window), "id", "old_price") == rows(expected)
    shared = alerts.oldest_in_window(df, window, slices=60)  # windows lie across several slices now
    assert rows(shared, "id", "old_price") == rows(expected)


def test_one_crowded_window_spreads_over_many_slices(spark):
    start = at("2024-01-01")
    df = ticks(spark, *[tick(i, start + dt.timedelta(milliseconds=i // 4), price=str(1 + i % 9)) for i in range(2000)])
    both = df.select("symbol", "id", F.explode(F.array(F.lit(0), F.lit(1))).alias("ask"), "time")
    sizes = [r["count"] for r in ordered.with_slices(both, ["symbol", "time", F.desc("ask"), "id"], 40).groupBy("_slice").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 5 * 4000 / 40
    assert alerts.oldest_in_window(df, "5 minutes", slices=40).filter("old_price <> 1").count() == 0


def test_gaps(spark):
    df = ticks(spark, tick(1, "2024-01-01 00:00:00"), tick(2, "2024-01-01 00:01:00"), tick(3, "2024-01-01 00:02:00.000001"),
               tick(4, "2024-01-01 00:10:00"), tick(5, "2024-01-01 00:05:00", symbol="B"))
    got = rows(monitor.data_gaps(df, 60), "symbol", "gap_start", "gap_seconds")
    assert got == [("A", at("2024-01-01 00:01:00"), 60.000001), ("A", at("2024-01-01 00:02:00.000001"), 479.999999)]
    whole = monitor.data_gaps(df, 60, keys=()).select("gap_seconds")
    assert {r[0] for r in whole.collect()} == {60.000001, 179.999999, 300.0}


def test_counter_rate_with_a_restart(spark):
    minutes = [(0, 100), (1, 160), (2, 10), (3, 40), (8, 100)]
    df = spark.createDataFrame([("c", at("2024-01-01") + dt.timedelta(minutes=m), v) for m, v in minutes],
                               "counter string, sampled_at timestamp, value long")
    got = [r[0] for r in monitor.counter_rate(df).orderBy("sampled_at").select("per_second").collect()]
    assert got == [0.0, 0.2, round(70 / 300, 6), round(100 / 300, 6), 0.2]


def test_delta_is_clamped(spark):
    df = ticks(spark, *[tick(i, f"2024-01-01 00:0{m}:00") for i, m in enumerate([0, 0, 0, 1, 2, 2])])
    got = [r[0] for r in monitor.throughput_delta(df, "1 minute").orderBy("sampled_at").select("delta_records").collect()]
    assert got == [3, 0, 1]


def test_empty_log(spark):
    df = ticks(spark)
    assert monitor.recent_activity(df, as_of=NOW).first().status == "error"
    assert tuple(monitor.ingest_lag(df, NOW).first()) == (0.0, 0.0)
    assert monitor.raw_exists(df).first()[0] is False
    empty = candles.candles(df)
    outcome = {r.validation: r.outcome for r in monitor.validation_summary(empty, "1 hour", NOW).collect()}
    assert outcome == {"candles_exist": "failed", "no_anomalies": "passed", "no_missing_periods": "failed"}
    assert monitor.missing_periods(empty, "1 hour", NOW).count() == 5


def test_flags(spark):
    lag = spark.createDataFrame([(20_000,)], "lag long")
    flags = monitor.threshold_flags(ticks(spark, tick(1, "2024-01-30 23:58:59")), lag, "1 hour", NOW).first()
    assert tuple(flags) == (True, True, True)


def test_histogram_bounds_are_inclusive_and_cumulative(spark):
    df = ticks(spark, *[tick(i, "2024-01-01", inserted=at("2024-01-01") + dt.timedelta(milliseconds=ms))
                        for i, ms in enumerate([1, 5, 6, 9000])])
    got = {r.le: r.cumulative_count for r in monitor.latency_histogram(df).collect()}
    assert (got[0.001], got[0.005], got[0.01], got[5.0], got[float("inf")]) == (1, 2, 3, 3, 4)


def test_write_throughput_table_function(spark):
    ticks(spark, *[tick(i, f"2024-01-01 00:0{i}:30") for i in range(4)]).createOrReplaceTempView("t_log")
    monitor.register_write_throughput(spark, "t_log")
    got = spark.sql("SELECT time_window, records_written FROM get_write_throughput(2, timestamp '2024-01-01 00:04:00')")
    assert [r[1] for r in rows(got)] == [1, 1]


def test_summary_and_latest_use_hash_aggregates(spark):
    df = staged_ticks(ticks(spark, *[tick(i, f"2024-01-01 00:00:{i:02d}", price=str(i + 1)) for i in range(40)]))
    plan = summary.price_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1 and "SortAggregate" not in plan
    seen = summary.price_summary(df.union(df)).first()
    assert (seen.update_count, seen.unique_seconds_with_updates) == (80, 40)
    found = latest.latest_prices(df, at("2024-01-01 01:00:00"))
    assert found._jdf.queryExecution().executedPlan().toString().count("SortAggregate") <= 2  # rows of the newest instants only
    assert (found.first().latest_price, found.first().updates_24h) == (40, 40)


@pytest.mark.parametrize("width", ["15 minutes", "1 hour", "1 day"])
def test_distinct_seconds_at_any_width(spark, width):
    moments = [f"2024-01-0{1 + d} {h:02d}:{m:02d}:{s:02d}.{f}" for d in range(2) for h in (0, 5, 23) for m in (0, 14, 59) for s in (0, 0, 59) for f in (1, 5)]
    found = summary.price_summary(ticks(spark, *[tick(i, t) for i, t in enumerate(moments)]).withColumns(
        {"spread": F.lit(None).cast("decimal(20,8)"), "spread_pct": F.lit(None).cast("double")}), at("2024-01-03"), width)
    seconds = {t[:19] for t in moments}
    assert found.agg(F.sum("unique_seconds_with_updates")).first()[0] == len(seconds)
    aggregates = found._jdf.queryExecution().optimizedPlan().toString().count("bit_or")
    assert aggregates <= 60 and (aggregates == 0) == (width == "1 day")
