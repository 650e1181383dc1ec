"""Look-ups along an order, cut into slices, against one window over the whole key."""

import random

import pytest
from helpers import at, rows, tick, ticks
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators.asof import as_of
from candlewick.operators.ordered import over_last_rows, running_totals, with_previous
from candlewick.plans import extras, latest, monitor


def series(spark, n=300):
    rng = random.Random(5)
    data = [(rng.choice(["a", "a", "a", "b", None]), i * 3 + rng.randrange(3), rng.randrange(50)) for i in range(n)]
    return spark.createDataFrame([*data, ("c", 7, None)], "k string, t long, v long")


def whole_key():
    return Window.partitionBy("k").orderBy("t")


def cut_by(expression):
    return F.expr(expression) if expression else None


@pytest.mark.parametrize("by", [None, "floor(t / 20)"])
def test_last_rows_over_slices(spark, by):
    df = series(spark)
    columns = {
        "lagged": lambda w: F.lag("v", 4).over(w),
        "total": lambda w: F.sum("v").over(w.rowsBetween(-6, 0)),
        "held": lambda w: F.count("*").over(w.rowsBetween(-7, -1)),
    }
    want = df.withColumns({n: make(whole_key()) for n, make in columns.items()})
    got = over_last_rows(df, ["k"], ["t"], 7, columns, slices=20, by=cut_by(by))
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("by", [None, "floor(t / 50)"])
def test_running_totals_and_neighbours_over_slices(spark, by):
    df = series(spark)
    want = df.withColumn("total", F.coalesce(F.sum("v").over(whole_key().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    assert rows(running_totals(df, ["k"], ["t"], {"v": "total"}, slices=20, by=cut_by(by))) == rows(want)
    want = df.withColumn("before", F.lag("v").over(whole_key()))
    assert rows(with_previous(df, ["k"], ["t"], {"v": "before"}, slices=20, by=cut_by(by)).drop("has_previous")) == rows(want)
    whole = running_totals(df, [], ["t", "k"], {"v": "total"}, slices=8).agg(F.max("total")).first()[0]
    assert whole == df.agg(F.sum("v")).first()[0]


def nearest(question, facts, direction, tolerance):
    key, moment = question
    if key is None or moment is None:
        return None
    found = []
    for k, t, i in facts:
        if k == key and t is not None:
            away = moment - t
            if (direction == "backward" and away < 0) or (direction == "forward" and away > 0):
                continue
            if tolerance is None or abs(away) <= tolerance:
                found.append((abs(away), t, i))
    return min(found)[2] if found else None


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 4])
def test_as_of(spark, direction, tolerance):
    rng = random.Random(6)
    facts = [(rng.choice(["a", "a", "b", None]), rng.choice([None, *range(0, 400, 5), *range(0, 400, 5)]), i) for i in range(160)]
    asked = [(rng.choice(["a", "a", "b", "c", None]), rng.choice([None, *range(-10, 420)])) for _ in range(200)]
    left = spark.createDataFrame([(i, *q) for i, q in enumerate(asked)], "n long, k string, at long")
    right = spark.createDataFrame(facts, "k string, t long, id long")
    got = as_of(left, right, ["k"], "at", "t", {"id": "found"}, direction, tolerance, "id", slices=12)
    assert got.columns == ["n", "k", "at", "found"]
    assert rows(got, "n", "found") == sorted(
        ((n, nearest(q, facts, direction, tolerance)) for n, q in enumerate(asked)), key=lambda r: (r[0] is not None, str(r[0]))
    )
    with pytest.raises(ValueError):
        as_of(left, right, ["k"], "at", "t", {"id": "found"}, "sideways")


def test_as_of_without_keys_and_without_facts(spark):
    left, right = spark.createDataFrame([(5,), (1,)], "at long"), spark.createDataFrame([(2, "x")], "t long, v string")
    assert rows(as_of(left, right, [], "at", "t", {"v": "w"})) == [(1, None), (5, "x")]
    assert rows(as_of(left, right.limit(0), [], "at", "t", {"v": "w"})) == [(1, None), (5, None)]


def test_earlier_prices(spark):
    day = "2024-01-0{} {}"
    stg = ticks(
        spark,
        tick(1, day.format(1, "12:00:00"), price="10"),
        tick(2, day.format(1, "13:00:00"), price="20"),  # as far from the target as the first: the earlier one counts
        tick(3, day.format(2, "12:30:00"), price="30"),
        tick(4, day.format(2, "12:30:00"), price="40", symbol="B"),  # nothing a day ago
        tick(5, day.format(3, "14:00:00"), price="50"),  # more than an hour away
    )
    got = latest.earlier_prices(stg, slices=3)
    assert [(r.id, r.earlier_price, r.change) for r in got.orderBy("id").collect()] == [
        (1, None, None), (2, None, None), (3, 10, 20), (4, None, None), (5, None, None),
    ]


def test_no_window_runs_over_a_whole_key(spark):
    """Windows over all rows of a key are only left where a key has one row for each slice."""
    candles = spark.createDataFrame([("a", at("2024-01-01"), 1.0)], "symbol string, period_start timestamp, close double")
    samples = candles.selectExpr("symbol as counter", "period_start as sampled_at", "1L as value")
    for plan in (extras.momentum(candles), extras.rsi(candles), monitor.counter_rate(samples)):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        for line in text.splitlines():
            if "Window [" in line:
                assert "_slice" in line, line


def test_rates_of_a_counter(spark):
    values = [5, 8, 8, 2, 9, 9, 1]
    samples = [("c", at(f"2024-01-01 00:0{i}:00"), v) for i, v in enumerate(values)] + [("d", at("2024-01-01"), 3)]
    df = spark.createDataFrame(samples, "counter string, sampled_at timestamp, value long")
    growth = [0, 3, 0, 2, 7, 0, 1]
    got = monitor.counter_rate(df, window="3 minutes", every="1 minute")
    want = [("c", round(sum(growth[max(0, i - 2) : i + 1]) / 180, 6)) for i in range(7)] + [("d", 0.0)]
    assert [(r.counter, r.per_second) for r in got.orderBy("counter", "sampled_at").collect()] == want
