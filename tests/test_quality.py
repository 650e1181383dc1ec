"""Each data test on an input that passes and on one that fails."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from candlewick.plans import quality as q

D = dt.date


def failures(df) -> int:
    return df.agg(q.failure_count(df)).first()[0]


def ints(spark, *values, name="id"):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def test_accepted_range(spark):
    df = ints(spark, -1, 11, None)
    assert failures(q.accepted_range(df, "id", -1, 11)) == 0
    assert failures(q.accepted_range(df, "id", -2, 11.1, inclusive=False)) == 0
    assert failures(q.accepted_range(df, "id", -1, 11, inclusive=False)) == 2
    assert failures(q.accepted_range(df, "id", low=0)) == 1
    with pytest.raises(ValueError):
        q.accepted_range(df, "id")


def test_at_least_one(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "field string, value int")
    assert failures(q.at_least_one(df, "field")) == 0
    assert failures(q.at_least_one(df, "value")) == 0
    assert rows(q.at_least_one(df, "value", ["field"])) == [("b", 0)]
    assert failures(q.at_least_one(df.filter("field = 'b'"), "value")) == 1
    assert failures(q.at_least_one(df.filter("false"), "value")) == 1


def test_cardinality_equality(spark):
    a, b = ints(spark, 1, 2, 3), spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "same_name int, different_name int")
    assert failures(q.cardinality_equality(a, "id", b, "same_name")) == 0
    assert failures(q.cardinality_equality(a, "id", b, "different_name")) == 0
    assert rows(q.cardinality_equality(ints(spark, 1, 2, 2, None), "id", a, "id")) == [(None, 1), (2, 1), (2, 2), (3, 1)]


def test_equal_rowcount(spark):
    df = ints(spark, 1, 1, 2, name="field")
    assert failures(q.equal_rowcount(df, df)) == 0
    assert failures(q.equal_rowcount(df, df, ["field"])) == 0
    other = ints(spark, 1, 2, 2, 2, 3, name="field")
    assert failures(q.equal_rowcount(df, other)) == 2
    assert failures(q.equal_rowcount(df, other, ["field"])) == 3
    assert failures(q.equal_rowcount(df, other, ["field"], missing_groups_fail=True)) == 4


def test_null_groups_are_not_joined(spark):
    df = ints(spark, None, name="field")
    assert q.equal_rowcount(df, df, ["field"]).count() == 2
    assert failures(q.equal_rowcount(df, df, ["field"])) == 0


def test_fewer_rows_than(spark):
    one = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "col_a int, field int")
    two = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 4), (2, 5)], "col_a int, field int")
    assert failures(q.fewer_rows_than(one, two)) == 0
    assert failures(q.fewer_rows_than(one, two, ["col_a"])) == 0
    assert failures(q.fewer_rows_than(one, one)) == 1
    assert failures(q.fewer_rows_than(two, one)) == 2


def test_equality(spark):
    schema = "col_a int, col_b int, col_c int"
    a = spark.createDataFrame([(1, 1, 3), (1, 2, 1), (2, 3, 3)], schema)
    b = spark.createDataFrame([(1, 1, 2), (1, 2, 2), (2, 3, 2)], schema)
    assert failures(q.equality(a, a)) == 0
    assert failures(q.equality(a, a.union(a))) == 0  # distinct rows are compared
    assert failures(q.equality(a, b)) == 6
    assert failures(q.equality(a, b, compare=["col_a", "col_b"])) == 0
    assert failures(q.equality(a, b, exclude=["COL_C"])) == 0
    with pytest.raises(ValueError):
        q.equality(a, b, compare=["col_a"], exclude=["col_b"])
    with pytest.raises(ValueError):
        q.equality(a, b.drop("col_c"))


def test_equality_with_precision(spark):
    a = spark.createDataFrame([("1", 62.3888186, "a"), ("2", None, "a")], "id string, float_number double, to_ignore string")
    b = spark.createDataFrame([("1", 62.3888187, "b"), ("2", None, "b")], a.schema)
    assert failures(q.equality(a, b, compare=["id", "float_number"], precision=4)) == 0
    assert failures(q.equality(a, b, exclude=["to_ignore"], precision=8)) == 2
    assert failures(q.equality(a, b, precision=4)) == 4


def test_expression_is_true(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 0.5)], "col_a double, col_b double")
    assert failures(q.expression_is_true(df, "col_a + col_b = 1")) == 0
    assert failures(q.expression_is_true(df.filter("col_b = 0.5"), "= 0.5", column="col_a")) == 0
    assert failures(q.expression_is_true(df, "= 0.5", column="col_a")) == 2


RANGES = "subscription_id int, valid_from date, valid_to date"


def test_mutually_exclusive_ranges(spark):
    df = spark.createDataFrame([(0, 1), (1, 2), (2, 4)], "low int, high int")
    assert failures(q.mutually_exclusive_ranges(df, "low", "high", gaps="not_allowed")) == 0
    assert failures(q.mutually_exclusive_ranges(df, "low", "high", gaps="required")) == 2
    overlap = df.union(spark.createDataFrame([(3, 5)], df.schema))
    assert rows(q.mutually_exclusive_ranges(overlap, "low", "high")) == [(2, 4, 3, 1)]
    with pytest.raises(ValueError):
        q.mutually_exclusive_ranges(df, "low", "high", gaps="some")


def test_ranges_with_gaps_per_partition(spark):
    df = spark.createDataFrame(
        [(1, D(2019, 1, 1), D(2019, 2, 1)), (1, D(2019, 3, 3), D(2019, 4, 1)), (2, D(2019, 5, 6), D(2019, 7, 2)), (2, D(2019, 7, 3), None)],
        RANGES,
    )
    upper = "coalesce(valid_to, date '2099-01-01')"
    for gaps, expected in (("allowed", 0), ("required", 0), ("not_allowed", 2)):
        got = q.mutually_exclusive_ranges(df, "valid_from", upper, "subscription_id", gaps)
        assert failures(got) == expected
    assert failures(q.mutually_exclusive_ranges(df, "valid_from", "valid_to", "subscription_id")) == 1  # NULL bound


def test_zero_length_ranges(spark):
    df = spark.createDataFrame([(1, D(2019, 1, 1), D(2019, 1, 1)), (1, D(2019, 1, 1), D(2019, 2, 1))], RANGES)
    args = ("valid_from", "valid_to", "subscription_id")
    assert failures(q.mutually_exclusive_ranges(df, *args, zero_length=True)) == 0
    assert failures(q.mutually_exclusive_ranges(df, *args)) == 1


def test_copies_of_a_range_overlap_each_other(spark):
    df = spark.createDataFrame([(0, 5)] * 4 + [(5, 6)], "low int, high int")
    assert failures(q.mutually_exclusive_ranges(df, "low", "high")) == 3


def test_value_lists(spark):
    df = spark.createDataFrame([(1, "Barcelona"), (2, "London"), (3, "Paris"), (4, "Paris"), (5, None)], "id int, city string")
    assert failures(q.not_accepted_values(df, "city", ["Madrid", "Berlin"])) == 0
    assert rows(q.not_accepted_values(df, "city", ["Paris", "Berlin"])) == [("Paris",)]
    assert failures(q.accepted_values(df, "city", ["Barcelona", "London", "Paris"])) == 0
    assert rows(q.accepted_values(df, "city", ["London", "Barcelona"])) == [("Paris", 2)]


def test_not_constant(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 7), (3, None)], "col_a int, field int")
    assert failures(q.not_constant(df, "field")) == 0
    assert rows(q.not_constant(df, "field", ["col_a"])) == [(2, 1)]


def test_not_empty_string(spark):
    df = spark.createDataFrame([("a",), ("  ",), (None,)], "s string")
    assert failures(q.not_empty_string(df, "s")) == 1
    assert failures(q.not_empty_string(df, "s", trim=False)) == 0


def test_not_null_proportion(spark):
    data = [(1 if i < 5 else None, 1 if i < 9 else None) for i in range(10)]
    df = spark.createDataFrame(data, "point_5 int, point_9 int")
    assert failures(q.not_null_proportion(df, "point_5", 0.5, 0.5)) == 0
    assert failures(q.not_null_proportion(df, "point_9", 0.9)) == 0
    assert failures(q.not_null_proportion(df, "point_5", 0.9)) == 1


def test_relationships_where(spark):
    one, two = ints(spark, 1, 2, 3), ints(spark, 1, 2, 4, 4, None)
    assert failures(q.relationships_where(two, "id", one, "id", from_condition="id <> 4")) == 0
    assert rows(q.relationships_where(two, "id", one, "id")) == [(4, 2)]
    assert failures(q.relationships_where(two, "id", one, "id", from_condition="id <> 4", to_condition="id > 1")) == 1


def test_sequential_values(spark):
    df = spark.createDataFrame([(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "col_a int, even int")
    assert failures(q.sequential_values(df, "even", 2)) == 0
    assert failures(q.sequential_values(df, "even", 2, group_by=["col_a"])) == 0
    assert failures(q.sequential_values(df, "even", 1)) == 4
    repeated = df.union(spark.createDataFrame([(1, 4), (1, 4)], df.schema))
    assert rows(q.sequential_values(repeated, "even", 2)) == [(4, 4, 2)]


def test_sequential_timestamps(spark):
    df = spark.sql("SELECT explode(sequence(timestamp '2021-01-01', timestamp '2021-01-01 03:00:00', interval 1 hour)) AS t")
    assert failures(q.sequential_values(df, "t", 1, part="hour")) == 0
    assert failures(q.sequential_values(df.filter("hour(t) <> 1"), "t", 1, part="hour")) == 1


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (None, "a")], "m int, p string")
    assert failures(q.unique_combination(df.filter("m IS NOT NULL"), ["m", "p"])) == 0
    assert rows(q.unique_combination(df, ["p", "m"])) == [("a", None)]
    assert rows(q.unique(df, "m")) == [(1, 2)]
    assert failures(q.not_null(df, "m")) == 2


def test_recency(spark):
    now = dt.datetime(2024, 1, 2, 12)
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 0), 1), (dt.datetime(2024, 1, 1, 0), 2), (None, 3)], "at timestamp, k int")
    assert failures(q.recency(df, "at", "day", 1, now)) == 0
    assert rows(q.recency(df, "at", "day", 1, now, group_by=["k"]), "k") == [(2,)]
    assert failures(q.recency(df, "at", "day", 1, now, ignore_time=True, group_by=["k"])) == 0


def test_assert_equal(spark):
    df = spark.createDataFrame([("a", "a"), (None, "b"), ("c", None), ("d", "e")], "actual string, expected string")
    assert rows(q.assert_equal(df, "actual", "expected")) == [("d", "e")]


def test_columns_match(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert failures(q.columns_match(df, ["A", "b"])) == 0
    assert rows(q.columns_match(df, ["a", "c"])) == [(None, "C"), ("B", None)]


def test_suite(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "c")], "k int, v string")
    result = q.run_suite(
        [
            q.Check("k_not_null", df, q.not_null, {"column": "k"}),
            q.Check("v_not_null_for_k", df, q.not_null, {"column": "v"}, where="k IS NULL"),
            q.Check("v_tolerated", df, q.not_null, {"column": "v"}, error_if="> 1"),
            q.Check("k_unique", df, q.unique, {"column": "k"}, severity="warn"),
            q.Check("must_fail", df, q.accepted_values, {"column": "v", "values": ["z"]}, error_if="< 1", warn_if="< 1"),
        ]
    )
    assert rows(result) == [
        ("k_not_null", 1, "error"),
        ("k_unique", 1, "warn"),
        ("must_fail", 2, "pass"),
        ("v_not_null_for_k", 0, "pass"),
        ("v_tolerated", 1, "warn"),
    ]


def test_null_checks_of_a_table_read_it_once(spark, folder):
    spark.range(5).select("id", F.lit(1).alias("x")).write.parquet(folder)
    df = spark.read.parquet(folder)
    suite = q.run_suite([q.Check("a", df, q.not_null, {"column": "id"}), q.Check("b", df, q.not_null, {"column": "x"})])
    assert suite._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_suite_counts_as_its_rules_do(spark):
    data = [(1, "a", 5, None), (1, " ", 7, 1), (2, "b", 5, None), (None, "c", None, None), (None, None, 5, None)]
    df = spark.createDataFrame(data, "k int, v string, n int, m int").withColumn("at", F.expr("timestamp '2024-01-01' + make_interval(0,0,0,n)"))
    now = dt.datetime(2024, 1, 8)
    cases = [
        (q.not_null, {"column": "k"}), (q.accepted_range, {"column": "n", "low": 6}), (q.expression_is_true, {"expression": "n > 5"}),
        (q.assert_equal, {"actual": "k", "expected": "m"}), (q.not_empty_string, {"column": "v"}),
        (q.accepted_values, {"column": "v", "values": ["a"]}), (q.unique, {"column": "k"}), (q.unique, {"column": "n"}),
        (q.unique_combination, {"columns": ["k", "n"]}), (q.unique_combination, {"columns": ["k"]}),
        (q.at_least_one, {"column": "m"}), (q.at_least_one, {"column": "m", "group_by": ["k"]}),
        (q.not_constant, {"column": "n"}), (q.not_constant, {"column": "n", "group_by": ["k"]}),
        (q.not_null_proportion, {"column": "m", "at_least": 0.5}), (q.not_null_proportion, {"column": "n", "at_least": 0.6, "group_by": ["k"]}),
        (q.recency, {"column": "at", "part": "day", "interval": 1, "as_of": now}),
        (q.recency, {"column": "at", "part": "day", "interval": 2, "as_of": now, "group_by": ["k"]}),
        (q.not_accepted_values, {"column": "v", "values": ["a", "b"]}), (q.sequential_values, {"column": "n"}),
    ]
    checks = [
        q.Check(f"{i}-{w}", df, rule, options, where=w) for i, (rule, options) in enumerate(cases) for w in (None, "k = 1", "k > 5")
    ]
    shared, alone = q.groupings(checks)
    assert len(alone) == 6 and len(shared) == 4  # by k, by n, by (k, n), whole table
    want = {r.test: r.failures for c in checks for r in c.result().collect()}
    assert {r.test: r.failures for r in q.run_suite(checks).collect()} == want and len(set(want.values())) > 3


def test_a_suite_scans_a_table_once_for_each_grouping(spark, folder):
    spark.range(5).select("id", F.lit(1).alias("x")).write.parquet(folder)
    df = spark.read.parquet(folder)
    rules = [(q.not_null, {"column": "x"}), (q.unique, {"column": "id"}), (q.accepted_range, {"column": "x", "low": 0}),
             (q.at_least_one, {"column": "x", "group_by": ["id"]}), (q.unique, {"column": "x"})]
    suite = q.run_suite([q.Check(str(i), df, rule, options) for i, (rule, options) in enumerate(rules)])
    assert suite._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert {r.test: r.failures for r in suite.collect()} == {"0": 0, "1": 0, "2": 0, "3": 0, "4": 1}
