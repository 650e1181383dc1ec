import datetime as dt
import random

import pytest
from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators import columns, dedupe, ordered, reshape, series
from candlewick.sources.tables import read_csv, relations_like, tables_like, tables_with_prefix


def test_star_and_filtered_columns(spark):
    df = spark.createDataFrame([("a", "b", "c")], "field_1 string, field_2 string, field_3 string")
    assert columns.star(df, exclude=["FIELD_3"]).columns == ["field_1", "field_2"]
    assert columns.star(df, prefix="prefix_", suffix="_suffix").columns[0] == "prefix_field_1_suffix"
    assert columns.columns_except(df, ["field_1"]) == ["field_2", "field_3"]


def test_star_with_group_by(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)], "g1 string, g2 string, v int")
    got = columns.group_by_first(df, 2, F.sum("v").alias("v"))
    assert rows(got) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]


def test_nullcheck_table(spark):
    df = spark.createDataFrame([("", "x", 1), ("y", "", 2)], "a string, b string, c int")
    assert rows(columns.nullcheck_table(df)) == [(None, "x", 1), ("y", None, 2)]


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    got = dedupe.deduplicate(df.filter("user_id = 1"), ["user_id"], [F.desc("version")])
    assert rows(got) == [(1, "play", 2)]


def test_deduplicate_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.deduplicate(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_deduplicate_keeps_a_group_of_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert rows(dedupe.deduplicate(df, ["k"], ["v"])) == [(None, 1), (1, 3)]


PIVOT = [("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")]


def test_pivot(spark):
    df = spark.createDataFrame(PIVOT, "size string, color string")
    got = reshape.pivot(df, ["size"], "color")
    assert got.columns == ["size", "red", "blue", "blue's"]
    assert rows(got) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_pivot_options(spark):
    df = spark.createDataFrame(PIVOT, "size string, color string")
    cols = reshape.pivot_columns("color", ["blue%"], agg="count", compare="like", then_value=F.col("color"),
                                 else_value=None, prefix="N ", distinct=True, slug_alias=True)
    got = df.groupBy("size").agg(*cols)
    assert got.columns[1] == "n_blue" and rows(got) == [("M", 0), ("S", 2)]


UNPIVOT = "customer_id int, created_at date, status string, segment string, name string"
CUSTOMERS = [
    (123, dt.date(2017, 1, 1), "active", "tier 1", "name 1"),
    (234, dt.date(2017, 2, 1), "active", "tier 3", "name 3"),
    (567, dt.date(2017, 3, 1), "churned", "tier 2", "name 2"),
]


def test_unpivot(spark):
    df = spark.createDataFrame(CUSTOMERS, UNPIVOT)
    got = reshape.unpivot(df, keep=["customer_id", "created_at"], remove=["NAME"], field_name="prop", value_name="val")
    assert got.columns == ["customer_id", "created_at", "prop", "val"] and got.count() == 6
    assert reshape.unpivot(df, keep=["customer_id", "created_at"]).count() == 9


def test_unpivot_booleans_and_nulls(spark):
    df = spark.createDataFrame([(1, True, None), (2, False, "x")], "Id int, Is_Updated boolean, sTaTuS string")
    got = rows(reshape.unpivot(df, keep=["Id"], field_name="Prop", value_name="Value"))
    assert got == [(1, "Is_Updated", "true"), (1, "sTaTuS", None), (2, "Is_Updated", "false"), (2, "sTaTuS", "x")]


def union_tables(spark):
    one = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    two = spark.createDataFrame([(1, "green", "7"), (2, "pink", "13")], "id int, favorite_color string, favorite_number string")
    return {"one": one, "two": two}


def test_union_relations(spark):
    got = reshape.union_relations(union_tables(spark), source_column=None)
    assert set(got.columns) == {"id", "name", "favorite_color", "favorite_number"} and got.count() == 5
    assert (2, None, "pink", "13") in rows(got, "id", "name", "favorite_color", "favorite_number")


def test_union_relations_options(spark):
    tables = union_tables(spark)
    excluded = reshape.union_relations(tables, exclude=["NAME"], where="id < 3", types={"id": "string"})
    assert excluded.columns == ["source_relation", "id", "favorite_number", "favorite_color"]
    assert excluded.count() == 4 and excluded.schema["id"].dataType.simpleString() == "string"
    assert reshape.union_relations(tables, include=["id"], source_column=None).columns == ["id"]
    with pytest.raises(ValueError):
        reshape.union_relations(tables, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations(tables, include=["nothing"])


def test_union_by_pattern(spark):
    for day in ("20180101", "20180102", "20180103"):
        spark.createDataFrame([(1, "play"), (2, "pause")], "user_id int, event string").createOrReplaceTempView(f"data_events_{day}")
    spark.range(1).createOrReplaceTempView("data_events_old")
    names = tables_like(spark, "DATA_EVENTS_2018%", exclude="%_old")
    assert len(names) == 3 and names == tables_with_prefix(spark, "data_events_2018")
    assert reshape.union_relations({n: spark.table(n) for n in names}).count() == 6


def test_column_values(spark):
    df = spark.createDataFrame([(c,) for c in "abcdefggggg"], "field string").withColumn(
        "condition", F.when(F.col("field").isin("a", "c", "e", "g"), "left").otherwise("right"))
    assert reshape.column_values(df, "field") == ["g", "a", "b", "c", "d", "e", "f"]
    assert reshape.column_values(df, "field", where="condition = 'left'") == ["g", "a", "c", "e"]
    assert reshape.column_values(df, "field", max_records=1) == ["g"]
    assert reshape.column_values(df, "field", where="false", default=["none"]) == ["none"]


def test_column_values_have_no_hidden_limit_and_an_order(spark):
    assert len(reshape.column_values(spark.range(10_001), "id")) == 10_001
    df = spark.createDataFrame([(c,) for c in "bbac"], "field string")
    assert reshape.column_values(df, "field", order_by="value desc") == ["c", "b", "a"]
    assert reshape.column_values(df, "field", order_by="row_count, value", max_records=2) == ["a", "c"]
    assert len(reshape.results_as_columns(spark.range(10_001), ["id"]).first().id) == 10_001


def test_long_spines_are_dealt_out(spark):
    bounds = spark.sql("SELECT TIMESTAMP '2024-01-01' AS start, TIMESTAMP '2024-01-02 00:00:01' AS end")
    spine = series.date_spine(bounds, "second")
    found = spine.agg(F.count("*").alias("n"), F.min("date_second").alias("a"), F.max("date_second").alias("b")).first()
    assert (found.n, str(found.a), str(found.b)) == (86401, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert "REPARTITION_BY_COL" in spine._jdf.queryExecution().toString()


def test_single_value(spark):
    df = spark.createDataFrame([(19, "string_a"), (20, "string_b")], "i int, s string")
    assert reshape.single_value(df) == 19
    assert reshape.single_value(df.filter("false"), default="fallback") == "fallback"


def test_results_as_columns(spark):
    df = spark.createDataFrame([(2, "b", False), (1, "a", True)], "c1 int, c2 string, c3 boolean")
    assert tuple(reshape.results_as_columns(df, ["c1"]).first()) == ([1, 2], ["a", "b"], [True, False])
    with pytest.raises(Exception, match="more than 1 rows"):
        reshape.results_as_columns(df, ["c1"], max_rows=1).collect()


def test_generate_series(spark):
    assert [r[0] for r in rows(series.generate_series(spark, 9))] == list(range(1, 10))


def test_date_spine(spark):
    bounds = spark.sql("SELECT date '2018-01-01' AS start, date '2018-01-10' AS end")
    days = [r[0] for r in rows(series.date_spine(bounds, "day"))]
    assert days == [dt.date(2018, 1, d) for d in range(1, 10)]
    assert series.date_spine(bounds, "week").count() == 1
    assert series.date_spine(bounds, "hour").count() == 9 * 24
    assert series.date_spine(bounds.filter("false"), "day").count() == 0
    with pytest.raises(ValueError):
        series.date_spine(bounds, "fortnight")


@pytest.mark.parametrize("slices", [1, 3, 50])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_neighbours_across_slices_equal_a_plain_window(spark, slices, keys):
    rng = random.Random(slices)
    data = [(rng.choice(["hot", "hot", "b", None]), rng.choice([None, *range(40)]), i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, v int, id int").repartition(3)
    spec = Window.partitionBy(*keys).orderBy(F.col("v").asc_nulls_last(), "id")
    plain = df.withColumn("p", F.lag("id").over(spec)).withColumn("n", F.lead("id").over(spec))
    before = ordered.with_previous(df, keys, ["v", "id"], {"id": "p"}, slices)
    after = ordered.with_next(df, keys, ["v", "id"], {"id": "n"}, slices)
    assert rows(before, "k", "v", "id", "p") == rows(plain, "k", "v", "id", "p")
    assert rows(after, "k", "v", "id", "n") == rows(plain, "k", "v", "id", "n")
    assert before.filter(F.col("has_previous") != F.col("p").isNotNull()).count() == 0


def test_slices_spread_a_hot_key(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    sizes = [r["count"] for r in ordered.with_slices(df, ["v"], 20).groupBy("_slice").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 1000


def test_csv_source_with_declared_types(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("col_1,col_2,col_3\n1,a,true\n2,,false\n")
    got = read_csv(spark, str(tmp_path / "seed.csv"), "col_1 int, col_2 string, col_3 boolean")
    assert rows(got) == [(1, "a", True), (2, None, False)]


def test_neighbours_in_text_order(spark):
    df = spark.createDataFrame([(c,) for c in "dbaec"] + [(None,)], "t string")
    got = rows(ordered.with_previous(df, [], ["t"], {"t": "p"}, slices=4), "t", "p")
    assert set(got) == {("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), (None, "e")}


def test_slices_are_as_many_as_asked_for(spark):
    sliced = ordered.with_slices(spark.range(20_000), ["id"], 200)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) == 200 and max(sizes) < 5 * 20_000 / 200


def test_relations_by_schema_and_type(spark, tmp_path):
    spark.sql(f"CREATE DATABASE cw_one LOCATION '{tmp_path}/one'")
    spark.sql(f"CREATE DATABASE cw_two LOCATION '{tmp_path}/two'")
    try:
        for schema in ("cw_one", "cw_two"):
            spark.range(1).write.saveAsTable(f"{schema}.events_a")
        spark.sql("CREATE VIEW cw_two.events_b AS SELECT 1 AS id")
        assert relations_like(spark, "CW_%", "events%") == [
            ("cw_one", "events_a", "table"), ("cw_two", "events_a", "table"), ("cw_two", "events_b", "view")
        ]
        assert relations_like(spark, "cw_two", "%", exclude="%_b") == [("cw_two", "events_a", "table")]
    finally:
        spark.sql("DROP DATABASE cw_one CASCADE")
        spark.sql("DROP DATABASE cw_two CASCADE")


def test_pivot_refuses_a_column_that_grows_with_the_data(spark):
    df = spark.range(20).selectExpr("id % 2 AS k", "id AS v")
    assert len(reshape.pivot(df, ["k"], "v").columns) == 21
    with pytest.raises(ValueError, match="more than 19"):
        reshape.pivot(df, ["k"], "v", most=19)
    assert reshape.pivot(df, ["k"], "v", values=[3, 4], most=1).columns == ["k", "3", "4"]
