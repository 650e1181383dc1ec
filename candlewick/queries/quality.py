"""Data-quality tests, each on a table where it finds something."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.adapters import AS_OF, table, ticks
from candlewick.operators import reshape
from candlewick.plans import quality
from candlewick.queries.base import NOW, query, sql
from candlewick.queries.models import log_rows, stg, stg_candles, stg_latest, stg_summary
from candlewick.sources.scratch import materialise


@query(
    "dq_not_null",
    sql("SELECT id, symbol, time FROM ticks WHERE exchange IS NULL", "ticks"),
)
def dq_not_null(spark, sf_dir):
    return quality.not_null(ticks(spark, sf_dir), "exchange").select("id", "symbol", "time")


@query(
    "dq_unique",
    "SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
)
def dq_unique(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "dq_accepted_range",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM lineitem
       WHERE l_discount < 0.02 OR l_discount > 0.08""",
)
def dq_accepted_range(spark, sf_dir):
    outside = quality.accepted_range(table(spark, sf_dir, "lineitem"), "l_discount", low=0.02, high=0.08)
    return outside.select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")


@query("dq_accepted_values", "SELECT o_orderstatus, count(*) AS failures FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"])


@query(
    "dq_not_accepted_values",
    "SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED', '9-NONE')",
)
def dq_not_accepted_values(spark, sf_dir):
    forbidden = ["5-LOW", "4-NOT SPECIFIED", "9-NONE"]
    return quality.not_accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", forbidden)


@query(
    "dq_assert_equal",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_tax, l_discount FROM lineitem
       WHERE nullif(l_tax, 0) <> l_discount""",
)
def dq_assert_equal(spark, sf_dir):
    source = table(spark, sf_dir, "lineitem").withColumn("actual", F.nullif(F.col("l_tax"), F.lit(0.0)))
    differing = quality.assert_equal(source, "actual", "l_discount")
    return differing.select("l_orderkey", "l_linenumber", "l_partkey", "l_tax", "l_discount")


@query(
    "dq_at_least_one",
    """SELECT event_type, count(CASE WHEN event_type <> 'error' THEN value END) AS value_count FROM events GROUP BY 1
       HAVING count(CASE WHEN event_type <> 'error' THEN value END) = 0""",
)
def dq_at_least_one(spark, sf_dir):
    source = table(spark, sf_dir, "events").withColumn(
        "checked", F.when(F.col("event_type") != "error", F.col("value"))
    )
    return quality.at_least_one(source, "checked", ["event_type"])


@query(
    "dq_cardinality_equality",
    """WITH a AS (SELECT o_custkey AS value, count(*) AS num_rows FROM orders GROUP BY 1),
            b AS (SELECT c_custkey AS value, count(*) AS num_rows FROM customer GROUP BY 1)
       (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def dq_cardinality_equality(spark, sf_dir):
    return quality.cardinality_equality(
        table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer"), "c_custkey"
    )


_STATUS_COUNTS = """
    WITH a AS (SELECT l_linestatus AS status, count(*) AS n FROM lineitem GROUP BY 1),
         b AS (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1)
    SELECT a.status AS status_a, b.status AS status_b, a.n AS count_a, b.n AS count_b, {verdict} AS failures
    FROM a FULL JOIN b ON a.status = b.status"""


def _by_status(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("status"))
    return lines, table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"))


@query("dq_equal_rowcount", _STATUS_COUNTS.format(verdict="coalesce(abs(a.n - b.n), 0)"))
def dq_equal_rowcount(spark, sf_dir):
    return quality.equal_rowcount(*_by_status(spark, sf_dir), group_by=["status"])


@query(
    "dq_fewer_rows_than",
    _STATUS_COUNTS.format(verdict="CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END"),
)
def dq_fewer_rows_than(spark, sf_dir):
    return quality.fewer_rows_than(*_by_status(spark, sf_dir), group_by=["status"])


@query(
    "dq_equality",
    """WITH a AS (SELECT l_orderkey, l_linenumber, round(CAST(l_tax AS DECIMAL(38,12)), 2) AS l_tax FROM lineitem),
            b AS (SELECT l_orderkey, l_linenumber, round(CAST(CASE WHEN l_returnflag = 'R' THEN l_tax + 0.004
                    ELSE CASE WHEN l_returnflag = 'A' THEN l_tax + 0.01 ELSE l_tax END END AS DECIMAL(38,12)), 2) AS l_tax
                  FROM lineitem)
       SELECT which_diff, l_orderkey, l_linenumber, round(CAST(l_tax AS DOUBLE), 6) AS l_tax FROM (
         SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
         UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a))""",
)
def dq_equality(spark, sf_dir):
    """One flag differs below the precision, another above it."""
    lines = table(spark, sf_dir, "lineitem")
    shift = F.when(F.col("l_returnflag") == "R", 0.004).when(F.col("l_returnflag") == "A", 0.01).otherwise(0.0)
    other = lines.withColumn("l_tax", F.col("l_tax") + shift)
    return quality.equality(lines, other, compare=["l_orderkey", "l_linenumber", "l_tax"], precision=2)


@query(
    "dq_expression_is_true",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_tax FROM lineitem WHERE NOT (nullif(l_tax, 0.0) <= l_discount)",
)
def dq_expression_is_true(spark, sf_dir):
    broken = quality.expression_is_true(table(spark, sf_dir, "lineitem"), "<= l_discount", column="nullif(l_tax, 0.0D)")
    return broken.select("l_orderkey", "l_linenumber", "l_partkey", "l_tax")


def _ranges_sql(source: str, key: str, order_key: str) -> str:
    partition = f"PARTITION BY {key}" if key else ""
    head = f"{key}, " if key else ""
    return f"""
        SELECT {head}lower_bound, upper_bound, next_lower_bound, count(*) AS failures FROM (
          SELECT *, lead(lower_bound) OVER ({partition} ORDER BY lower_bound, upper_bound) AS next_lower_bound,
                 lead(1) OVER ({partition} ORDER BY lower_bound, upper_bound) IS NULL AS is_last
          FROM ({source}))
        WHERE NOT (coalesce(lower_bound < upper_bound, false)
                   AND coalesce(upper_bound <= next_lower_bound, is_last, false))
        GROUP BY ALL"""


@query(
    "dq_mutually_exclusive_ranges",
    _ranges_sql(
        "SELECT o_custkey AS partition_key, o_orderdate AS lower_bound, o_orderdate + INTERVAL 90 DAYS AS upper_bound FROM orders",
        "partition_key",
        "",
    ),
)
def dq_mutually_exclusive_ranges(spark, sf_dir):
    failing = quality.mutually_exclusive_ranges(
        table(spark, sf_dir, "orders"), "o_orderdate", "o_orderdate + INTERVAL 90 DAYS", partition_by="o_custkey"
    )
    return failing.groupBy("partition_key", "lower_bound", "upper_bound", "next_lower_bound").agg(
        F.sum("failures").alias("failures")
    )


@query(
    "dq_ranges_whole_table",
    _ranges_sql("SELECT ts AS lower_bound, ts + INTERVAL 5 MINUTES AS upper_bound FROM events", "", ""),
)
def dq_ranges_whole_table(spark, sf_dir):
    """Without a partition column: the whole table is one ordered sequence."""
    failing = quality.mutually_exclusive_ranges(
        table(spark, sf_dir, "events"), "cast(ts AS timestamp)", "cast(ts AS timestamp) + INTERVAL 5 MINUTES"
    )
    return failing.groupBy("lower_bound", "upper_bound", "next_lower_bound").agg(F.sum("failures").alias("failures"))


@query(
    "dq_sequential_values",
    """SELECT event_type, event_id, previous_event_id, count(*) AS failures FROM (
         SELECT event_type, event_id, lag(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS previous_event_id
         FROM events) WHERE NOT (event_id = previous_event_id + 1) GROUP BY ALL""",
)
def dq_sequential_values(spark, sf_dir):
    return quality.sequential_values(table(spark, sf_dir, "events"), "event_id", 1, group_by=["event_type"])


@query(
    "dq_sequential_times",
    """SELECT ship_day, previous_ship_day, count(*) AS failures FROM (
         SELECT ship_day, lag(ship_day) OVER (ORDER BY ship_day) AS previous_ship_day
         FROM (SELECT l_shipdate AS ship_day FROM lineitem))
       WHERE NOT (ship_day = previous_ship_day + INTERVAL 1 DAY) GROUP BY ALL""",
)
def dq_sequential_times(spark, sf_dir):
    """One ordered sequence over the whole table, with many equal values."""
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("timestamp").alias("ship_day"))
    return quality.sequential_values(days, "ship_day", 1, part="day")


@query(
    "dq_not_constant",
    """SELECT o_custkey, count(DISTINCT o_orderstatus) AS distinct_values FROM orders GROUP BY 1
       HAVING count(DISTINCT o_orderstatus) = 1""",
)
def dq_not_constant(spark, sf_dir):
    return quality.not_constant(table(spark, sf_dir, "orders"), "o_orderstatus", ["o_custkey"])


@query(
    "dq_not_empty_string",
    "SELECT p_name FROM (SELECT trim(CASE WHEN p_size < 10 THEN '   ' ELSE p_name END) AS p_name FROM part) WHERE p_name = ''",
)
def dq_not_empty_string(spark, sf_dir):
    source = table(spark, sf_dir, "part").withColumn(
        "p_name", F.when(F.col("p_size") < 10, "   ").otherwise(F.col("p_name"))
    )
    return quality.not_empty_string(source, "p_name")


@query(
    "dq_not_null_proportion",
    sql(
        """SELECT symbol, avg(CASE WHEN exchange IS NULL THEN 0.0 ELSE 1.0 END) AS not_null_proportion FROM ticks
           GROUP BY 1 HAVING avg(CASE WHEN exchange IS NULL THEN 0.0 ELSE 1.0 END) < 0.9""",
        "ticks",
        "not_null_proportion",
    ),
)
def dq_not_null_proportion(spark, sf_dir):
    return quality.not_null_proportion(ticks(spark, sf_dir), "exchange", 0.9, group_by=["symbol"])


@query(
    "dq_recency",
    sql(
        f"""SELECT symbol, max(time) AS most_recent, {NOW} - INTERVAL 25 MINUTES AS threshold FROM ticks GROUP BY 1
            HAVING max(time) < {NOW} - INTERVAL 25 MINUTES""",
        "ticks",
    ),
)
def dq_recency(spark, sf_dir):
    return quality.recency(ticks(spark, sf_dir), "time", "minute", 25, AS_OF, group_by=["symbol"])


@query(
    "dq_relationships_where",
    """SELECT l_suppkey AS id, count(*) AS failures FROM lineitem
       WHERE l_quantity > 10 AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1""",
)
def dq_relationships_where(spark, sf_dir):
    return quality.relationships_where(
        table(spark, sf_dir, "lineitem"), "l_suppkey", table(spark, sf_dir, "supplier"), "s_suppkey",
        from_condition="l_quantity > 10", to_condition="s_acctbal > 0",
    )


@query(
    "dq_unique_combination",
    "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def dq_unique_combination(spark, sf_dir):
    return quality.unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_columns_match",
    """WITH have AS (SELECT 'O_ORDERSTATUS' AS relation_column
                     UNION SELECT DISTINCT upper('at_' || o_orderpriority) FROM orders),
            want AS (SELECT unnest(['O_ORDERSTATUS', 'AT_1-URGENT', 'AT_2-HIGH', 'AT_6-NEVER']) AS input_column)
       SELECT relation_column, input_column FROM have FULL JOIN want ON relation_column = input_column
       WHERE relation_column IS NULL OR input_column IS NULL""",
)
def dq_columns_match(spark, sf_dir):
    """The columns come from the data: a pivot over every value found in the table."""
    pivoted = reshape.pivot(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderpriority", prefix="at_")
    return quality.columns_match(pivoted, ["o_orderstatus", "at_1-URGENT", "at_2-HIGH", "at_6-NEVER"])


def _suite_sql() -> str:
    parts = []
    for name, relation, required, key in (
        ("raw", "log", ["time", "symbol", "price"], None),
        ("stg", "stg", ["time", "symbol", "price"], None),
        ("latest", "latest", ["symbol", "latest_price", "last_updated"], "symbol"),
        ("summary", "summary", ["window_id", "window_start", "window_end", "symbol"], "window_id"),
        ("candles", "candles", ["period_key", "period_start", "symbol"], "period_key"),
    ):
        parts += [f"SELECT '{name}_not_null_{c}' AS test, count(*) AS failures FROM {relation} WHERE {c} IS NULL"
                  for c in required]
        if key:
            parts.append(f"""SELECT '{name}_unique_{key}', count(*) FROM (SELECT {key} FROM {relation}
                             WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""")
    parts.append("SELECT 'ticks_exchange_given', count(*) FROM ticks WHERE exchange IS NULL AND price > 1")
    parts.append("SELECT 'ticks_price_range', count(*) FROM ticks WHERE price > 400")
    body = " UNION ALL ".join(parts)
    status = """CASE WHEN test = 'ticks_exchange_given' THEN CASE WHEN failures > 0 THEN 'warn' ELSE 'pass' END
                     WHEN test = 'ticks_price_range' THEN CASE WHEN failures > 1000000 THEN 'error'
                       WHEN failures > 5 THEN 'warn' ELSE 'pass' END
                     WHEN failures > 0 THEN 'error' ELSE 'pass' END"""
    return sql(f"SELECT test, failures, {status} AS status FROM ({body})", "ticks log stg latest summary candles")


@query("dq_suite", _suite_sql())
def dq_suite(spark, sf_dir):
    """The declared tests of the models, plus tests with a condition and with thresholds."""
    source = ticks(spark, sf_dir)
    models = [materialise(build(spark, sf_dir), "model") for build in (stg_latest, stg_summary, stg_candles)]
    checks = quality.model_suite(log_rows(spark, sf_dir), stg(spark, sf_dir), *models)
    checks += [
        quality.Check("ticks_exchange_given", source, quality.not_null, {"column": "exchange"}, where="price > 1",
                      severity="warn"),
        quality.Check("ticks_price_range", source, quality.accepted_range, {"column": "price", "high": 400},
                      warn_if="> 5", error_if="> 1000000"),
    ]
    return quality.run_suite(checks)
