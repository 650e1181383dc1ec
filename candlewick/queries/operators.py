"""Table operators and column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.adapters import table
from candlewick.functions import geo, numbers, text, web
from candlewick.operators import columns, dedupe, reshape, series
from candlewick.queries.base import query, sql
from candlewick.sources.tables import tables_like


@query(
    "op_star",
    'SELECT c_custkey AS x_c_custkey_y, c_name AS x_c_name_y, c_nationkey AS x_c_nationkey_y, '
    "c_mktsegment AS x_c_mktsegment_y FROM customer",
)
def op_star(spark, sf_dir):
    return columns.star(table(spark, sf_dir, "customer"), exclude=["C_ACCTBAL"], prefix="x_", suffix="_y")


@query(
    "op_nullcheck",
    """SELECT o_orderkey, nullif(CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END, '') AS status,
              nullif(CASE WHEN o_orderpriority LIKE '4%' THEN '' ELSE o_orderpriority END, '') AS priority
       FROM orders""",
)
def op_nullcheck(spark, sf_dir):
    blanked = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderpriority").like("4%"), "").otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    return columns.nullcheck_table(blanked)


@query(
    "op_deduplicate",
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
         l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def op_deduplicate(spark, sf_dir):
    order = [F.desc("l_shipdate"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return dedupe.deduplicate(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order)


@query(
    "op_group_by_n",
    sql("SELECT event_type, user_id, sum(value) AS total, count(*) AS n FROM events GROUP BY ALL", numbers="total"),
)
def op_group_by_n(spark, sf_dir):
    source = table(spark, sf_dir, "events").select("event_type", "user_id", "value")
    return columns.group_by_first(source, 2, F.sum("value").alias("total"), F.count("*").alias("n"))


@query(
    "op_pivot",
    """SELECT l_returnflag, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS status_F,
              CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS status_O FROM lineitem GROUP BY 1""",
)
def op_pivot(spark, sf_dir):
    source = table(spark, sf_dir, "lineitem")
    return reshape.pivot(source, ["l_returnflag"], "l_linestatus", prefix="status_")


@query(
    "op_pivot_max_like",
    """SELECT p_brand, max(CASE WHEN p_type LIKE 'ECO%' THEN p_size ELSE 0 END) AS largest_eco,
              max(CASE WHEN p_type LIKE 'S%' THEN p_size ELSE 0 END) AS largest_s,
              count(DISTINCT CASE WHEN p_size >= 10 THEN p_type END) AS types_10,
              count(DISTINCT CASE WHEN p_size >= 25 THEN p_type END) AS types_25
       FROM part GROUP BY 1""",
)
def op_pivot_max_like(spark, sf_dir):
    largest = reshape.pivot_columns(
        "p_type", ["ECO%", "S%"], agg="max", compare="like", then_value=F.col("p_size"), prefix="largest ", slug_alias=True
    )
    types = reshape.pivot_columns(
        "p_size", [10, 25], agg="count", compare=">=", then_value=F.col("p_type"), else_value=None, prefix="types_",
        distinct=True,
    )
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(*largest, *types)


@query("op_column_values", "SELECT o_orderpriority AS value, count(*) AS row_count FROM orders GROUP BY 1")
def op_column_values(spark, sf_dir):
    return reshape.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority").orderBy(F.desc("row_count"), "value")


@query("op_single_value", sql("SELECT max(value) AS highest FROM events", numbers="highest"))
def op_single_value(spark, sf_dir):
    highest = reshape.single_value(table(spark, sf_dir, "events").agg(F.max("value")), default=0.0)
    return spark.range(1).select(F.lit(highest).alias("highest"))


@query(
    "op_results_as_dict",
    """SELECT string_agg(event_type, ',' ORDER BY event_type) AS event_type,
              string_agg(CAST(n AS VARCHAR), ',' ORDER BY event_type) AS n
       FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)""",
)
def op_results_as_dict(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    arrays = reshape.results_as_columns(counts, ["event_type"])
    return arrays.select(
        F.array_join("event_type", ",").alias("event_type"),
        F.array_join(F.col("n").cast("array<string>"), ",").alias("n"),
    )


@query(
    "op_union_relations",
    sql(
        """SELECT 'customer' AS source_relation, c_custkey AS key, c_name AS name, c_acctbal AS balance,
                  c_mktsegment AS segment, NULL::INTEGER AS nation FROM customer
           UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
        numbers="balance",
    ),
)
def op_union_relations(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment",
        "c_nationkey AS internal",
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS key", "s_name AS name", "s_acctbal AS balance", "s_nationkey AS nation"
    )
    return reshape.union_relations({"customer": customers, "supplier": suppliers}, exclude=["INTERNAL"])


@query(
    "op_union_by_pattern",
    """SELECT 'cw_party_customer' AS source_relation, c_custkey AS key, c_nationkey AS nation FROM customer
       UNION ALL SELECT 'cw_party_supplier', s_suppkey, s_nationkey FROM supplier""",
)
def op_union_by_pattern(spark, sf_dir):
    """Views matched by name; the third one matches the pattern but is excluded."""
    table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_nationkey AS nation").createOrReplaceTempView(
        "cw_party_customer"
    )
    table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS key", "s_nationkey AS nation").createOrReplaceTempView(
        "cw_party_supplier"
    )
    table(spark, sf_dir, "nation").selectExpr("n_nationkey AS key").createOrReplaceTempView("cw_party_nation_tmp")
    names = tables_like(spark, "cw_party_%", exclude="%_tmp")
    return reshape.union_relations({n: spark.table(n) for n in names})


@query(
    "op_unpivot",
    """SELECT p_partkey, unnest(['p_brand', 'p_type', 'p_size', 'p_retailprice', 'is_large']) AS prop,
              unnest([p_brand, p_type, CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR),
                      CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END]) AS val FROM part""",
)
def op_unpivot(spark, sf_dir):
    source = table(spark, sf_dir, "part").withColumn("is_large", F.col("p_size") > 25)
    return reshape.unpivot(source, keep=["p_partkey"], remove=["P_NAME"], field_name="prop", value_name="val")


@query(
    "op_generate_series",
    "SELECT unnest(generate_series(1, (SELECT count(*) FROM events))) AS generated_number",
)
def op_generate_series(spark, sf_dir):
    return series.generate_series(spark, table(spark, sf_dir, "events").count())


@query(
    "op_date_spine",
    """SELECT CAST(unnest(range(min_d, max_d, INTERVAL 1 DAY)) AS DATE) AS date_day, intervals
       FROM (SELECT min(l_shipdate) AS min_d, max(l_shipdate) AS max_d,
                    CAST(date_diff('day', min(l_shipdate), max(l_shipdate)) AS INTEGER) AS intervals FROM lineitem)""",
)
def op_date_spine(spark, sf_dir):
    bounds = table(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").cast("timestamp").alias("start"), F.max("l_shipdate").cast("timestamp").alias("end")
    )
    length = bounds.select(series.intervals_between("day", F.col("start"), F.col("end")).alias("intervals"))
    return series.date_spine(bounds, "day").withColumn("intervals", F.lit(reshape.single_value(length)))


@query(
    "op_surrogate_key",
    """SELECT c_custkey,
              md5(CAST(c_custkey AS VARCHAR) || '-' || c_name || '-' || coalesce(nullif(c_mktsegment, 'BUILDING'),
                  '_dbt_utils_surrogate_key_null_')) AS surrogate_key,
              md5(CAST(c_custkey AS VARCHAR) || '-' || coalesce(nullif(c_mktsegment, 'BUILDING'), '')) AS legacy_key
       FROM customer""",
)
def op_surrogate_key(spark, sf_dir):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.surrogate_key("c_custkey", "c_name", segment).alias("surrogate_key"),
        text.surrogate_key("c_custkey", segment, null_as_empty=True).alias("legacy_key"),
    )


@query(
    "op_safe_math",
    sql(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                  coalesce(nullif(l_quantity, 1), 0) + coalesce(nullif(l_tax, 0), 0) + l_linenumber AS added,
                  l_linenumber - coalesce(nullif(l_quantity, 1), 0) AS subtracted,
                  l_extendedprice / nullif(l_discount, 0) AS divided
           FROM lineitem""",
        numbers="l_extendedprice added subtracted divided",
    ),
)
def op_safe_math(spark, sf_dir):
    quantity, tax = F.nullif(F.col("l_quantity"), F.lit(1.0)), F.nullif(F.col("l_tax"), F.lit(0.0))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        numbers.safe_add(quantity, tax, "l_linenumber").alias("added"),
        numbers.safe_subtract("l_linenumber", quantity).alias("subtracted"),
        numbers.safe_divide("l_extendedprice", "l_discount").alias("divided"),
    )


@query(
    "op_width_bucket",
    """SELECT bucket, count(*) AS n FROM (
         SELECT CASE WHEN l_extendedprice < 10000 THEN 0 WHEN l_extendedprice >= 60000 THEN 11
                     ELSE CAST(floor(10.0::DOUBLE * (l_extendedprice - 10000) / 50000) AS BIGINT) + 1 END AS bucket
         FROM lineitem) GROUP BY 1""",
)
def op_width_bucket(spark, sf_dir):
    bucket = numbers.bucket_number("l_extendedprice", 10000, 60000, 10).alias("bucket")
    return table(spark, sf_dir, "lineitem").groupBy(bucket).agg(F.count("*").alias("n"))


@query(
    "op_haversine",
    """WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 90 AS a, CAST(embedding[2] AS DOUBLE) * 180 AS b,
                         CAST(embedding[3] AS DOUBLE) * 90 AS c, CAST(embedding[4] AS DOUBLE) * 180 AS d FROM embeddings),
            h AS (SELECT vec_id, 2 * 3961 * asin(least(1.0, sqrt(pow(sin(radians((c - a) / 2)), 2)
                    + cos(radians(a)) * cos(radians(c)) * pow(sin(radians((d - b) / 2)), 2)))) AS mi FROM p)
       SELECT vec_id, round(mi, 6) AS miles, round(mi * 1.60934::DOUBLE, 6) AS kilometres FROM h""",
)
def op_haversine(spark, sf_dir):
    """Embedding components scaled to coordinates."""
    part = F.col("embedding")
    lat1, lon1 = part[0].cast("double") * 90, part[1].cast("double") * 180
    lat2, lon2 = part[2].cast("double") * 90, part[3].cast("double") * 180
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        geo.haversine_distance(lat1, lon1, lat2, lon2).alias("miles"),
        geo.haversine_distance(lat1, lon1, lat2, lon2, unit="km").alias("kilometres"),
    )


@query(
    "op_url_parts",
    r"""SELECT page_id, regexp_extract(url, '^(?:(?:https?|android-app)://)?([^/?]*)', 1) AS host,
               regexp_extract(url, '^(?:https?://)?[^/?]*/?([^?]*)', 1) AS path,
               nullif(regexp_extract(url, 'page=([^&]*)', 1), '') AS page,
               nullif(regexp_extract(url, 'utm_source=([^&]*)', 1), '') AS utm_source FROM pages""",
)
def op_url_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        web.url_host("url").alias("host"),
        web.url_path("url").alias("path"),
        web.url_parameter("url", "page").alias("page"),
        web.url_parameter("url", "utm_source").alias("utm_source"),
    )


@query(
    "op_slugify",
    """SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(p_size || ' ' || p_brand || ' - ' || p_name),
                '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1') AS slug FROM part""",
)
def op_slugify(spark, sf_dir):
    label = F.concat_ws(" ", F.col("p_size").cast("string"), "p_brand", F.lit("-"), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", text.slug(label).alias("slug"))
