"""lag, lead, trailing rows and running totals over groups of any size.

A window partitioned by the key alone sends a whole key to one task. Here the rows of a key are cut into slices along
their order, the window runs per (key, slice), and what a slice needs of the ones before it is carried over: one row for
a neighbour, the last k rows (a halo) for a window of k rows, one total for a running sum. A key with a third of all rows
is so spread over many tasks.

Slices come in two ways. By default the order columns, of any type, are range-partitioned into about equal shares of all
rows; this needs a sample and one written table. Where rows have a bounded density, such as one candle per period, give
`by`, an expression that never falls along the order: the slices are then known beforehand and nothing is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

SLICE, _CARRIED = "_slice", "_carried"


def with_slices(
    df: DataFrame, order_by: list[str | Column], slices: int | None = None, by: Column | None = None
) -> DataFrame:
    """The rows with `_slice`: a number that never falls in the order of `order_by` (NULL last).

    Without `by` they are written once; range partitioning does the cutting, so there are as many slices as asked for as
    long as the rows differ in the order columns.
    """
    if by is not None:
        return df.withColumn(SLICE, by)
    count = slices or max(16, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(count, *[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by])
    return materialise(dealt.withColumn(SLICE, F.spark_partition_id()), "ordered")


def in_steps(time: str, width_us: int, rows: int = 1024) -> Column:
    """Slices of `rows` periods of a time column, for `by`."""
    return F.floor(F.unix_micros(time) / F.lit(width_us * rows))


def _order(order_by: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order_by]


def _place(order_by: list[str]) -> Column:
    """A struct that is ordered as the rows are, NULL last."""
    return F.struct(
        *[F.col(c).isNull().alias(f"n{i}") if j == 0 else F.col(c).alias(f"v{i}") for i, c in enumerate(order_by) for j in (0, 1)]
    )


def _over(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _neighbour(
    df: DataFrame, keys: list[str], order_by: list[str], columns: dict[str, str], following: bool, slices: int | None, by: Column | None
) -> DataFrame:
    sliced = with_slices(df, order_by, slices, by)
    wanted = F.struct(*[F.col(c) for c in columns])
    edge = (F.min_by if following else F.max_by)(wanted, _place(order_by))
    edges = sliced.groupBy(*keys, SLICE).agg(edge.alias("_edge"))
    # At most one row per key and slice.
    beside = (F.lead if following else F.lag)("_edge").over(_over(keys).orderBy(SLICE))
    carried = edges.withColumn("_edge", beside).filter(F.col("_edge").isNotNull())

    base = sliced.withColumn(_CARRIED, F.lit(False)).withColumn("_value", wanted)
    stand_in = carried.select(
        *keys, SLICE, F.lit(True).alias(_CARRIED), F.col("_edge").alias("_value")
    )
    rows = base.unionByName(stand_in, allowMissingColumns=True)
    # The stand-in comes first for lag (it precedes the slice) and last for lead.
    first = F.col(_CARRIED).asc() if following else F.col(_CARRIED).desc()
    inside = Window.partitionBy(*keys, SLICE).orderBy(first, *_order(order_by))
    step = (F.lead if following else F.lag)("_value").over(inside)
    named = rows.withColumn("_beside", step).filter(~F.col(_CARRIED))
    for source, target in columns.items():
        named = named.withColumn(target, F.col("_beside").getField(source))
    flag = "has_next" if following else "has_previous"
    return named.withColumn(flag, F.col("_beside").isNotNull()).drop(SLICE, _CARRIED, "_value", "_beside")


def with_previous(
    df: DataFrame, keys: list[str], order_by: list[str], columns: dict[str, str], slices: int | None = None, by: Column | None = None
) -> DataFrame:
    """Add {source: name} values of the previous row per key in ascending order, and `has_previous`."""
    return _neighbour(df, keys, order_by, columns, False, slices, by)


def with_next(
    df: DataFrame, keys: list[str], order_by: list[str], columns: dict[str, str], slices: int | None = None, by: Column | None = None
) -> DataFrame:
    """Add {source: name} values of the next row per key in ascending order, and `has_next`."""
    return _neighbour(df, keys, order_by, columns, True, slices, by)


def over_last_rows(
    df: DataFrame,
    keys: list[str],
    order_by: list[str],
    rows: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    slices: int | None = None,
    by: Column | None = None,
) -> DataFrame:
    """Add columns that look at a row and up to `rows` rows before it, per key in ascending order.

    Each column is made from the ordered window: `lambda w: F.lag("close", 4).over(w)`, `lambda w:
    F.sum("gain").over(w.rowsBetween(-13, 0))`. A slice gets the last `rows` rows of the key from before it, from as many
    slices back as that takes, so the result is what one window over the whole key gives.
    """
    sliced = with_slices(df, order_by, slices, by)
    row = F.struct(*[F.col(c) for c in df.columns])
    backwards = Window.partitionBy(*keys, SLICE).orderBy(
        *[F.col(c).desc_nulls_first() for c in order_by]
    )
    tails = sliced.withColumn("_back", F.row_number().over(backwards)).filter(F.col("_back") <= rows)
    # `rows` rows at most for each key and slice, the farthest back first
    ends = tails.groupBy(*keys, SLICE).agg(F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("at"), row.alias("row")))).alias("_tail"))
    earlier = F.flatten(F.collect_list("_tail").over(_over(keys).orderBy(SLICE).rowsBetween(-rows, -1)))
    last = F.slice("_earlier", F.greatest(F.size("_earlier") - rows + 1, F.lit(1)), F.lit(rows))
    reached = ends.select(SLICE, earlier.alias("_earlier")).select(SLICE, F.explode(last).alias("_h"))
    halo = reached.select(SLICE, "_h.row.*", F.lit(True).alias(_CARRIED))
    every = sliced.withColumn(_CARRIED, F.lit(False)).unionByName(halo)
    inside = Window.partitionBy(*keys, SLICE).orderBy(F.desc(_CARRIED), *_order(order_by))
    return every.withColumns({n: make(inside) for n, make in columns.items()}).filter(~F.col(_CARRIED)).drop(SLICE, _CARRIED)


def running_totals(
    df: DataFrame, keys: list[str], order_by: list[str], columns: dict[str, str], slices: int | None = None, by: Column | None = None
) -> DataFrame:
    """Add {source: name} sums of the key's rows up to and with each row: inside the slice, plus all earlier slices.

    Sum whole numbers or decimals where the totals must be exact. Rows that are equal in the order columns have no
    order among them, so make the order unique.
    """
    sliced = with_slices(df, order_by, slices, by)
    sums = sliced.groupBy(*keys, SLICE).agg(*[F.sum(c).alias(f"_t_{t}") for c, t in columns.items()])
    before = _over(keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(SLICE).alias("_base"),
        *[F.coalesce(F.sum(f"_t_{t}").over(before), F.lit(0)).alias(f"_b_{t}") for t in columns.values()],
    )
    inside = Window.partitionBy(*keys, SLICE).orderBy(*_order(order_by)).rowsBetween(Window.unboundedPreceding, 0)
    summed = sliced.withColumns({f"_s_{t}": F.sum(c).over(inside) for c, t in columns.items()})
    same = F.col(SLICE) == F.col("_base")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = summed.join(base, same)  # a row per key and slice on the right
    totals = {t: F.coalesce(f"_s_{t}", F.lit(0)) + F.col(f"_b_{t}") for t in columns.values()}
    return joined.withColumns(totals).select(*df.columns, *columns.values())
