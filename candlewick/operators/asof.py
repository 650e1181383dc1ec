"""As-of look-ups: for every question of one table the nearest fact of another, along an ordered column.

Facts and questions are sorted together, per key, in slices of equal size: a key with a third of all rows is cut into
many slices, and the slices of all keys are dealt to all tasks. Inside a slice two running values give the last fact
before a question and the first one after it; where a slice has none on one side, the nearest slice of the key that has
one hands its edge over. So every look-up is answered by one sort, and no pair of rows is formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.ordered import SLICE, with_slices

DIRECTIONS = ("backward", "forward", "nearest")


def as_of(
    questions: DataFrame,
    facts: DataFrame,
    keys: list[str],
    at: str,
    fact_at: str,
    columns: dict[str, str],
    direction: str = "backward",
    tolerance: int | None = None,
    tie: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """`questions` with {fact column: new name}, NULL where no fact is near enough.

    `at` and `fact_at` are whole numbers of one unit (such as microseconds), `tolerance` is in it too. `backward` takes
    the last fact not after `at`, `forward` the first one not before it, `nearest` the nearer of both, the earlier one
    where they are equally near. Of facts at one moment the one with the smallest `tie` counts. Keys match by plain
    equality: a question with a NULL in a key or in `at` finds nothing, but stays.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"direction is one of {', '.join(DIRECTIONS)}")
    if "at" in columns.values():
        raise ValueError("`at` is the moment of a fact; give the column another name")
    fact = F.struct(F.col(fact_at).cast("long").alias("at"), *[F.col(c).alias(n) for c, n in columns.items()])
    usable = F.col(fact_at).isNotNull()
    for k in keys:
        usable &= F.col(k).isNotNull()
    order = F.col(tie) if tie else F.lit(0)
    moment = F.col(fact_at).cast("long").alias("_at")
    told = facts.filter(usable).select(*keys, moment, order.alias("_tie"), fact.alias("_fact"), F.lit(0).alias("_ask"))
    asked = F.struct(*[F.col(c) for c in questions.columns]).alias("_asked")
    asking = questions.select(*keys, F.col(at).cast("long").alias("_at"), asked, F.lit(1).alias("_ask"))
    # by key and moment, so that what belongs to one moment of a key is in one slice
    rows = with_slices(told.unionByName(asking, allowMissingColumns=True), [*keys, "_at"], slices)

    told_here = F.when(F.col("_ask") == 0, F.struct("_at", "_tie"))
    told_last = F.when(F.col("_ask") == 0, F.struct((-F.col("_at")).alias("at"), "_tie"))
    edges = rows.groupBy(*keys, SLICE).agg(F.min_by("_fact", told_here).alias("first"), F.min_by("_fact", told_last).alias("last"))
    # one row for each key and slice
    across = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(SLICE)
    before = F.last("last", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("first", ignorenulls=True).over(across.rowsBetween(1, Window.unboundedFollowing))
    carried = edges.select(
        *[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)], F.col(SLICE).alias("_s"), before.alias("_before"), after.alias("_after")
    )
    same = F.col(SLICE) == F.col("_s")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k_{i}"))

    inside = Window.partitionBy(*keys, SLICE)
    seen = F.when(F.col("_ask") == 0, F.col("_fact"))
    # of the facts of one moment the one with the smallest tie comes last, and the questions stand behind them
    here = [F.asc("_ask"), F.desc("_tie")]
    found = {}
    if direction != "forward":
        upwards = inside.orderBy(F.asc("_at"), *here).rowsBetween(Window.unboundedPreceding, 0)
        found["_back"] = F.last(seen, ignorenulls=True).over(upwards)
    if direction != "backward":
        downwards = inside.orderBy(F.desc("_at"), *here).rowsBetween(Window.unboundedPreceding, 0)
        found["_ahead"] = F.last(seen, ignorenulls=True).over(downwards)
    met = rows.withColumns(found).filter("_ask = 1").join(carried, same)

    moment = F.col("_at")
    back, ahead = (F.coalesce(n, c) if n in found else None for n, c in (("_back", "_before"), ("_ahead", "_after")))
    if direction == "nearest":
        later = back.isNull() | (ahead["at"] - moment < moment - back["at"])
        best = F.when(ahead.isNotNull() & later, ahead).otherwise(back)
    else:
        best = back if direction == "backward" else ahead
    named = met.select("_asked.*", moment.alias("_moment"), best.alias("_best"))
    near = F.col("_moment").isNotNull()
    if tolerance is not None:
        near &= F.abs(F.col("_best.at") - F.col("_moment")) <= tolerance
    return named.select(*questions.columns, *[F.when(near, F.col(f"_best.{n}")).alias(n) for n in columns.values()])
