"""As-of joins and calendar windows over keys of which one may hold a large part of all rows.

A key with more rows than one task should sort is cut into ranges of time of about equal
size; others stay whole. Each range is swept by itself, so a frequent key spreads over
tasks. What a range needs from before it comes along: for an as-of join one row, the last
one of all ranges before; for a window the rows that lie within its days before the range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of a key, at most, and the rows of a range, about.
MAX_RANGES, ROWS_PER_RANGE = 256, 1_000_000


def with_cuts(rows: DataFrame, keys: list[str], time: str, per_range: int, cuts: str = "__cuts") -> DataFrame:
    """``rows`` with the times between the ranges of their key in order; none for keys of at most ``per_range`` rows. Nulls equal nulls."""
    steps = F.array(*(F.lit(n / MAX_RANGES) for n in range(1, MAX_RANGES)))
    held = rows.groupBy(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys))).agg(F.count("*").alias("__n"), F.percentile_approx(time, steps, 100 * MAX_RANGES).alias("__p"))
    # Of the steps every so many are kept, so that a key gets as many ranges as it has rows for.
    every = F.greatest(F.ceil(F.lit(MAX_RANGES) / F.ceil(F.col("__n") / per_range)), F.lit(1))
    frequent = held.filter(F.col("__n") > per_range).select(*(f"__k{i}" for i in range(len(keys))), F.array_distinct(F.filter("__p", lambda p, i: (i + 1) % every == 0)).alias(cuts))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)))
    return rows.join(frequent, same, "left").select(*rows.columns, cuts)


def range_of(time: Column, cuts: str = "__cuts") -> Column:
    """The number of the range that a time lies in; equal times lie in one, nulls in the first."""
    return F.coalesce(F.when(time.isNotNull() & F.col(cuts).isNotNull(), F.size(F.filter(cuts, lambda c: c < time))), F.lit(0))


def asof_backward(
    probes: DataFrame, context: DataFrame, keys: list[str], probe_time: str, context_time: str, values: list[str], order: list[str] | None = None, per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """As ``pointintime.asof_backward``, with the rows of frequent keys swept in ranges of time."""
    extra = order or []
    kept = [c for c in probes.columns if c not in keys]
    found = F.struct(F.col(context_time).alias("found_at"), *(F.col(v) for v in dict.fromkeys([*values, *extra])))
    left = probes.select(*keys, F.col(probe_time).alias("__t"), F.lit(1).alias("__side"), F.struct(*kept).alias("__probe"))
    right = context.select(*keys, F.col(context_time).alias("__t"), F.lit(0).alias("__side"), found.alias("__found"))
    both = with_cuts(left.unionByName(right, allowMissingColumns=True), keys, "__t", per_range).withColumn("__range", range_of(F.col("__t"))).drop("__cuts")
    sort = ["__t", *(f"__found.{c}" for c in extra)]
    ends = both.filter("__side = 0").groupBy(*keys, "__range").agg(F.max_by("__found", F.struct(F.col("__t").isNotNull().alias("__some"), *(F.col(c).alias(f"__s{i}") for i, c in enumerate(sort)))).alias("__last"))
    # One row a range: the last of the ranges before it that has rows. Ranges without context rows take it from there too.
    places = both.select(*keys, "__range").distinct().join(ends.withColumnRenamed("__range", "__r").select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), "__r", "__last"), reduce(Column.__and__, [*(F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)), F.col("__range") == F.col("__r")]), "left")
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.withColumn("__found", F.last("__last", ignorenulls=True).over(before)).filter("__found is not null").select(*keys, "__range", F.lit(-1).alias("__side"), "__found")
    every = both.unionByName(carried, allowMissingColumns=True)
    sweep = Window.partitionBy(*keys, "__range").orderBy(F.col("__side") >= 0, "__t", "__side", *(F.col(f"__found.{c}") for c in extra)).rowsBetween(Window.unboundedPreceding, 0)
    swept = every.withColumn("found", F.last("__found", ignorenulls=True).over(sweep)).filter("__side = 1")
    return swept.select(*keys, *(F.col(f"__probe.{c}").alias(c) for c in kept), "found")


def calendar_windows(rows: DataFrame, keys: list[str], day: str, specs: dict[str, tuple[Column, int]], per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """As ``pointintime.calendar_windows`` for any number of rows a key and day: aggregates over the last n days up to each row's own.

    A row also goes to the ranges that begin within the longest window after it.
    """
    longest = max(days for _, days in specs.values())
    cut = with_cuts(rows, keys, day, per_range)
    own, to = range_of(F.col(day)), range_of(F.date_add(day, longest - 1))
    dealt = cut.withColumns({"__own": own, "__range": F.explode(F.sequence(own, F.greatest(own, to)))}).drop("__cuts")
    out = dealt
    for name, (aggregate, days) in specs.items():
        out = out.withColumn(name, aggregate.over(Window.partitionBy(*keys, "__range").orderBy(F.unix_date(day)).rangeBetween(1 - days, 0)))
    return out.filter(F.col("__own") == F.col("__range")).drop("__own", "__range")
