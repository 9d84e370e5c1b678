"""As-of joins, windows and other time operators; keys, times and values are arguments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(
    probes: DataFrame, context: DataFrame, keys: list[str], probe_time: str, context_time: str, values: list[str], order: list[str] | None = None
) -> DataFrame:
    """Each probe with the context row that is latest at its time or before, as struct ``found``.

    Both sides are united and swept once per key: one shuffle, no range join. Ties in
    time go to the highest of ``order``. Where a few keys hold many probes, pass
    distinct probe times and join back.
    """
    extra = order or []
    kept = [c for c in probes.columns if c not in keys]
    left = probes.select(*keys, F.col(probe_time).alias("__t"), F.lit(1).alias("__side"), F.struct(*kept).alias("__probe"))
    found = F.struct(F.col(context_time).alias("found_at"), *(F.col(v) for v in dict.fromkeys([*values, *extra])))
    right = context.select(*keys, F.col(context_time).alias("__t"), F.lit(0).alias("__side"), found.alias("__found"))
    both = left.unionByName(right, allowMissingColumns=True)
    sort = ["__t", "__side", *(F.col(f"__found.{c}") for c in extra)]
    sweep = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("found", F.last("__found", ignorenulls=True).over(sweep)).filter("__side = 1")
    return swept.select(*keys, *(F.col(f"__probe.{c}").alias(c) for c in kept), "found")


def asof_offsets(probes: DataFrame, context: DataFrame, keys: list[str], day: str, context_day: str, value: str, shifts: dict[str, Column], order: list[str] | None = None) -> DataFrame:
    """Values as of several shifted days, one sweep: a column for each entry of ``shifts`` (name to shifted day)."""
    names = F.array(*(F.struct(F.lit(n).alias("name"), c.alias("probe_day")) for n, c in shifts.items()))
    long = probes.select(*keys, day, F.inline(names))
    found = asof_backward(long, context, keys, "probe_day", context_day, [value], order)
    aggs = [F.max(F.when(F.col("name") == n, F.col(f"found.{value}"))).alias(n) for n in shifts]
    return found.groupBy(*keys, day).agg(*aggs)


def daily_bar(rows: DataFrame, keys: list[str], day: str, time: str, value: str, row_id: str) -> DataFrame:
    """First, last, min, max and count per key and day; ties in time go to the highest id."""
    at = F.struct(F.col(time), F.col(row_id))
    return rows.groupBy(*keys, day).agg(
        F.min_by(value, at).alias("first"), F.max_by(value, at).alias("last"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.count("*").alias("n"), F.max(time).alias("as_of_at"),
    )


def previous_change(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Adds ``previous`` (the last row before, whatever the gap), ``delta_abs`` and ``delta_pct``."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = rows.withColumn("previous", F.lag(value).over(w))
    change = F.col(value) - F.col("previous")
    return out.withColumn("delta_abs", change.cast("double")).withColumn("delta_pct", F.round(F.try_divide(change.cast("double"), F.col("previous").cast("double")), 6))


def rolling_rows(rows: DataFrame, keys: list[str], order: str, value: str, means: list[int], deviations: list[int]) -> DataFrame:
    """Means and population deviations of the last n rows; null until n rows are there."""
    out = rows
    for name, sizes, f in (("mean", means, F.avg), ("std", deviations, F.stddev_pop)):
        for n in sizes:
            w = Window.partitionBy(*keys).orderBy(order).rowsBetween(1 - n, 0)
            out = out.withColumn(f"rolling_{name}_{n}", F.when(F.count(value).over(w) == n, F.round(f(F.col(value).cast("double")).over(w), 6)))
    return out


def date_spine(entities: DataFrame, bounds: DataFrame, day: str = "day") -> DataFrame:
    """Every entity on every day of the one-row ``bounds`` (first, last); entities are a dimension."""
    return bounds.select(F.explode(F.sequence("first", "last")).alias(day)).join(F.broadcast(entities))


def calendar_windows(spine: DataFrame, keys: list[str], day: str, specs: dict[str, tuple[Column, int]]) -> DataFrame:
    """Aggregates over the last n calendar days, one column for each (aggregate, n)."""
    out = spine
    for name, (aggregate, days) in specs.items():
        w = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(1 - days, 0)
        out = out.withColumn(name, aggregate.over(w))
    return out


def interval_join(days: DataFrame, weights: DataFrame, day: str, keys: list[str] | None = None) -> DataFrame:
    """Rows of a small effective-dated dimension that hold on each day."""
    valid = (F.col("effective_from") <= F.col(day)) & (F.col("effective_to").isNull() | (F.col("effective_to") >= F.col(day)))
    if keys:
        valid &= reduce(Column.__and__, (days[k] == weights[k] for k in keys))
    joined = days.join(F.broadcast(weights), valid)
    return joined.select(*(days[c] for c in days.columns), *(weights[c] for c in weights.columns if c not in (keys or [])))


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The row that is last in a total order, by one aggregation."""
    best = F.max(F.struct(*order, *values)).alias("best")
    return rows.groupBy(*keys).agg(best).select(*keys, *(F.col(f"best.{c}").alias(c) for c in dict.fromkeys([*order, *values])))


def last_n_per_key(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def last_n_periods(rows: DataFrame, keys: list[str], period: str, value: str, mean_of: int, sum_of: int) -> DataFrame:
    """Mean and sum of the last available periods, null if there are fewer."""
    w = Window.partitionBy(*keys).orderBy(period)
    out = rows
    for name, n, f in (("mean_last", mean_of, F.avg), ("sum_last", sum_of, F.sum)):
        frame = w.rowsBetween(1 - n, 0)
        out = out.withColumn(name, F.when(F.count(value).over(frame) == n, F.round(f(F.col(value).cast("double")).over(frame), 4)))
    return out


def year_change(rows: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Relative change from the same month a year earlier."""
    past = rows.select(*keys, F.add_months(period, 12).alias(period), F.col(value).alias("past"))
    joined = rows.join(past, [*keys, period], "left")
    return joined.withColumn("yoy", F.round(F.try_divide((F.col(value) - F.col("past")).cast("double"), F.col("past").cast("double")), 6))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum of value times weight over the weights of non-null values; null if those sum to 0."""
    w = F.when(value.isNotNull(), weight)
    return F.try_divide(F.sum(value.cast("double") * w.cast("double")), F.sum(w.cast("double")))


def coverage_prefix(rows: DataFrame, keys: list[str], share: str, name: str, threshold: float, most: int | None = None) -> DataFrame:
    """The smallest set of largest shares that reaches the threshold, with ranks, running shares and ``status``.

    At most ``most`` of a key are taken. The status says whether those taken reach the
    threshold, and if not, whether that has to be reviewed, as there was a cap.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc(share), name)
    out = rows.withColumn("rank", F.row_number().over(w)).withColumn("running", F.sum(share).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    taken = out.filter(F.col("running") - F.col(share) < threshold)
    taken = taken.filter(F.col("rank") <= most) if most is not None else taken
    reached = F.max("running").over(Window.partitionBy(*keys)) >= threshold
    return taken.withColumn("status", F.when(reached, "threshold_reached").otherwise("threshold_not_reached" if most is None else "coverage_requires_review"))


def residual_weights(rows: DataFrame, keys: list[str], weight: str, name: str, scale: int = 8) -> DataFrame:
    """Shares rounded to a scale; the last by name takes what is left of 1."""
    whole, w = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(name)
    share = F.round(F.try_divide(F.col(weight).cast("double"), F.sum(F.col(weight).cast("double")).over(whole)), scale).cast("decimal(18,8)")
    out = rows.withColumn("share", share)
    before = F.coalesce(F.sum("share").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = F.row_number().over(w) == F.count("*").over(whole)
    return out.withColumn("share", F.when(last, 1 - before).otherwise(F.col("share")).cast("double"))
