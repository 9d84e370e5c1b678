"""Sums over periods as they were known on each day: two time axes.

A row says something about a period and becomes known on a day, so the total of a period
grows as rows become known, and the newest periods change with it. A weight that holds
for a time adds its rows when it begins and takes them out after it ends. Both are signed
changes of a period's total on a day. Changes are summed up by period and day before they
are shuffled, then each key is swept once in the order of days.
"""

from __future__ import annotations

import bisect
import decimal
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import pointintime as P

#: Type of sums and what they are written with.
EXACT = "decimal(38,12)"
_ARROW = pa.decimal128(38, 12)
_UNIT = decimal.Decimal(1).scaleb(-12)
_PRECISE = decimal.Context(prec=60, rounding=decimal.ROUND_HALF_UP)


def weighted_changes(rows: DataFrame, weights: DataFrame | None, on: list[str], keys: list[str], period: str, since: Column, volume: Column, value: Column) -> DataFrame:
    """(keys, period, at, volume, value, n_values, n): what is added to a period's totals on a day, negative where taken out.

    ``since`` is the day from which a row counts. ``weights`` (on, weight, effective_from,
    effective_to, and any of ``keys``) multiply rows while they hold, one at a time for each
    of ``on`` and ``keys``; None is a weight of 1 for ever. Rows without a volume or a day
    are left out; those without a value count for volumes only.
    """
    held = rows.withColumns({"__since": since, "__volume": volume.cast(EXACT), "__value": value.cast(EXACT)}).filter("__volume is not null and __since is not null")
    weight, ends = F.lit(1), F.lit(None).cast("date")
    if weights is not None:
        held = held.join(weights, on).withColumn("__since", F.greatest("__since", "effective_from")).filter(F.col("effective_to").isNull() | (F.col("__since") <= F.col("effective_to")))
        weight, ends = F.col("weight"), F.date_add("effective_to", 1)
    begin = F.struct(F.col("__since").alias("at"), F.lit(1).alias("sign"))
    end = F.struct(ends.alias("at"), F.lit(-1).alias("sign"))
    change = held.select(*keys, period, weight.alias("__w"), "__volume", "__value", F.inline(F.array(begin, end))).filter("at is not null")
    times = lambda c: (F.col(c) * F.col("__w") * F.col("sign")).cast(EXACT)
    return change.groupBy(*keys, period, "at").agg(
        F.sum(times("__volume")).cast(EXACT).alias("volume"), F.coalesce(F.sum(times("__value")), F.lit(0)).cast(EXACT).alias("value"),
        F.sum(F.when(F.col("__value").isNotNull(), F.col("sign")).otherwise(0)).cast("long").alias("n_values"), F.sum("sign").cast("long").alias("n"),
    )


class _Periods:
    """The totals of one key's periods on a day; as many as the calendar has."""

    def __init__(self):
        self.order: list = []
        self.totals: dict = {}

    def add(self, period, volume, value, n_values: int, n: int) -> None:
        old = self.totals.get(period)
        if old is None:
            bisect.insort(self.order, period)
            old = (0, 0, 0, 0)
        now = (_PRECISE.add(decimal.Decimal(old[0]), volume), _PRECISE.add(decimal.Decimal(old[1]), value), old[2] + n_values, old[3] + n)
        if now[3]:
            self.totals[period] = now
        else:
            del self.totals[period]
            self.order.pop(bisect.bisect_left(self.order, period))

    def newest(self, mean_of: int, sum_of: int) -> tuple:
        """(period, volume, value, mean, sum, volume a year before); nulls where there is none or too few."""
        if not self.order:
            return None, None, None, None, None, None
        period = self.order[-1]
        volume, value, n_values, _ = self.totals[period]

        def last(n: int):
            return sum((self.totals[p][0] for p in self.order[-n:]), decimal.Decimal(0)) if len(self.order) >= n else None

        total, mean = last(sum_of), last(mean_of)
        try:
            past = self.totals.get(period.replace(year=period.year - 1))
        except ValueError:  # February 29th
            past = None
        mean = None if mean is None else _PRECISE.quantize(_PRECISE.divide(mean, decimal.Decimal(mean_of)), _UNIT)
        return period, volume, value if n_values else None, mean, total, past and past[0]


def newest_periods(changes: DataFrame, keys: list[str], period: str, mean_of: int = 3, sum_of: int = 12) -> DataFrame:
    """(keys, at, period, volume, value, mean, sum, past): the newest period and its windows, once for each day of a change.

    ``mean`` and ``sum`` are over the last so many available periods, null if there are
    fewer; ``past`` is the volume of the same period a year before. A day after which no
    period is left gives nulls. Each key's changes pass through one task as a sorted
    stream; it keeps the totals of the key's periods.
    """
    k = len(keys)
    names = [*keys, "at", "period", "volume", "value", "mean", "sum", "past"]

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at, state = None, None, _Periods()
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key is not None and (row[:k], row[k]) != (key, at):
                    out.append((*key, at, *state.newest(mean_of, sum_of)))
                if row[:k] != key:
                    state = _Periods()
                key, at = row[:k], row[k]
                state.add(*row[k + 1 :])
            yield write(out, batch)
        if key is not None:
            yield write([(*key, at, *state.newest(mean_of, sum_of))], batch)

    def write(out: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
        types = [*(c.type for c in batch.columns[: k + 2]), *[_ARROW] * 5]
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    sorted_ = changes.select(*keys, "at", period, "volume", "value", "n_values", "n").repartition(*keys).sortWithinPartitions(*keys, "at", period)
    kinds = dict(changes.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keys), f"at {kinds['at']}", f"period {kinds[period]}", *(f"{c} {EXACT}" for c in names[k + 2 :])])
    return sorted_.mapInArrow(sweep, schema)


def known_through(rows: DataFrame, weights: DataFrame, on: list[str], keys: list[str], days: DataFrame, day: str, since: Column, known: Column) -> DataFrame:
    """(keys, day, known): per day the latest ``known`` of all rows that count by then under a weight that holds on it; keys without rows are left out.

    ``days`` has (keys, day).
    """
    steps = rows.select(*on, since.alias("__since"), known.alias("__known")).filter("__since is not null").groupBy(*on, "__since").agg(F.max("__known").alias("__known"))
    running = Window.partitionBy(*on).orderBy("__since").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("__known", F.max("__known").over(running))
    active = days.join(weights, [c for c in keys if c in weights.columns])
    active = active.filter((F.col("effective_from") <= F.col(day)) & (F.col("effective_to").isNull() | (F.col("effective_to") >= F.col(day))))
    # Codes that several entities share are looked up once a day.
    found = P.asof_backward(active.select(*on, day).distinct(), steps, on, day, "__since", ["__known"])
    known_ = found.filter("found is not null").select(*on, day, F.col("found.__known").alias("known"))
    return active.select(*keys, *on, day).join(known_, [*on, day]).groupBy(*keys, day).agg(F.max("known").alias("known"))
