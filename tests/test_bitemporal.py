"""Totals over two time axes against a plain look at every row for every day."""

import collections
import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import bitemporal as B
from tidemark.operators import pointintime as P

EPOCH = dt.date(2020, 1, 1)


def months(n):
    return dt.date(2020 + n // 12, n % 12 + 1, 1)


def plainly(rows, weights, key, day):
    """What is known of a key on a day: (period, volume, value, mean of 3, sum of 12, volume a year before)."""
    total, value, valued = collections.Counter(), collections.Counter(), set()
    for k, code, period, since, volume, worth in rows:
        w = [x for c, x, a, z in weights if c == code and a <= day and (z is None or z >= day)]
        if k == key and w and since is not None and since <= day and volume is not None:
            total[period] += volume * w[0]
            if worth is not None:
                value[period] += worth * w[0]
                valued.add(period)
    order = sorted(total)
    if not order:
        return (None,) * 6
    last = order[-1]
    last_n = lambda n: sum(total[p] for p in order[-n:]) if len(order) >= n else None
    past = total.get(last.replace(year=last.year - 1))
    return last, total[last], value[last] if last in valued else None, None if last_n(3) is None else round(last_n(3) / 3, 6), last_n(12), past


def test_totals_as_known_equal_looking_at_every_row(spark):
    rng = random.Random(11)
    weights = [("a", 2, EPOCH, None), ("b", 3, dt.date(2020, 9, 1), dt.date(2021, 3, 1)), ("b", 1, dt.date(2021, 6, 1), None), ("c", 5, EPOCH, dt.date(2020, 12, 31))]
    rows = []
    for _ in range(400):
        m = rng.randrange(24)
        since = months(m) + dt.timedelta(days=rng.choice([31, 40, 45, 60, 400]))
        rows.append((rng.choice(["x", "y", None]), rng.choice("abcd"), months(m), rng.choice([since] * 9 + [None]), rng.choice([1.0, 2.5, 0.0, None]), rng.choice([10.0, None])))
    rows += rows[:20]
    data = spark.createDataFrame(rows, "k string, code string, period date, since date, volume double, worth double").withColumn("at", F.lit(1)).withColumn("n", F.lit("x"))
    w = spark.createDataFrame(weights, "code string, weight int, effective_from date, effective_to date")
    changes = B.weighted_changes(data, w, ["code"], ["k"], "period", F.col("since"), F.col("volume"), F.col("worth"))
    steps = B.newest_periods(changes, ["k"], "period").withColumn("k", F.coalesce("k", F.lit("none")))
    days = [EPOCH + dt.timedelta(days=d) for d in range(0, 1300, 11)]
    probes = spark.createDataFrame([(k, d) for k in ("x", "y", "none") for d in days], "k string, day date")
    values = ["period", "volume", "value", "mean", "sum", "past"]
    got = P.asof_backward(probes, steps, ["k"], "day", "at", values).collect()
    some = 0
    for r in got:
        want = plainly(rows, weights, None if r.k == "none" else r.k, r.day)
        have = tuple(r.found[v] if r.found else None for v in values)
        assert tuple(float(x) if x is not None and not isinstance(x, dt.date) else x for x in (*have[:3], have[3] and round(have[3], 6), *have[4:])) == want, (r.k, r.day)
        some += want[4] is not None and want[5] is not None
    assert some > 50


def test_partial_months_grow_as_reporters_publish(spark):
    day = lambda m, d: dt.date(2024, m, d)
    rows = [("p", day(1, 1), day(2, 10), 5.0), ("p", day(1, 1), day(2, 20), 7.0), ("p", day(2, 1), day(2, 15), 1.0)]
    data = spark.createDataFrame(rows, "k string, period date, since date, v double")
    steps = B.newest_periods(B.weighted_changes(data, None, [], ["k"], "period", F.col("since"), F.col("v"), F.lit(None)), ["k"], "period", 2, 2)
    got = [(r["at"], r.period, float(r.volume), r.value, r["sum"] and float(r["sum"])) for r in steps.orderBy("at").collect()]
    # February is there before January is complete, and January's growth moves the sum.
    assert got == [(day(2, 10), day(1, 1), 5.0, None, None), (day(2, 15), day(2, 1), 1.0, None, 6.0), (day(2, 20), day(2, 1), 1.0, None, 13.0)]
    assert B.newest_periods(B.weighted_changes(data.limit(0), None, [], ["k"], "period", F.col("since"), F.col("v"), F.lit(None)), ["k"], "period").count() == 0


def test_latest_knowledge_follows_the_weights_that_hold(spark):
    day = lambda n: dt.date(2024, 1, n)
    rows = spark.createDataFrame([("a", day(2)), ("b", day(4)), ("a", day(6))], "code string, known date")
    w = spark.createDataFrame([("a", 1, day(1), None), ("b", 1, day(1), day(5))], "code string, k int, effective_from date, effective_to date")
    days = spark.createDataFrame([(1, day(n)) for n in range(1, 8)], "k int, day date")
    got = {r.day.day: r.known.day for r in B.known_through(rows, w, ["code"], ["k"], days, "day", F.col("known"), F.col("known")).collect()}
    assert got == {2: 2, 3: 2, 4: 4, 5: 4, 6: 6, 7: 6}
