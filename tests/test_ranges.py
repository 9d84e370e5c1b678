"""Frequent keys cut into ranges of time: the results are those of one sweep, and no task gets the whole key."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import pointintime as P
from tidemark.operators import ranges as R

DAY = dt.date(2024, 1, 1)


def rows_of(seed, n, hot=0.5):
    rng = random.Random(seed)
    return [("hot" if rng.random() < hot else rng.choice(["a", "b", None]), rng.choice([None, *[DAY + dt.timedelta(days=rng.randrange(300))] * 20]), i, rng.choice([None, 1.0, 2.0, 7.0])) for i in range(n)]


def test_asof_in_ranges_equals_one_sweep(spark):
    schema = "k string, d date, i int, v double"
    probes, context = spark.createDataFrame(rows_of(1, 900), schema), spark.createDataFrame(rows_of(2, 700), schema)
    context = context.unionByName(context.limit(50)).filter("k <> 'a' or d > date '2024-06-01' or d is null")
    args = (probes, context, ["k"], "d", "d", ["v"], ["i"])
    key = lambda df: sorted(repr(r) for r in df.collect())
    want = key(P.asof_backward(*args))
    assert len(want) == 900
    for per_range in (7, 100, 10_000):
        assert key(R.asof_backward(*args, per_range=per_range)) == want
    assert R.asof_backward(probes.limit(0), context, *args[2:], per_range=5).count() == 0
    assert R.asof_backward(probes, context.limit(0), *args[2:], per_range=5).filter("found is null").count() == 900


def test_context_long_before_is_carried_through_ranges_without_any(spark):
    context = spark.createDataFrame([("hot", DAY, 1.0)], "k string, d date, v double")
    probes = spark.createDataFrame([("hot", DAY + dt.timedelta(days=n)) for n in range(200)], "k string, d date")
    got = R.asof_backward(probes, context, ["k"], "d", "d", ["v"], per_range=10)
    assert got.filter("found.v = 1.0").count() == 200


def test_ranges_bound_what_meets(spark):
    rows = spark.createDataFrame(rows_of(3, 4000), "k string, d date, i int, v double")
    dealt = R.with_cuts(rows, ["k"], "d", 200).withColumn("r", R.range_of(F.col("d")))
    sizes = {(r.k, r.r): r["count"] for r in dealt.groupBy("k", "r").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert len(hot) >= 8 and max(hot) <= 600
    assert {r for k, r in sizes if k == "hot"} == set(range(len(hot)))
    stamps = rows.select("k", F.col("d").cast("timestamp_ntz").alias("d"))
    assert R.with_cuts(stamps, ["k"], "d", 200).filter("__cuts is not null").count() == 4000


def test_windows_in_ranges_equal_one_sweep(spark):
    rows = spark.createDataFrame(rows_of(4, 1200), "k string, d date, i int, v double").filter("d is not null")
    specs = {"n": (F.count("*"), 3), "s": (F.sum("v"), 30), "m": (F.max("i"), 1)}
    key = lambda df: sorted(repr(r) for r in df.collect())
    want = key(P.calendar_windows(rows, ["k"], "d", specs))
    for per_range in (5, 60, 10_000):
        assert key(R.calendar_windows(rows, ["k"], "d", specs, per_range)) == want
