"""Selection of reported values: each branch by hand, and that every branch occurs in the queries."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import selection as V
from tidemark.plans.registry import QUERIES

D = dt.date
LONG = (D(2000, 1, 1), None)


def run(spark, observations, mappings, baskets, days, **more):
    rows = spark.createDataFrame(observations, "commodity string, country string, value double, known date, id long")
    maps = spark.createDataFrame(mappings, "entity string, metric string, commodity string, family string, weight double, effective_from date, effective_to date")
    held = spark.createDataFrame(baskets, "entity string, family string, metric string, country string, weight double, least double, effective_from date, effective_to date")
    probes = spark.createDataFrame([(e, m, d) for e, m in {r[:2] for r in mappings} for d in days], "entity string, metric string, day date").withColumn("known_by", F.col("day"))
    selected = V.select_metrics(probes, rows, maps, held, ("p",), "r", ("id",))
    out = V.revisions(selected, rows, maps, held, ("p",), "r", ("id",)) if more.get("revised") else selected
    return {(r.entity, r.metric, r.day): r for r in out.collect()}


def test_world_then_basket_then_latest_and_a_veto(spark):
    day = D(2024, 2, 1)
    rows = [("w", "WLD", 10.0, D(2024, 1, 1), 1), ("w", "A", 99.0, D(2024, 1, 5), 2), ("b", "A", 1.0, D(2024, 1, 1), 3), ("b", "B", 5.0, D(2024, 1, 2), 4), ("b", "A", 3.0, D(2024, 1, 3), 5), ("b", "A", 7.0, D(2024, 3, 1), 6), ("c", "Z", 4.0, D(2024, 1, 1), 7), ("c", "Y", 6.0, D(2024, 1, 1), 8)]
    maps = [("e", "p", "w", "f", 1.0, *LONG), ("e", "p", "b", "f", 3.0, *LONG), ("l", "p", "c", "g", 1.0, *LONG), ("v", "p", "w", "f", 1.0, *LONG), ("v", "p", "b", "h", 1.0, *LONG), ("n", "p", "none", "f", 1.0, *LONG), ("e", "r", "b", "f", 1.0, *LONG), ("l", "r", "c", "g", 1.0, *LONG)]
    baskets = [("e", "f", "p", "A", 0.6, 0.5, *LONG), ("e", "f", "p", "B", 0.2, 0.5, *LONG), ("e", "f", "p", "C", 0.2, 0.8, *LONG), ("v", "h", None, "A", 0.4, 0.5, *LONG), ("v", "h", None, "Q", 0.6, 0.3, *LONG)]
    got = run(spark, rows, maps, baskets, [day])
    e = got["e", "p", day]
    assert (e.value, e.mode, e.as_of) == ((10.0 + 3 * (0.6 * 3 + 0.2 * 5) / 0.8) / 4, "partial,world", D(2024, 1, 3))
    assert (got["l", "p", day].value, got["l", "p", day].mode) == (6.0, "latest")  # of equal days the higher id
    assert (got["v", "p", day].value, got["v", "p", day].as_of, got["v", "p", day].mode) == (None, None, "insufficient,world")
    assert ("n", "p", day) not in got and ("e", "r", day) not in got  # nothing known; a ratio beside scoped baskets
    assert got["l", "r", day].value == 6.0


def test_baskets_and_mappings_hold_for_a_time_and_revisions_look_back(spark):
    rows = [("b", "A", 1.0, D(2024, 1, 1), 1), ("b", "A", 4.0, D(2024, 1, 10), 2), ("b", "B", 8.0, D(2024, 1, 20), 3)]
    maps = [("e", "p", "b", "f", 1.0, D(2024, 1, 1), D(2024, 1, 25))]
    baskets = [("e", "f", None, "A", 1.0, 0.5, *LONG), ("e", "f", "q", "B", 5.0, 0.9, *LONG), ("e", "f", "p", "B", 1.0, 0.2, D(2024, 1, 15), None), ("e", "f", "p", "C", 0.0, 1.0, *LONG)]
    got = run(spark, rows, maps, baskets, [D(2023, 12, 31), D(2024, 1, 5), D(2024, 1, 12), D(2024, 1, 22), D(2024, 1, 26)], revised=True)
    assert {d.isoformat(): (r.value, r.revision, r.mode) for (_, _, d), r in got.items()} == {"2024-01-05": (1.0, None, "basket"), "2024-01-12": (4.0, 3.0, "basket"), "2024-01-22": (6.0, 2.0, "basket")}


def test_every_branch_occurs(spark):
    modes = {m for r in QUERIES["metric_selection"](spark, "/root/testdata/sf0.01").select("mode").distinct().collect() for m in r.mode.split(",")}
    assert modes == {"world", "basket", "partial", "insufficient", "latest"}
