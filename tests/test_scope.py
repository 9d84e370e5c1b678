"""Entities, days, regions and plans of a run, by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scope as C

D = dt.date


def test_bounds_prefer_features_and_grow_with_what_is_available(spark):
    days = lambda *ds: spark.createDataFrame([(d,) for d in ds], "day date")
    own, features, late = days(D(2024, 1, 1), D(2024, 3, 1), None), days(D(2024, 2, 1), D(2024, 2, 5)), days(D(2024, 2, 9))
    got = lambda *a, **k: [tuple(r) for r in C.date_bounds(*a, **k).collect()]
    assert got(own) == [(D(2024, 1, 1), D(2024, 3, 1))]
    assert got(own, features) == [(D(2024, 2, 1), D(2024, 2, 5))]
    assert got(own, days(), late) == [(D(2024, 1, 1), D(2024, 3, 1))]
    assert got(own, features, late) == [(D(2024, 2, 1), D(2024, 2, 9))]
    assert got(own, features, end=D(2024, 2, 2)) == [(D(2024, 2, 1), D(2024, 2, 2))]
    assert got(own, features, start=D(2024, 2, 3)) == [(D(2024, 2, 3), D(2024, 2, 5))]
    assert got(days()) == [] and got(days(), start=D(2024, 1, 1)) == []
    with pytest.raises(Exception, match="after the last"):
        got(own, features, start=D(2024, 5, 1))


def test_entities_by_code_family_alias_and_group(spark):
    rows = spark.createDataFrame([("a", "x", True), ("b", "x", False), ("c", "y", True), ("d", None, True)], "code string, family string, active boolean")
    got = lambda **k: {r.code for r in C.select_entities(rows, aliases={"old": "x"}, groups={"some": ("c", "d"), "every": None}, **k).collect()}
    assert got() == {"a", "c", "d"} and got(code="c") == {"c"} and got(family="old") == {"a"} and got(family="none") == set()
    assert got(family="some") == {"c", "d"} and got(family="every") == {"a", "c", "d"} and got(code="c", family="x") == set()
    for unknown in ("b", "z"):
        with pytest.raises(ValueError, match="unknown code"):
            got(code=unknown)


def test_coverage_names_every_gap(spark):
    day = D(2024, 1, 10)
    probes = spark.createDataFrame([(e, day) for e in ("full", "part", "ahead", "blank", "none")], "entity string, day date")
    weights = spark.createDataFrame([(e, r, D(2024, 1, 1), z) for e, r, z in (("full", 2, None), ("full", 10, None), ("full", 3, D(2024, 1, 9)), ("part", 2, None), ("part", 9, None), ("ahead", 5, None), ("blank", 10, day))], "entity string, region int, effective_from date, effective_to date")
    features = spark.createDataFrame([(2, D(2024, 1, 8), D(2024, 1, 8), 1.0), (2, D(2024, 1, 11), D(2024, 1, 11), 9.0), (10, D(2024, 1, 9), D(2024, 1, 9), None), (5, day, D(2024, 1, 12), 2.0)], "region int, day date, at date, value double")
    out = C.coverage(probes, weights, features, "entity", "region", "at", F.col("value").isNotNull(), {"gap": F.col("value").isNull(), "low": F.col("value") < 2})
    got = {r.entity: (r.as_of, r.used, r.flags) for r in out.collect()}
    assert got == {
        "full": (D(2024, 1, 9), "2", "2:low,10:gap"), "part": (D(2024, 1, 8), "2", "2:low,missing_region:9,partial_regions"), "ahead": (None, None, "future_as_of:5,missing_all_regions"),
        "blank": (D(2024, 1, 9), None, "10:gap,missing_all_values"), "none": (None, None, "missing_weights"),
    }


def test_plan_takes_as_few_countries_as_the_gap_needs(spark):
    cells = [("m", "A", 1, 5.0, True), ("m", "B", 1, 2.0, False), ("m", "C", 1, 2.0, False), ("m", "E", 1, 1.0, False), ("n", "B", 1, 1.0, False), ("n", "A", 1, 9.0, True), ("o", "E", 2, 1.0, False)]
    df = spark.createDataFrame(cells, "metric string, country string, marketing_year int, weight double, there boolean")
    got = [tuple(r) for r in C.collection_plan(df, 0.6).orderBy("rank").collect()]
    assert got == [("E", 2, "o", 1.0, 0.6, 1), ("B", 1, "m", 0.2, 0.1, 2)]
    assert [r.country for r in C.collection_plan(df, 0.75).orderBy("rank").collect()] == ["E", "B", "C"]


def test_contract_cells_take_the_worst_status(spark):
    required = spark.createDataFrame([(m, c) for m in "pq" for c in "ABC"], "metric string, country string")
    raw = spark.createDataFrame([("p", "A", "x", 0), ("p", "A", "y", 0), ("p", "B", "x", 1), ("p", "B", "x", 2), ("q", "A", None, 1), ("q", "Z", "x", 0), (None, "A", "x", 0)], "metric string, country string, name string, fault int")
    cells = C.contract_cells(required, raw, ["metric", "country"], "name", {"mismatch": F.col("fault") == 2, "unreadable": F.col("fault") >= 1})
    got = {(r.metric, r.country): (r.raw_rows, r.normalized_rows, r.names, r.status) for r in cells.collect()}
    assert got == {
        ("p", "A"): (2, 2, "x,y", "available"), ("p", "B"): (2, 0, "x", "mismatch"), ("p", "C"): (0, 0, None, "missing_raw_row"),
        ("q", "A"): (1, 0, None, "unreadable"), ("q", "B"): (0, 0, None, "missing_raw_row"), ("q", "C"): (0, 0, None, "missing_raw_row"),
    }
    assert {tuple(r) for r in C.contract_metrics(cells, "metric").collect()} == {("p", 1, 2, 1), ("q", 0, 3, 1)}
