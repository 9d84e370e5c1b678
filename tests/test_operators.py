"""Hand-made rows for the rules that decide correctness."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import ingest as I
from tidemark.operators import pointintime as P
from tidemark.plans import payloads
from tidemark.sources import export as E
from tidemark.sources import parsers as A


def day(n):
    return dt.date(2024, 1, n)


def test_asof_takes_the_latest_earlier_row_and_ties_go_to_the_highest_id(spark):
    probes = spark.createDataFrame([("a", day(2)), ("a", day(5)), ("b", day(5))], "k string, d date")
    context = spark.createDataFrame([("a", day(3), 1, 1.0), ("a", day(3), 2, 2.0), ("a", day(6), 3, 9.0)], "k string, t date, id int, v double")
    out = {(r.k, r.d): r.found and r.found.v for r in P.asof_backward(probes, context, ["k"], "d", "t", ["v"], ["id"]).collect()}
    assert out == {("a", day(2)): None, ("a", day(5)): 2.0, ("b", day(5)): None}


def test_future_rows_change_nothing_before_them(spark):
    probes = spark.createDataFrame([("a", day(n)) for n in range(1, 9)], "k string, d date")
    known = [("a", day(2), 1.0), ("a", day(4), 2.0)]
    context = spark.createDataFrame(known, "k string, t date, v double")
    more = spark.createDataFrame([*known, ("a", day(9), 99.0)], "k string, t date, v double")
    look = lambda c: sorted((r.d, r.found and r.found.v) for r in P.asof_backward(probes, c, ["k"], "d", "t", ["v"]).collect())
    assert look(context) == look(more)


def test_local_day_crosses_midnight(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 21:30:00' ts")
    assert df.select(S.local_date(F.col("ts"), "Europe/Moscow")).first()[0] == day(2)


def test_rolling_waits_for_a_full_window(spark):
    df = spark.createDataFrame([("a", n, float(n)) for n in range(1, 5)], "k string, t int, v double")
    out = [r.rolling_mean_3 for r in P.rolling_rows(df, ["k"], "t", "v", [3], []).orderBy("t").collect()]
    assert out == [None, None, 2.0, 3.0]


def test_second_upsert_skips_everything(spark):
    df = spark.createDataFrame([(1, 1.5), (2, None)], "k int, v double")
    out = I.feature_upsert(df, df, ["k"], S.values_equal(F.col("x.v"), F.col("y.v")))
    assert sorted(map(tuple, out.collect())) == [(1, "skipped"), (2, "skipped")]
    new = spark.createDataFrame([(1, None), (2, 2.0), (3, None)], "k int, v double")
    out = I.feature_upsert(df, new, ["k"], S.values_equal(F.col("x.v"), F.col("y.v")))
    assert sorted(map(tuple, out.collect())) == [(1, "updated"), (2, "updated"), (3, "created")]


def test_merge_actions(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, h string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (3, "c")], "k int, h string")
    assert {r.k: r.action for r in I.merge_actions(old, new, ["k"], "h").collect()} == {1: "skip", 2: "conflict", 3: "insert"}
    old = spark.createDataFrame([(1, None), (2, None), (3, "a")], "k int, h string")
    new = spark.createDataFrame([(1, "x"), (2, None), (3, None), (4, None)], "k int, h string")
    assert {r.k: r.action for r in I.merge_actions(old, new, ["k"], "h").collect()} == {1: "conflict", 2: "skip", 3: "conflict", 4: "insert"}


def test_identity_match_keeps_rows_where_stored_keys_repeat(spark):
    old = spark.createDataFrame([(1, 9), (1, 4), (None, 7)], "k int, id int")
    new = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    assert sorted(map(tuple, I.identity_match(new, old, ["k"], "id").collect()), key=str) == [(1, 4), (2, None), (None, 7)]


def test_written_datasets_are_checked(spark, tmp_path):
    rows = spark.createDataFrame([("b", day(1), None, 1.5), ("a", day(2), "x", None)], "k string, d date, f string, v double")
    files = E.write_dataset(rows, str(tmp_path / "one"), ["k", "d"])
    assert sorted(map(tuple, E.read_csv(spark, files, rows.columns).collect())) == [("a", "2024-01-02", "x", ""), ("b", "2024-01-01", "", "1.5")]
    m = E.manifest(spark, files, rows.schema, "k", "d", "f").first()
    assert (m.n_rows, m.entities, m.first_day, m.unflagged, m.csv_equals_parquet) == (2, "a,b", day(1), 1, True)
    for n, bad in enumerate((rows.limit(0), rows.union(rows), rows.withColumn("k", F.lit(None).cast("string")))):
        with pytest.raises(ValueError):
            E.write_dataset(bad, str(tmp_path / f"bad{n}"), ["k", "d"])


def test_keywords_stand_for_themselves(spark):
    df = spark.createDataFrame([("the u.s. and us",), ("uxsx",), ("soybean meal soybeans",)], "t string")
    hits = [sorted(r[0]) for r in df.select(S.keyword_hits(F.col("t"), ["u.s.", "soybean", "soybean meal", "and"])).collect()]
    assert hits == [["and", "u.s."], [], ["soybean", "soybean meal"]]
    assert [r[0] for r in df.select(S.keyword_match(F.col("t"), "u.s.")).collect()] == [True, False, False]


def test_scalars(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(S.canonical_decimal(F.lit("100.00000000"))) == "100"
    assert get(S.canonical_decimal(F.lit("1.50"))) == "1.5"
    assert get(S.normalize_url(F.lit("HTTP://Ex.COM/A/?q=1#f"))) == "http://ex.com/A"
    assert get(S.normalize_text(F.lit(" A\n b "))) == "a b"
    assert get(S.lenient_decimal(F.lit('"1,234.5"'))) == 1234.5
    assert get(S.lenient_decimal(F.lit("N/A"))) is None
    assert get(S.safe_ratio(F.lit(1), F.lit(0))) is None
    assert get(S.keyword_match(F.lit("soybeans rise"), "soybean")) is False


def test_size_anomaly_of_one_large_source_is_dealt_by_ranges(spark):
    rng = random.Random(7)
    rows = [("big", n, rng.randrange(1, 400)) for n in range(3000)] + [(None, n, rng.randrange(1, 400)) for n in range(30)] + [("one", 5, 3), ("big", None, 7)]
    df = spark.createDataFrame(rows, "source string, doc_id long, n_chars long").repartition(4)
    out = I.size_anomaly(df, ["source"], "doc_id", "n_chars")
    got = {(r.source, r.doc_id): (r.mean_before, r.status) for r in out.collect()}
    want = {}
    for source in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == source), key=lambda r: -1 if r[1] is None else r[1])
        for i, (_, doc, n) in enumerate(mine):
            past = [x[2] for x in mine[max(0, i - 20) : i]]
            mean = sum(past) / len(past) if past else None
            want[source, doc] = (mean, "skip" if mean is None else "fail" if n > 3 * mean or n * 3 < mean else "pass")
    assert got == want and out.count() == len(rows)
    assert "__range" in out._jdf.queryExecution().optimizedPlan().toString()
    few = I.size_anomaly(df, ["source"], "doc_id", "n_chars", ranges=2000).collect()  # ranges of fewer rows than are looked back on
    assert {(r.source, r.doc_id): (r.mean_before, r.status) for r in few} == want


def test_all_orders_pass_through_observations_in_bounded_documents(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    want = sorted((r.o_orderpriority, r.o_orderkey, float(r.o_totalprice)) for r in orders.collect() if r.o_orderkey % 7)
    assert sorted(map(tuple, payloads.observations(orders, 50).collect())) == want


def test_sources_are_compared_day_by_day(spark):
    history = spark.createDataFrame([("a", day(1), 10.0), ("a", day(2), 10.0), ("a", day(3), 10.0), ("a", day(4), 1.0), ("b", day(1), 1.0), ("c", day(1), None), ("c", None, 2.0)], "k string, d date, v double")
    current = spark.createDataFrame([("a", day(1), 10.0), ("a", day(2), 9.95), ("a", day(3), 5.0), ("a", day(4), 0.0), ("b", day(9), 1.0), ("c", day(1), 1.0), ("z", day(1), 1.0)], "k string, d date, p double")
    got = sorted((r.k, r.d and r.d.day, r.diff_abs and round(r.diff_abs, 6), r.diff_pct and round(r.diff_pct, 6), r.status) for r in I.compare_sources(history, current, "k", "d", "v", "p").collect())
    assert got == [
        ("a", 1, 0.0, 0.0, "match_close"), ("a", 2, 0.05, 0.005025, "small_diff"), ("a", 3, 5.0, 1.0, "large_diff"), ("a", 4, 1.0, None, "large_diff"),
        ("b", None, None, None, "no_overlap"), ("c", None, None, None, "not_comparable"),
    ]


def test_prefixes_tell_whether_they_reach_the_threshold(spark):
    shares = spark.createDataFrame([("m", c, s) for c, s in (("x", 0.5), ("y", 0.3), ("z", 0.2))], "k string, c string, s double")
    see = lambda least, most: [(r.c, r.status) for r in P.coverage_prefix(shares, ["k"], "s", "c", least, most).orderBy("rank").collect()]
    assert see(0.6, None) == [("x", "threshold_reached"), ("y", "threshold_reached")]
    assert see(0.6, 1) == [("x", "coverage_requires_review")]
    assert see(2.0, None) == [(c, "threshold_not_reached") for c in "xyz"]
