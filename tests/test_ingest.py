"""Merges in delivery order, digests and differences, and streams over several batches."""

import collections
import datetime as dt
import hashlib
import json
import random

from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import ingest as I
from tidemark.streaming import jobs as J


def plain_merge(stored, deliveries):
    """(key, digest, order) rows in order; one stored digest a key, the least."""
    held = {}
    for key, digest in sorted(stored, key=lambda r: (r[1] is not None, r[1] or ""), reverse=True):
        held[key] = digest
    out = []
    for key, digest, n in sorted(deliveries, key=lambda r: (r[2], r[1] is not None, r[1] or "")):
        out.append((key, digest, n, "insert" if key not in held else "skip" if held[key] == digest else "conflict"))
        held.setdefault(key, digest)
    return out


def test_merge_is_an_ordered_fold(spark):
    rng = random.Random(12)
    stored = [((rng.choice("abc") if rng.random() < 0.8 else None, rng.randint(0, 5)), rng.choice("xy")) for _ in range(12)]
    deliveries = [((rng.choice("abcde") if rng.random() < 0.8 else None, rng.randint(0, 5)), rng.choice(["x", "y", "z", None]), rng.randint(0, 4)) for _ in range(200)]
    old = spark.createDataFrame([(*k, d) for k, d in stored], "a string, b int, h string")
    new = spark.createDataFrame([(*k, d, n) for k, d, n in deliveries], "a string, b int, h string, n int").withColumn("action_before", F.lit(1))
    got = I.merge_actions(old, new, ["a", "b"], "h", ["n"]).collect()
    want = collections.Counter(((*k,), d, n, a) for k, d, n, a in plain_merge(stored, deliveries))
    assert collections.Counter(((r.a, r.b), r.h, r.n, r.action) for r in got) == want


def test_what_repeated_and_null_keys_gave_wrong_before(spark):
    stored = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "k int, h string")
    new = spark.createDataFrame([(1, "b", 1), (2, "x", 1), (2, "x", 2), (2, "y", 3), (None, "n", 1), (None, "m", 2)], "k int, h string, n int")
    got = sorted((r.k or 0, r.n, r.action) for r in I.merge_actions(stored, new, ["k"], "h", ["n"]).collect())
    assert got == [(0, 1, "skip"), (0, 2, "conflict"), (1, 1, "conflict"), (2, 1, "insert"), (2, 2, "skip"), (2, 3, "conflict")]
    assert I.merge_actions(stored.limit(0), new, ["k"], "h", ["n"]).filter("action = 'insert'").count() == 3
    assert [r.k for r in I.insert_if_absent(stored, new, ["k"], ["n"]).collect()] == [2]
    assert I.merge_actions(stored, new.limit(0), ["k"], "h").count() == 0


def test_upserts_in_order(spark):
    stored = spark.createDataFrame([(1, 1.0), (1, 0.5), (None, 2.0)], "k int, v double")
    built = spark.createDataFrame([(1, 1.0, 1), (1, 3.0, 2), (1, 3.0, 3), (2, None, 1), (2, None, 2), (None, 2.0, 1)], "k int, v double, n int")
    got = I.feature_upsert(stored, built, ["k"], S.values_equal(F.col("x.v"), F.col("y.v")), ["n"]).collect()
    assert sorted((r.k or 0, r.action) for r in got) == [(0, "skipped"), (1, "skipped"), (1, "skipped"), (1, "updated"), (2, "created"), (2, "skipped")]


def test_the_newest_bar_moves(spark):
    day = lambda n: dt.date(2024, 1, n)
    stored = spark.createDataFrame([("p", day(1), "a"), ("p", day(2), "b")], "k string, d date, h string")
    new = [("p", day(2), "c", 1, "update"), ("p", day(2), "c", 2, "skip"), ("p", day(2), "b", 3, "update"), ("p", day(1), "z", 4, "reject"), ("p", day(1), "a", 5, "skip")]
    new += [("p", day(3), "n", 6, "insert"), ("p", day(2), "q", 7, "reject"), ("p", day(2), "b", 8, "skip"), ("p", day(3), "m", 9, "update"), ("q", day(1), "a", 1, "insert"), ("q", day(1), "b", 2, "update")]
    rows = spark.createDataFrame([r[:4] for r in new], "k string, d date, h string, n int")
    got = {(r.k, r.n): r.action for r in I.bar_revisions(stored, rows, ["k"], "d", "h", ["n"]).collect()}
    assert got == {(r[0], r[3]): r[4] for r in new}


def test_revisions_are_numbered_on(spark):
    stored = spark.createDataFrame([("a", 1), ("a", 4)], "k string, revision int")
    changes = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "k string, n int")
    got = sorted((r.k or "", r.n, r.revision) for r in I.revision_numbers(changes, stored, ["k"], ["n"]).collect())
    assert got == [("", 1, 1), ("a", 1, 5), ("a", 2, 6), ("b", 1, 1)]


def test_digests_are_those_of_sorted_json(spark):
    rows = [("a|b", "", "1.50"), ("a", "b|", "1.5"), (None, 'q"\\\n\té', None)]
    df = spark.createDataFrame(rows, "x string, y string, p string").withColumn("p", F.col("p").cast("decimal(18,6)"))
    fields = {"y": F.col("y"), "p": S.canonical_decimal(F.col("p")), "in": {"x": F.col("x"), "n": F.lit(3)}, "ok": F.lit(True)}
    again = dict(reversed(fields.items()))
    got = df.select(S.record_hash(fields).alias("a"), S.record_hash(again).alias("b")).collect()
    want = [{"y": y, "p": None if p is None else "1.5", "in": {"x": x, "n": 3}, "ok": True} for x, y, p in rows]
    digest = lambda v: hashlib.sha256(json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    assert [(r.a, r.b) for r in got] == [(digest(v), digest(v)) for v in want]
    assert got[0].a != got[1].a
    empty = spark.createDataFrame([(None,), ("",)], "x string").select(S.record_hash({"x": F.col("x")}).alias("h")).collect()
    assert empty[0].h != empty[1].h


def test_differences_have_old_and_new_values(spark):
    old = spark.createDataFrame([(1, "2.00", "s"), (2, None, None), (3, "0", "s"), (None, "1", "s"), (5, "1.5", "s")], "k int, p string, t string").withColumn("p", F.col("p").cast("decimal(18,6)"))
    new = spark.createDataFrame([(1, "2.50", "s"), (2, "1", "t"), (3, "4", "s"), (None, "1", None), (5, "1.500", "s")], "k int, p string, t string").withColumn("p", F.col("p").cast("decimal(18,6)"))
    got = {r.k: (r.changed, json.loads(r["diff"])) for r in I.field_diff(old, new, ["k"], ["p", "t"]).collect()}
    assert got == {
        1: ("p", {"p": {"old": "2", "new": "2.5", "diff_abs": "0.5", "diff_pct": "0.25"}}),
        2: ("p,t", {"p": {"old": None, "new": "1"}, "t": {"old": None, "new": "t"}}),
        3: ("p", {"p": {"old": "0", "new": "4", "diff_abs": "4", "diff_pct": None}}),
        None: ("t", {"t": {"old": "s", "new": None}}),
    }


def test_batches_read_what_those_before_left_and_may_run_again(spark, tmp_path):
    stored = spark.createDataFrame([(0, "a")], "k int, h string")
    store = J.BatchStore(stored, f"{tmp_path}/store", every=2)
    batches = [[(1, "x")], [(1, "y"), (2, "x")], [(1, "x"), (2, "z"), (3, "q")], [(3, "q"), (0, "b")]]
    run = lambda n: J.merge_batch(store, spark.createDataFrame(batches[n], "k int, h string"), n, ["k"], "h", [], f"{tmp_path}/out")
    read = lambda n: sorted((r.k, r.action) for r in spark.read.parquet(f"{tmp_path}/out/batch={n}").collect())
    want = [[(1, "insert")], [(1, "conflict"), (2, "insert")], [(1, "skip"), (2, "conflict"), (3, "insert")], [(0, "conflict"), (3, "skip")]]
    for n in range(4):
        run(n)
        assert read(n) == want[n]
        run(n)  # as after a failure
        assert read(n) == want[n]
    assert sorted(map(tuple, store.before(4).collect())) == [(0, "a"), (1, "x"), (2, "x"), (3, "q")]


def test_silence_is_told_once_and_so_is_the_return(spark, tmp_path):
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    hours = [[("a", 0), ("a", 1), ("b", 0), ("c", 1)], [("a", 3), ("b", 9), ("b", 8)], [("a", 30), (None, 31), ("a", 31)], [("c", 60)]]
    every = [(k, base + dt.timedelta(hours=h)) for part in hours for k, h in part]
    for part in hours:
        spark.createDataFrame([(k, base + dt.timedelta(hours=h)) for k, h in part], "k string, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    limit, found = dt.timedelta(hours=5), []
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        J.each_batch(J.silence_alerts(stream, "k", "ts", limit, "0 seconds"), f"{tmp_path}/state", lambda b, n: found.extend(b.collect()))
    finally:
        spark.conf.set(name, before)
    until = spark.createDataFrame([(base + dt.timedelta(hours=60),)], "until timestamp")
    want = J.silence_gaps(spark.createDataFrame(every, "k string, ts timestamp"), "k", "ts", limit, until).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want))
    assert collections.Counter((r.key, r.status) for r in want) == {("a", "stale"): 2, ("a", "recovered"): 1, ("b", "stale"): 2, ("b", "recovered"): 1, ("c", "stale"): 1, ("c", "recovered"): 1}
