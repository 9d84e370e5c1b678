"""Landed payloads and written exports, as files."""

import datetime as dt
import hashlib
from pathlib import Path

import pytest

from tidemark.sources import export as E
from tidemark.sources import landing as W


def test_a_second_landing_writes_nothing(spark, tmp_path):
    at = dt.datetime(2024, 1, 2, 3, tzinfo=dt.timezone.utc)
    rows = [("a b", "r/1", at, "text/csv; x=1", b"1,2"), ("a b", "r/1", at + dt.timedelta(hours=1), "text/json", b"1,2"), ("a b", "r/1", at, None, None), ("../", None, at, "image/png", b"1,2"), ("a b", "r2", at, "text/html", b"1,2")]
    df = spark.createDataFrame(rows, "source_code string, run_id string, fetched_at timestamp, content_type string, payload binary")
    folder = str(tmp_path / "landed")
    assert tuple(W.land(df, folder).first()) == (5, 4)
    files = {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}
    assert tuple(W.land(df, folder).first()) == (5, 0)
    assert {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet") if p in files} == files
    assert tuple(W.land(df.limit(0), folder).first()) == (0, 0)
    got = {r.path: (bytes(r.payload), r.bytes_size) for r in W.landed(spark, folder).collect()}
    two, none = hashlib.sha256(b"1,2").hexdigest(), hashlib.sha256(b"").hexdigest()
    day = "2024/01/02"
    assert got == {f"a_b/{day}/r_1/{two}.csv": (b"1,2", 3), f"a_b/{day}/r_1/{none}.bin": (b"", 0), f"unknown/{day}/unknown/{two}.bin": (b"1,2", 3), f"a_b/{day}/r2/{two}.html": (b"1,2", 3)}
    later = df.limit(1).withColumn("fetched_at", df["fetched_at"] + dt.timedelta(days=1))
    assert tuple(W.land(later, folder).first()) == (1, 1)


def test_files_are_listed_with_their_digests(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.5, None), ("b", dt.date(2024, 1, 2), None, "late")], "k string, d date, v double, flags string")
    files = E.write_dataset(df, str(tmp_path / "out"), ["k", "d"])
    entries = E.file_entries(spark, files).collect()
    for r in entries:
        data = Path(r.path.removeprefix("file:")).read_bytes()
        assert (r.bytes_size, r.sha256, r.markers) == (len(data), hashlib.sha256(data).hexdigest(), [])
    assert {r.format for r in entries} == {"csv", "parquet"}
    m = E.checked_manifest(spark, files, df.schema, "k", "d", "flags").first()
    assert (m.n_rows, m.n_files, m.bytes_size, m.csv_equals_parquet) == (2, len(entries), sum(r.bytes_size for r in entries), True)


def test_a_secret_in_a_file_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), "x TELEGRAM_TOKEN=1")], "k string, d date, flags string")
    files = E.write_dataset(df, str(tmp_path / "out"), ["k", "d"])
    with pytest.raises(ValueError, match="TELEGRAM_TOKEN"):
        E.checked_manifest(spark, files, df.schema, "k", "d", "flags")


def test_a_missing_header_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), None)], "k string, d date, flags string")
    files = E.write_dataset(df, str(tmp_path / "out"), ["k", "d"])
    other = spark.createDataFrame([], "k string, d date, flag string").schema
    with pytest.raises(ValueError, match="header"):
        E.checked_manifest(spark, files, other, "k", "d", "flag")


def test_rows_are_checked_before_export(spark):
    day = dt.date(2024, 1, 1)
    checks = lambda rows: {r.check: (r.status, r.n) for r in E.row_checks(spark.createDataFrame(rows, "n string, day date"), "n", "day").collect()}
    good = checks([("a", day), ("b", day), ("a", day + dt.timedelta(1))])
    assert good == {"has_rows": ("pass", 3), "entity_present": ("pass", 0), "day_present": ("pass", 0), "keys_unique": ("pass", 0)}
    bad = checks([("a", day), ("a", day), ("a ", day), (" ", day), (None, day), (None, day), ("b", None), ("b", None)])
    assert bad == {"has_rows": ("pass", 8), "entity_present": ("fail", 3), "day_present": ("fail", 2), "keys_unique": ("fail", 1)}
    assert checks([])["has_rows"] == ("fail", 0)


def test_scan_of_features(spark):
    day = lambda n: dt.date(2024, 1, n)
    rows = spark.createDataFrame([(1, day(1), 1.0, "x"), (1, day(2), 2.0, "y"), (2, day(3), 3.0, "z"), (9, day(2), 4.0, "q"), (None, day(2), 5.0, "r"), (1, None, 6.0, "s")], "id int, day date, v double, name string")
    names = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "id int, name string")
    scan = lambda *ends: sorted(map(tuple, E.scan_features(rows, names, "id", "day", ["name", "day", "v"], *ends).collect()), key=str)
    assert scan("2024-01-02", "2024-01-03") == [("one", day(2), 2.0), ("two", day(3), 3.0)]
    assert scan(None, "2024-01-01") == [("one", day(1), 1.0)]
    assert len(scan()) == 4
