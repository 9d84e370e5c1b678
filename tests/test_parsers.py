"""Parsers on payloads written by hand and by Python's own writers."""

import csv
import datetime as dt
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import csvtext as C
from tidemark.sources import parsers as A


def day(n):
    return dt.date(2024, 1, n)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "k int, p string")


def test_csv_records_equal_python(spark):
    rng, texts, want = random.Random(5), [], []
    for _ in range(300):
        rows = [["".join(rng.choice('ab,"\n\r é') for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(2, 4))] for _ in range(rng.randint(1, 5))]
        rows = [[f"x{c}x" for c in row] for row in rows]  # trimmed fields are their own test
        out = io.StringIO()
        csv.writer(out, quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]), lineterminator=rng.choice(["\n", "\r\n"])).writerows(rows)
        texts.append(out.getvalue())
        want.append(rows)
    got = frame(spark, texts).select("k", C.records(F.col("p")).alias("r")).orderBy("k").collect()
    assert [r.r for r in got] == want


def test_csv_rows_by_name(spark):
    texts = ['﻿Country Name, Value\n"Korea, South","1,5"\n\n x ,\n"a ""b""\nc"\n', "Value\n7", "other\n1", 'value\n"open', "", None, "value\n"]
    got = {(r.k, r.row): (r.c, r.v, r.unreadable) for r in C.named_rows(frame(spark, texts), ["k"], "p", {"c": ("country_name",), "v": ("amount", "value")}).collect()}
    assert got == {
        (0, 0): ("Korea, South", "1,5", False), (0, 1): ("x", "", False), (0, 2): ('a "b"\nc', None, False), (1, 0): (None, "7", False),
        (2, None): (None, None, True), (3, None): (None, None, True), (4, None): (None, None, True), (5, None): (None, None, True), (6, None): (None, None, False),
    }


def test_series_with_quotes_and_bad_cells(spark):
    texts = [
        'date,v\n2024-01-06,"1,234.5"\n"2024-01-07",.\n', "date,v\n2024-01-02,1x\n2024-01-03,2\n", "date,v\n2023-01-02,1x\n2024-01-03,2\n", "v\n1", "date,v\nsoon,1", "date,v\n", 'date,v\n2024-01-06,"1',
    ]
    out = sorted(map(tuple, A.parse_series_csv(frame(spark, texts), "k", "p", ("date",), "v", "2024-01-01", "2024-01-31").collect()), key=str)
    assert [(k, d, v and float(v), f) for k, d, v, f in out] == [(0, day(6), 1234.5, False), (1, None, None, True), (2, day(3), 2.0, False), (3, None, None, True), (4, None, None, True), (5, None, None, False), (6, None, None, True)]


def test_balances_from_csv_and_json(spark):
    texts = [
        'country_name,attribute_description,market_year,month,value\n"Korea, South",Exports,1997,3,"5,000.5"\nX,Exports,1997,,1\n',
        json.dumps([{"country": "Korea, South", "metric": "exports", "marketing_year": 1998, "amount": 2, "estimate_type": "Projected"}, {"country": "Korea, South", "metric": "tea", "marketing_year": "1998", "value": "1"}]),
        "{broken", "no header",
    ]
    got = A.parse_balances(frame(spark, texts), ["k"], "p", {"exports": "exports"}, ("Korea, South",), (1990, 1999), F.lit("2024-05-01").cast("date"))
    rows = sorted(((r.k, r.country, r.metric, r.marketing_year, r.report_month, r.estimate_type, r.value, r.route) for r in got.collect() if r.country), key=str)
    assert rows == [
        (0, "Korea, South", "exports", 1997, 3, "unknown", 5000.5, "parsed"), (0, "X", "exports", 1997, 5, "unknown", 1.0, "skipped"),
        (1, "Korea, South", "exports", 1998, 5, "projection", 2.0, "parsed"), (1, "Korea, South", None, 1998, 5, "unknown", 1.0, "skipped"),
    ]
    assert sorted((r.k, r.route) for r in got.collect() if not r.country) == [(2, "malformed"), (3, "malformed")]


def test_malformed_trade_rows_and_payloads(spark):
    texts = ['{"data": [{"reporter": 1, "period": "2024-02", "primaryValue": "", "qty": 0, "tradeValue": 6}, 5, {"period": "202413", "tradeValue": 1}, {"fobvalue": 1}]}', "no json", '[{"reporter": "2", "refPeriodId": "202401", "tradeValue": "8", "qtyValue": 4}]', None]
    out = {(r.k, r.pos): r for r in A.parse_trade_json(frame(spark, texts), ["k"], "p", {"reporter": ("reporter",)}).collect()}
    assert (out[0, 0].reporter, out[0, 0].value, out[0, 0].unit_value, out[0, 0].malformed) == ("1", 6.0, None, False)
    assert (out[2, 0].reporter, out[2, 0].unit_value, out[2, 0].malformed) == ("2", 2.0, False)
    assert all(out[at].malformed for at in ((0, 1), (0, 2), (0, 3), (1, None), (3, None)))
    given = A.parse_trade_json(frame(spark, texts[:1]), ["k"], "p", default_period=F.lit("2020-05")).filter("pos = 3").first()
    assert (given.period, given.malformed) == (dt.date(2020, 5, 1), False)


def test_trade_rows_are_read_once(spark):
    texts = ['{"items": [{"a": [1, {"b": null}], "c": {"d": 1.50}, "e": null, "f": true, "period": 202401, "qty": 1e2, "reporter": " x "}, null, [1]]}']
    more = {n: (n,) for n in ("reporter", "a", "c", "e", "f", "none")}
    found = A.parse_trade_json(frame(spark, texts), ["k"], "p", more).filter("not malformed")
    row = found.first()
    assert [row[n] for n in ("pos", *more, "quantity")] == [0, "x", '[1,{"b":null}]', '{"d":1.5}', None, "true", None, 100.0]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") <= len(A.TRADE_ROWS) + 2


def test_the_first_date_that_reads_counts(spark):
    article = lambda **more: json.dumps({"articles": [{"url": "http://A.b/c", "title": "t", **more}]})
    texts = [article(date="20240102", published_at="2024-01-03"), article(seendate="soon", publishedAt="2024-01-04T01:00:00+02:00"), article(datetime="20240105T060708Z", source="S"), article(), article(date="20240106070809")]
    got = [(r.published_at, r.source_name, r.malformed) for r in A.parse_article_json(frame(spark, texts), ["k"], "p").orderBy("k").collect()]
    assert got == [
        (dt.datetime(2024, 1, 2), "a.b", False), (dt.datetime(2024, 1, 3, 23), "a.b", False), (dt.datetime(2024, 1, 5, 6, 7, 8), "S", False), (None, "a.b", True), (dt.datetime(2024, 1, 6, 7, 8, 9), "a.b", False),
    ]


MILLIS = 1704067200000


@pytest.mark.parametrize("text", [
    '{"list": [{"day": "2024-01-01", "open": 1, "high": "3,5", "low": 0.5, "close": 2, "volume": 9}]}',
    f'var k = {{"data": {{"items": [{{"time": "{MILLIS}", "o": 1, "h": 3.5, "l": 0.5, "price": 2, "vol": 9}}]}}}};',
    f'quote = {{"data": {{"X": [{{"time": {MILLIS}, "q1": 1, "q2": 2, "q3": 3.5, "q4": 0.5, "q60": 9}}]}}}}',
    f"[[{MILLIS}, 1, 3.5, 0.5, 2, 9]]", '{"kline": [["2024/01/01", "1", "3.5", "0.5", "2", 0, 0, 0, 0, "9"]]}', '{"rows": [["20240101", 1, 3.5, 0.5, 2, 9]]}', '{"data": [{"date": "2024-01-01 00:00:00", "open": 1, "high": 3.5, "low": 0.5, "c": 2, "volume": "9"}]}',
])
def test_bars_of_every_shape(spark, text):
    df = frame(spark, [text]).withColumn("code", F.lit("X"))
    assert list(map(tuple, A.parse_bars(df, "k", "p", "code").collect())) == [(0, day(1), 1.0, 3.5, 0.5, 2.0, 9.0, False)]


def test_bars_that_cant_be_read_are_counted_and_the_last_kept(spark):
    texts = ["{", None, '{"data": {"note": 1}}', '{"data": []}', json.dumps([[f"2024010{n}", n, n, n, n, n] for n in range(1, 6)])]
    got = sorted((r.k, r.day, r.failed) for r in A.parse_bars(frame(spark, texts), "k", "p", last=2).collect())
    assert got == [(0, None, True), (1, None, True), (2, None, True), (3, None, True), (4, day(4), False), (4, day(5), False)]


def test_headers_are_found_within_the_first_rows(spark):
    sheets = ['Title\n,"Crude** oil",  Gold \n2024M01,"1,000",x\n2024-02-15,3,4\nnote,5,6\n', "a\n" * 12 + ",Gold\n2024M01,1", "Month,gold\n2024M01,..\n2024M13,1\n2024M03,7"]
    got = sorted((r.k, r.series, str(r.period), str(r.period_end), r.value and float(r.value)) for r in A.sheet_series(frame(spark, sheets), "k", "p", {"oil": ("oil", "crude oil"), "gold": ("Gold",)}).collect())
    none = "None"
    assert got == [
        (0, "gold", "2024-02-01", "2024-02-29", 4.0), (0, "oil", "2024-01-01", "2024-01-31", 1000.0), (0, "oil", "2024-02-01", "2024-02-29", 3.0),
        (1, "gold", none, none, None), (1, "oil", none, none, None), (2, "gold", "2024-03-01", "2024-03-31", 7.0), (2, "oil", none, none, None),
    ]


def test_observations_of_all_shapes(spark):
    good = '{"code": " ru ", "day": "2024-02-29", "value": 1.50}'
    docs = [
        (0, f"[{good}]"), (1, f'{{"observations": [{good}], "inventory": [1, 2]}}'), (2, f'{{"inventory": [{good}, 7]}}'), (3, '{"observations": {}, "inventory": []}'),
        (4, '[{"code": "", "day": "2024-02-30", "value": "x"}, {"code": "a", "day": "2024-02-30", "value": "x"}, {"code": "a", "day": "2024-2-3", "value": 1}, {"code": "a", "day": "2024-01-01", "value": "x"}]'),
        (5, None), (6, ""), (7, "[]"), (8, "{"), (9, '{"observations": null, "inventory": []}'),
    ]
    rows = spark.createDataFrame(docs, "id int, payload string").withColumn("row", F.lit(1))
    got = A.load_json_observations(rows, ["id"], "payload", ["code"], ["day"], ["value"], upper=["code"]).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.id, r.pos or 0)):
        by.setdefault(r.id, []).append(r.problem)
    assert by == {
        0: [None], 1: [None], 2: [None, "no object"], 3: ["payload"], 4: ["missing: code", "date: day", "date: day", "number: value"],
        5: ["payload"], 6: ["payload"], 8: ["payload"], 9: ["payload"],
    }
    first = next(r for r in got if r.id == 0)
    assert (first.code, str(first.day), float(first.value)) == ("RU", "2024-02-29", 1.5)


def test_missing_currencies(spark):
    one = lambda code, value, nominal="1": f"<Valute><CharCode>{code}</CharCode><Nominal>{nominal}</Nominal><Value>{value}</Value></Valute>"
    doc = lambda *items: f'<ValCurs Date="02.01.2024">{"".join(items)}</ValCurs>'
    docs = [doc(one("USD", "90,5"), one("EUR", "99,1"), one("X", "1")), doc(one("USD", "n/a"), one("EUR", "1", "0")), doc(one("USD", "x"), one("USD", "1,5")), doc(), None, "", "<broken"]
    rows = spark.createDataFrame(list(enumerate(docs)), "id int, payload string").withColumn("x", F.lit(1))
    got = {r.id: (r.day and str(r.day), r.missing) for r in A.missing_currencies(rows, ["id"], "payload", ["USD", "EUR", "USD"]).collect()}
    assert got[0] == ("2024-01-02", None) and got[1] == ("2024-01-02", "EUR,USD") and got[2] == ("2024-01-02", "EUR")
    assert all(got[i][1] == "EUR,USD" for i in (3, 4, 5, 6)) and len(got) == 7
