"""Queries over parsers. Payloads are folded from the tables, parsed, and compared with the tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import scope as C
from tidemark.plans.registry import query
from tidemark.plans.series import events
from tidemark.plans.weighted import BALANCE_SQL, balance
from tidemark.session import scratch_root, table
from tidemark.sources import landing as W
from tidemark.sources import parsers as A


@query("land_payloads", """WITH p AS (SELECT page_id, 'source ' || page_id % 5 AS s, page_id % 3 AS m, html FROM pages), r AS (SELECT 1 AS run, * FROM p WHERE page_id % 2 = 0 UNION ALL SELECT 2, * FROM p)
SELECT DISTINCT replace(s, ' ', '_') AS source_code, 'run_' || run AS run_id, DATE '2024-01-31' + run AS fetch_date, sha256(html) AS sha256, CAST(strlen(html) AS BIGINT) AS bytes_size, replace(s, ' ', '_') || strftime(DATE '2024-01-31' + run, '/%Y/%m/%d/') || 'run_' || run || '/' || sha256(html) || CASE min(m) OVER (PARTITION BY s, run, sha256(html)) WHEN 0 THEN '.html' WHEN 1 THEN '.bin' ELSE '.csv' END AS path FROM r""")
def land_payloads(spark, sf_dir):
    """Two runs of payloads, the second landed twice, which writes nothing more; what has landed then."""
    pages = table(spark, sf_dir, "pages")
    m = F.col("page_id") % 3
    mime = F.when(m == 0, "Text/HTML; charset=utf-8").when(m == 1, "text/plain").otherwise("text/csv")
    rows = pages.select(F.concat(F.lit("source "), (F.col("page_id") % 5).cast("string")).alias("source_code"), mime.alias("content_type"), F.col("html").cast("binary").alias("payload"), "page_id", m.alias("m"))
    at = lambda n: (F.expr(f"timestamp '2024-01-31 12:00:00' + interval {n} day") + F.make_dt_interval(secs=F.col("m"))).cast("timestamp").alias("fetched_at")
    run = lambda n: rows.select("source_code", F.lit(f"run {n}").alias("run_id"), at(n), "content_type", "payload", "page_id")
    folder = f"{scratch_root(spark)}/tidemark/landed-{uuid.uuid4().hex}"
    for delivery in (run(1).filter("page_id % 2 = 0"), run(2), run(2)):
        W.land(delivery, folder)
    return W.landed(spark, folder).select("source_code", "run_id", "fetch_date", "sha256", "bytes_size", "path")


@query("payload_kind", "SELECT page_id, CASE WHEN page_id % 4 = 1 THEN 'json_rows' WHEN page_id % 4 = 2 THEN 'csv' WHEN page_id % 4 = 3 THEN 'json_metadata' WHEN lower(ltrim(html, chr(32) || chr(10) || chr(9))) LIKE '<!doctype html%' OR lower(html) LIKE '<html%' THEN 'html' WHEN html LIKE '<%' THEN 'xml' ELSE 'unknown' END AS kind FROM pages")
def payload_kind(spark, sf_dir):
    n = F.col("page_id") % 4
    body = F.when(n == 1, F.concat(F.lit('{"data": ['), F.col("page_id").cast("string"), F.lit("]}"))).when(n == 2, F.lit("a,b\n1,2\n")).when(n == 3, F.lit('{"title": 1}')).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", A.payload_kind(body).alias("kind"))


_VALIDITY = {
    "payload_non_empty": "m <> 1", "content_type_expected": "m <> 2", "size_within_limit": "m <> 3", "prefix_found": "m NOT IN (1, 4)", "parseable": "m NOT IN (1, 4, 5)",
    "code_present": "m NOT IN (1, 4, 5, 6)", "value_present": "m NOT IN (1, 4, 5, 7)", "value_convertible": "m NOT IN (1, 4, 5, 7, 8)",
}
_WARNINGS = ("content_type_expected", "size_within_limit")


@query("payload_checks", f"""SELECT page_id, c.check_name, CASE WHEN c.ok THEN 'pass' ELSE 'fail' END AS status, CASE WHEN c.check_name IN {_WARNINGS} THEN 'warning' ELSE 'error' END AS severity FROM (SELECT page_id, page_id % 11 AS m FROM pages) p,
LATERAL (VALUES {", ".join(f"('{n}', {e})" for n, e in _VALIDITY.items())}) c(check_name, ok)""")
def payload_checks(spark, sf_dir):
    """Eight checks of payloads of three kinds, each of them failed by some: nothing, a wrong type, too much, no prefix, broken, no code, no value, no number."""
    k, m, part = F.col("page_id"), F.col("page_id") % 11, F.floor(F.col("page_id") / 11) % 3
    kind = F.when(part == 0, "json").when(part == 1, "csv").otherwise("xml")
    text = lambda *x: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in x))
    number = F.when(m == 7, "").when(m == 8, "none so far").otherwise(k.cast("string"))
    code = F.when(m == 6, "other").otherwise(F.concat(F.lit("c"), k.cast("string")))
    pad = F.when(m == 3, F.repeat(F.lit("x"), F.lit(5000))).otherwise("")
    body = F.when(part == 0, text('{"', code, '": 1, "pad": "', pad, '", "last": "', number, '"}')).when(part == 1, text(code, ',"a, ""b""\nc', pad, '",', F.when(m == 7, "").otherwise(text('"', number, '"')))).otherwise(text("<quote><code>", code, "</code><pad>", pad, "</pad><value>", number, "</value></quote>"))
    broken = F.when(m == 5, F.when(part == 1, F.concat(body, F.lit('"'))).otherwise(F.substring(body, F.lit(1), F.length(body) - 1))).otherwise(body)
    whole = F.when(m == 1, "").when(m == 4, broken).otherwise(F.concat(F.lit("var q="), broken, F.lit(";")))
    rows = table(spark, sf_dir, "pages").select("page_id", F.when(m == 2, "image/png").otherwise("Text/Plain; charset=utf-8").alias("mime"), kind.alias("kind"), whole.alias("payload"), text("c", k.cast("string")).alias("code"))
    return A.payload_validity(rows, ["page_id"], "payload", "mime", "kind", ("text/plain", "application/json"), 4000, "var q=", "code", "$.last", 2)


@query("parse_series_csv", """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, CAST(round(sum(CAST(value AS DECIMAL(18,6))), 2) AS DOUBLE) AS value FROM events GROUP BY 1, 2)
SELECT event_type, CASE WHEN event_type <> 'error' THEN day END AS day, CASE WHEN event_type <> 'error' THEN value END AS value, event_type = 'error' AS failed FROM d WHERE event_type <> 'error' AND day BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND day(day) % 10 <> 7
UNION SELECT 'error', NULL, NULL, TRUE""")
def parse_series_csv(spark, sf_dir):
    """Round trip: daily sums as one CSV a type; every tenth day is missing, one type has a bad number."""
    d = events(spark, sf_dir).groupBy("event_type", F.col("utc_day").alias("day")).agg(F.round(F.sum("value"), 2).cast("decimal(18,2)").alias("value"))
    cell = F.when((F.col("event_type") == "error") & (F.dayofmonth("day") == 9), "12x").when(F.dayofmonth("day") % 10 == 7, ".").otherwise(F.col("value").cast("string"))
    lines = F.array_join(F.array_sort(F.collect_list(F.concat_ws(",", F.col("day").cast("string"), cell))), "\n")
    docs = d.groupBy("event_type").agg(F.concat(F.lit("﻿observation_date,VALUE\n"), lines).alias("payload"))
    out = A.parse_series_csv(docs, "event_type", "payload", ("date", "observation_date"), "value", "2024-01-05", "2024-01-25")
    return out.withColumn("value", F.col("value").cast("double"))


@query("parse_props_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events")
def parse_props_json(spark, sf_dir):
    """`var q = {...};` around the JSON is stripped before the path is read."""
    body = F.concat(F.lit("var q = "), F.col("props"), F.lit(";"))
    plain = F.regexp_replace(F.regexp_replace(body, r"^\s*var\s+\w+\s*=\s*", ""), r";\s*$", "")
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json(plain), "$.k", "double").alias("k"))


BARS_SQL = """WITH b AS (SELECT c_mktsegment AS seg, CAST(date_trunc('month', o_orderdate) AS DATE) AS day, CAST(arg_min(o_totalprice, o_orderkey) AS DOUBLE) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low, CAST(arg_max(o_totalprice, o_orderkey) AS DOUBLE) AS close, CAST(count(*) AS DOUBLE) AS volume
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2), p AS (SELECT *, row_number() OVER (PARTITION BY seg ORDER BY day DESC) AS back FROM b)
SELECT seg, day, open, high, low, close, volume, FALSE AS failed FROM p WHERE back <= 60 UNION ALL SELECT seg || ' lost', NULL, NULL, NULL, NULL, NULL, NULL, TRUE FROM (SELECT DISTINCT seg FROM p)"""


@query("parse_bars", BARS_SQL)
def parse_bars(spark, sf_dir):
    """Round trip: monthly bars as one payload a segment, of five shapes, the last 60 kept; and as many payloads that can't be read."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    bars = rows.groupBy(F.col("c_mktsegment").alias("seg"), F.to_date(F.trunc("o_orderdate", "month")).alias("day")).agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"), F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low"), F.max_by("o_totalprice", "o_orderkey").alias("close"), F.count("*").alias("volume")
    )
    grouped = bars.groupBy("seg").agg(F.array_sort(F.collect_list(F.struct("day", "open", "high", "low", "close", "volume"))).alias("d"))
    of = lambda f: F.transform("d", f)
    millis = lambda b: F.unix_date(b["day"]).cast("long") * 86_400_000
    named = of(lambda b: F.struct(b["day"].cast("string").alias("day"), *(b[n].alias(n) for n in ("open", "high", "low", "close", "volume"))))
    short = of(lambda b: F.struct(millis(b).alias("time"), *(F.replace(b[n].cast("string"), F.lit("."), F.lit(",")).alias(n[0]) for n in ("open", "high", "low")), b["close"].alias("price"), b["volume"].alias("vol")))
    coded = of(lambda b: F.struct(millis(b).alias("time"), b["open"].alias("q1"), b["close"].alias("q2"), b["high"].alias("q3"), b["low"].alias("q4"), b["volume"].alias("q60")))
    listed = of(lambda b: F.array(F.date_format(b["day"], "yyyy/MM/dd"), *(b[n].cast("string") for n in ("open", "high", "low", "close")), b["volume"].cast("string")))
    wide = of(lambda b: F.array(F.date_format(b["day"], "yyyyMMdd"), *(b[n].cast("string") for n in ("open", "high", "low", "close")), F.lit("x"), F.lit("x"), F.lit("x"), F.lit("x"), b["volume"].cast("string")))
    s = F.col("seg")
    body = (
        F.when(s == "AUTOMOBILE", F.to_json(F.struct(named.alias("list")))).when(s == "BUILDING", F.to_json(F.struct(F.struct(short.alias("klines")).alias("data"))))
        .when(s == "FURNITURE", F.concat(F.lit('{"flag": 1, "data": {"FURNITURE": '), F.to_json(coded), F.lit("}}"))).when(s == "MACHINERY", F.to_json(listed)).otherwise(F.to_json(F.struct(wide.alias("rows"))))
    )
    docs = grouped.select(s, F.concat(F.lit("var kline = "), body, F.lit(";")).alias("payload"))
    lost = docs.select(F.concat(s, F.lit(" lost")).alias("seg"), F.when(s < "F", F.left("payload", F.length("payload") - 3)).otherwise('{"data": {"note": "none"}}').alias("payload"))
    return A.parse_bars(docs.unionByName(lost), "seg", "payload", "seg", 60)


@query("parse_fx_xml", "SELECT CAST(ts AS DATE) AS day, upper(event_type) AS code, round(CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) / 100, 6) AS rate FROM events GROUP BY 1, 2")
def parse_fx_xml(spark, sf_dir):
    d = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), F.upper("event_type").alias("code")).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)").alias("v"))
    return A.parse_fx_xml(fx_docs(d), "payload")


def fx_docs(d):
    """Rates (day, code, v) as one XML a day."""
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    item = text("<Valute><CharCode>", F.col("code"), "</CharCode><Nominal>100</Nominal><Value>", F.replace(F.col("v").cast("string"), F.lit("."), F.lit(",")), "</Value></Valute>")
    return d.groupBy("day").agg(text('<ValCurs Date="', F.first(F.date_format("day", "dd.MM.yyyy")), '">', F.array_join(F.collect_list(item), ""), "</ValCurs>").alias("payload"))


@query("fx_missing", """WITH r AS (SELECT CAST(ts AS DATE) AS day, upper(event_type) AS code, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY 1, 2)
SELECT day, nullif(concat_ws(',', CASE WHEN NOT coalesce(bool_or(code = 'CLICK' AND v > 0 AND day(day) % 3 <> 0), FALSE) THEN 'CLICK' END, CASE WHEN NOT coalesce(bool_or(code = 'ERROR' AND v > 0 AND day(day) % 4 <> 0), FALSE) THEN 'ERROR' END, 'NONE'), '') AS missing
FROM r WHERE NOT (code = 'CLICK' AND day(day) % 3 = 0) GROUP BY 1""")
def fx_missing(spark, sf_dir):
    """Which of the wanted codes each day's XML lacks: one on every third day, one whose rate is no number on every fourth, one always."""
    d = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), F.upper("event_type").alias("code")).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)").cast("string").alias("v"))
    kept = d.filter("not (code = 'CLICK' and day(day) % 3 = 0)")
    docs = fx_docs(kept.withColumn("v", F.when((F.col("code") == "ERROR") & (F.day("day") % 4 == 0), "n/a").otherwise(F.col("v"))))
    return A.missing_currencies(docs, [], "payload", ["NONE", "CLICK", "ERROR"])


@query("zip_arrays", """SELECT vec_id, CAST(p.p AS INTEGER) AS pos, CAST(p.p AS INTEGER) AS time, round(CAST(embedding[p.p + 1] AS DOUBLE), 6) AS mean, CASE WHEN p.p < 6 THEN round(CAST(embedding[p.p + 9] AS DOUBLE), 6) END AS rain, 'rain' AS missing FROM embeddings, range(8) p(p)""")
def zip_arrays(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.sequence(F.lit(0), F.lit(7)).alias("t"), F.slice("embedding", 1, 8).alias("m"), F.slice("embedding", 9, 6).alias("r"))
    out = A.zip_arrays(rows, ["vec_id"], "t", {"mean": "m", "rain": "r"})
    return out.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("mean", "rain")})


@query("sheet_series", """WITH m AS (SELECT l_returnflag AS f, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2), k AS (SELECT unnest([0, 1, 2]) AS sheet)
SELECT sheet, CASE f WHEN 'A' THEN 'accepted' ELSE 'new' END AS series, period, last_day(period) AS period_end, q AS value FROM m, k WHERE f IN ('A', 'N') AND month(period) % 3 = sheet UNION ALL SELECT sheet, 'absent', NULL, NULL, NULL FROM k""")
def sheet_series(spark, sf_dir):
    """Round trip: monthly sums as three wide sheets with titles above, headers in different rows and columns, and notes in between."""
    m = table(spark, sf_dir, "lineitem").groupBy(F.to_date(F.trunc("l_shipdate", "month")).alias("period")).pivot("l_returnflag", ["A", "N"]).agg(F.sum("l_quantity").cast("decimal(18,2)"))
    n = F.month("period") % 3
    month = F.when(n == 1, F.date_format("period", "yyyy-MM-dd")).otherwise(F.date_format("period", "yyyy'M'MM"))
    cell = lambda c: F.coalesce(F.concat(F.lit('"'), F.format_number(c, 2), F.lit('"')), F.lit(".."))
    line = F.when(n == 2, F.concat_ws(",", month, F.lit("x"), cell("N"), cell("A"))).otherwise(F.concat_ws(",", month, cell("A"), cell("N")))
    body = m.groupBy(n.alias("sheet")).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))
    head = F.when(F.col("sheet") == 2, '"Prices, monthly",,\n\n,note,"New\n flow **",Accepted flow\n,,$,$\n').otherwise('Title\nUpdated,"1, 2"\nMonth,Accepted*  Flow,NEW FLOW\n')
    sheets = body.select("sheet", F.concat(head, F.col("body"), F.lit("\nnot a month,1,2,3\n")).alias("payload"))
    out = A.sheet_series(sheets, "sheet", "payload", {"accepted": ("accepted flow",), "new": ("Flow new", "New flow"), "absent": ("nowhere",)})
    return out.withColumn("value", F.col("value").cast("double"))


@query("unpivot_series", """WITH m AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS a, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS n FROM lineitem GROUP BY 1)
SELECT period, last_day(period) AS period_end, 'accepted' AS series, a AS value FROM m WHERE a IS NOT NULL UNION ALL SELECT period, last_day(period), 'new', n FROM m WHERE n IS NOT NULL""")
def unpivot_series(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy(F.to_date(F.trunc("l_shipdate", "month")).alias("period")).pivot("l_returnflag", ["A", "N"]).agg(F.sum("l_quantity"))
    return A.unpivot_series(m, ["period"], {"A": "accepted", "N": "new"}).withColumn("period_end", F.last_day("period"))


@query("load_observations", "SELECT o_orderpriority AS metric, o_orderkey AS k, CAST(o_totalprice AS DOUBLE) AS value FROM orders WHERE o_orderkey % 7 <> 0")
def load_observations(spark, sf_dir):
    """Round trip: observations as JSON documents by metric; such as lack a required field are left out."""
    return observations(table(spark, sf_dir, "orders"))


def observations(o, chunk_rows=10_000):
    """All orders through JSON documents of about ``chunk_rows`` observations, by metric and chunk of the key, and back."""
    chunks = max(1, -(-o.count() // chunk_rows))
    value = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice").cast("string"))
    observation = F.struct(F.col("o_orderpriority").alias("metric"), F.col("o_orderkey").alias("k"), value.alias("value"))
    docs = o.groupBy("o_orderpriority", F.pmod(F.xxhash64("o_orderkey"), F.lit(chunks)).alias("chunk")).agg(
        F.to_json(F.struct(F.collect_list(observation).alias("observations"))).alias("payload")
    )
    rows = docs.select(F.inline(F.from_json("payload", "observations array<struct<metric:string,k:bigint,value:string>>")["observations"]))
    return rows.filter("value is not null").withColumn("value", F.col("value").cast("double"))


_KEPT = "o_orderkey % 7 <> 0"
_SHAPE = "CASE o_orderpriority WHEN '1-URGENT' THEN 'list' WHEN '2-HIGH' THEN 'inventory' ELSE 'observations' END"


@query("json_observations", f"""SELECT {_SHAPE} AS shape, o_orderpriority AS metric, CASE WHEN o_orderkey % 11 = 3 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS code,
  CASE WHEN o_orderkey % 13 = 5 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_orderkey % 17 = 7 OR NOT {_KEPT} THEN NULL ELSE CAST(o_totalprice AS DECIMAL(38,6)) END AS value,
  CASE WHEN o_orderkey % 11 = 3 OR NOT {_KEPT} THEN 'missing: ' || concat_ws(',', CASE WHEN o_orderkey % 11 = 3 THEN 'code' END, CASE WHEN NOT {_KEPT} THEN 'value' END)
    WHEN o_orderkey % 13 = 5 THEN 'date: day' WHEN o_orderkey % 17 = 7 THEN 'number: value' END AS problem
FROM orders UNION ALL SELECT 'unreadable', NULL, NULL, NULL, NULL, 'payload' FROM (SELECT DISTINCT o_orderpriority FROM orders)""")
def json_observations(spark, sf_dir):
    """Round trip: all orders as documents of three shapes, some fields blank, no dates or no numbers; and documents without a list."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    chunks = max(1, -(-o.count() // 10_000))
    day = F.when(key % 13 == 5, F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    value = F.when(key % 7 != 0, F.when(key % 17 == 7, "n/a").otherwise(F.col("o_totalprice").cast("string")))
    row = F.struct(F.lower("o_orderpriority").alias("metric"), F.when(key % 11 == 3, " ").otherwise(F.concat(F.lit(" "), key.cast("string"))).alias("code"), day.alias("day"), value.alias("value"))
    grouped = o.groupBy("o_orderpriority", F.pmod(F.xxhash64("o_orderkey"), F.lit(chunks)).alias("chunk")).agg(F.to_json(F.collect_list(row)).alias("rows"))
    inside = lambda name: F.concat(F.lit(f'{{"note": 1, "{name}": '), F.col("rows"), F.lit("}"))
    p = F.col("o_orderpriority")
    shape = F.when(p == "1-URGENT", "list").when(p == "2-HIGH", "inventory").otherwise("observations")
    docs = grouped.select(shape.alias("shape"), F.when(p == "1-URGENT", F.col("rows")).when(p == "2-HIGH", inside("inventory")).otherwise(inside("observations")).alias("payload"))
    odd = o.select("o_orderpriority").distinct().select(F.lit("unreadable").alias("shape"), F.when(p < "3", '{"rows": [1]}').when(p < "5", '{"observations": "none", "inventory": [1]}').otherwise('[{"a": ').alias("payload"))
    return A.load_json_observations(docs.unionByName(odd), ["shape"], "payload", ["metric", "code"], ["day"], ["value"], upper=["metric"]).drop("pos")


@query("normalize_url", r"SELECT page_id, lower(regexp_extract(url, '^([^:]+://[^/?#]*)', 1)) || regexp_replace(regexp_replace(regexp_extract(url, '^[^:]+://[^/]*(.*)$', 1), '[?#].*$', ''), '/+$', '') AS url FROM pages")
def normalize_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", S.normalize_url(F.col("url")).alias("url"))


@query("articles_from_pages", r"SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, CASE WHEN page_id % 3 = 0 THEN 'source ' || page_id % 9 ELSE lower(regexp_extract(url, '^[^:]+://([^/?#:]*)', 1)) END AS source_name, CAST(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER) AS DATE) AS day FROM pages WHERE trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) <> '' AND page_id % 25 <> 7")
def articles_from_pages(spark, sf_dir):
    """Round trip: pages as JSON payloads of articles, their dates under several names and in several forms, some unreadable."""
    k = F.col("page_id")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 28).cast("int"))
    title, bad = F.regexp_extract("html", "<title>([^<]*)</title>", 1), k % 25 == 7
    fields = F.struct(
        "url", title.alias("title"), F.when(k % 3 == 0, F.concat(F.lit("source "), (k % 9).cast("string"))).alias("domain"), F.lit("soon").alias("seendate"),
        F.when((k % 2 == 0) & ~bad, F.date_format(day, "yyyyMMdd")).alias("datetime"), F.when((k % 2 == 1) & ~bad, F.date_format(day, "yyyy-MM-dd")).alias("date"), F.when(~bad, "2001-01-01T00:00:00Z").alias("publishedAt"),
    )
    body = F.concat(F.when(k % 2 == 0, '{"articles": [').otherwise('{"articles": 1, "documents": ['), F.to_json(fields), F.lit("]}"))
    found = A.parse_article_json(table(spark, sf_dir, "pages").select("page_id", body.alias("payload")), ["page_id"], "payload").filter("not malformed")
    return found.select("page_id", "title", "source_name", F.to_date("published_at").alias("day"))


@query("trade_rows", "SELECT l_orderkey, l_linenumber, round(l_extendedprice / nullif(CASE WHEN l_orderkey % 13 = 0 THEN 0 ELSE l_quantity END, 0), 8) AS unit_value, strftime(l_shipdate, '%Y%m') AS period, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL")
def trade_rows(spark, sf_dir):
    """Round trip: each order's lines as a JSON payload, fields under several names, with rows that are no objects."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select("o_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    even = F.col("l_orderkey") % 2 == 0
    q = F.when(F.col("l_orderkey") % 13 == 0, 0.0).otherwise(F.col("l_quantity"))
    fields = F.struct(
        F.when(even, F.col("l_orderkey")).alias("reporterCode"), F.when(~even, F.col("l_orderkey").cast("string")).alias("reporter"), F.col("l_linenumber").alias("lineNumber"),
        F.when(even, F.date_format("l_shipdate", "yyyyMM")).otherwise(F.date_format("l_shipdate", "yyyy-MM")).alias("period"),
        F.when(even, q).alias("qty"), F.when(~even, q).alias("primaryQuantity"), F.when(even, F.col("l_extendedprice")).alias("primaryValue"), F.when(~even, F.col("l_extendedprice")).alias("cifvalue"),
    )
    lines = F.array_join(F.collect_list(F.to_json(fields)), ",")
    docs = rows.groupBy("l_orderkey").agg(F.concat(F.when(F.first(even), '{"data": [').otherwise('{"count": 2, "results": ["n/a", 7, {"period": "1996-13"}, '), lines, F.lit("]}")).alias("payload"))
    found = A.parse_trade_json(docs, [], "payload", {"reporter": ("reporterCode", "reporter"), "line": ("lineNumber",)}).filter("not malformed")
    return found.groupBy(F.col("reporter").cast("long").alias("l_orderkey"), F.col("line").cast("int").alias("l_linenumber"), F.round("unit_value", 8).alias("unit_value"), F.date_format("period", "yyyyMM").alias("period")).agg(F.count("*").alias("n"))


#: Metric names and codes, countries and years of the balance round trip.
BALANCE_METRICS = {"1-urgent": "urgent", "2-high": "high", "3-medium": "medium"}
BALANCE_SCOPE, BALANCE_YEARS = tuple(f'Rep. of "NATION_{n}", The' for n in (0, 1, 2, 7)), (1996, 1999)


@query("balance_rows", f"""WITH {BALANCE_SQL}, r AS (SELECT 'Rep. of "' || country || '", The' AS country, CASE lower(metric) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in BALANCE_METRICS.items())} END AS metric, marketing_year, CASE WHEN report_month = 7 THEN 11 ELSE report_month END AS report_month, CASE report_month % 3 WHEN 0 THEN 'projection' WHEN 1 THEN 'estimate' ELSE 'unknown' END AS estimate_type,
  CASE WHEN NOT (report_month = 2 AND marketing_year = 1997) THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS value FROM balance)
SELECT country, metric, CAST(marketing_year AS INTEGER) AS marketing_year, CAST(report_month AS INTEGER) AS report_month, estimate_type, value, make_date(marketing_year, 1, 1) AS year_start, make_date(marketing_year, 12, 31) AS year_end, CASE WHEN value IS NULL THEN 'malformed' WHEN metric IS NULL OR country NOT IN {BALANCE_SCOPE} OR marketing_year NOT BETWEEN 1996 AND 1999 THEN 'skipped' ELSE 'parsed' END AS route FROM r
UNION ALL SELECT NULL, NULL, NULL, 11, 'unknown', NULL, NULL, NULL, 'malformed' FROM range(3)""")
def balance_rows(spark, sf_dir):
    """Round trip: balances as one payload a country and year, CSV with quoted names and numbers or JSON, some values no numbers, some months not given; and three payloads that can't be read."""
    b = balance(spark, sf_dir)
    bad = (F.col("report_month") == 2) & (F.col("marketing_year") == 1997)
    value = F.when(bad, "not-a-number").otherwise(F.format_number(F.col("value").cast("decimal(18,2)"), 2))
    month = F.when(F.col("report_month") != 7, F.col("report_month").cast("string")).otherwise("")
    name = F.concat(F.lit('Rep. of "'), "country", F.lit('", The'))
    estimate = F.when(F.col("report_month") % 3 == 0, "Projected").when(F.col("report_month") % 3 == 1, " estimate").otherwise("guess")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", quoted(name), "metric", F.col("marketing_year").cast("string"), month, quoted(value), estimate, F.lit('"a\nnote, ""quoted"""'))
    row = F.to_json(F.struct(name.alias("country"), F.col("metric").alias("attribute"), F.col("marketing_year").alias("market_year"), month.alias("month"), estimate.alias("estimate_type"), value.alias("amount")))
    head = F.when(F.col("marketing_year") % 3 == 0, "Country Name,Attribute-Description,Market Year,Month,Value,Estimate Type,Notes\n").otherwise("Country_Name,Attribute_Description,Market_Year,Month,Value,Estimate_Type,Notes\r\n")
    grouped = b.select("country", "marketing_year", line.alias("line"), row.alias("row"), head.alias("head")).groupBy("country", "marketing_year")
    docs = grouped.agg(F.when(F.col("marketing_year") % 3 == 1, F.concat(F.lit('{"rows": ['), F.array_join(F.collect_list("row"), ","), F.lit("]}"))).otherwise(F.concat(F.first("head"), F.array_join(F.collect_list("line"), "\r\n"))).alias("payload"))
    lost = spark.range(3).select(F.when(F.col("id") == 0, "no header at all").when(F.col("id") == 1, 'Country Name,Value\n"open,1').otherwise('{"rows": 7}').alias("payload"))
    return A.parse_balances(docs.select("payload").unionByName(lost), [], "payload", BALANCE_METRICS, BALANCE_SCOPE, BALANCE_YEARS, F.lit("2000-11-05").cast("date"))


@query("parse_quotes", "SELECT event_id, CASE WHEN event_type <> 'error' AND event_id % 11 <> 0 THEN CAST(CAST(value AS DECIMAL(18,6)) AS DOUBLE) END AS price FROM events")
def parse_quotes(spark, sf_dir):
    """Round trip: prices as JSON or CSV in a script's variable, by instrument; one has no mapping, some are no numbers."""
    v = F.when(F.col("event_id") % 11 == 0, "x").otherwise(F.col("value").cast("decimal(18,6)").cast("string"))
    nested = F.concat(F.lit('var q = {"data": {"last": ["'), v, F.lit('"]}};'))
    listed = F.concat(F.lit('var hq_str = "name,0,'), v, F.lit(',1";'))
    body = F.when(F.col("event_type").isin("click", "view"), nested).otherwise(listed)
    paths = {"click": "$.data.last[0]", "view": "$.data.last[0]", "purchase": 2, "signup": 2}
    quotes = A.parse_quotes(table(spark, sf_dir, "events").select("event_id", "event_type", body.alias("payload")), "event_type", "payload", paths)
    return quotes.select("event_id", F.col("price").cast("double"))


@query("canonical_decimal", r"SELECT l_orderkey, l_linenumber, regexp_replace(regexp_replace(CAST(CAST(l_discount AS DECIMAL(18,8)) AS VARCHAR), '(\.[0-9]*?)0+$', '\1'), '\.$', '') AS d, count(*) AS n FROM lineitem GROUP BY ALL")
def canonical_decimal(spark, sf_dir):
    d = S.canonical_decimal(F.col("l_discount").cast("decimal(18,8)"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", d.alias("d")).agg(F.count("*").alias("n"))


@query("quantize", "SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(0.125 AS DECIMAL(4,3)), 2) AS DOUBLE) AS p2, CAST(round(CAST(-l_quantity AS DECIMAL(12,2)) * CAST(0.0625 AS DECIMAL(5,4)), 1) AS DOUBLE) AS q1, count(*) AS n FROM lineitem GROUP BY ALL")
def quantize(spark, sf_dir):
    """Decimals rounded half away from zero to the places of their field, negative ones too."""
    price = F.col("l_extendedprice").cast("decimal(14,2)") * F.lit("0.125").cast("decimal(4,3)")
    quantity = (-F.col("l_quantity")).cast("decimal(12,2)") * F.lit("0.0625").cast("decimal(5,4)")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", S.quantize(price, 2).alias("p2"), S.quantize(quantity, 1).alias("q1")).agg(F.count("*").alias("n"))


@query("lenient_casts", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS v FROM orders")
def lenient_casts(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 9 == 0, "N/A").otherwise(F.concat(F.lit('"'), F.format_number("o_totalprice", 2), F.lit('" ')))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.lenient_decimal(text).cast("double").alias("v"))


@query("composite_id", "SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN 'id-' || o_orderkey END, concat_ws('|', o_custkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d'))) AS id FROM orders")
def composite_id(spark, sf_dir):
    explicit = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("id-"), F.col("o_orderkey").cast("string")))
    parts = (F.col("o_custkey").cast("string"), F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.composite_id(explicit, *parts).alias("id"))


@query("normalize_codes", "SELECT p_type, CASE replace(replace(lower(trim(p_type)), '-', '_'), ' ', '_') WHEN 'economy' THEN 'eco' WHEN 'promo' THEN 'promotion' ELSE replace(replace(lower(trim(p_type)), '-', '_'), ' ', '_') END AS code, count(*) AS n FROM part GROUP BY 1, 2")
def normalize_codes(spark, sf_dir):
    code = F.translate(F.lower(F.trim("p_type")), "- ", "__")
    alias = F.create_map(*map(F.lit, ("economy", "eco", "promo", "promotion")))
    return table(spark, sf_dir, "part").groupBy("p_type", F.coalesce(F.try_element_at(alias, code), code).alias("code")).agg(F.count("*").alias("n"))


@query("normalize_enums", "SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'unknown' END AS status, count(*) AS n FROM orders GROUP BY 1, 2")
def normalize_enums(spark, sf_dir):
    names = F.create_map(*map(F.lit, ("F", "final", "O", "open")))
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus", F.coalesce(F.try_element_at(names, F.col("o_orderstatus")), F.lit("unknown")).alias("status")).agg(F.count("*").alias("n"))


@query("resolve_identity", "SELECT n_nationkey, CASE WHEN n_nationkey % 6 = 0 THEN 'NATION_1' WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name END AS resolved, n_nationkey % 6 = 0 AND n_nationkey <> 1 AS mismatch FROM nation")
def resolve_identity(spark, sf_dir):
    """A code and a name are resolved apart; the code wins where they differ."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    rows = n.select(k, F.when(k % 6 == 0, F.lit(1)).when(k % 5 != 0, k).alias("code"), F.when((k % 6 == 0) | (k % 5 != 0), F.lower("n_name")).alias("name"))
    by_code = F.broadcast(n.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("x")))
    by_name = F.broadcast(n.select(F.lower("n_name").alias("name"), F.col("n_name").alias("y")))
    both = rows.join(by_code, "code", "left").join(by_name, "name", "left")
    return both.select("n_nationkey", F.coalesce("x", "y").alias("resolved"), F.coalesce(F.col("x") != F.col("y"), F.lit(False)).alias("mismatch"))


@query("missing_flags", "SELECT o_orderkey, nullif(concat_ws(',', CASE WHEN o_orderkey % 7 = 0 THEN 'no_status' END, CASE WHEN o_totalprice < 50000 THEN 'small' END), '') AS flags FROM orders")
def missing_flags(spark, sf_dir):
    flags = {"no_status": F.col("o_orderkey") % 7 == 0, "small": F.col("o_totalprice") < 50000}
    return table(spark, sf_dir, "orders").select("o_orderkey", S.true_flags(flags).alias("flags"))


@query("ordered_dedupe", "SELECT o_orderkey, CASE WHEN o_orderstatus = o_orderpriority[3:3] THEN o_orderstatus ELSE o_orderstatus || ',' || o_orderpriority[3:3] END AS flags FROM orders")
def ordered_dedupe(spark, sf_dir):
    flags = F.array("o_orderstatus", F.substring("o_orderpriority", 3, 1), "o_orderstatus")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.array_distinct(flags), ",").alias("flags"))


@query("tolerant_diff", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE round(l_extendedprice, 2) <> round(l_extendedprice + CASE WHEN l_orderkey % 10 = 0 THEN 0.01 ELSE 0.0000000001 END, 2) GROUP BY 1")
def tolerant_diff(spark, sf_dir):
    other = F.col("l_extendedprice") + F.when(F.col("l_orderkey") % 10 == 0, 0.01).otherwise(0.0000000001)
    return table(spark, sf_dir, "lineitem").filter(~S.values_equal(F.col("l_extendedprice"), other, 2)).groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("features_json", """SELECT o_orderkey, '{"day":"' || strftime(o_orderdate, '%Y-%m-%d') || '","price":"' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '","status":"' || o_orderstatus || '"}' AS j FROM orders""")
def features_json(spark, sf_dir):
    fields = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"), F.col("o_orderstatus").alias("status"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(fields).alias("j"))


@query("select_entities", "SELECT DISTINCT c_mktsegment AS segment FROM customer WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '1995-03-01')")
def select_entities(spark, sf_dir):
    seen = table(spark, sf_dir, "orders").filter("o_orderdate < timestamp_ntz '1995-03-01'").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    all_ = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment")).distinct()
    return all_.join(seen.select(F.col("c_mktsegment").alias("segment")), "segment", "left_semi")


# Families of market segments under older names, and groups of several.
_ALIASES = {"cars": "AUTOMOBILE"}
_GROUPS = {"home": ("FURNITURE", "HOUSEHOLD"), "all": None}


@query("family_entities", "SELECT 'cars' AS asked, c_custkey FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'AUTOMOBILE' UNION ALL SELECT 'home', c_custkey FROM customer WHERE c_acctbal > 0 AND c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') UNION ALL SELECT 'all', c_custkey FROM customer WHERE c_acctbal > 0 UNION ALL SELECT 'BUILDING', c_custkey FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'")
def family_entities(spark, sf_dir):
    """Customers with a positive balance by what is asked for: an alias, a group, all, or a segment."""
    seg = F.col("c_mktsegment")
    customers = table(spark, sf_dir, "customer").select("c_custkey", seg.alias("code"), seg.alias("family"), (F.col("c_acctbal") > 0).alias("active"))
    asked = (C.select_entities(customers, family=f, aliases=_ALIASES, groups=_GROUPS).select(F.lit(f).alias("asked"), "c_custkey") for f in ("cars", "home", "all", "BUILDING"))
    return reduce(DataFrame.unionByName, asked)
