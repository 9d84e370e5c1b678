"""Queries over idempotent ingest, quality rules, monitoring and export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import ingest as I
from tidemark.operators import pointintime as P
from tidemark.plans.registry import query
from tidemark.session import table

EXISTING_SQL = "existing AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 <> 0)"
INCOMING_SQL = "incoming AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN o_orderkey % 5 = 0 THEN 100 ELSE 0 END AS cents, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders)"
_PLAIN = r"regexp_replace(regexp_replace(CAST(CAST({} AS DECIMAL(38,8)) AS VARCHAR), '(\.[0-9]*?)0+$', '\1'), '\.$', '')"
HASH_SQL = f"sha256(CAST(to_json({{'about': {{'customer': c, 'note': CASE WHEN k % 4 <> 0 THEN s END}}, 'k': k, 'price': {_PLAIN.format('cents / 100.0')}, 's': s}}) AS VARCHAR))"


def orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.col("o_orderstatus").alias("s"))


def hashed(rows: DataFrame) -> DataFrame:
    """With the digest of each row's canonical JSON: its price, written with or without zeros, and nested fields, some null."""
    price = F.when(F.col("k") % 2 == 0, (F.col("cents") / 100).cast("decimal(18,2)").cast("string")).otherwise((F.col("cents") / 100).cast("decimal(18,6)").cast("string"))
    about = {"note": F.when(F.col("k") % 4 != 0, F.col("s")), "customer": F.col("c")}
    return rows.withColumn("h", S.record_hash({"s": F.col("s"), "price": S.canonical_decimal(price), "k": F.col("k"), "about": about}))


def sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """What is stored, and a later delivery with new and changed rows."""
    o = orders(spark, sf_dir)
    cents = F.col("cents") + F.when(F.col("k") % 5 == 0, 100).otherwise(0)
    incoming = o.withColumn("cents", cents).withColumn("s", F.when(F.col("k") % 11 == 0, "X").otherwise(F.col("s")))
    return hashed(o.filter("k % 3 <> 0")), hashed(incoming)


@query("record_hash", f"WITH {INCOMING_SQL} SELECT k, {HASH_SQL} AS h FROM incoming")
def record_hash(spark, sf_dir):
    return sides(spark, sf_dir)[1].select("k", "h")


DELIVERIES_SQL = f"""{EXISTING_SQL}, {INCOMING_SQL}, deliveries AS (SELECT 1 AS n, * FROM incoming UNION ALL SELECT 2, k, c, cents + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END, s FROM incoming WHERE k % 2 = 0),
base AS (SELECT k, first(cents ORDER BY n, cents, s) AS cents, first(s ORDER BY n, cents, s) AS s, min(n) AS n FROM (SELECT 0 AS n, k, c, cents, s FROM existing UNION ALL SELECT n, k, c, cents, s FROM deliveries) GROUP BY k)"""


def deliveries(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """What is stored, and two deliveries: all rows, some changed, and a part of them again."""
    existing, first = sides(spark, sf_dir)
    again = hashed(first.drop("h").filter("k % 2 = 0").withColumn("cents", F.col("cents") + F.when(F.col("k") % 7 == 0, 1).otherwise(0)))
    return existing, first.withColumn("n", F.lit(1)).unionByName(again.withColumn("n", F.lit(2)))


@query("merge_actions", f"""WITH {DELIVERIES_SQL}
SELECT d.n, d.k, CASE WHEN b.n = d.n THEN 'insert' WHEN b.cents = d.cents AND b.s = d.s THEN 'skip' ELSE 'conflict' END AS action FROM deliveries d JOIN base b USING (k)""")
def merge_actions(spark, sf_dir):
    """Two deliveries in order against what is stored: of a new key the first is inserted, the second skipped or a conflict."""
    existing, rows = deliveries(spark, sf_dir)
    return I.merge_actions(existing, rows, ["k"], "h", ["n"]).select("n", "k", "action")


@query("insert_if_absent", f"WITH {EXISTING_SQL}, {INCOMING_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY c, s ORDER BY k) AS rn FROM incoming) SELECT k, c, s FROM f WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.c = f.c AND e.s = f.s)")
def insert_if_absent(spark, sf_dir):
    existing, incoming = sides(spark, sf_dir)
    return I.insert_if_absent(existing, incoming, ["c", "s"], ["k"]).select("k", "c", "s")


@query("identity_match", f"WITH {EXISTING_SQL}, {INCOMING_SQL} SELECT i.k, e.k AS found FROM incoming i LEFT JOIN existing e ON e.k = i.k AND nullif(e.k % 7, 0) IS NOT DISTINCT FROM nullif(i.k % 7, 0)")
def identity_match(spark, sf_dir):
    part = F.nullif(F.col("k") % 7, F.lit(0))
    existing, incoming = (x.withColumn("part", part).withColumn("key", F.col("k")) for x in sides(spark, sf_dir))
    return I.identity_match(incoming, existing, ["key", "part"], "k").select("k", "found")


@query("two_tier_match", """WITH x AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url END AS ext, sha256(html) AS h FROM pages), e AS (SELECT page_id, ext, h FROM x WHERE page_id % 2 = 0)
SELECT x.page_id, coalesce((SELECT min(page_id) FROM e WHERE e.ext = x.ext), (SELECT min(page_id) FROM e WHERE e.h = x.h)) AS found FROM x""")
def two_tier_match(spark, sf_dir):
    """By external id where there is one, else by content; two joins, the first wins."""
    x = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, F.col("url")).alias("ext"), F.sha2("html", 256).alias("h"))
    e = x.filter("page_id % 2 = 0")
    by_ext = e.filter("ext is not null").groupBy("ext").agg(F.min("page_id").alias("a"))
    by_hash = e.groupBy("h").agg(F.min("page_id").alias("b"))
    return x.join(by_ext, "ext", "left").join(by_hash, "h", "left").select("page_id", F.coalesce("a", "b").alias("found"))


BAR_SQL = """bars AS (SELECT c_mktsegment AS seg, CAST(o_orderdate AS DATE) AS day, arg_min(cents, k) AS open, arg_max(cents, k) AS close, max(cents) AS high, min(cents) AS low FROM (SELECT o_orderkey AS k, o_custkey, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
newest AS (SELECT seg, max(day) AS day FROM bars GROUP BY 1), fresh AS (SELECT b.*, b.close + CASE WHEN b.day = n.day OR b.day = DATE '1999-03-01' THEN 5 ELSE 0 END AS close2 FROM bars b JOIN newest n USING (seg))"""


def day_bars(spark, sf_dir) -> DataFrame:
    o = orders(spark, sf_dir).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("day")), "k")
    rows = o.join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"), F.col("c_mktsegment").alias("seg")), "c")
    return rows.groupBy("seg", "day").agg(F.min_by("cents", "k").alias("open"), F.max_by("cents", "k").alias("close"), F.max("cents").alias("high"), F.min("cents").alias("low"))


def bar_hash():
    return S.record_hash({x: F.col(x) for x in ("open", "close", "high", "low")})


def bar_sides(spark, sf_dir):
    b = day_bars(spark, sf_dir)
    newest = b.groupBy("seg").agg(F.max("day").alias("newest"))
    changed = (F.col("day") == F.col("newest")) | (F.col("day") == F.lit("1999-03-01").cast("date"))
    fresh = b.join(newest, "seg").withColumn("close", F.col("close") + F.when(changed, 5).otherwise(0)).drop("newest")
    return b.withColumn("h", bar_hash()), fresh.withColumn("h", bar_hash())


@query("bar_revisions", f"""WITH {BAR_SQL}, f AS (SELECT 1 AS n, seg, day, close2 FROM fresh UNION ALL SELECT 2, seg, day, close FROM fresh UNION ALL SELECT 2, seg, day + INTERVAL 400 DAY, close FROM fresh WHERE day IN (SELECT day FROM newest) UNION ALL SELECT 3, seg, day, close2 + 1 FROM fresh UNION ALL SELECT 3, seg, day + INTERVAL 400 DAY, close + 1 FROM fresh WHERE day IN (SELECT day FROM newest))
SELECT f.n, f.seg, CAST(f.day AS DATE) AS day, CASE WHEN e.close IS NULL THEN CASE WHEN f.n = 2 THEN 'insert' WHEN f.day = l.day THEN 'update' ELSE 'reject' END WHEN f.n = 1 THEN CASE WHEN e.close = f.close2 THEN 'skip' WHEN f.day = w.day THEN 'update' ELSE 'reject' END
  WHEN f.n = 2 THEN CASE WHEN f.day = w.day THEN 'update' ELSE 'skip' END ELSE 'reject' END AS action
FROM f JOIN newest w ON w.seg = f.seg LEFT JOIN bars e ON e.seg = f.seg AND e.day = f.day JOIN (SELECT seg, max(day) AS day FROM f WHERE n = 2 GROUP BY 1) l ON l.seg = f.seg""")
def bar_revisions(spark, sf_dir):
    """Three deliveries: changed bars, then the old ones again and later bars, then changes of all, when only the latest bars may still move."""
    old, first = bar_sides(spark, sf_dir)
    newest = old.select("day", "seg").groupBy("seg").agg(F.max("day").alias("day")).select("day").distinct()
    later = old.join(newest, "day", "left_semi").withColumn("day", F.date_add("day", 400))
    more = lambda x, d: x.withColumn("close", F.col("close") + d)
    parts = [(1, first), (2, old), (2, later), (3, more(first, 1)), (3, more(later, 1))]
    rows = reduce(DataFrame.unionByName, (x.withColumn("n", F.lit(n)) for n, x in parts)).withColumn("h", bar_hash())
    return I.bar_revisions(old, rows, ["seg"], "day", "h", ["n"]).select("n", "seg", "day", "action")


@query("revision_number", f"WITH {BAR_SQL}, stored AS (SELECT seg, CAST(count(*) AS INTEGER) AS last FROM bars WHERE day < DATE '1993-01-01' AND seg <> 'BUILDING' GROUP BY 1) SELECT seg, day, CAST(coalesce(last, 0) + row_number() OVER (PARTITION BY seg ORDER BY day) AS INTEGER) AS revision FROM fresh LEFT JOIN stored USING (seg) WHERE close <> close2")
def revision_number(spark, sf_dir):
    """Changes of this delivery numbered on from the revisions that are stored; one segment has none yet."""
    old, new = bar_sides(spark, sf_dir)
    changed = I.merge_actions(old, new, ["seg", "day"], "h").filter("action = 'conflict'")
    early = old.filter("day < date '1993-01-01' and seg <> 'BUILDING'")
    stored = early.select("seg", F.row_number().over(Window.partitionBy("seg").orderBy("day")).alias("revision"))
    return I.revision_numbers(changed.select("seg", "day"), stored, ["seg"], ["day"])


@query("field_diff", f"""WITH {EXISTING_SQL}, {INCOMING_SQL}, x AS (SELECT e.k, nullif(e.s, 'P') AS s, i.s AS s2, CASE WHEN e.k % 20 <> 0 THEN e.cents END AS p, i.cents AS p2 FROM existing e JOIN incoming i USING (k)),
y AS (SELECT k, CASE WHEN p IS DISTINCT FROM p2 THEN '"price":{{"old":' || coalesce('"' || {_PLAIN.format('p / 100.0')} || '"', 'null') || ',"new":"' || {_PLAIN.format('p2 / 100.0')} || '"' || coalesce(',"diff_abs":"' || {_PLAIN.format('(p2 - p) / 100.0')} || '","diff_pct":"' || {_PLAIN.format('round((p2 - p) / p, 8)')} || '"', '') || '}}' END AS a,
  CASE WHEN s IS DISTINCT FROM s2 THEN '"s":{{"old":' || coalesce('"' || s || '"', 'null') || ',"new":"' || s2 || '"}}' END AS b FROM x)
SELECT k, concat_ws(',', CASE WHEN a IS NOT NULL THEN 'price' END, CASE WHEN b IS NOT NULL THEN 's' END) AS changed, '{{' || concat_ws(',', a, b) || '}}' AS diff FROM y WHERE a IS NOT NULL OR b IS NOT NULL""")
def field_diff(spark, sf_dir):
    """Old and new values of changed prices and states; some old ones are null."""
    price = (F.col("cents") / 100).cast("decimal(18,2)")
    existing, incoming = (x.select("k", "s", price.alias("price")) for x in sides(spark, sf_dir))
    existing = existing.withColumn("s", F.nullif(F.col("s"), F.lit("P"))).withColumn("price", F.when(F.col("k") % 20 != 0, F.col("price")))
    return I.field_diff(existing, incoming, ["k"], ["price", "s"])


@query("feature_upsert", f"WITH {EXISTING_SQL}, {INCOMING_SQL} SELECT i.k, CASE WHEN e.k IS NULL THEN 'created' WHEN e.cents = i.cents THEN 'skipped' ELSE 'updated' END AS action FROM incoming i LEFT JOIN existing e ON e.k = i.k")
def feature_upsert(spark, sf_dir):
    existing, incoming = (x.select("k", "cents") for x in sides(spark, sf_dir))
    return I.feature_upsert(existing, incoming, ["k"], S.values_equal(F.col("x.cents"), F.col("y.cents")))


@query("build_counters", f"WITH {EXISTING_SQL}, {INCOMING_SQL} SELECT CASE WHEN e.k IS NULL THEN 'created' WHEN e.cents = i.cents THEN 'skipped' ELSE 'updated' END AS action, count(*) AS n FROM incoming i LEFT JOIN existing e ON e.k = i.k GROUP BY 1")
def build_counters(spark, sf_dir):
    return feature_upsert(spark, sf_dir).groupBy("action").agg(F.count("*").alias("n"))


@query("run_summary", f"""WITH {DELIVERIES_SQL}, a AS (SELECT d.k % 12 AS run, CASE WHEN d.k % 12 = 5 THEN 'malformed' WHEN d.k % 12 = 6 AND d.k % 5 = 0 THEN 'unmapped' WHEN b.n = d.n THEN 'insert' WHEN b.cents = d.cents AND b.s = d.s THEN 'skip' ELSE 'conflict' END AS action FROM deliveries d JOIN base b USING (k) UNION ALL SELECT 7, 'error' UNION ALL SELECT 99, 'error'),
c AS (SELECT run, count(*) FILTER (action <> 'error') AS found, count(*) FILTER (action = 'insert') AS written, count(*) FILTER (action = 'skip') AS skipped, count(*) FILTER (action = 'conflict') AS conflicts, count(*) FILTER (action = 'malformed') AS malformed, count(*) FILTER (action = 'unmapped') AS unmapped, count(*) FILTER (action = 'error') AS errors FROM a GROUP BY 1)
SELECT *, CASE WHEN conflicts + malformed + unmapped + errors = 0 THEN 'success' WHEN written + skipped + conflicts > 0 THEN 'partial_success' ELSE 'error' END AS status FROM c""")
def run_summary(spark, sf_dir):
    """Twelve runs by key, of which one has malformed rows only, one unmapped rows, one an error besides; and one that is an error alone."""
    run = (F.col("k") % 12).alias("run")
    action = F.when(run == 5, "malformed").when((run == 6) & (F.col("k") % 5 == 0), "unmapped").otherwise(F.col("action"))
    failed = spark.range(2).select(F.when(F.col("id") == 0, 7).otherwise(99).cast("long").alias("run"), F.lit("error").alias("action"))
    return I.run_summary(merge_actions(spark, sf_dir).select(run, action.alias("action")).unionByName(failed), "run")


@query("quarantine", "SELECT l_returnflag, CASE WHEN l_orderkey % 50 = 0 THEN 'malformed' WHEN l_linestatus = 'F' THEN 'skipped' ELSE 'parsed' END AS route, count(*) AS n FROM lineitem GROUP BY 1, 2")
def quarantine(spark, sf_dir):
    bad = F.when(F.col("l_orderkey") % 50 == 0, "n/a").otherwise(F.col("l_quantity").cast("string"))
    rows = table(spark, sf_dir, "lineitem").withColumn("q", S.lenient_decimal(bad))
    return I.route(rows, F.col("q").isNull(), F.col("l_linestatus") == "F").groupBy("l_returnflag", "route").agg(F.count("*").alias("n"))


def lineitem_checks(spark, sf_dir) -> DataFrame:
    rules = {
        "quantity_positive": (F.nullif(F.col("l_orderkey") % 7, F.lit(0)).isNotNull() & (F.col("l_quantity") > 0), "error"),
        "discount_in_range": (F.col("l_discount").between(0, 0.05), "warning"),
        "tax_known": (F.col("l_tax") > 0, "info"),
    }
    return I.row_checks(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("checked_on")], rules)


CHECKS_SQL = """checks AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS checked_on, 'quantity_positive' AS check_name, CASE WHEN l_orderkey % 7 <> 0 AND l_quantity > 0 THEN 'pass' ELSE 'fail' END AS status, 'error' AS severity FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE), 'discount_in_range', CASE WHEN l_discount BETWEEN 0 AND 0.05 THEN 'pass' ELSE 'fail' END, 'warning' FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE), 'tax_known', CASE WHEN l_tax > 0 THEN 'pass' ELSE 'fail' END, 'info' FROM lineitem)"""


@query("row_checks", f"WITH {CHECKS_SQL} SELECT check_name, status, severity, count(*) AS n FROM checks GROUP BY 1, 2, 3")
def row_checks(spark, sf_dir):
    return lineitem_checks(spark, sf_dir).groupBy("check_name", "status", "severity").agg(F.count("*").alias("n"))


@query("checks_long", f"WITH {CHECKS_SQL} SELECT l_orderkey, l_linenumber, check_name, status, count(*) AS n FROM checks GROUP BY 1, 2, 3, 4")
def checks_long(spark, sf_dir):
    return lineitem_checks(spark, sf_dir).groupBy("l_orderkey", "l_linenumber", "check_name", "status").agg(F.count("*").alias("n"))


@query("problem_checks", f"WITH {CHECKS_SQL} SELECT year(checked_on) AS y, check_name, count(*) AS n FROM checks WHERE status NOT IN ('pass', 'skip', 'info') GROUP BY 1, 2")
def problem_checks(spark, sf_dir):
    return I.problem_checks(lineitem_checks(spark, sf_dir)).groupBy(F.year("checked_on").alias("y"), "check_name").agg(F.count("*").alias("n"))


@query("status_counts", f"WITH {CHECKS_SQL} SELECT severity, status, count(*) AS n FROM checks GROUP BY 1, 2")
def status_counts(spark, sf_dir):
    return lineitem_checks(spark, sf_dir).groupBy("severity", "status").agg(F.count("*").alias("n"))


CLASS_SQL = "CASE WHEN check_name = 'tax_known' THEN 'expected_diagnostic' WHEN checked_on BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' THEN 'known_historical' ELSE 'active' END"


@query("classify_checks", f"WITH {CHECKS_SQL} SELECT check_name, {CLASS_SQL} AS class, count(*) AS n FROM checks WHERE status = 'fail' GROUP BY 1, 2")
def classify_checks(spark, sf_dir):
    return classified(spark, sf_dir).groupBy("check_name", "class").agg(F.count("*").alias("n"))


def classified(spark, sf_dir) -> DataFrame:
    past = F.col("checked_on").between(F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date"))
    kind = F.when(F.col("check_name") == "tax_known", "expected_diagnostic").when(past, "known_historical").otherwise("active")
    return I.problem_checks(lineitem_checks(spark, sf_dir)).withColumn("class", kind)


@query("top_recent", f"WITH {CHECKS_SQL}, d AS (SELECT DISTINCT {CLASS_SQL} AS class, checked_on, l_orderkey, l_linenumber, check_name FROM checks WHERE status = 'fail') SELECT class, checked_on, l_orderkey, l_linenumber, check_name FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY checked_on DESC, l_orderkey, l_linenumber, check_name) AS rn FROM d) WHERE rn <= 10")
def top_recent(spark, sf_dir):
    rows = classified(spark, sf_dir).select("class", "checked_on", "l_orderkey", "l_linenumber", "check_name").distinct()
    order = [F.desc("checked_on"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("check_name")]
    return P.last_n_per_key(rows, ["class"], order, 10).drop("rn")


@query("ohlc_check", f"WITH {BAR_SQL} SELECT CASE WHEN b.high >= greatest(f.open, f.close2, f.low) AND f.low <= least(f.open, f.close2, f.high) THEN 'pass' ELSE 'fail' END AS status, count(*) AS n FROM fresh f JOIN bars b USING (seg, day) GROUP BY 1")
def ohlc_check(spark, sf_dir):
    fresh = bar_sides(spark, sf_dir)[1]
    good = (F.col("high") >= F.greatest("open", "close", "low")) & (F.col("low") <= F.least("open", "close", "high"))
    return I.row_checks(fresh, ["seg", "day"], {"ohlc": (good, "error")}).groupBy("status").agg(F.count("*").alias("n"))


@query("size_anomaly", "WITH d AS (SELECT doc_id, source, n_chars, avg(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS m FROM documents) SELECT doc_id, CASE WHEN m IS NULL THEN 'skip' WHEN n_chars > 3 * m OR n_chars * 3 < m THEN 'fail' ELSE 'pass' END AS status FROM d")
def size_anomaly(spark, sf_dir):
    return I.size_anomaly(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), ["source"], "doc_id", "n_chars").select("doc_id", "status")


@query("missing_days", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity > 45)")
def missing_days(spark, sf_dir):
    need = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    have = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.to_date("l_shipdate").alias("day"))
    return I.anti_gaps(need, have, ["day"])


@query("stale_keys", "SELECT user_id, CAST(max(ts) AS DATE) AS last_day FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'")
def stale_keys(spark, sf_dir):
    stale = I.stale_keys(table(spark, sf_dir, "events"), "user_id", "ts", F.expr("timestamp_ntz '2024-01-30 12:00:00'"))
    return stale.select("user_id", F.to_date("last_seen").alias("last_day"))


@query("latest_run", "SELECT event_type, max(ts) AS last_ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def latest_run(spark, sf_dir):
    return P.latest_per_key(table(spark, sf_dir, "events"), ["event_type"], ["ts", "event_id"], []).select("event_type", F.col("ts").alias("last_ts"), "event_id")


@query("bounded_scan", "SELECT doc_id, lang FROM documents WHERE lang = 'fr' ORDER BY n_chars DESC, doc_id LIMIT 25")
def bounded_scan(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("lang = 'fr'").orderBy(F.desc("n_chars"), "doc_id").limit(25).select("doc_id", "lang")


@query("last_n", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 3")
def last_n(spark, sf_dir):
    return P.last_n_per_key(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 3).select("user_id", "event_id")


@query("leakage_guard", "SELECT l_returnflag, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate > o_orderdate + INTERVAL 30 DAY GROUP BY 1")
def leakage_guard(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    rows = rows.withColumn("as_of", F.expr("o_orderdate + interval 30 day"))
    return I.leaks(rows, "l_shipdate", "as_of").groupBy("l_returnflag").agg(F.count("*").alias("n"))


_COVERED = {
    "orders": ("CAST(o_orderdate AS DATE)", "o_orderkey", ("nullif(o_orderkey % 7, 0)", "o_orderstatus"), "2001-08-01"),
    "lineitem": ("CAST(l_shipdate AS DATE)", "l_orderkey", ("nullif(l_orderkey % 5, 0)", "nullif(l_linenumber % 2, 0)"), "2002-01-01"),
    "events": ("CAST(ts AS DATE)", "user_id", ("nullif(event_id % 3, 0)", "nullif(event_id % 9, 0)"), "2024-01-30"),
}


@query("table_coverage", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n, count(DISTINCT {k}) AS keys, min({d}) AS first_day, max({d}) AS last_day, max({d}) >= DATE '{c}' AS fresh, count(*) FILTER ({v[0]} IS NOT NULL AND {v[1]} IS NOT NULL) AS complete, count(*) FILTER ({v[0]} IS NOT NULL OR {v[1]} IS NOT NULL) AS with_any, max(CASE WHEN {v[0]} IS NOT NULL OR {v[1]} IS NOT NULL THEN {d} END) AS last_with_any FROM {t}"
    for t, (d, k, v, c) in _COVERED.items()
))
def table_coverage(spark, sf_dir):
    """Each table is read once."""
    parts = [I.coverage(table(spark, sf_dir, t), t, [k], F.expr(d), [F.expr(x) for x in v], F.lit(c).cast("date")) for t, (d, k, v, c) in _COVERED.items()]
    return reduce(DataFrame.unionByName, parts)


@query("export_validation", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def export_validation(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


@query("manifest_agg", "SELECT count(*) AS n, min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM orders")
def manifest_agg(spark, sf_dir):
    d = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.min(d).alias("first"), F.max(d).alias("last"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"))


@query("export_strings", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END, '') AS o_orderstatus FROM orders")
def export_strings(spark, sf_dir):
    status = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), F.coalesce(status, F.lit("")).alias("o_orderstatus"))


@query("compare_sources", """WITH h AS (SELECT l_partkey % 40 AS product, CAST(l_shipdate AS DATE) AS day, CASE WHEN l_partkey % 40 <> 38 THEN CAST(sum(l_quantity) AS DOUBLE) END AS value FROM lineitem GROUP BY 1, 2, l_partkey % 40),
c AS (SELECT product, day, value * CASE CAST(day(day) AS INTEGER) % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.0078125 WHEN 2 THEN 1.5 ELSE 0.0 END AS price FROM h WHERE product < 35 AND day(day) < 20 AND value IS NOT NULL),
m AS (SELECT product, day, value, price, value - price AS diff_abs, CASE WHEN price <> 0 THEN (value - price) / price END AS diff_pct FROM h JOIN c USING (product, day))
SELECT product, day, value, price, diff_abs, round(diff_pct, 8) AS diff_pct, CASE WHEN diff_abs = 0 THEN 'match_close' WHEN abs(diff_pct) <= 0.01 THEN 'small_diff' ELSE 'large_diff' END AS status FROM m
UNION ALL SELECT product, NULL, NULL, NULL, NULL, NULL, CASE WHEN count(value) > 0 THEN 'no_overlap' ELSE 'not_comparable' END FROM h WHERE product NOT IN (SELECT product FROM m) GROUP BY 1""")
def compare_sources(spark, sf_dir):
    """Daily sums of forty products against another source's: equal, near, far and zero prices, products that it lacks and one without values."""
    c = F.col
    h = table(spark, sf_dir, "lineitem").groupBy((c("l_partkey") % 40).alias("product"), F.to_date("l_shipdate").alias("day")).agg(F.sum("l_quantity").cast("double").alias("value"))
    h = h.withColumn("value", F.when(c("product") != 38, c("value")))
    n = F.dayofmonth("day") % 4
    price = c("value") * F.when(n == 0, 1.0).when(n == 1, 1.0078125).when(n == 2, 1.5).otherwise(0.0)
    current = h.filter((c("product") < 35) & (F.dayofmonth("day") < 20)).select("product", "day", price.alias("price"))
    out = I.compare_sources(h, current, "product", "day", "value", "price")
    return out.withColumn("diff_pct", F.round("diff_pct", 8))


@query("seed_idempotent", "SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'created' WHEN n_nationkey % 6 = 1 THEN 'updated' ELSE 'skipped' END AS action FROM nation")
def seed_idempotent(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    old = n.filter("n_nationkey % 4 <> 0").withColumn("n_name", F.when(F.col("n_nationkey") % 6 == 1, "old").otherwise(F.col("n_name")))
    return I.feature_upsert(old, n, ["n_nationkey"], F.col("x.n_name").eqNullSafe(F.col("y.n_name")))


@query("mapping_lookup", "WITH m AS (SELECT n_nationkey AS k, min(n_name) AS name FROM nation WHERE n_nationkey % 5 <> 2 GROUP BY 1) SELECT coalesce(m.name, 'skipped_unmapped') AS mapped, count(*) AS n FROM customer LEFT JOIN m ON m.k = c_nationkey GROUP BY 1")
def mapping_lookup(spark, sf_dir):
    m = table(spark, sf_dir, "nation").filter("n_nationkey % 5 <> 2").groupBy(F.col("n_nationkey").alias("c_nationkey")).agg(F.min("n_name").alias("name"))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(m), "c_nationkey", "left")
    return rows.groupBy(F.coalesce("name", F.lit("skipped_unmapped")).alias("mapped")).agg(F.count("*").alias("n"))
