"""Queries over effective-dated weights, baskets, shares and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import pointintime as P
from tidemark.operators import scope as C
from tidemark.plans.registry import query
from tidemark.plans.series import WEATHER_SQL, events, weather
from tidemark.session import table

WEIGHTS_SQL = """weights AS (SELECT p.p AS product, r.r AS region, CASE WHEN r.r = 13 THEN 0.071432 ELSE 0.071428 END AS weight,
  CASE WHEN (p.p + r.r) % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-01-15' END AS effective_from, CASE WHEN r.r = 3 THEN DATE '2024-01-25' END AS effective_to FROM range(4) p(p), range(14) r(r))"""
VALID = "w.effective_from <= d.day AND (w.effective_to IS NULL OR w.effective_to >= d.day)"


def weights(spark) -> DataFrame:
    """Region weights of four products with days from and to which they hold."""
    grid = spark.range(56).select((F.col("id") / 14).cast("int").alias("product"), (F.col("id") % 14).alias("region"))
    start = F.when((F.col("product") + F.col("region")) % 2 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-15")).cast("date")
    return grid.select(
        "product", "region", F.when(F.col("region") == 13, 0.071432).otherwise(0.071428).alias("weight"), start.alias("effective_from"),
        F.when(F.col("region") == 3, F.lit("2024-01-25").cast("date")).alias("effective_to"),
    )


def days_of(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select(F.col("utc_day").alias("day")).distinct()


@query("effective_weights", f"WITH {WEIGHTS_SQL}, d AS (SELECT DATE '2024-01-20' AS day) SELECT product, region, weight, n FROM weights w, d, (SELECT user_id % 14 AS g, count(*) AS n FROM events GROUP BY 1) e WHERE e.g = w.region AND {VALID}")
def effective_weights(spark, sf_dir):
    day = events(spark, sf_dir).agg(F.lit("2024-01-20").cast("date").alias("day"))
    n = events(spark, sf_dir).groupBy((F.col("user_id") % 14).alias("region")).agg(F.count("*").alias("n"))
    return P.interval_join(day, weights(spark), "day").join(n, "region").select("product", "region", "weight", "n")


@query("weights_interval_join", f"WITH {WEIGHTS_SQL}, d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) SELECT d.day, product, region, weight FROM d JOIN weights w ON {VALID}")
def weights_interval_join(spark, sf_dir):
    return P.interval_join(days_of(spark, sf_dir), weights(spark), "day").select("day", "product", "region", "weight")


@query("weighted_mean", f"WITH {WEIGHTS_SQL}, {WEATHER_SQL} SELECT product, d.day, round(sum(mean * weight) / nullif(sum(CASE WHEN mean IS NOT NULL THEN weight END), 0), 5) AS mean FROM weather d JOIN weights w ON w.region = d.region AND {VALID} GROUP BY 1, 2")
def weighted_mean(spark, sf_dir):
    joined = P.interval_join(weather(spark, sf_dir), weights(spark), "day", ["region"])
    return joined.groupBy("product", "day").agg(F.round(P.weighted_mean(F.col("mean"), F.col("weight")), 5).alias("mean"))


@query("coverage_rollup", f"""WITH {WEIGHTS_SQL}, {WEATHER_SQL}, d AS (SELECT DISTINCT day FROM weather)
SELECT product, d.day, string_agg(CASE WHEN x.mean IS NOT NULL THEN CAST(w.region AS VARCHAR) END, ',' ORDER BY w.region) AS used, count(*) - count(x.mean) AS missing, CASE WHEN count(x.mean) = 0 THEN 'all_missing' WHEN count(x.mean) < count(*) THEN 'partial' ELSE 'full' END AS status
FROM d JOIN weights w ON {VALID} LEFT JOIN weather x ON x.region = w.region AND x.day = d.day GROUP BY 1, 2""")
def coverage_rollup(spark, sf_dir):
    x = weather(spark, sf_dir).select("region", "day", "mean")
    held = P.interval_join(x.select("day").distinct(), weights(spark), "day").join(x, ["region", "day"], "left")
    there = F.when(F.col("mean").isNotNull(), F.col("region"))
    agg = held.groupBy("product", "day").agg(F.array_sort(F.collect_list(there)).alias("u"), F.count("*").alias("n"), F.count("mean").alias("m"))
    status = F.when(F.col("m") == 0, "all_missing").when(F.col("m") < F.col("n"), "partial").otherwise("full")
    used = F.nullif(F.array_join(F.col("u").cast("array<string>"), ","), F.lit(""))
    return agg.select("product", "day", used.alias("used"), (F.col("n") - F.col("m")).alias("missing"), status.alias("status"))


@query("coverage_flags", f"""WITH {WEIGHTS_SQL}, {WEATHER_SQL}, held AS (SELECT * FROM weights UNION ALL SELECT 5, 12, 1.0, DATE '2024-01-01', NULL),
f AS (SELECT region, day, day + CAST((region + day(day)) % 11 = 0 AS INTEGER) AS known, mean, hi = lo AS single_reading FROM weather WHERE region <> 12 OR day >= DATE '2024-01-10'),
g AS (SELECT p.p AS product, d.day FROM range(6) p(p), (SELECT DISTINCT day FROM weather) d),
h AS (SELECT d.product, d.day, w.region FROM g d JOIN held w ON w.product = d.product AND {VALID}),
a AS (SELECT h.*, f.known IS NOT NULL AND f.known <= h.day AS taken, f.known, f.mean, CASE WHEN f.known IS NULL THEN ['missing_region:' || h.region] WHEN f.known > h.day THEN ['future_as_of:' || h.region]
  ELSE list_filter([CASE WHEN f.mean IS NULL THEN h.region || ':no_temperature' END, CASE WHEN f.single_reading THEN h.region || ':single_reading' END], lambda x: x IS NOT NULL) END AS said FROM h ASOF LEFT JOIN f ON f.region = h.region AND f.day <= h.day),
r AS (SELECT product, day, max(CASE WHEN taken THEN known END) AS as_of, string_agg(CASE WHEN taken AND mean IS NOT NULL THEN CAST(region AS VARCHAR) END, ',' ORDER BY region) AS used, flatten(list(said ORDER BY region)) AS said, count(*) AS n, count(CASE WHEN taken THEN 1 END) AS k FROM a GROUP BY 1, 2)
SELECT g.product, g.day, as_of, used, CASE WHEN n IS NULL THEN 'missing_weights' ELSE nullif(concat_ws(',', nullif(array_to_string(said, ','), ''), CASE WHEN k = 0 THEN 'missing_all_regions' WHEN k < n THEN 'partial_regions' END, CASE WHEN k > 0 AND used IS NULL THEN 'missing_all_values' END), '') END AS flags
FROM g LEFT JOIN r USING (product, day)""")
def coverage_flags(spark, sf_dir):
    """Regions behind each product's weather: one opens late, some rows are known a day late, product 4 has no weights, product 5 the late region alone."""
    c = F.col
    x = weather(spark, sf_dir).filter("region <> 12 or day >= date '2024-01-10'")
    x = x.withColumn("at", F.date_add("day", F.when((c("region") + F.dayofmonth("day")) % 11 == 0, 1).otherwise(0)))
    one = spark.range(1).select(F.lit(5).alias("product"), F.lit(12).cast("long").alias("region"), F.lit(1.0).alias("weight"), F.lit("2024-01-01").cast("date").alias("effective_from"), F.lit(None).cast("date").alias("effective_to"))
    probes = x.select("day").distinct().select(F.explode(F.sequence(F.lit(0), F.lit(5))).alias("product"), "day")
    return C.coverage(probes, weights(spark).unionByName(one), x, "product", "region", "at", c("mean").isNotNull(), {"no_temperature": c("mean").isNull(), "single_reading": c("hi") == c("lo")})


TRADE_SQL = """trade AS (SELECT p_brand AS code, s_nationkey AS reporter, CASE l_returnflag WHEN 'A' THEN 'export' WHEN 'N' THEN 'import' ELSE 're_export' END AS flow, CAST(date_trunc('month', l_shipdate) AS DATE) AS period,
  sum(l_quantity) AS quantity, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS value, last_day(date_trunc('month', l_shipdate)) + (40 + s_nationkey % 20) AS known
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL)"""


def trade(spark, sf_dir) -> DataFrame:
    """Monthly flows per brand, reporting nation and direction, with the day they were known."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    rows = rows.join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    flow = F.when(F.col("l_returnflag") == "A", "export").when(F.col("l_returnflag") == "N", "import").otherwise("re_export")
    period = F.to_date(F.trunc("l_shipdate", "month"))
    agg = rows.groupBy(F.col("p_brand").alias("code"), F.col("s_nationkey").alias("reporter"), flow.alias("flow"), period.alias("period"))
    agg = agg.agg(F.sum("l_quantity").alias("quantity"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("value"))
    return agg.withColumn("known", F.date_add(F.last_day("period"), 40 + F.col("reporter") % 20))


# Sixths, so that weighted sums stay exact until the last division.
CODE_WEIGHT_SQL = "(6 // (1 + CAST(split_part(code, '#', 2) AS INTEGER) % 3))"


def code_weight():
    return (6 / (1 + F.split_part(F.col("code"), F.lit("#"), F.lit(2)).cast("int") % 3)).cast("int")


@query("weighted_monthly", f"WITH {TRADE_SQL} SELECT flow, period, round(sum(quantity * {CODE_WEIGHT_SQL}) / 6, 4) AS volume, round(CAST(sum(value * {CODE_WEIGHT_SQL}) AS DOUBLE) / 6, 4) AS value, max(known) AS known, count(*) AS n FROM trade GROUP BY 1, 2")
def weighted_monthly(spark, sf_dir):
    w = code_weight()
    return trade(spark, sf_dir).groupBy("flow", "period").agg(
        F.round(F.sum(F.col("quantity") * w) / 6, 4).alias("volume"), F.round(F.sum(F.col("value") * w).cast("double") / 6, 4).alias("value"), F.max("known").alias("known"), F.count("*").alias("n")
    )


@query("subset_latest", f"WITH {TRADE_SQL}, m AS (SELECT flow, period, sum(quantity) AS v FROM trade WHERE reporter IN (1, 3, 5) GROUP BY 1, 2) SELECT flow, max(period) AS period, arg_max(v, period) AS v FROM m GROUP BY 1")
def subset_latest(spark, sf_dir):
    m = trade(spark, sf_dir).groupBy("flow", "period").agg(F.sum(F.when(F.col("reporter").isin(1, 3, 5), F.col("quantity"))).alias("v"))
    return m.filter("v is not null").groupBy("flow").agg(F.max("period").alias("period"), F.max_by("v", "period").alias("v"))


@query("pit_filter", f"WITH {TRADE_SQL} SELECT flow, d.day, CAST(sum(quantity) AS DOUBLE) AS volume, count(*) AS n, max(period) AS last_period FROM trade, (SELECT unnest([DATE '1996-06-30', DATE '1999-12-31', DATE '2001-03-15']) AS day) d WHERE known <= d.day AND last_day(period) <= d.day GROUP BY 1, 2")
def pit_filter(spark, sf_dir):
    days = F.array(*(F.lit(d).cast("date") for d in ("1996-06-30", "1999-12-31", "2001-03-15")))
    rows = trade(spark, sf_dir).withColumn("day", F.explode(days)).filter("known <= day and last_day(period) <= day")
    return rows.groupBy("flow", "day").agg(F.sum("quantity").alias("volume"), F.count("*").alias("n"), F.max("period").alias("last_period"))


@query("availability", f"WITH {TRADE_SQL} SELECT reporter, coalesce(CASE WHEN reporter % 3 = 0 THEN known END, period) AS available, count(*) AS n FROM trade GROUP BY 1, 2")
def availability(spark, sf_dir):
    published = F.when(F.col("reporter") % 3 == 0, F.col("known"))
    return trade(spark, sf_dir).groupBy("reporter", S.availability_date(published, F.col("period")).alias("available")).agg(F.count("*").alias("n"))


@query("value_fallback", "SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END, l_extendedprice / 1000) AS v, count(*) AS n FROM lineitem GROUP BY ALL")
def value_fallback(spark, sf_dir):
    v = S.value_fallback(F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")), F.col("l_extendedprice") / 1000)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", v.alias("v")).agg(F.count("*").alias("n"))


BALANCE_SQL = """balance AS (SELECT n_name AS country, o_orderpriority AS metric, year(o_orderdate) AS marketing_year, month(o_orderdate) AS report_month, CAST(round(sum(o_totalprice), 2) AS DOUBLE) AS value,
  last_day(max(o_orderdate)) + 12 AS known FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3, 4)"""


def balance(spark, sf_dir) -> DataFrame:
    """Reported totals per country, metric, year and month."""
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))
    rows = table(spark, sf_dir, "orders").join(c, F.col("c_custkey") == F.col("o_custkey"))
    agg = rows.groupBy(F.col("n_name").alias("country"), F.col("o_orderpriority").alias("metric"), F.year("o_orderdate").alias("marketing_year"), F.month("o_orderdate").alias("report_month"))
    return agg.agg(F.round(F.sum("o_totalprice"), 2).alias("value"), F.date_add(F.last_day(F.max("o_orderdate")), 12).alias("known"))


LATEST_SQL = f"{BALANCE_SQL}, latest AS (SELECT country, metric, arg_max(value, (known, marketing_year, report_month)) AS value, max((known, marketing_year, report_month)) AS k FROM balance WHERE known <= DATE '2000-06-30' GROUP BY 1, 2)"


def latest(spark, sf_dir) -> DataFrame:
    known = balance(spark, sf_dir).filter("known <= date '2000-06-30'")
    return P.latest_per_key(known, ["country", "metric"], ["known", "marketing_year", "report_month"], ["value"])


@query("latest_per_key", f"WITH {LATEST_SQL} SELECT country, metric, value, k[1] AS known FROM latest")
def latest_per_key(spark, sf_dir):
    return latest(spark, sf_dir).select("country", "metric", "value", "known")


@query("selection_meta", f"WITH {LATEST_SQL} SELECT metric, max(k[1]) AS known, CAST(max((k[1], k[2]))[2] AS INTEGER) AS marketing_year FROM latest GROUP BY 1")
def selection_meta(spark, sf_dir):
    return latest(spark, sf_dir).groupBy("metric").agg(F.max("known").alias("known"), F.max_by("marketing_year", F.struct("known", "marketing_year")).cast("int").alias("marketing_year"))


BASKET = {"NATION_0": 0.35, "NATION_1": 0.25, "NATION_2": 0.15, "NATION_3": 0.10, "NATION_4": 0.10, "NATION_5": 0.05}
LEAST_WEIGHT = 0.75
_BASKET_SQL = "basket(country, w) AS (VALUES " + ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in BASKET.items()) + ")"


@query("country_basket", f"""WITH {LATEST_SQL}, {_BASKET_SQL}, m AS (SELECT DISTINCT metric FROM latest),
x AS (SELECT m.metric, b.country, b.w, CASE WHEN b.country <> 'NATION_0' OR m.metric < '3' THEN l.value END AS value FROM m CROSS JOIN basket b LEFT JOIN latest l ON l.metric = m.metric AND l.country = b.country),
a AS (SELECT metric, sum(CASE WHEN value IS NOT NULL THEN w END) AS there, sum(w) AS whole, sum(w * value) AS total, string_agg(CASE WHEN value IS NOT NULL THEN country END, ',' ORDER BY country) AS used FROM x GROUP BY 1)
SELECT metric, used, round(there / whole, 6) AS coverage, CASE WHEN there / whole >= 0.75 THEN round(total / there, 2) END AS value, CASE WHEN there >= whole - 1e-9 THEN 'full' WHEN there / whole >= 0.75 THEN 'partial' ELSE 'insufficient' END AS status FROM a""")
def country_basket(spark, sf_dir):
    """Weighted mean over the configured countries that have a value; the first lacks one for late metrics."""
    names = spark.range(1).select(F.explode(F.create_map(*(F.lit(x) for kv in BASKET.items() for x in kv))).alias("country", "w"))
    l = latest(spark, sf_dir).select("metric", "country", "value")
    grid = l.select("metric").distinct().join(F.broadcast(names))
    x = grid.join(l, ["metric", "country"], "left").withColumn("value", F.when((F.col("country") != "NATION_0") | (F.col("metric") < "3"), F.col("value")))
    here = F.col("value").isNotNull()
    a = x.groupBy("metric").agg(
        F.sum(F.when(here, F.col("w"))).alias("there"), F.sum("w").alias("whole"), F.sum(F.col("w") * F.col("value")).alias("total"),
        F.array_join(F.array_sort(F.collect_list(F.when(here, F.col("country")))), ",").alias("used"),
    )
    cover = F.col("there") / F.col("whole")
    status = F.when(F.col("there") >= F.col("whole") - 1e-9, "full").when(cover >= LEAST_WEIGHT, "partial").otherwise("insufficient")
    return a.select("metric", "used", F.round(cover, 6).alias("coverage"), F.when(cover >= LEAST_WEIGHT, F.round(F.col("total") / F.col("there"), 2)).alias("value"), status.alias("status"))


SHARE_SQL = f"{BALANCE_SQL}, t AS (SELECT metric, country, sum(value) AS v FROM balance WHERE marketing_year BETWEEN 1996 AND 1998 GROUP BY 1, 2), s AS (SELECT metric, country, v / sum(v) OVER (PARTITION BY metric) AS share FROM t)"


def shares(spark, sf_dir) -> DataFrame:
    t = balance(spark, sf_dir).filter("marketing_year between 1996 and 1998").groupBy("metric", "country").agg(F.sum("value").alias("v"))
    return t.withColumn("share", F.col("v") / F.sum("v").over(Window.partitionBy("metric")))


@query("share_of_total", f"WITH {SHARE_SQL} SELECT metric, country, round(share, 6) AS share, CASE WHEN share >= 0.04 THEN 'included' ELSE 'below_minimum' END AS status FROM s")
def share_of_total(spark, sf_dir):
    return shares(spark, sf_dir).select("metric", "country", F.round("share", 6).alias("share"), F.when(F.col("share") >= 0.04, "included").otherwise("below_minimum").alias("status"))


_PREFIX_SQL = "r{n} AS (SELECT metric, country, share, row_number() OVER w AS rank, sum(share) OVER (w ROWS UNBOUNDED PRECEDING) AS running FROM s WINDOW w AS (PARTITION BY metric ORDER BY share DESC, country)), t{n} AS (SELECT * FROM r{n} WHERE running - share < {least} AND rank <= {most})"


@query("coverage_prefix", f"""WITH {SHARE_SQL}, {_PREFIX_SQL.format(n=1, least=0.6, most=999)}, {_PREFIX_SQL.format(n=2, least=0.6, most=5)}, {_PREFIX_SQL.format(n=3, least=1.5, most=999)}
SELECT 'open' AS kind, metric, country, CAST(rank AS INTEGER) AS rank, round(running, 6) AS running, 'threshold_reached' AS status FROM t1 UNION ALL SELECT 'capped', metric, country, CAST(rank AS INTEGER), round(running, 6), CASE WHEN max(running) OVER (PARTITION BY metric) >= 0.6 THEN 'threshold_reached' ELSE 'coverage_requires_review' END FROM t2
UNION ALL SELECT 'beyond', metric, country, CAST(rank AS INTEGER), round(running, 6), 'threshold_not_reached' FROM t3""")
def coverage_prefix(spark, sf_dir):
    """Countries by share up to a threshold, with a cap that doesn't reach it, and up to one that nothing reaches."""
    s = shares(spark, sf_dir)
    kinds = {"open": (0.6, None), "capped": (0.6, 5), "beyond": (1.5, None)}
    parts = [P.coverage_prefix(s, ["metric"], "share", "country", least, most).withColumn("kind", F.lit(kind)) for kind, (least, most) in kinds.items()]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("kind", "metric", "country", "rank", F.round("running", 6).alias("running"), "status")


@query("gap_fill", f"WITH {SHARE_SQL}, m AS (SELECT metric, country, share, sum(share) OVER (PARTITION BY metric ORDER BY share DESC, country ROWS UNBOUNDED PRECEDING) - share AS before FROM s WHERE country >= 'NATION_2') SELECT metric, country, round(share, 6) AS share FROM m WHERE before < 0.3")
def gap_fill(spark, sf_dir):
    missing = shares(spark, sf_dir).filter("country >= 'NATION_2'")
    return P.coverage_prefix(missing, ["metric"], "share", "country", 0.3).select("metric", "country", F.round("share", 6).alias("share"))


@query("residual_weights", f"WITH {SHARE_SQL}, r AS (SELECT metric, country, CAST(round(share, 8) AS DECIMAL(18,8)) AS share, row_number() OVER w AS rn, count(*) OVER (PARTITION BY metric) AS n, coalesce(sum(CAST(round(share, 8) AS DECIMAL(18,8))) OVER (PARTITION BY metric ORDER BY country ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s WINDOW w AS (PARTITION BY metric ORDER BY country)) SELECT metric, country, CAST(CASE WHEN rn = n THEN 1 - before ELSE share END AS DOUBLE) AS share FROM r")
def residual_weights(spark, sf_dir):
    return P.residual_weights(shares(spark, sf_dir), ["metric"], "v", "country").select("metric", "country", "share")


@query("safe_ratio", f"WITH {BALANCE_SQL} SELECT country, marketing_year, report_month, round(sum(CASE WHEN metric = '1-URGENT' THEN value END) / nullif(sum(CASE WHEN metric = '5-LOW' THEN value END), 0), 6) AS ratio FROM balance GROUP BY 1, 2, 3")
def safe_ratio(spark, sf_dir):
    total = lambda m: F.sum(F.when(F.col("metric") == m, F.col("value")))
    return balance(spark, sf_dir).groupBy("country", "marketing_year", "report_month").agg(F.round(S.safe_ratio(total("1-URGENT"), total("5-LOW")), 6).alias("ratio"))


@query("expected_grid", f"WITH {BALANCE_SQL} SELECT m.metric, n.n_name AS country, y.y AS marketing_year, count(b.value) AS n, CASE WHEN count(b.value) > 0 THEN 'available' ELSE 'missing' END AS status FROM (SELECT DISTINCT metric FROM balance) m CROSS JOIN nation n CROSS JOIN (SELECT unnest([1995, 1998, 2003]) AS y) y LEFT JOIN balance b ON b.metric = m.metric AND b.country = n.n_name AND b.marketing_year = y.y GROUP BY 1, 2, 3")
def expected_grid(spark, sf_dir):
    b = balance(spark, sf_dir)
    years = F.explode(F.array(*map(F.lit, (1995, 1998, 2003)))).alias("marketing_year")
    grid = b.select("metric").distinct().join(F.broadcast(table(spark, sf_dir, "nation").select(F.col("n_name").alias("country")))).select("metric", "country", years)
    have = b.groupBy("metric", "country", "marketing_year").agg(F.count("value").alias("n"))
    out = grid.join(have, ["metric", "country", "marketing_year"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("status", F.when(F.col("n") > 0, "available").otherwise("missing"))


@query("missing_years", "SELECT o_custkey, array_to_string(list_filter([1995,1996,1997,1998,1999,2000,2001], lambda y: NOT list_contains(list(DISTINCT year(o_orderdate)), y)), ',') AS missing FROM orders GROUP BY 1")
def missing_years(spark, sf_dir):
    have = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set(F.year("o_orderdate")).alias("years"))
    gone = F.array_except(F.sequence(F.lit(1995), F.lit(2001)), F.col("years"))
    return have.select("o_custkey", F.array_join(gone.cast("array<string>"), ",").alias("missing"))


@query("concrete_only", "SELECT n_regionkey, n_name FROM nation WHERE upper(trim(CASE WHEN n_nationkey % 5 = 0 THEN ' world ' ELSE n_name END)) NOT IN ('', 'ALL', 'E4', 'EU', 'EU27', 'EU-27', 'R00', 'WORLD', 'WLD')")
def concrete_only(spark, sf_dir):
    # Codes of aggregates.
    codes = ("", "ALL", "E4", "EU", "EU27", "EU-27", "R00", "WORLD", "WLD")
    name = F.when(F.col("n_nationkey") % 5 == 0, " world ").otherwise(F.col("n_name"))
    return table(spark, sf_dir, "nation").filter(~F.upper(F.trim(name)).isin(*codes)).select("n_regionkey", "n_name")


@query("dim_join", "SELECT n_name, r_name, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey % 4 <> 1 GROUP BY 1, 2")
def dim_join(spark, sf_dir):
    n = table(spark, sf_dir, "nation").filter("n_nationkey % 4 <> 1").join(F.broadcast(table(spark, sf_dir, "region")), F.col("r_regionkey") == F.col("n_regionkey"))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(n), F.col("n_nationkey") == F.col("c_nationkey"))
    return rows.groupBy("n_name", "r_name").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
