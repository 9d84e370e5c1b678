"""Queries over time series: local days, as-of joins, bars, windows and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import pointintime as P
from tidemark.operators import ranges as R
from tidemark.operators import scope as C
from tidemark.plans.registry import query
from tidemark.session import table

ZONE = "Europe/Moscow"

PRICES_SQL = """prices AS (SELECT user_id % 20 AS product, event_id AS id, ts, CAST(value AS DECIMAL(18,6)) AS price, CAST(ts + INTERVAL 3 HOUR AS DATE) AS day
  FROM events WHERE event_type IN ('purchase', 'view'))"""
BARS_SQL = f"""{PRICES_SQL}, bars AS (SELECT product, day, arg_min(price, (ts, id)) AS first, arg_max(price, (ts, id)) AS last, min(price) AS low, max(price) AS high, count(*) AS n FROM prices GROUP BY 1, 2)"""
RATES_SQL = """rates AS (SELECT event_type AS currency, CAST(ts AS DATE) AS rate_day, arg_min(CAST(value AS DECIMAL(18,6)), (ts, event_id)) AS rate
  FROM events WHERE event_type IN ('click', 'signup', 'error') AND isodow(CAST(ts AS DATE)) <= 5 GROUP BY 1, 2)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", F.to_date("ts").alias("utc_day"), "user_id", "event_type", F.col("value").cast("decimal(18,6)").alias("value"), "props")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price observations: purchases and views, a product for each twentieth user."""
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("purchase", "view"))
    return rows.select((F.col("user_id") % 20).alias("product"), F.col("event_id").alias("id"), "ts", F.col("value").alias("price"), S.local_date(F.col("ts"), ZONE).alias("day"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.daily_bar(prices(spark, sf_dir), ["product"], "day", "ts", "price", "id")


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each of three types on a UTC weekday, as a currency's rate."""
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("click", "signup", "error") & (F.weekday("utc_day") < 5))
    return rows.groupBy(F.col("event_type").alias("currency"), F.col("utc_day").alias("rate_day")).agg(F.min_by("value", F.struct("ts", "event_id")).alias("rate"))


def doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query("local_day", "SELECT CAST(ts + INTERVAL 3 HOUR AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def local_day(spark, sf_dir):
    return events(spark, sf_dir).groupBy(S.local_date(F.col("ts"), ZONE).alias("day")).agg(F.count("*").alias("n"))


@query("date_bounds", "SELECT event_type, min(CAST(ts AS DATE)) AS first, greatest(max(CAST(ts AS DATE)), DATE '2024-02-05') AS last FROM events GROUP BY 1")
def date_bounds(spark, sf_dir):
    agg = events(spark, sf_dir).groupBy("event_type").agg(F.min("utc_day").alias("first"), F.max("utc_day").alias("last"))
    return agg.withColumn("last", F.greatest("last", F.lit("2024-02-05").cast("date")))


@query("feature_bounds", "SELECT min(CAST(ts + INTERVAL 3 HOUR AS DATE)) AS first, greatest(max(CAST(ts + INTERVAL 3 HOUR AS DATE)), (SELECT max(CAST(ts AS DATE)) + 12 FROM events)) AS last FROM events WHERE event_type IN ('purchase', 'view')")
def feature_bounds(spark, sf_dir):
    """Days from the first price to the last day on which an event becomes available, 12 days after it."""
    e = events(spark, sf_dir)
    return C.date_bounds(e.select(F.col("utc_day").alias("day")), prices(spark, sf_dir).select("day"), e.select(F.date_add("utc_day", 12).alias("day")))


@query("date_spine", "SELECT e.event_type, CAST(d.day AS DATE) AS day FROM (SELECT DISTINCT event_type FROM events) e, (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS day FROM events) d")
def date_spine(spark, sf_dir):
    e = events(spark, sf_dir)
    bounds = e.agg(F.min("utc_day").alias("first"), F.max("utc_day").alias("last"))
    return P.date_spine(e.select("event_type").distinct(), bounds)


@query("daily_bar", f"WITH {BARS_SQL} SELECT product, day, CAST(first AS DOUBLE) AS first, CAST(last AS DOUBLE) AS last, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, n, CASE WHEN n > 1 THEN CAST(last - first AS DOUBLE) END AS intraday FROM bars")
def daily_bar(spark, sf_dir):
    b = bars(spark, sf_dir).drop("as_of_at").withColumn("intraday", F.when(F.col("n") > 1, (F.col("last") - F.col("first")).cast("double")))
    return doubles(b, "first", "last", "low", "high")


@query("daily_last", f"WITH {PRICES_SQL} SELECT product, day, CAST(arg_max(price, (ts, id)) AS DOUBLE) AS last FROM prices WHERE day <= DATE '2024-01-20' GROUP BY 1, 2")
def daily_last(spark, sf_dir):
    rows = prices(spark, sf_dir).filter("day <= date '2024-01-20'")
    return P.latest_per_key(rows, ["product", "day"], ["ts", "id"], ["price"]).select("product", "day", F.col("price").cast("double").alias("last"))


@query("price_delta", f"""WITH {BARS_SQL}, d AS (SELECT product, day, last, lag(last) OVER (PARTITION BY product ORDER BY day) AS p FROM bars)
SELECT product, day, CAST(last AS DOUBLE) AS last, CAST(p AS DOUBLE) AS previous, CAST(last - p AS DOUBLE) AS delta_abs, round(CAST(last - p AS DOUBLE) / nullif(CAST(p AS DOUBLE), 0), 6) AS delta_pct FROM d""")
def price_delta(spark, sf_dir):
    return doubles(P.previous_change(bars(spark, sf_dir).select("product", "day", "last"), ["product"], "day", "last"), "last", "previous")


@query("rolling_price", f"""WITH {BARS_SQL}, d AS (SELECT product, day, CAST(last AS DOUBLE) AS last FROM bars)
SELECT product, day, last, CASE WHEN count(*) OVER w3 = 3 THEN round(avg(last) OVER w3, 6) END AS rolling_mean_3, CASE WHEN count(*) OVER w7 = 7 THEN round(avg(last) OVER w7, 6) END AS rolling_mean_7,
  CASE WHEN count(*) OVER w7 = 7 THEN round(stddev_pop(last) OVER w7, 6) END AS rolling_std_7 FROM d
WINDOW w3 AS (PARTITION BY product ORDER BY day ROWS 2 PRECEDING), w7 AS (PARTITION BY product ORDER BY day ROWS 6 PRECEDING)""")
def rolling_price(spark, sf_dir):
    rows = doubles(bars(spark, sf_dir).select("product", "day", "last"), "last")
    return P.rolling_rows(rows, ["product"], "day", "last", [3, 7], [7])


ASOF_SQL = """(SELECT max(rate_day) FROM rates r WHERE r.currency = c.currency AND r.rate_day <= {day})"""


@query("asof_fx", f"""WITH {BARS_SQL}, {RATES_SQL}, pc AS (SELECT b.product, b.day, c.currency FROM bars b, (SELECT DISTINCT currency FROM rates) c),
j AS (SELECT c.*, {ASOF_SQL.format(day='c.day')} AS rate_day FROM pc c)
SELECT j.product, j.day, j.currency, j.rate_day, CAST(r.rate AS DOUBLE) AS rate FROM j LEFT JOIN rates r USING (currency, rate_day)""")
def asof_fx(spark, sf_dir):
    """Rates as of each product day: swept over distinct days, then joined back by day."""
    r = rates(spark, sf_dir)
    days = bars(spark, sf_dir).select("product", "day")
    probes = days.select("day").distinct().join(F.broadcast(r.select("currency").distinct()))
    found = P.asof_backward(probes, r, ["currency"], "day", "rate_day", ["rate"])
    return days.join(found, "day").select("product", "day", "currency", F.col("found.found_at").alias("rate_day"), F.col("found.rate").cast("double").alias("rate"))


@query("asof_context", f"""WITH {RATES_SQL}, p AS (SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'),
j AS (SELECT p.*, (SELECT max(rate_day) FROM rates r WHERE r.currency = 'click' AND r.rate_day <= p.day) AS rate_day FROM p)
SELECT event_id, j.rate_day, CAST(rate AS DOUBLE) AS rate FROM j LEFT JOIN rates r ON r.rate_day = j.rate_day AND r.currency = 'click'""")
def asof_context(spark, sf_dir):
    r = rates(spark, sf_dir).filter("currency = 'click'")
    p = events(spark, sf_dir).filter("event_type = 'purchase'").select("event_id", F.col("utc_day").alias("day"))
    days = P.asof_backward(p.select(F.lit("click").alias("currency"), "day").distinct(), r, ["currency"], "day", "rate_day", ["rate"])
    return p.join(days, "day").select("event_id", F.col("found.found_at").alias("rate_day"), F.col("found.rate").cast("double").alias("rate"))


def _offset_sql(table_sql: str, shifts: dict[str, str]) -> str:
    cols = ", ".join(f"(SELECT CAST(value AS DOUBLE) FROM s r WHERE r.series = p.series AND r.ad = (SELECT max(ad) FROM s q WHERE q.series = p.series AND q.ad <= {e})) AS {n}" for n, e in shifts.items())
    return f"WITH {table_sql}, p AS (SELECT x.series, d.ad AS day FROM (SELECT DISTINCT series FROM s) x, (SELECT DISTINCT ad FROM s) d) SELECT p.series, p.day, {cols} FROM p"


ENERGY_SQL = "s AS (SELECT user_id % 4 AS series, CAST(ts AS DATE) AS ad, arg_max(CAST(value AS DECIMAL(18,6)), (ts, event_id)) AS value FROM events WHERE event_type = 'error' GROUP BY 1, 2)"
MONTHLY_SQL = "s AS (SELECT p_type AS series, CAST(date_trunc('month', l_shipdate) AS DATE) AS ad, CAST(round(sum(l_extendedprice) / sum(l_quantity), 6) AS DECIMAL(18,6)) AS value FROM lineitem JOIN part ON p_partkey = l_partkey WHERE month(l_shipdate) <> 5 GROUP BY 1, 2)"


@query("asof_delta", _offset_sql(ENERGY_SQL, {"value": "p.day", "value_1d": "p.day - INTERVAL 1 DAY", "value_7d": "p.day - INTERVAL 7 DAY"}))
def asof_delta(spark, sf_dir):
    s = P.daily_bar(events(spark, sf_dir).filter("event_type = 'error'").withColumn("series", F.col("user_id") % 4), ["series"], "utc_day", "ts", "value", "event_id")
    s = s.select("series", F.col("utc_day").alias("at"), F.col("last").alias("value"))
    probes = s.select("series").distinct().join(F.broadcast(s.select(F.col("at").alias("day")).distinct()))
    day = F.col("day")
    return doubles(P.asof_offsets(probes, s, ["series"], "day", "at", "value", {"value": day, "value_1d": F.date_sub(day, 1), "value_7d": F.date_sub(day, 7)}), "value", "value_1d", "value_7d")


def monthly(spark, sf_dir):
    """Average unit price per part type and month; May is left out to make gaps."""
    rows = table(spark, sf_dir, "lineitem").filter(F.month("l_shipdate") != 5).join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    value = F.round(F.sum("l_extendedprice") / F.sum("l_quantity"), 6).cast("decimal(18,6)")
    return rows.groupBy(F.col("p_type").alias("series"), F.to_date(F.trunc("l_shipdate", "month")).alias("at")).agg(value.alias("value"))


@query("asof_delta_months", _offset_sql(MONTHLY_SQL, {"value": "p.day", "value_1m": "p.day - INTERVAL 1 MONTH", "value_3m": "p.day - INTERVAL 3 MONTH"}))
def asof_delta_months(spark, sf_dir):
    s = monthly(spark, sf_dir)
    probes = s.select("series").distinct().join(F.broadcast(s.select(F.col("at").alias("day")).distinct()))
    day = F.col("day")
    return doubles(P.asof_offsets(probes, s, ["series"], "day", "at", "value", {"value": day, "value_1m": F.add_months(day, -1), "value_3m": F.add_months(day, -3)}), "value", "value_1m", "value_3m")


WEATHER_SQL = """weather AS (SELECT user_id % 14 AS region, CAST(ts AS DATE) AS day,
  CASE WHEN (user_id % 14 + day(ts)) % 7 <> 0 THEN round(avg(value - 20), 6) END AS mean, CASE WHEN (user_id % 14 + day(ts)) % 7 <> 0 THEN max(value - 20) END AS hi,
  CASE WHEN (user_id % 14 + day(ts)) % 7 <> 0 THEN min(value - 20) END AS lo FROM events GROUP BY user_id % 14, CAST(ts AS DATE), day(ts))"""


def weather(spark, sf_dir):
    """Daily temperatures of regions from events, some days without values."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 14).alias("region"), F.to_date("ts").alias("day"), (F.col("value") - 20).alias("t"))
    on = (F.col("region") + F.dayofmonth("day")) % 7 != 0
    agg = e.groupBy("region", "day").agg(F.round(F.avg("t"), 6).alias("mean"), F.max("t").alias("hi"), F.min("t").alias("lo"))
    return agg.select("region", "day", *(F.when(on, F.col(c)).alias(c) for c in ("mean", "hi", "lo")))


@query("range_windows", f"""WITH {WEATHER_SQL} SELECT region, day, round(avg(mean) OVER w7, 10) AS mean_7, min(lo) OVER w7 AS lo_7, max(hi) OVER w7 AS hi_7, round(avg(mean) OVER w30, 10) AS mean_30,
  count(CASE WHEN hi >= 30 THEN 1 END) OVER w7 AS heat_7, count(CASE WHEN lo <= 0 THEN 1 END) OVER w30 AS frost_30, round(sum(CASE WHEN mean IS NOT NULL THEN greatest(mean - 10, 0) END) OVER w30, 10) AS gdd_30 FROM weather
WINDOW w7 AS (PARTITION BY region ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), w30 AS (PARTITION BY region ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""")
def range_windows(spark, sf_dir):
    t = F.col
    specs = {
        "mean_7": (F.avg("mean"), 7), "lo_7": (F.min("lo"), 7), "hi_7": (F.max("hi"), 7), "mean_30": (F.avg("mean"), 30),
        "heat_7": (F.count(F.when(t("hi") >= 30, 1)), 7), "frost_30": (F.count(F.when(t("lo") <= 0, 1)), 30),
        "gdd_30": (F.sum(F.when(t("mean").isNotNull(), F.greatest(t("mean") - S.gdd_base(F.lit("wheat")), F.lit(0.0)))), 30),
    }
    out = P.calendar_windows(weather(spark, sf_dir), ["region"], "day", specs)
    return out.select("region", "day", *(F.round(n, 10).alias(n) if n in ("mean_7", "mean_30", "gdd_30") else n for n in specs))


@query("event_windows", """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, day, n AS n_1, CAST(sum(n) OVER w7 AS BIGINT) AS n_7, CAST(sum(n) OVER w30 AS BIGINT) AS n_30 FROM d
WINDOW w7 AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), w30 AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""")
def event_windows(spark, sf_dir):
    d = events(spark, sf_dir).groupBy("event_type", F.col("utc_day").alias("day")).agg(F.count("*").alias("n_1"))
    return P.calendar_windows(d, ["event_type"], "day", {"n_7": (F.sum("n_1"), 7), "n_30": (F.sum("n_1"), 30)})


@query("jump_check", """WITH d AS (SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
SELECT event_id, CASE WHEN p IS NULL OR p <= 0 THEN 'skip' WHEN abs(value - p) > 0.2 * p THEN 'fail' ELSE 'pass' END AS status FROM d""")
def jump_check(spark, sf_dir):
    from pyspark.sql import Window

    p = F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    d = table(spark, sf_dir, "events").withColumn("p", p)
    status = F.when(F.col("p").isNull() | (F.col("p") <= 0), "skip").when(F.abs(F.col("value") - F.col("p")) > 0.2 * F.col("p"), "fail").otherwise("pass")
    return d.select("event_id", status.alias("status"))


@query("calendar", """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT day, year(day) AS calendar_year, month(day) AS calendar_month, quarter(day) AS calendar_quarter, weekofyear(day) AS calendar_week_of_year, dayofyear(day) AS calendar_day_of_year, isodow(day) AS calendar_day_of_week,
  day(day) = 1 AS calendar_is_month_start, last_day(day) = day AS calendar_is_month_end, day(day) = 1 AND month(day) IN (1,4,7,10) AS calendar_is_quarter_start, last_day(day) = day AND month(day) IN (3,6,9,12) AS calendar_is_quarter_end,
  round(sin(2 * pi() * dayofyear(day) / dayofyear(make_date(year(day), 12, 31))), 9) + 0.0 AS calendar_sin_day_of_year, round(cos(2 * pi() * dayofyear(day) / dayofyear(make_date(year(day), 12, 31))), 9) + 0.0 AS calendar_cos_day_of_year,
  round(sin(2 * pi() * month(day) / 12), 9) + 0.0 AS calendar_sin_month, round(cos(2 * pi() * month(day) / 12), 9) + 0.0 AS calendar_cos_month,
  CASE WHEN month(day) IN (12,1,2) THEN 'winter' WHEN month(day) <= 5 THEN 'spring' WHEN month(day) <= 8 THEN 'summer' ELSE 'autumn' END AS calendar_season FROM d""")
def calendar(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", *(c.alias(n) for n, c in S.calendar_features(F.col("day")).items()))


@query("scan_series", "SELECT user_id % 4 AS series, CAST(ts AS DATE) AS day, event_id, CAST(value AS DOUBLE) AS value FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-21'")
def scan_series(spark, sf_dir):
    rows = table(spark, sf_dir, "events").filter("event_type = 'error' and ts < timestamp_ntz '2024-01-21'")
    return rows.select((F.col("user_id") % 4).alias("series"), F.to_date("ts").alias("day"), "event_id", "value")


@query("last_n_months", """WITH m AS (SELECT l_returnflag AS flag, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)
SELECT flag, period, v, CASE WHEN count(*) OVER w3 = 3 THEN round(avg(v) OVER w3, 4) END AS mean_last, CASE WHEN count(*) OVER w12 = 12 THEN round(sum(v) OVER w12, 4) END AS sum_last FROM m
WINDOW w3 AS (PARTITION BY flag ORDER BY period ROWS 2 PRECEDING), w12 AS (PARTITION BY flag ORDER BY period ROWS 11 PRECEDING)""")
def last_n_months(spark, sf_dir):
    return P.last_n_periods(months(spark, sf_dir), ["flag"], "period", "v", 3, 12)


def months(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.to_date(F.trunc("l_shipdate", "month")).alias("period"))
    return rows.agg(F.sum("l_quantity").alias("v"))


@query("yoy", """WITH m AS (SELECT l_returnflag AS flag, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)
SELECT a.flag, a.period, a.v, b.v AS past, round((a.v - b.v) / nullif(b.v, 0), 6) AS yoy FROM m a LEFT JOIN m b ON a.flag = b.flag AND a.period = b.period + INTERVAL 12 MONTH""")
def yoy(spark, sf_dir):
    return P.year_change(months(spark, sf_dir), ["flag"], "period", "v").select("flag", "period", "v", "past", "yoy")


@query("month_periods", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS period, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start, last_day(o_orderdate) AS period_end FROM orders")
def month_periods(spark, sf_dir):
    d = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(d, "yyyyMM").alias("period"), F.trunc(d, "month").alias("period_start"), F.last_day(d).alias("period_end"))


@query("product_daily", f"""WITH {BARS_SQL}, {RATES_SQL}, {WEATHER_SQL},
d AS (SELECT product, day, n, CAST(first AS DOUBLE) AS first, CAST(last AS DOUBLE) AS last, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high FROM bars),
w AS (SELECT *, lag(last) OVER o AS previous, CASE WHEN count(*) OVER w3 = 3 THEN round(avg(last) OVER w3, 6) END AS rolling_mean_3, CASE WHEN count(*) OVER w7 = 7 THEN round(avg(last) OVER w7, 6) END AS rolling_mean_7, CASE WHEN count(*) OVER w7 = 7 THEN round(stddev_pop(last) OVER w7, 6) END AS rolling_std_7
  FROM d WINDOW o AS (PARTITION BY product ORDER BY day), w3 AS (PARTITION BY product ORDER BY day ROWS 2 PRECEDING), w7 AS (PARTITION BY product ORDER BY day ROWS 6 PRECEDING)),
days AS (SELECT DISTINCT day FROM d),
fx AS (SELECT day, CAST((SELECT arg_max(rate, rate_day) FROM rates WHERE currency = 'click' AND rate_day <= day) AS DOUBLE) AS click_rate, CAST((SELECT arg_max(rate, rate_day) FROM rates WHERE currency = 'error' AND rate_day <= day) AS DOUBLE) AS error_rate FROM days),
t AS (SELECT day, round(avg(mean), 4) AS temperature FROM weather GROUP BY 1)
SELECT w.product, w.day, n AS price_observations, first AS price_first, last AS price_last, low AS price_min, high AS price_max, round(last - previous, 6) AS price_delta_abs_1d, rolling_mean_3, rolling_mean_7, rolling_std_7,
  click_rate, error_rate, temperature, isodow(w.day) AS calendar_day_of_week, nullif(concat_ws(',', CASE WHEN click_rate IS NULL THEN 'missing_click' END, CASE WHEN error_rate IS NULL THEN 'missing_error' END, CASE WHEN temperature IS NULL THEN 'missing_weather' END), '') AS missing_flags
FROM w LEFT JOIN fx USING (day) LEFT JOIN t USING (day)""")
def product_daily(spark, sf_dir):
    """The flagship: one leakage-safe row per product and local price day.

    Price windows run on one exchange by product. Series shared by all products are
    looked up once per distinct day and joined back by day, not swept per product.
    """
    b = doubles(bars(spark, sf_dir).drop("as_of_at"), "first", "last", "low", "high")
    rows = P.rolling_rows(P.previous_change(b, ["product"], "day", "last"), ["product"], "day", "last", [3, 7], [7])
    days = b.select("day").distinct()
    probes = days.join(F.broadcast(spark.createDataFrame([("click",), ("error",)], "currency string")))
    found = P.asof_backward(probes, rates(spark, sf_dir), ["currency"], "day", "rate_day", ["rate"])
    fx = found.groupBy("day").agg(*(F.max(F.when(F.col("currency") == c, F.col("found.rate").cast("double"))).alias(f"{c}_rate") for c in ("click", "error")))
    t = weather(spark, sf_dir).groupBy("day").agg(F.round(F.avg("mean"), 4).alias("temperature"))
    out = rows.join(fx, "day", "left").join(t, "day", "left")
    flags = {"missing_click": F.col("click_rate").isNull(), "missing_error": F.col("error_rate").isNull(), "missing_weather": F.col("temperature").isNull()}
    return out.select(
        "product", "day", F.col("n").alias("price_observations"), F.col("first").alias("price_first"), F.col("last").alias("price_last"), F.col("low").alias("price_min"), F.col("high").alias("price_max"),
        F.round("delta_abs", 6).alias("price_delta_abs_1d"), "rolling_mean_3", "rolling_mean_7", "rolling_std_7", "click_rate", "error_rate", "temperature",
        (F.weekday("day") + 1).alias("calendar_day_of_week"), S.true_flags(flags).alias("missing_flags"),
    )


#: Few rows a range here, so that the frequent user is cut at every size of the tables.
_PER_RANGE = 500
_HOT_SQL = "h AS (SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS u, event_id, event_type, ts, CAST(ts AS DATE) AS day, CAST(CAST(value AS DECIMAL(18,6)) AS DOUBLE) AS value FROM events)"


def hot_events(spark, sf_dir) -> DataFrame:
    """Events of users of whom one has a third of all."""
    user = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    return events(spark, sf_dir).select(user.alias("u"), "event_id", "event_type", "ts", F.col("utc_day").alias("day"), F.col("value").cast("double").alias("value"))


@query("asof_hot_key", f"""WITH {_HOT_SQL}, c AS (SELECT u, ts, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM h WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT p.event_id, c.event_id AS found_id, c.value AS found_value FROM (SELECT * FROM h WHERE event_type <> 'purchase') p ASOF LEFT JOIN c ON c.u = p.u AND c.ts <= p.ts""")
def asof_hot_key(spark, sf_dir):
    """Every other event with its user's last purchase; one user has a third of both."""
    h = hot_events(spark, sf_dir)
    context = h.filter("event_type = 'purchase'").select("u", "ts", F.col("event_id").alias("id"), "value")
    out = R.asof_backward(h.filter("event_type <> 'purchase'").select("u", "event_id", "ts"), context, ["u"], "ts", "ts", ["value"], ["id"], _PER_RANGE)
    return out.select("event_id", F.col("found.id").alias("found_id"), F.col("found.value").alias("found_value"))


@query("calendar_windows_hot_key", f"""WITH {_HOT_SQL} SELECT event_id, count(*) OVER w3 AS n_3, max(value) OVER w3 AS high_3, min(value) OVER w7 AS low_7, count(DISTINCT day) OVER w7 AS days_7 FROM h
WINDOW w3 AS (PARTITION BY u ORDER BY day RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW), w7 AS (PARTITION BY u ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""")
def calendar_windows_hot_key(spark, sf_dir):
    """Windows of 3 and 7 days over every event's user; one user has a third of all."""
    specs = {"n_3": (F.count("*"), 3), "high_3": (F.max("value"), 3), "low_7": (F.min("value"), 7), "days": (F.collect_set("day"), 7)}
    out = R.calendar_windows(hot_events(spark, sf_dir), ["u"], "day", specs, _PER_RANGE)
    return out.select("event_id", "n_3", "high_3", "low_7", F.size("days").cast("long").alias("days_7"))
