"""Feature groups per product and day, and the wide product row that joins all of them.

Each group is worked out once per day on which its series change and looked up as of the
days asked for; groups that all products share are swept over distinct days.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import bitemporal as B
from tidemark.operators import pointintime as P
from tidemark.plans.registry import ORACLE, QUERIES, query
from tidemark.plans.series import BARS_SQL, MONTHLY_SQL, RATES_SQL, WEATHER_SQL, bars, events, monthly, rates, weather
from tidemark.plans.textevents import RULES
from tidemark.plans.weighted import BALANCE_SQL, BASKET, LEAST_WEIGHT, TRADE_SQL, VALID, WEIGHTS_SQL, balance, trade, weights
from tidemark.session import scratch_root, table
from tidemark.sources import export as E

PRODUCTS = 4
#: Smallest share by which a basket counts, less what sums of shares may lose.
_LEAST = LEAST_WEIGHT - 1e-9


def _cases(key: str, values: dict[str, str], columns: dict[str, str]) -> str:
    return ", ".join(f"max(CASE WHEN {key} = '{v}' THEN {e} END) AS {n}{s}" for v, n in values.items() for s, e in columns.items())


def _pivoted(key: str, values: dict[str, str], columns: dict[str, Column]) -> list[Column]:
    """One aggregate for each value of ``key`` and each column, named value's name and column's suffix."""
    return [F.max(F.when(F.col(key) == v, e)).alias(f"{n}{s}") for v, n in values.items() for s, e in columns.items()]


# --- weather -----------------------------------------------------------------------

# name: (aggregate in SQL, days); the names are the columns of both sides.
_WEATHER = {
    "temperature_7d_mean": ("avg(mean)", 7), "temperature_30d_mean": ("avg(mean)", 30), "temperature_min_7d": ("min(lo)", 7), "temperature_max_7d": ("max(hi)", 7),
    "precipitation_7d_sum": ("CAST(sum(rain) OVER {w} AS DOUBLE)", 7), "precipitation_14d_sum": ("CAST(sum(rain) OVER {w} AS DOUBLE)", 14), "precipitation_30d_sum": ("CAST(sum(rain) OVER {w} AS DOUBLE)", 30),
    "heat_days_7d": ("count(CASE WHEN hi >= 30 THEN 1 END)", 7), "heat_days_30d": ("count(CASE WHEN hi >= 30 THEN 1 END)", 30), "frost_days_7d": ("count(CASE WHEN lo <= 0 THEN 1 END)", 7), "frost_days_30d": ("count(CASE WHEN lo <= 0 THEN 1 END)", 30),
    "degree_days_7d": ("sum(CASE WHEN mean IS NOT NULL THEN greatest(mean - 10, 0) END)", 7), "degree_days_30d": ("sum(CASE WHEN mean IS NOT NULL THEN greatest(mean - 10, 0) END)", 30),
    # The month's precipitation stands for drought: little of it is much of the other.
    "drought_proxy_30d": ("CAST(sum(rain) OVER {w} AS DOUBLE)", 30),
}
_OVER = ", ".join(f"w{n} AS (PARTITION BY region ORDER BY day RANGE BETWEEN INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW)" for n in (7, 14, 30))
_W = "round(sum({n} * weight) / nullif(sum(CASE WHEN {n} IS NOT NULL THEN weight END), 0), 5) AS {n}"
PRODUCT_WEATHER_SQL = f"""WITH {WEIGHTS_SQL}, {WEATHER_SQL}, rain AS (SELECT user_id % 14 AS region, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,4))) AS rain FROM events WHERE event_type = 'signup' GROUP BY 1, 2),
f AS (SELECT region, day, mean, {", ".join((e.format(w=f"w{n}") if "OVER" in e else f"{e} OVER w{n}") + f" AS {c}" for c, (e, n) in _WEATHER.items())} FROM weather LEFT JOIN rain USING (region, day) WINDOW {_OVER})
SELECT product, d.day, {", ".join(_W.format(n=n) for n in _WEATHER)}, string_agg(CASE WHEN mean IS NOT NULL THEN CAST(w.region AS VARCHAR) END, ',' ORDER BY w.region) AS regions_used,
  CASE WHEN count(mean) = 0 THEN 'missing_weather' WHEN count(mean) < count(*) THEN 'partial_weather' END AS missing_flags FROM f d JOIN weights w ON w.region = d.region AND {VALID} GROUP BY 1, 2"""


@query("product_weather_daily", PRODUCT_WEATHER_SQL)
def product_weather_daily(spark, sf_dir):
    """Windows per region, then means over a product's regions by the weights that hold on the day."""
    c = F.col
    rain = table(spark, sf_dir, "events").filter("event_type = 'signup'").groupBy((c("user_id") % 14).alias("region"), F.to_date("ts").alias("day"))
    rows = weather(spark, sf_dir).join(rain.agg(F.sum(c("value").cast("decimal(18,4)")).alias("rain")), ["region", "day"], "left")
    heat, frost = F.count_if(c("hi") >= 30), F.count_if(c("lo") <= 0)
    degrees = F.sum(F.when(c("mean").isNotNull(), F.greatest(c("mean") - S.gdd_base(F.lit("wheat")), F.lit(0.0))))
    of = {"temperature_min": F.min("lo"), "temperature_max": F.max("hi"), "temperature": F.avg("mean"), "precipitation": F.sum("rain"), "drought": F.sum("rain"), "heat": heat, "frost": frost, "degree": degrees}
    specs = {n: (next(a for k, a in of.items() if n.startswith(k)), days) for n, (_, days) in _WEATHER.items()}
    held = P.interval_join(P.calendar_windows(rows, ["region"], "day", specs), weights(spark), "day", ["region"])
    used = F.nullif(F.array_join(F.array_sort(F.collect_list(F.when(c("mean").isNotNull(), c("region")))).cast("array<string>"), ","), F.lit(""))
    flag = F.when(F.count("mean") == 0, "missing_weather").when(F.count("mean") < F.count("*"), "partial_weather")
    return held.groupBy("product", "day").agg(*(F.round(P.weighted_mean(c(n), c("weight")), 5).alias(n) for n in _WEATHER), used.alias("regions_used"), flag.alias("missing_flags"))


# --- trade -------------------------------------------------------------------------

#: Groups of rows whose months are totalled: flow and reporting nations (None: all).
_TRADE_GROUPS = {"export": ("export", None), "import": ("import", None), "china_import": ("import", (2,)), "major_exporter": ("export", (1, 3, 5, 7)), "major_importer": ("import", (2, 4, 6, 8))}
_MONTHS = {"_volume_1m": "volume", "_volume_3m_avg": "mean", "_volume_12m_sum": "sum", "_value_1m": "value", "_past": "past", "_period": "period"}
_TRADE_FLAGS = {
    "missing_export_volume": "export_volume_1m", "missing_import_volume": "import_volume_1m", "missing_3m_history": "export_volume_3m_avg", "missing_12m_history": "export_volume_12m_sum",
    "missing_yoy_history": "trade_yoy_change", "missing_china_import_proxy": "china_import_volume_1m", "missing_major_exporter_proxy": "major_exporter_volume_1m", "missing_major_importer_proxy": "major_importer_volume_1m",
}
#: By code number and product: sixths of a weight, and from and until when it holds.
TRADE_WEIGHTS_SQL = f"""tw AS (SELECT 'Brand#' || c AS code, p AS product, CAST(6 // (1 + (c + p) % 3) AS INTEGER) AS weight, CASE WHEN (c + p) % 5 = 1 THEN DATE '1997-01-01' ELSE DATE '1990-01-01' END AS effective_from,
  CASE WHEN p = 3 THEN DATE '1999-06-30' WHEN (c + p) % 5 = 0 THEN DATE '1998-06-30' END AS effective_to FROM (SELECT 10 * a + b AS c FROM range(1, 6) x(a), range(1, 6) y(b)), range({PRODUCTS}) r(p)),
tr AS (SELECT code, reporter, flow, period, last_day(period) AS period_end, known, CASE WHEN reporter <> 24 THEN quantity END AS volume, CASE WHEN reporter % 8 <> 3 THEN value END AS value FROM trade)"""


def trade_weights(spark) -> DataFrame:
    """The same weights as rows: 25 codes for each product."""
    c, p = F.col("c"), F.col("product")
    grid = spark.range(25 * PRODUCTS).select((10 * (1 + F.floor(F.col("id") / 5) % 5) + 1 + F.col("id") % 5).cast("int").alias("c"), F.floor(F.col("id") / 25).cast("long").alias("product"))
    until = F.when(p == 3, F.lit("1999-06-30")).when((c + p) % 5 == 0, F.lit("1998-06-30")).cast("date")
    return grid.select(F.concat(F.lit("Brand#"), c.cast("string")).alias("code"), "product", (6 / (1 + (c + p) % 3)).cast("int").alias("weight"), F.when((c + p) % 5 == 1, F.lit("1997-01-01")).otherwise(F.lit("1990-01-01")).cast("date").alias("effective_from"), until.alias("effective_to"))


def _trade_sql(probes: str) -> str:
    """Columns of ``probes`` (product, day) from all rows known then, each joined to each day. ``probes`` names a table."""
    kind = " ".join(f"WHEN grp = '{g}' THEN flow = '{flow}'" + (f" AND reporter IN ({', '.join(map(str, only))})" if only else "") for g, (flow, only) in _TRADE_GROUPS.items())
    flags = ", ".join(f"CASE WHEN {c} IS NULL THEN '{n}' END" for n, c in _TRADE_FLAGS.items())
    cases = ", ".join(f"max(CASE WHEN grp = '{g}' AND rn = 1 THEN {c} END) AS {g}_{c}" for g in _TRADE_GROUPS for c in ("period", "volume", "value"))
    windows = ", ".join(f"CASE WHEN count(CASE WHEN grp = '{g}' AND rn <= {n} THEN 1 END) = {n} THEN sum(CASE WHEN grp = '{g}' AND rn <= {n} THEN volume END) END AS {g}_{n}" for g in ("export", "import") for n in (3, 12))
    return f"""WITH el AS (SELECT g.product, g.day, t.*, w.weight FROM {probes} g JOIN tw w ON w.product = g.product AND w.effective_from <= g.day AND (w.effective_to IS NULL OR w.effective_to >= g.day) JOIN tr t ON t.code = w.code AND t.known <= g.day AND t.period_end <= g.day),
mo AS (SELECT product, day, grp, period, sum(volume * weight) / 6 AS volume, CAST(sum(value * weight) AS DOUBLE) / 6 AS value FROM el, (VALUES {", ".join(f"('{g}')" for g in _TRADE_GROUPS)}) x(grp) WHERE volume IS NOT NULL AND CASE {kind} END GROUP BY ALL),
rk AS (SELECT a.*, b.volume AS past, row_number() OVER (PARTITION BY a.product, a.day, a.grp ORDER BY a.period DESC) AS rn FROM mo a LEFT JOIN mo b ON b.product = a.product AND b.day = a.day AND b.grp = a.grp AND b.period = a.period - INTERVAL 12 MONTH),
wd AS (SELECT product, day, {cases}, {windows}, max(CASE WHEN grp = 'export' AND rn = 1 THEN past END) AS export_past, max(CASE WHEN grp = 'import' AND rn = 1 THEN past END) AS import_past FROM rk GROUP BY 1, 2),
ao AS (SELECT product, day, max(known) AS trade_as_of FROM el GROUP BY 1, 2),
aw AS (SELECT DISTINCT g.product, g.day FROM {probes} g JOIN tw w ON w.product = g.product AND w.effective_from <= g.day AND (w.effective_to IS NULL OR w.effective_to >= g.day)),
fe AS (SELECT g.product, g.day, export_period AS trade_export_period, import_period AS trade_import_period, round(export_volume, 4) AS export_volume_1m, round(export_3 / 3, 4) AS export_volume_3m_avg, round(export_12, 4) AS export_volume_12m_sum, round(import_volume, 4) AS import_volume_1m, round(import_3 / 3, 4) AS import_volume_3m_avg, round(import_12, 4) AS import_volume_12m_sum,
  round(export_volume - import_volume, 4) AS net_export_volume_1m, round(export_value, 4) AS export_value_1m, round(import_value, 4) AS import_value_1m, round(export_value / nullif(export_volume, 0), 6) AS export_unit_value, round(import_value / nullif(import_volume, 0), 6) AS import_unit_value, round(china_import_volume, 4) AS china_import_volume_1m, round(major_exporter_volume, 4) AS major_exporter_volume_1m,
  round(major_importer_volume, 4) AS major_importer_volume_1m, round(export_volume - import_volume, 4) AS trade_balance_proxy, round(CASE WHEN export_volume IS NOT NULL THEN (export_volume - export_past) / nullif(export_past, 0) ELSE (import_volume - import_past) / nullif(import_past, 0) END, 6) AS trade_yoy_change,
  trade_as_of, CAST(g.day - trade_as_of AS INTEGER) AS trade_lag_days, aw.day IS NOT NULL AS weighted FROM (SELECT DISTINCT product, day FROM {probes}) g LEFT JOIN wd ON wd.product = g.product AND wd.day = g.day LEFT JOIN ao ON ao.product = g.product AND ao.day = g.day LEFT JOIN aw ON aw.product = g.product AND aw.day = g.day)
SELECT * EXCLUDE (weighted), CASE WHEN NOT weighted THEN 'no_product_trade_code_weights' WHEN trade_as_of IS NULL THEN 'no_trade_flows' ELSE nullif(concat_ws(',', {flags}), '') END AS trade_flags FROM fe"""


def trade_as_of(spark, sf_dir, probes: DataFrame) -> DataFrame:
    """``probes`` (product, day), once each, with volumes, values, windows and yearly change of what was known on the day.

    A row counts from the day on which it is known and its month is over. A month shows
    with those of its rows that count, so its total grows while reporters publish, and
    only under weights that hold on the day.
    """
    c = F.col
    rows = trade(spark, sf_dir).withColumns({"volume": F.when(c("reporter") != 24, c("quantity")), "value": F.when(c("reporter") % 8 != 3, c("value")), "since": F.greatest("known", F.last_day("period"))})
    groups = F.array_compact(F.array(*(F.when((c("flow") == flow) & (c("reporter").isin(*only) if only else F.lit(True)), F.lit(g)) for g, (flow, only) in _TRADE_GROUPS.items())))
    w, keys = trade_weights(spark), ["product", "grp"]
    changes = B.weighted_changes(rows.withColumn("grp", F.explode(groups)), w, ["code"], keys, "period", c("since"), c("volume"), c("value"))
    steps = B.newest_periods(changes, keys, "period")
    days = probes.select("product", "day").distinct()
    grid = days.withColumn("grp", F.explode(F.array(*map(F.lit, _TRADE_GROUPS))))
    found = P.asof_backward(grid, steps, keys, "day", "at", ["period", "volume", "value", "mean", "sum", "past"])
    sixth = {s: c(f"found.{n}") if n == "period" else c(f"found.{n}").cast("double") / 6 for s, n in _MONTHS.items()}
    wide = found.groupBy("product", "day").agg(*_pivoted("grp", {g: g for g in _TRADE_GROUPS}, sixth))
    known = B.known_through(rows, w, ["code"], ["product"], days, "day", c("since"), c("known")).withColumnRenamed("known", "trade_as_of")
    holds = days.join(w, "product").filter("effective_from <= day and (effective_to is null or effective_to >= day)").select("product", "day").distinct().withColumn("weighted", F.lit(True))
    wide = wide.join(known, ["product", "day"], "left").join(holds, ["product", "day"], "left")
    out, into = c("export_volume_1m"), c("import_volume_1m")
    yoy = lambda g: S.safe_ratio(c(f"{g}_volume_1m") - c(f"{g}_past"), c(f"{g}_past"))
    made = wide.select(
        "product", "day", c("export_period").alias("trade_export_period"), c("import_period").alias("trade_import_period"), *(F.round(f"{g}{s}", 4).alias(f"{g}{s}") for g in ("export", "import") for s in list(_MONTHS)[:4]),
        *(F.round(f"{g}_volume_1m", 4).alias(f"{g}_volume_1m") for g in list(_TRADE_GROUPS)[2:]), *(F.round(out - into, 4).alias(n) for n in ("net_export_volume_1m", "trade_balance_proxy")),
        F.round(S.safe_ratio(c("export_value_1m"), out), 6).alias("export_unit_value"), F.round(S.safe_ratio(c("import_value_1m"), into), 6).alias("import_unit_value"),
        F.round(F.when(out.isNotNull(), yoy("export")).otherwise(yoy("import")), 6).alias("trade_yoy_change"), "trade_as_of", F.date_diff("day", "trade_as_of").alias("trade_lag_days"), "weighted",
    )
    flags = S.true_flags({n: c(x).isNull() for n, x in _TRADE_FLAGS.items()})
    return made.withColumn("trade_flags", F.when(c("weighted").isNull(), "no_product_trade_code_weights").when(c("trade_as_of").isNull(), "no_trade_flows").otherwise(flags)).drop("weighted")


_TRADE_GRID = f"(SELECT CAST(p.product AS BIGINT) AS product, CAST(d.d AS DATE) AS day FROM range({PRODUCTS}) p(product), (SELECT unnest(generate_series(DATE '1991-12-15', DATE '2001-01-15', INTERVAL 1 MONTH)) AS d) d)"


@query("product_trade_daily", f"WITH {TRADE_SQL}, {TRADE_WEIGHTS_SQL}, gr AS {_TRADE_GRID}, tx AS ({_trade_sql('gr')}) SELECT * FROM tx")
def product_trade_daily(spark, sf_dir):
    days = spark.range(PRODUCTS).select(F.col("id").alias("product"), F.explode(F.expr("sequence(date '1991-12-15', date '2001-01-15', interval 1 month)")).alias("day"))
    return trade_as_of(spark, sf_dir, days)


# --- supply and demand -------------------------------------------------------------

_METRICS = {"1-URGENT": "production", "2-HIGH": "consumption", "3-MEDIUM": "stocks", "4-NOT SPECIFIED": "exports", "5-LOW": "imports"}
SUPPLY_SQL = f"""{BALANCE_SQL}, basket(country, w) AS (VALUES {", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in BASKET.items())}),
held AS (SELECT b.*, w FROM balance b JOIN basket USING (country)),
changes AS (SELECT m.metric, m.known, b.country, b.w FROM (SELECT DISTINCT metric, known FROM held) m, basket b),
levels AS (SELECT c.metric, c.known, sum(c.w * h.value) / sum(c.w) AS value, sum(c.w) AS there, count(*) AS countries FROM changes c ASOF JOIN held h ON h.metric = c.metric AND h.country = c.country AND h.known <= c.known GROUP BY 1, 2),
moves AS (SELECT metric, known, countries, CASE WHEN there >= {_LEAST} THEN value END AS value, CASE WHEN there >= {_LEAST} THEN value END - lag(CASE WHEN there >= {_LEAST} THEN value END) OVER (PARTITION BY metric ORDER BY known) AS revision FROM levels)"""


def _supply_sql(probes: str) -> str:
    """Columns of ``probes`` (day) with the basket levels known then."""
    return f"""SELECT *, round(stocks / nullif(consumption, 0), 6) AS stock_to_use_ratio, round(stocks / nullif(consumption, 0) - (stocks - stocks_revision) / nullif(consumption - consumption_revision, 0), 5) AS stock_to_use_revision,
  CAST(day - supply_as_of AS INTEGER) AS supply_lag_days, CASE WHEN production IS NULL OR consumption IS NULL OR stocks IS NULL THEN 'insufficient_basket' END AS supply_flags FROM (
  SELECT g.day, max(m.known) AS supply_as_of, min(m.countries) AS fewest_countries, {_cases("m.metric", _METRICS, {"": "round(m.value, 4)", "_revision": "round(m.revision, 4)"})}
  FROM (SELECT p.day, x.metric FROM {probes} p, (SELECT DISTINCT metric FROM moves) x) g ASOF JOIN moves m ON m.metric = g.metric AND m.known <= g.day GROUP BY 1)"""


def supply_as_of(spark, sf_dir, probes: DataFrame) -> DataFrame:
    """``probes`` (day) with each metric's weighted basket and its change against the level before.

    Levels are worked out once per day on which a country's value becomes known; a basket
    under the least weight has no level.
    """
    c = F.col
    held = balance(spark, sf_dir).filter(c("country").isin(*BASKET))
    w = F.element_at(F.create_map(*(F.lit(x) for kv in BASKET.items() for x in kv)), c("country"))
    changes = held.select("metric", "known").distinct().select("metric", c("known").alias("at"), F.explode(F.array(*map(F.lit, BASKET))).alias("country"))
    found = P.asof_backward(changes, held, ["metric", "country"], "at", "known", ["value"]).filter("found is not null").withColumn("w", w)
    levels = found.groupBy("metric", c("at").alias("known")).agg((F.sum(c("w") * c("found.value")) / F.sum("w")).alias("level"), F.sum("w").alias("there"), F.count("*").alias("countries"))
    levels = levels.withColumn("value", F.when(c("there") >= _LEAST, c("level")))
    moves = levels.withColumn("revision", c("value") - F.lag("value").over(Window.partitionBy("metric").orderBy("known")))
    grid = probes.withColumn("metric", F.explode(F.array(*map(F.lit, _METRICS))))
    got = P.asof_backward(grid, moves, ["metric"], "day", "known", ["value", "revision", "countries"]).filter("found is not null")
    wide = got.groupBy("day").agg(F.max("found.found_at").alias("supply_as_of"), F.min("found.countries").alias("fewest_countries"), *_pivoted("metric", _METRICS, {"": F.round("found.value", 4), "_revision": F.round("found.revision", 4)}))
    before = S.safe_ratio(c("stocks") - c("stocks_revision"), c("consumption") - c("consumption_revision"))
    ratio = S.safe_ratio(c("stocks"), c("consumption"))
    return wide.withColumns({
        "stock_to_use_ratio": F.round(ratio, 6), "stock_to_use_revision": F.round(ratio - before, 5), "supply_lag_days": F.date_diff("day", "supply_as_of"),
        "supply_flags": F.when(c("production").isNull() | c("consumption").isNull() | c("stocks").isNull(), "insufficient_basket"),
    })


@query("basket_supply_daily", f"WITH {SUPPLY_SQL} {_supply_sql('(SELECT CAST(unnest(generate_series(DATE ' + repr('1997-01-10') + ', DATE ' + repr('1999-12-10') + ', INTERVAL 1 MONTH)) AS DATE) AS day)')}")
def basket_supply_daily(spark, sf_dir):
    return supply_as_of(spark, sf_dir, spark.range(1).select(F.explode(F.expr("sequence(date '1997-01-10', date '1999-12-10', interval 1 month)")).alias("day")))


# --- the wide row ------------------------------------------------------------------

_CURRENCIES = {"click": "click", "signup": "signup", "error": "error"}
_ENERGY = {str(k): f"energy_{k}" for k in range(4)}
_BENCHMARKS = {t: f"benchmark_{t.lower()}" for t in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")}
#: Months by which the tables of orders lie before the events.
_BEFORE = 312
_DAYS = "SELECT DISTINCT day FROM bars"
FX_SQL = f"""fxs AS (SELECT currency, rate_day, CAST(rate AS DOUBLE) AS rate, CAST(rate - lag(rate) OVER o AS DOUBLE) AS delta_abs, round(CAST(rate - lag(rate) OVER o AS DOUBLE) / nullif(CAST(lag(rate) OVER o AS DOUBLE), 0), 6) AS delta_pct FROM rates WINDOW o AS (PARTITION BY currency ORDER BY rate_day)),
fx AS (SELECT g.day, max(s.rate_day) AS fx_as_of, {_cases("s.currency", _CURRENCIES, {"_rub": "s.rate", "_rub_delta_abs_1d": "s.delta_abs", "_rub_delta_pct_1d": "s.delta_pct"})}
  FROM (SELECT day, currency FROM days, (SELECT DISTINCT currency FROM rates)) g ASOF JOIN fxs s ON s.currency = g.currency AND s.rate_day <= g.day GROUP BY 1)"""
ENERGY_SQL = f"""es AS (SELECT CAST(user_id % 4 AS VARCHAR) AS series, CAST(ts AS DATE) AS ad, CAST(arg_max(CAST(value AS DECIMAL(18,6)), (ts, event_id)) AS DOUBLE) AS value FROM events WHERE event_type = 'error' GROUP BY 1, 2),
eg AS (SELECT day, series FROM days, (SELECT DISTINCT series FROM es)),
ej AS (SELECT g.day, g.series, a.ad, a.value, b.value AS b, c.value AS c FROM eg g ASOF LEFT JOIN es a ON a.series = g.series AND a.ad <= g.day ASOF LEFT JOIN es b ON b.series = g.series AND b.ad <= g.day - INTERVAL 1 DAY ASOF LEFT JOIN es c ON c.series = g.series AND c.ad <= g.day - INTERVAL 7 DAY),
energy AS (SELECT day, max(ad) AS energy_as_of, {_cases("series", _ENERGY, {"": "value", "_as_of": "ad", "_delta_1d": "round(value - b, 6)", "_delta_7d": "round(value - c, 6)"})} FROM ej GROUP BY 1)"""

BENCHMARK_SQL = f"""{MONTHLY_SQL.replace("s AS (", "bm AS (", 1)},
bg AS (SELECT d.day, m.series FROM (SELECT DISTINCT past AS day FROM base) d, (SELECT DISTINCT series FROM bm) m),
bj AS (SELECT g.day, g.series, a.ad, CAST(a.value AS DOUBLE) AS value, CAST(b.value AS DOUBLE) AS b, CAST(c.value AS DOUBLE) AS c FROM bg g ASOF LEFT JOIN bm a ON a.series = g.series AND a.ad <= g.day ASOF LEFT JOIN bm b ON b.series = g.series AND b.ad <= g.day - INTERVAL 1 MONTH ASOF LEFT JOIN bm c ON c.series = g.series AND c.ad <= g.day - INTERVAL 3 MONTH),
bx AS (SELECT day, max(ad) AS benchmark_as_of, {_cases("series", _BENCHMARKS, {"": "value", "_as_of": "ad", "_delta_1m": "round(value - b, 6)", "_delta_3m": "round(value - c, 6)"})} FROM bj GROUP BY 1)"""


def fx_group(spark, sf_dir, days: DataFrame) -> DataFrame:
    """Per day each currency's rate and its change against the rate before."""
    r = P.previous_change(rates(spark, sf_dir), ["currency"], "rate_day", "rate")
    probes = days.withColumn("currency", F.explode(F.array(*map(F.lit, _CURRENCIES))))
    found = P.asof_backward(probes, r, ["currency"], "day", "rate_day", ["rate", "delta_abs", "delta_pct"]).filter("found is not null")
    columns = {"_rub": F.col("found.rate").cast("double"), "_rub_delta_abs_1d": F.col("found.delta_abs"), "_rub_delta_pct_1d": F.col("found.delta_pct")}
    return found.groupBy("day").agg(F.max("found.found_at").alias("fx_as_of"), *_pivoted("currency", _CURRENCIES, columns))


def energy_group(spark, sf_dir, days: DataFrame) -> DataFrame:
    """Per day each energy series' last value, its day, and its changes against those a day and a week before."""
    day = F.col("day")
    e = events(spark, sf_dir).filter("event_type = 'error'").withColumn("series", (F.col("user_id") % 4).cast("string"))
    level = F.struct(F.col("last").cast("double").alias("value"), F.col("utc_day").alias("at"))
    s = P.daily_bar(e, ["series"], "utc_day", "ts", "value", "event_id").select("series", F.col("utc_day").alias("at"), level.alias("level"))
    probes = days.withColumn("series", F.explode(F.array(*map(F.lit, _ENERGY))))
    got = P.asof_offsets(probes, s, ["series"], "day", "at", "level", {"now": day, "before": F.date_sub(day, 1), "week": F.date_sub(day, 7)})
    change = lambda past: F.round(F.col("now.value") - F.col(f"{past}.value"), 6)
    columns = {"": F.col("now.value"), "_as_of": F.col("now.at"), "_delta_1d": change("before"), "_delta_7d": change("week")}
    return got.groupBy("day").agg(F.max("now.at").alias("energy_as_of"), *_pivoted("series", _ENERGY, columns))


def benchmark_group(spark, sf_dir, days: DataFrame) -> DataFrame:
    """Per day each monthly series' last value, its month, and its changes against those one and three months before."""
    day, now = F.col("day"), F.col("now.value")
    s = monthly(spark, sf_dir).select("series", "at", F.struct(F.col("value").cast("double").alias("value"), "at").alias("level"))
    probes = days.withColumn("series", F.explode(F.array(*map(F.lit, _BENCHMARKS))))
    got = P.asof_offsets(probes, s, ["series"], "day", "at", "level", {"now": day, "month": F.add_months(day, -1), "quarter": F.add_months(day, -3)})
    columns = {"": now, "_as_of": F.col("now.at"), "_delta_1m": F.round(now - F.col("month.value"), 6), "_delta_3m": F.round(now - F.col("quarter.value"), 6)}
    return got.groupBy("day").agg(F.max("now.at").alias("benchmark_as_of"), *_pivoted("series", _BENCHMARKS, columns))


_NEWS = (
    *(f"{c}_{n}d" for c in ("articles", "events") for n in (1, 7, 30)), "bullish_7d", "bearish_7d", "mixed_7d",
    *(f"{r.name}_30d" for r in RULES), "sentiment", "as_of", "missing_flags",
)
_FLAGS = {"missing_fx": "click_rub", "missing_energy": "energy_0", "missing_benchmark": "benchmark_economy", "missing_weather": "weather_temperature_7d_mean", "missing_news": "news_events_30d", "missing_trade": "export_volume_1m", "missing_supply": "production"}
_CAL_SQL = ORACLE["calendar"].replace("SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders", "SELECT DISTINCT CAST(ts + INTERVAL 3 HOUR AS DATE) AS day FROM events WHERE event_type IN ('purchase', 'view')")
_WIDE_SQL = f"""WITH {BARS_SQL}, {RATES_SQL}, days AS ({_DAYS}), {FX_SQL}, {ENERGY_SQL}, {TRADE_SQL}, {TRADE_WEIGHTS_SQL}, {SUPPLY_SQL},
base AS (SELECT product, day, price_observations, price_first, price_last, price_min, price_max, price_delta_abs_1d, rolling_mean_3, rolling_mean_7, rolling_std_7, CASE WHEN price_observations > 1 THEN round(price_last - price_first, 6) END AS price_intraday_abs, CAST(day - INTERVAL {_BEFORE} MONTH AS DATE) AS past FROM ({ORACLE["product_daily"]})),
wx AS (SELECT product, day, {", ".join(f"{n} AS weather_{n}" for n in _WEATHER)}, regions_used AS weather_regions_used, missing_flags AS weather_flags FROM ({PRODUCT_WEATHER_SQL})),
nx AS (SELECT product AS letter, day, {", ".join(f"{n} AS news_{n}" for n in _NEWS)} FROM ({ORACLE["news_daily"]})),
pp AS (SELECT DISTINCT product % 4 AS product, past AS day FROM base),
tx AS ({_trade_sql("pp")}),
sx AS ({_supply_sql("(SELECT DISTINCT past AS day FROM base)")}),
{BENCHMARK_SQL},
cal AS ({_CAL_SQL}),
wide AS (SELECT base.*, cal.* EXCLUDE (day), fx.* EXCLUDE (day), energy.* EXCLUDE (day), bx.* EXCLUDE (day), wx.* EXCLUDE (product, day), nx.* EXCLUDE (letter, day), tx.* EXCLUDE (product, day), sx.* EXCLUDE (day)
FROM base LEFT JOIN cal USING (day) LEFT JOIN fx USING (day) LEFT JOIN energy USING (day) LEFT JOIN wx ON wx.product = base.product % 4 AND wx.day = base.day LEFT JOIN nx ON nx.letter = chr(CAST(65 + base.product % 3 AS INTEGER)) AND nx.day = base.day
LEFT JOIN tx ON tx.product = base.product % 4 AND tx.day = base.past LEFT JOIN sx ON sx.day = base.past LEFT JOIN bx ON bx.day = base.past)
SELECT * EXCLUDE (past), nullif(concat_ws(',', {", ".join(f"CASE WHEN {c} IS NULL THEN '{n}' END" for n, c in _FLAGS.items())}), '') AS missing_flags FROM wide"""


@query("product_features", _WIDE_SQL)
def product_features(spark, sf_dir):
    """One row per product and price day with the groups price, calendar, rates, energy, benchmarks, weather, news, trade and balances.

    Benchmarks, trade and balances are as known 26 years before, where the order tables have rows.
    Groups are joined by day, or by product and day; each is one row per such key, so
    that the joins neither multiply rows nor move more than the product days.
    """
    c = F.col
    base = QUERIES["product_daily"](spark, sf_dir).select("product", "day", "price_observations", "price_first", "price_last", "price_min", "price_max", "price_delta_abs_1d", "rolling_mean_3", "rolling_mean_7", "rolling_std_7")
    base = base.withColumns({
        "price_intraday_abs": F.when(c("price_observations") > 1, F.round(c("price_last") - c("price_first"), 6)), "past": F.add_months("day", -_BEFORE),
        "part": c("product") % 4, "letter": F.char((65 + c("product") % 3).cast("int")),
    })
    price_days = bars(spark, sf_dir).select("product", "day")
    days = price_days.select("day").distinct()
    past = price_days.select((c("product") % 4).alias("product"), F.add_months("day", -_BEFORE).alias("day")).distinct()
    wx = product_weather_daily(spark, sf_dir).select(c("product").alias("part"), "day", *(c(n).alias(f"weather_{n}") for n in _WEATHER), c("regions_used").alias("weather_regions_used"), c("missing_flags").alias("weather_flags"))
    nx = QUERIES["news_daily"](spark, sf_dir).select(c("product").alias("letter"), "day", *(c(n).alias(f"news_{n}") for n in _NEWS))
    tx = trade_as_of(spark, sf_dir, past).withColumnsRenamed({"product": "part", "day": "past"})
    sx = supply_as_of(spark, sf_dir, past.select("day").distinct()).withColumnRenamed("day", "past")
    bx = benchmark_group(spark, sf_dir, past.select("day").distinct()).withColumnRenamed("day", "past")
    wide = base.join(fx_group(spark, sf_dir, days), "day", "left").join(energy_group(spark, sf_dir, days), "day", "left")
    wide = wide.join(wx, ["part", "day"], "left").join(nx, ["letter", "day"], "left").join(tx, ["part", "past"], "left").join(sx, ["past"], "left").join(bx, ["past"], "left")
    wide = wide.withColumns(S.calendar_features(c("day")))
    return wide.withColumn("missing_flags", S.true_flags({n: c(x).isNull() for n, x in _FLAGS.items()})).drop("past", "part", "letter")


@query("features_export", _WIDE_SQL)
def features_export(spark, sf_dir):
    """The wide row written as Parquet and CSV, both checked by the manifest, and the Parquet read back."""
    rows = product_features(spark, sf_dir)
    files = E.write_dataset(rows, f"{scratch_root(spark)}/tidemark/features-{uuid.uuid4().hex}", ["product", "day"])
    E.checked_manifest(spark, files, rows.schema, "product", "day", "missing_flags")
    return spark.read.schema(rows.schema).parquet(files["parquet"])


#: The columns of the scan: who, when, as of when, and some of each group.
_SCANNED = ["product_code", "product_name", "day", "as_of", "price_last", "price_delta_abs_1d", "calendar_day_of_week", "click_rub", "energy_0", "weather_temperature_7d_mean", "news_articles_30d", "news_events_30d", "export_volume_1m", "benchmark_economy", "missing_flags"]
_RANGE = ("2024-01-05", "2024-01-20")
_AS_OF = ("fx_as_of", "energy_as_of", "news_as_of")


@query("feature_scan", f"""SELECT {", ".join(_SCANNED)} FROM (SELECT f.*, 'P' || lpad(CAST(f.product AS VARCHAR), 5, '0') AS product_code, p_name AS product_name, greatest({", ".join(_AS_OF)}) AS as_of
FROM ({_WIDE_SQL}) f JOIN part ON p_partkey = f.product) WHERE day BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}'""")
def feature_scan(spark, sf_dir):
    """The wide row of a range of days with the parts' names, its latest as-of day, and a projection."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product"), F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 5, "0")).alias("product_code"), F.col("p_name").alias("product_name"))
    rows = product_features(spark, sf_dir).withColumn("as_of", F.greatest(*_AS_OF))
    return E.scan_features(rows, parts, "product", "day", _SCANNED, *_RANGE)


_CHECKED_SQL = """SELECT user_id % 20 AS product, CASE WHEN event_id % 500 <> 3 THEN CAST(ts AS DATE) END AS day FROM events"""


def _checks_sql(rows: str, subject: str) -> str:
    faults = {"has_rows": ("sum(n)", "sum(n) = 0"), "entity_present": ("sum(n) FILTER (product IS NULL)", None), "day_present": ("sum(n) FILTER (day IS NULL)", None), "keys_unique": ("count(*) FILTER (product IS NOT NULL AND day IS NOT NULL AND n > 1)", None)}
    return " UNION ALL ".join(
        f"SELECT '{subject}' AS subject, '{check}' AS \"check\", CASE WHEN {fault or f'coalesce({n}, 0) > 0'} THEN 'fail' ELSE 'pass' END AS status, CAST(coalesce({n}, 0) AS BIGINT) AS n FROM (SELECT product, day, count(*) AS n FROM ({rows}) GROUP BY 1, 2)"
        for check, (n, fault) in faults.items()
    )


@query("export_checks", f"{_checks_sql(ORACLE['daily_last'], 'bars')} UNION ALL {_checks_sql(_CHECKED_SQL, 'events')}")
def export_checks(spark, sf_dir):
    """What an export would check, of rows by product and day (one each) and of the events that they come from (many, some without a day)."""
    raw = events(spark, sf_dir).select((F.col("user_id") % 20).alias("product"), F.when(F.col("event_id") % 500 != 3, F.to_date("ts")).alias("day"))
    some = {"bars": QUERIES["daily_last"](spark, sf_dir), "events": raw}
    parts = [E.row_checks(rows, "product", "day").select(F.lit(name).alias("subject"), "*") for name, rows in some.items()]
    return parts[0].unionByName(parts[1])
