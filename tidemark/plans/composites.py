"""Composite pipelines and selections: weather, trade and balance features, audits, export."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import bitemporal as B
from tidemark.operators import ingest as I
from tidemark.operators import pointintime as P
from tidemark.operators import scope as C
from tidemark.operators import selection as V
from tidemark.plans.registry import ORACLE, query
from tidemark.plans.series import WEATHER_SQL, product_daily, weather
from tidemark.plans.weighted import BALANCE_SQL, BASKET, TRADE_SQL, balance, trade
from tidemark.session import scratch_root, table
from tidemark.sources import export as E

_BASKET = "basket(country, w) AS (VALUES " + ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in BASKET.items()) + ")"


@query("weather_daily", f"""WITH {WEATHER_SQL}, b AS (SELECT min(day) AS a, max(day) AS z FROM weather), spine AS (SELECT r.region, CAST(d.d AS DATE) AS day FROM (SELECT DISTINCT region FROM weather) r, (SELECT unnest(generate_series((SELECT a FROM b), (SELECT z FROM b), INTERVAL 1 DAY)) AS d) d),
s AS (SELECT spine.region, spine.day, mean, hi, lo FROM spine LEFT JOIN weather x ON x.region = spine.region AND x.day = spine.day)
SELECT region, day, round(avg(mean) OVER w7, 10) AS mean_7, max(hi) OVER w7 AS hi_7, min(lo) OVER w30 AS lo_30, count(mean) OVER w7 AS days_7, CASE WHEN count(mean) OVER w7 < 7 THEN 'incomplete_7d' END AS missing_flags FROM s
WINDOW w7 AS (PARTITION BY region ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), w30 AS (PARTITION BY region ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""")
def weather_daily(spark, sf_dir):
    x = weather(spark, sf_dir)
    bounds = x.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    spine = P.date_spine(x.select("region").distinct(), bounds).join(x, ["region", "day"], "left")
    specs = {"mean_7": (F.avg("mean"), 7), "hi_7": (F.max("hi"), 7), "lo_30": (F.min("lo"), 30), "days_7": (F.count("mean"), 7)}
    out = P.calendar_windows(spine, ["region"], "day", specs)
    return out.select("region", "day", F.round("mean_7", 10).alias("mean_7"), "hi_7", "lo_30", "days_7", S.true_flags({"incomplete_7d": F.col("days_7") < 7}).alias("missing_flags"))


@query("trade_daily", f"""WITH {TRADE_SQL}, days AS (SELECT CAST(unnest(generate_series(DATE '1996-01-15', DATE '2001-01-15', INTERVAL 1 MONTH)) AS DATE) AS day),
k AS (SELECT flow, day, period, sum(quantity) AS v, count(*) AS n FROM trade JOIN days ON known <= day AND last_day(period) <= day GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY flow, day ORDER BY period DESC) AS rn FROM k)
SELECT flow, day, max(CASE WHEN rn = 1 THEN period END) AS last_period, max(CASE WHEN rn = 1 THEN v END) AS volume, CASE WHEN count(CASE WHEN rn <= 3 THEN 1 END) = 3 THEN round(sum(CASE WHEN rn <= 3 THEN v END) / 3, 4) END AS mean_3, CASE WHEN count(CASE WHEN rn <= 12 THEN 1 END) = 12 THEN sum(CASE WHEN rn <= 12 THEN v END) END AS sum_12,
  max(CASE WHEN rn = 1 THEN (SELECT v FROM k p WHERE p.flow = r.flow AND p.day = r.day AND p.period = r.period - INTERVAL 12 MONTH) END) AS past FROM r GROUP BY 1, 2""")
def trade_daily(spark, sf_dir):
    """Monthly flows as known on each day of a month grid: a month counts with the rows known by then.

    Totals are swept once over the days on which something becomes known, and looked up as of each day.
    """
    c = F.col
    changes = B.weighted_changes(trade(spark, sf_dir), None, [], ["flow"], "period", F.greatest("known", F.last_day("period")), c("quantity"), c("value"))
    steps = B.newest_periods(changes, ["flow"], "period")
    days = changes.select("flow").distinct().select("flow", F.explode(F.expr("sequence(date '1996-01-15', date '2001-01-15', interval 1 month)")).alias("day"))
    got = P.asof_backward(days, steps, ["flow"], "day", "at", ["period", "volume", "mean", "sum", "past"]).filter("found is not null")
    number = lambda n: c(f"found.{n}").cast("double")
    return got.select("flow", "day", c("found.period").alias("last_period"), number("volume").alias("volume"), F.round(number("mean"), 4).alias("mean_3"), number("sum").alias("sum_12"), number("past").alias("past"))


#: Entities, metrics, commodities, families and weights; since and until when.
_MAPPINGS = [
    (0, "production", "1-URGENT", "oil", 0.6, "1990-01-01", None), (0, "production", "2-HIGH", "oil", 0.4, "1990-01-01", None), (0, "stock_ratio", "3-MEDIUM", "oil", 1.0, "1990-01-01", None),
    (1, "production", "3-MEDIUM", "grain", 1.0, "1990-01-01", "1998-12-31"), (1, "stock_ratio", "3-MEDIUM", "grain", 1.0, "1990-01-01", None), (1, "production", "4-NOT SPECIFIED", "grain", 0.5, "1997-01-01", None),
    (2, "production", "2-HIGH", "oil", 0.5, "1990-01-01", None), (2, "production", "4-NOT SPECIFIED", "rare", 0.5, "1990-01-01", None), (2, "stock_ratio", "5-LOW", "oil", 1.0, "1990-01-01", None),
]
#: Entities, families, metrics (None: all), countries, weights and the least share that has to be known.
_BASKETS = [
    (0, "oil", "production", "NATION_0", 0.5, 0.75, "1990-01-01", None), (0, "oil", "production", "NATION_1", 0.3, 0.7, "1990-01-01", None), (0, "oil", "production", "NATION_2", 0.2, 0.5, "1990-01-01", None),
    (2, "oil", None, "NATION_3", 0.9, 0.5, "1990-01-01", None), (2, "oil", None, "NATION_4", 0.1, 0.5, "1990-01-01", "1996-06-30"), (2, "oil", None, "NATION_9", 0.4, 0.5, "1990-01-01", None),
    (2, "rare", "production", "NATION_5", 0.4, 0.6, "1996-01-01", None), (2, "rare", "production", "NATION_NONE", 0.6, 0.6, "1996-01-01", "1998-01-31"), (2, "rare", "production", "NATION_6", 0.0, 0.9, "1996-01-01", None),
]
_ADDITIVE, _RATIO, _ORDER = ("production",), "stock_ratio", ("marketing_year", "report_month", "id")


def _literal(rows: list[tuple]) -> str:
    text = lambda v: "NULL" if v is None else f"DATE '{v}'" if isinstance(v, str) and v[4:5] == "-" and v[:4].isdigit() else f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)
    return ", ".join(f"({', '.join(map(text, r))})" for r in rows)


#: Reported rows; nation 24 reports the world's urgent ones, from 1995 on; nation 9 gives no values.
SELECT_SQL = f"""{BALANCE_SQL}, obs AS (SELECT metric AS commodity, CASE WHEN country = 'NATION_24' AND metric = '1-URGENT' AND marketing_year >= 1995 THEN 'WLD' ELSE country END AS country, marketing_year, report_month, value, known, marketing_year * 100 + report_month AS id FROM balance WHERE country <> 'NATION_9'),
mp(entity, metric, commodity, family, weight, effective_from, effective_to) AS (VALUES {_literal(_MAPPINGS)}), bk(entity, family, scope, country, share, least, effective_from, effective_to) AS (VALUES {_literal(_BASKETS)}),
dd AS (SELECT CAST(unnest(generate_series(DATE '1992-02-20', DATE '1999-12-20', INTERVAL 5 MONTH)) AS DATE) AS day), pr AS (SELECT DISTINCT entity, metric, day, day AS known_by FROM mp, dd)"""


def _selection_sql(n: str, probes: str) -> str:
    """CTEs that end in ``sel_n``: every row known by every probe's day, ranked."""
    return f"""ac_{n} AS (SELECT p.*, m.commodity, m.family, m.weight FROM {probes} p JOIN mp m ON m.entity = p.entity AND m.metric = p.metric AND m.effective_from <= p.day AND (m.effective_to IS NULL OR m.effective_to >= p.day)),
kn_{n} AS (SELECT a.*, o.country, o.value, o.known, o.marketing_year, o.report_month, o.id, row_number() OVER (PARTITION BY a.entity, a.metric, a.day, a.commodity, o.country ORDER BY o.known DESC, o.marketing_year DESC, o.report_month DESC, o.id DESC) AS rn, row_number() OVER (PARTITION BY a.entity, a.metric, a.day, a.commodity ORDER BY o.known DESC, o.marketing_year DESC, o.report_month DESC, o.id DESC, o.country DESC) AS ra
  FROM ac_{n} a JOIN obs o ON o.commodity = a.commodity AND o.known <= a.known_by),
ba_{n} AS (SELECT a.entity, a.metric, a.day, a.commodity, b.country, b.share, b.least, b.scope FROM ac_{n} a JOIN bk b ON b.entity = a.entity AND b.family = a.family AND b.effective_from <= a.day AND (b.effective_to IS NULL OR b.effective_to >= a.day) AND b.share > 0),
pt_{n} AS (SELECT k.entity, k.metric, k.day, k.known_by, k.commodity, any_value(k.weight) AS weight, max(CASE WHEN k.rn = 1 AND k.country = 'WLD' THEN (k.known, k.marketing_year, k.report_month, k.id, k.country, k.value) END) AS world, max(CASE WHEN k.ra = 1 THEN (k.known, k.marketing_year, k.report_month, k.id, k.country, k.value) END) AS latest,
  (SELECT sum(share) FROM ba_{n} b WHERE b.entity = k.entity AND b.metric = k.metric AND b.day = k.day AND b.commodity = k.commodity AND (scope IS NULL OR scope = k.metric)) AS total, (SELECT max(least) FROM ba_{n} b WHERE b.entity = k.entity AND b.metric = k.metric AND b.day = k.day AND b.commodity = k.commodity AND (scope IS NULL OR scope = k.metric)) AS least,
  (SELECT bool_or(scope IS NOT NULL) FROM ba_{n} b WHERE b.entity = k.entity AND b.metric = k.metric AND b.day = k.day AND b.commodity = k.commodity) AS scoped FROM kn_{n} k GROUP BY 1, 2, 3, 4, 5),
bv_{n} AS (SELECT k.entity, k.metric, k.day, k.commodity, sum(share) AS there, sum(share * value) / sum(share) AS mean, max((k.known, k.marketing_year, k.report_month, k.id, k.country, k.value)) AS last FROM kn_{n} k JOIN ba_{n} b ON b.entity = k.entity AND b.metric = k.metric AND b.day = k.day AND b.commodity = k.commodity AND b.country = k.country WHERE k.rn = 1 AND (scope IS NULL OR scope = k.metric) GROUP BY 1, 2, 3, 4),
mo_{n} AS (SELECT p.*, v.there, v.mean, v.last, CASE WHEN world IS NOT NULL THEN 'world' WHEN total IS NOT NULL AND p.metric <> 'production' THEN 'none' WHEN total IS NOT NULL AND there / total >= least - 1e-9 THEN CASE WHEN there < total - 1e-9 THEN 'partial' ELSE 'basket' END WHEN total IS NOT NULL THEN 'insufficient' WHEN p.metric = 'stock_ratio' AND scoped THEN 'none' ELSE 'latest' END AS mode
  FROM pt_{n} p LEFT JOIN bv_{n} v ON v.entity = p.entity AND v.metric = p.metric AND v.day = p.day AND v.commodity = p.commodity),
us_{n} AS (SELECT *, CASE mode WHEN 'world' THEN world[6] WHEN 'latest' THEN latest[6] WHEN 'insufficient' THEN NULL ELSE mean END AS v, CASE mode WHEN 'world' THEN world WHEN 'latest' THEN latest WHEN 'insufficient' THEN NULL ELSE last END AS used FROM mo_{n} WHERE mode <> 'none'),
sel_{n} AS (SELECT entity, metric, day, known_by, CASE WHEN NOT bool_or(mode = 'insufficient') THEN sum(v * weight) / sum(CASE WHEN v IS NOT NULL THEN weight END) END AS value, CASE WHEN NOT bool_or(mode = 'insufficient') THEN max(used) END AS last, string_agg(DISTINCT mode, ',' ORDER BY mode) AS mode FROM us_{n} GROUP BY 1, 2, 3, 4)"""


def selection_config(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Probes, observations, mappings and baskets of the selection queries."""
    c = F.col
    days = lambda df: df.withColumns({n: c(n).cast("date") for n in ("effective_from", "effective_to")})
    mappings = days(spark.createDataFrame(_MAPPINGS, "entity int, metric string, commodity string, family string, weight double, effective_from string, effective_to string"))
    baskets = days(spark.createDataFrame(_BASKETS, "entity int, family string, metric string, country string, weight double, least double, effective_from string, effective_to string"))
    world = (c("country") == "NATION_24") & (c("metric") == "1-URGENT") & (c("marketing_year") >= 1995)
    rows = balance(spark, sf_dir).filter("country <> 'NATION_9'").select(c("metric").alias("commodity"), F.when(world, "WLD").otherwise(c("country")).alias("country"), "marketing_year", "report_month", "value", "known", (c("marketing_year") * 100 + c("report_month")).alias("id"))
    probes = mappings.select("entity", "metric").distinct().select("entity", "metric", F.explode(F.expr("sequence(date '1992-02-20', date '1999-12-20', interval 5 month)")).alias("day")).withColumn("known_by", c("day"))
    return probes, rows, mappings, baskets


@query("metric_selection", f"WITH {SELECT_SQL}, {_selection_sql('a', 'pr')} SELECT entity, metric, day, round(value, 2) AS value, last[1] AS as_of, last[2] AS marketing_year, last[3] AS report_month, mode FROM sel_a")
def metric_selection(spark, sf_dir):
    """Metrics of three entities on a grid of days: world rows, full, partial and insufficient baskets, latest countries, and a ratio that has none."""
    probes, rows, mappings, baskets = selection_config(spark, sf_dir)
    out = V.select_metrics(probes, rows, mappings, baskets, _ADDITIVE, _RATIO, _ORDER)
    return out.select("entity", "metric", "day", F.round("value", 2).alias("value"), "as_of", "marketing_year", "report_month", "mode")


_REVISION_SQL = f"WITH {SELECT_SQL}, {_selection_sql('a', 'pr')}, qr AS (SELECT entity, metric, day, last[1] - 1 AS known_by FROM sel_a WHERE last IS NOT NULL), {_selection_sql('b', 'qr')}"


@query("revision_delta", f"{_REVISION_SQL} SELECT a.entity, a.metric, a.day, round(a.value - b.value, 2) AS revision FROM sel_a a LEFT JOIN sel_b b USING (entity, metric, day)")
def revision_delta(spark, sf_dir):
    """The selection minus the one known strictly before its as-of day, under the weights of the day."""
    probes, rows, mappings, baskets = selection_config(spark, sf_dir)
    now = V.select_metrics(probes, rows, mappings, baskets, _ADDITIVE, _RATIO, _ORDER)
    return V.revisions(now, rows, mappings, baskets, _ADDITIVE, _RATIO, _ORDER).select("entity", "metric", "day", F.round("revision", 2).alias("revision"))


@query("supply_demand_daily", f"""{_REVISION_SQL}, x AS (SELECT a.entity, a.metric, a.day, a.value, a.value - b.value AS revision, a.last, a.mode FROM sel_a a LEFT JOIN sel_b b USING (entity, metric, day)), g AS (SELECT DISTINCT entity, day FROM pr),
w AS (SELECT g.entity, g.day, max(CASE WHEN metric = 'production' THEN value END) AS p, max(CASE WHEN metric = 'production' THEN revision END) AS pr, max(CASE WHEN metric = 'stock_ratio' THEN value END) AS s, max(CASE WHEN metric = 'stock_ratio' THEN revision END) AS sr, max(last[1]) AS supply_as_of, max(last[2]) AS marketing_year, bool_or(contains(mode, 'insufficient')) AS insufficient, bool_or(contains(mode, 'partial')) AS partial, count(x.metric) AS n FROM g LEFT JOIN x ON x.entity = g.entity AND x.day = g.day GROUP BY 1, 2)
SELECT entity, day, round(p, 2) AS production, round(pr, 2) AS production_revision, round(s, 2) AS stock_ratio, round(sr, 2) AS stock_ratio_revision, supply_as_of, CAST(day - supply_as_of AS INTEGER) AS lag_days, marketing_year, nullif(concat_ws(',', CASE WHEN n = 0 THEN 'no_observations' END, CASE WHEN n > 0 AND p IS NULL THEN 'missing_production' END, CASE WHEN n > 0 AND s IS NULL THEN 'missing_stock_ratio' END, CASE WHEN insufficient THEN 'insufficient_basket' END, CASE WHEN partial THEN 'partial_basket' END), '') AS missing_flags FROM w""")
def supply_demand_daily(spark, sf_dir):
    """Per entity and day the selected metrics, their revisions, as-of day, lag and flags; a row also where nothing is known yet."""
    c = F.col
    probes, rows, mappings, baskets = selection_config(spark, sf_dir)
    now = V.revisions(V.select_metrics(probes, rows, mappings, baskets, _ADDITIVE, _RATIO, _ORDER), rows, mappings, baskets, _ADDITIVE, _RATIO, _ORDER)
    of = lambda m, v: F.round(F.max(F.when(c("metric") == m, c(v))), 2)
    wide = now.groupBy("entity", "day").agg(
        of("production", "value").alias("production"), of("production", "revision").alias("production_revision"), of("stock_ratio", "value").alias("stock_ratio"), of("stock_ratio", "revision").alias("stock_ratio_revision"),
        F.max("as_of").alias("supply_as_of"), F.max("marketing_year").alias("marketing_year"), F.bool_or(c("mode").contains("insufficient")).alias("insufficient"), F.bool_or(c("mode").contains("partial")).alias("partial"), F.lit(True).alias("some"),
    )
    out = probes.select("entity", "day").distinct().join(wide, ["entity", "day"], "left")
    flags = {"no_observations": c("some").isNull(), "missing_production": c("some") & c("production").isNull(), "missing_stock_ratio": c("some") & c("stock_ratio").isNull(), "insufficient_basket": c("insufficient"), "partial_basket": c("partial")}
    return out.withColumns({"lag_days": F.date_diff("day", "supply_as_of"), "missing_flags": S.true_flags(flags)}).drop("insufficient", "partial", "some")


CELLS_SQL = f"{BALANCE_SQL}, cells AS (SELECT m.metric, b.country, y.y AS marketing_year, count(x.value) AS n FROM (SELECT DISTINCT metric FROM balance) m CROSS JOIN {{basket}} b CROSS JOIN (SELECT unnest([1994, 1996, 2000]) AS y) y LEFT JOIN balance x ON x.metric = m.metric AND x.country = b.country AND x.marketing_year = y.y AND x.report_month <= 6 GROUP BY 1, 2, 3)".replace("{basket}", "basket")


def cells(spark, sf_dir) -> DataFrame:
    """Required metric, country and year cells with how many rows each has."""
    b = balance(spark, sf_dir)
    need = F.explode(F.array(*map(F.lit, BASKET))).alias("country")
    grid = b.select("metric").distinct().select("metric", need).select("metric", "country", F.explode(F.array(*map(F.lit, (1994, 1996, 2000)))).alias("marketing_year"))
    have = b.filter("report_month <= 6").groupBy("metric", "country", "marketing_year").agg(F.count("value").alias("n"))
    return grid.join(have, ["metric", "country", "marketing_year"], "left").fillna(0, ["n"])


@query("contract_cells", f"WITH {_BASKET}, {CELLS_SQL} SELECT metric, country, marketing_year, n, CASE WHEN n = 0 THEN 'missing' WHEN n < 6 THEN 'partial' ELSE 'available' END AS status FROM cells")
def contract_cells(spark, sf_dir):
    return cells(spark, sf_dir).withColumn("status", F.when(F.col("n") == 0, "missing").when(F.col("n") < 6, "partial").otherwise("available"))


_AUDIT_SQL = f"""WITH {_BASKET}, {CELLS_SQL}, raw AS (SELECT *, CASE WHEN report_month % 2 = 0 THEN lower(metric) ELSE metric END AS name, CASE WHEN country = 'NATION_0' AND marketing_year = 1996 AND report_month = 3 THEN 0 WHEN metric = '5-LOW' AND report_month <= 3 THEN 1 WHEN metric = '2-HIGH' AND marketing_year = 1996 THEN 2 END AS p FROM balance WHERE report_month <= 6),
r AS (SELECT metric, country, marketing_year, count(*) AS k, string_agg(DISTINCT name, ',' ORDER BY name) AS names, min(p) AS p FROM raw GROUP BY 1, 2, 3),
audit AS (SELECT metric, country, marketing_year, coalesce(k, 0) AS raw_rows, CASE WHEN p IS NULL THEN coalesce(k, 0) ELSE 0 END AS normalized_rows, names, CASE WHEN k IS NULL THEN 'missing_raw_row' WHEN p = 0 THEN 'identity_mismatch' WHEN p = 1 THEN 'mapping_gap' WHEN p = 2 THEN 'parser_failure' ELSE 'available' END AS status FROM cells LEFT JOIN r USING (metric, country, marketing_year))"""


@query("contract_audit", f"{_AUDIT_SQL} SELECT * FROM audit")
def contract_audit(spark, sf_dir):
    """Required cells against raw rows of which some name another country, lack a mapping or can't be read."""
    c, keys = F.col, ["metric", "country", "marketing_year"]
    raw = balance(spark, sf_dir).filter("report_month <= 6").withColumn("name", F.when(c("report_month") % 2 == 0, F.lower("metric")).otherwise(c("metric")))
    problems = {
        "identity_mismatch": (c("country") == "NATION_0") & (c("marketing_year") == 1996) & (c("report_month") == 3),
        "mapping_gap": (c("metric") == "5-LOW") & (c("report_month") <= 3), "parser_failure": (c("metric") == "2-HIGH") & (c("marketing_year") == 1996),
    }
    return C.contract_cells(cells(spark, sf_dir), raw, keys, "name", problems)


@query("contract_metrics", f"{_AUDIT_SQL} SELECT metric, count(CASE WHEN status = 'available' THEN 1 END) AS available, count(CASE WHEN status <> 'available' THEN 1 END) AS missing, count(CASE WHEN status NOT IN ('available', 'missing_raw_row') THEN 1 END) AS unexpected FROM audit GROUP BY 1")
def contract_metrics(spark, sf_dir):
    return C.contract_metrics(contract_audit(spark, sf_dir), "metric")


@query("source_contract", f"WITH {_BASKET}, {CELLS_SQL} SELECT country, marketing_year, count(*) AS required, count(CASE WHEN n > 0 THEN 1 END) AS available, CASE WHEN bool_and(n > 0) THEN 'ready' ELSE 'blocked' END AS status FROM cells GROUP BY 1, 2")
def source_contract(spark, sf_dir):
    some = F.col("n") > 0
    return cells(spark, sf_dir).groupBy("country", "marketing_year").agg(F.count("*").alias("required"), F.count_if(some).alias("available"), F.when(F.bool_and(some), "ready").otherwise("blocked").alias("status"))


@query("basket_readiness", f"WITH {_BASKET}, {CELLS_SQL}, r AS (SELECT metric, marketing_year, sum(CASE WHEN n > 0 THEN w ELSE 0 END) AS there FROM cells JOIN basket USING (country) GROUP BY 1, 2) SELECT metric, marketing_year, round(there, 6) AS coverage, round(greatest(0.75 - there, 0), 6) + 0.0 AS gap, CASE WHEN there = 0 THEN 'missing' WHEN there < 0.75 THEN 'insufficient' WHEN there < 1 - 1e-9 THEN 'partial' ELSE 'full' END AS status FROM r")
def basket_readiness(spark, sf_dir):
    w = F.element_at(F.create_map(*(F.lit(x) for kv in BASKET.items() for x in kv)), F.col("country"))
    r = cells(spark, sf_dir).groupBy("metric", "marketing_year").agg(F.sum(F.when(F.col("n") > 0, w).otherwise(0.0)).alias("there"))
    t = F.col("there")
    status = F.when(t == 0, "missing").when(t < 0.75, "insufficient").when(t < 1 - 1e-9, "partial").otherwise("full")
    return r.select("metric", "marketing_year", F.round("there", 6).alias("coverage"), F.round(F.greatest(0.75 - t, F.lit(0.0)), 6).alias("gap"), status.alias("status"))


@query("collection_plan", f"""WITH {_BASKET}, {CELLS_SQL}, c AS (SELECT metric, country, marketing_year, n, w, sum(w) OVER g AS total, sum(CASE WHEN n > 0 THEN w ELSE 0 END) OVER g AS have FROM cells JOIN basket USING (country) WINDOW g AS (PARTITION BY metric, marketing_year)),
m AS (SELECT *, round((have + sum(w) OVER (PARTITION BY metric, marketing_year ORDER BY w DESC, country ROWS UNBOUNDED PRECEDING) - w) / total, 9) AS before, w / total AS impact, greatest(0.75 - have / total, 0) AS gap FROM c WHERE n = 0),
p AS (SELECT country, marketing_year, string_agg(metric, ',' ORDER BY metric) AS metrics, round(max(impact), 6) AS impact, round(max(least(impact, gap)), 6) AS gap_reduction FROM m WHERE before < 0.75 GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (ORDER BY gap_reduction DESC, impact DESC, marketing_year, country) AS INTEGER) AS rank FROM p""")
def collection_plan(spark, sf_dir):
    """What to collect so that each basket is known to three quarters, the largest part of a gap first."""
    w = F.element_at(F.create_map(*(F.lit(x) for kv in BASKET.items() for x in kv)), F.col("country"))
    return C.collection_plan(cells(spark, sf_dir).select("metric", "country", "marketing_year", w.alias("weight"), (F.col("n") > 0).alias("there")), 0.75)


@query("health_status", """WITH k AS (SELECT event_type, user_id, max(CASE WHEN value > 5 THEN ts END) AS s, max(CASE WHEN NOT value > 5 THEN ts END) AS f, count(*) FILTER (value > 5 AND ts >= TIMESTAMP '2024-01-29 00:00:00') AS ns, count(*) FILTER (NOT value > 5 AND ts >= TIMESTAMP '2024-01-29 00:00:00') AS nf, max(ts) AS t FROM events GROUP BY 1, 2),
o AS (SELECT event_type, max(s) AS last_success, max(f) AS last_failure, CAST(sum(ns) AS BIGINT) AS recent_successes, CAST(sum(nf) AS BIGINT) AS recent_failures, count(*) FILTER (t < TIMESTAMP '2024-01-29 00:00:00') AS stale_keys FROM k GROUP BY 1)
SELECT *, CASE WHEN last_success IS NULL OR recent_successes <= recent_failures OR stale_keys > 0 THEN 'degraded' ELSE 'ok' END AS status FROM o""")
def health_status(spark, sf_dir):
    return I.source_health(table(spark, sf_dir, "events"), "event_type", "user_id", "ts", F.col("value") > 5, F.expr("timestamp_ntz '2024-01-29 00:00:00'"))


@query("feature_checks", """WITH x AS (SELECT l_returnflag, CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity - CASE WHEN l_orderkey % 11 = 0 THEN 20 ELSE 0 END END AS v, CAST(l_shipdate AS DATE) > DATE '2001-06-30' AS late, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem)
SELECT l_returnflag, count(*) AS n, count(*) FILTER (v IS NULL) AS missing, count(*) FILTER (v <= 0) AS not_positive, count(*) FILTER (copies > 1) AS repeated, count(*) FILTER (late) AS future, round(count(v) / count(*), 6) AS coverage FROM x GROUP BY 1""")
def feature_checks(spark, sf_dir):
    v = F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity") - F.when(F.col("l_orderkey") % 11 == 0, 20).otherwise(0))
    return I.feature_checks(table(spark, sf_dir, "lineitem"), ["l_returnflag"], ["l_orderkey", "l_linenumber"], v, F.to_date("l_shipdate"), F.lit("2001-06-30").cast("date"))


@query("export_projection", "SELECT o_orderkey, c_name, CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30'")
def export_projection(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").filter("o_orderdate between timestamp_ntz '1997-01-01' and timestamp_ntz '1997-06-30'")
    return rows.join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "c_name", F.to_date("o_orderdate").alias("day"))


_TEXT = {c: f"CAST({c} AS VARCHAR)" for c in ("product", "day", "price_observations", "calendar_day_of_week", "missing_flags")} | {
    c: f"CAST(CAST({c} AS DECIMAL(18,6)) AS VARCHAR)"
    for c in ("price_first", "price_last", "price_min", "price_max", "price_delta_abs_1d", "rolling_mean_3", "rolling_mean_7", "rolling_std_7", "click_rate", "error_rate", "temperature")
}


@query("dataset_export", f"SELECT {', '.join(f'coalesce({e}, {chr(39) * 2}) AS {c}' for c, e in _TEXT.items())} FROM ({ORACLE['product_daily']})")
def dataset_export(spark, sf_dir):
    """The flagship written as Parquet and CSV, checked, and read back from the CSV as text."""
    rows = product_daily(spark, sf_dir)
    exact = rows.select(*(F.col(c).cast("decimal(18,6)") if t == "double" else F.col(c) for c, t in rows.dtypes))
    files = E.write_dataset(exact, f"{scratch_root(spark)}/tidemark/export-{uuid.uuid4().hex}", ["product", "day"])
    return E.read_csv(spark, files, rows.columns)


@query("export_manifest", f"SELECT count(*) AS n_rows, {len(_TEXT)} AS n_columns, '{','.join(sorted(_TEXT))}' AS columns, string_agg(DISTINCT CAST(product AS VARCHAR), ',' ORDER BY CAST(product AS VARCHAR)) AS entities, min(day) AS first_day, max(day) AS last_day, count(*) - count(missing_flags) AS unflagged, TRUE AS csv_equals_parquet, 2 AS formats, TRUE AS files_listed, 0 AS n_markers FROM ({ORACLE['product_daily']})")
def export_manifest(spark, sf_dir):
    rows = product_daily(spark, sf_dir)
    exact = rows.select(*(F.col(c).cast("decimal(18,6)") if t == "double" else F.col(c) for c, t in rows.dtypes))
    files = E.write_dataset(exact, f"{scratch_root(spark)}/tidemark/export-{uuid.uuid4().hex}", ["product", "day"])
    m = E.checked_manifest(spark, files, exact.schema, "product", "day", "missing_flags")
    listed = (F.col("n_files") >= 2) & (F.col("bytes_size") > 0) & (F.length("files_sha256") == 64)
    return m.select("n_rows", "n_columns", "columns", "entities", "first_day", "last_day", "unflagged", "csv_equals_parquet", "formats", listed.alias("files_listed"), F.size("markers").alias("n_markers"))
