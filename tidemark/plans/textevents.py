"""Queries over rule-based text events and the daily news features built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import pointintime as P
from tidemark.operators import textevents as T
from tidemark.operators.textevents import Rule
from tidemark.plans.registry import query
from tidemark.session import table

#: Rules over words that the documents hold; a user brings their own.
RULES = [
    Rule("conjunction", (("the", "der"), ("and", "und")), negative=("license",), strong=("that",), direction="bullish"),
    Rule("license", (("license",),), strong=("version",), direction="bearish"),
    Rule("romance", (("les", "que"), ("des", "los", "de")), direction="mixed"),
]
FAMILIES = {"english": ("the", "for"), "german": ("und", "der"), "french": ("les",), "policy_context": ("license",)}
BRIDGE = {"english": ("A", "B"), "german": ("B",), "french": ("C",), "policy_context": ("A", "B", "C")}

NORM = "lower(regexp_replace(text, '\\s+', ' ', 'g'))"
PAD = "' ' || regexp_replace(n, '[^\\p{L}\\p{N}_]+', ' ', 'g') || ' '"
TEXT_SQL = f"x AS (SELECT doc_id, DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS day, {PAD} AS w FROM (SELECT doc_id, trim({NORM}) AS n FROM documents))"


def _has(*words: str) -> str:
    return "(" + " OR ".join(f"contains(w, ' {x} ')" for x in words) + ")"


def _n(*words: str) -> str:
    return "(" + " + ".join(f"CAST(contains(w, ' {x} ') AS INTEGER)" for x in words) + ")"


EVENTS_SQL = TEXT_SQL + ", ev AS (" + " UNION ALL ".join(
    f"SELECT doc_id, day, w, '{r.name}' AS category, '{r.direction}' AS direction, round(least(0.95, 0.70 + 0.10 * {_n(*r.strong) if r.strong else '0'} + 0.05 * CAST({_n(*dict.fromkeys(k for g in r.groups for k in g))} > 1 AS INTEGER)), 2) AS confidence FROM x WHERE "
    + " AND ".join(_has(*g) for g in r.groups) + (f" AND NOT {_has(*r.negative)}" if r.negative else "")
    for r in RULES
) + "), fam AS (" + " UNION ALL ".join(f"SELECT doc_id, '{f}' AS family FROM x WHERE {_has(*w)}" for f, w in FAMILIES.items()) + ")"
BRIDGE_SQL = "bridge(family, product) AS (VALUES " + ", ".join(f"('{f}', '{p}')" for f, ps in BRIDGE.items() for p in ps) + ")"


def articles(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("day"), S.normalize_text(F.col("text")).alias("t"))


def found(spark, sf_dir) -> DataFrame:
    return T.detect(articles(spark, sf_dir), "t", RULES)


@query("normalize_text", f"SELECT doc_id, sha256(trim({NORM})) AS h FROM documents")
def normalize_text(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", F.sha2("t", 256).alias("h"))


@query("keyword_flags", f"WITH {TEXT_SQL} SELECT doc_id, contains(w, ' the ') AS the, contains(w, ' und ') AS und, contains(w, ' license ') AS license FROM x")
def keyword_flags(spark, sf_dir):
    t = F.col("t")
    return articles(spark, sf_dir).select("doc_id", *(S.keyword_match(t, w).alias(w) for w in ("the", "und", "license")))


@query("detect_categories", f"WITH {EVENTS_SQL} SELECT doc_id, category, direction FROM ev")
def detect_categories(spark, sf_dir):
    return found(spark, sf_dir).select("doc_id", "category", "direction")


@query("event_confidence", f"WITH {EVENTS_SQL} SELECT doc_id, category, CAST(confidence AS DOUBLE) AS confidence FROM ev")
def event_confidence(spark, sf_dir):
    return found(spark, sf_dir).select("doc_id", "category", F.col("confidence").cast("double"))


@query("detect_families", f"WITH {EVENTS_SQL} SELECT doc_id, family FROM fam")
def detect_families(spark, sf_dir):
    return T.families(articles(spark, sf_dir), "t", FAMILIES).select("doc_id", "family")


def extracted(spark, sf_dir) -> DataFrame:
    return T.extract(articles(spark, sf_dir), "t", RULES, FAMILIES)


@query("extract_events", f"WITH {EVENTS_SQL} SELECT doc_id, day, category, family, direction FROM ev JOIN fam USING (doc_id)")
def extract_events(spark, sf_dir):
    return extracted(spark, sf_dir).select("doc_id", "day", "category", "family", "direction")


@query("event_product_bridge", f"WITH {EVENTS_SQL}, {BRIDGE_SQL} SELECT DISTINCT doc_id, category, product FROM ev JOIN fam USING (doc_id) JOIN bridge USING (family)")
def event_product_bridge(spark, sf_dir):
    return product_events(spark, sf_dir).select("doc_id", "category", "product")


def product_events(spark, sf_dir) -> DataFrame:
    linked = T.event_products(extracted(spark, sf_dir), "family", BRIDGE)
    return linked.select("doc_id", "day", "category", "direction", "product").distinct()


PRODUCT_SQL = f"{EVENTS_SQL}, {BRIDGE_SQL}, pe AS (SELECT DISTINCT doc_id, day, category, direction, product FROM ev JOIN fam USING (doc_id) JOIN bridge USING (family))"


@query("event_checks", f"WITH {EVENTS_SQL} SELECT x.doc_id, CASE WHEN count(ev.category) > 0 THEN 'pass' ELSE 'fail' END AS category_found, CASE WHEN bool_and(coalesce(confidence BETWEEN 0 AND 1, TRUE)) THEN 'pass' ELSE 'fail' END AS confidence_in_range FROM x LEFT JOIN ev USING (doc_id) GROUP BY 1")
def event_checks(spark, sf_dir):
    ev = found(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_and(F.col("confidence").between(0, 1)).alias("ok"))
    all_ = articles(spark, sf_dir).select("doc_id").join(ev, "doc_id", "left")
    state = lambda c: F.when(c, "pass").otherwise("fail")
    return all_.select("doc_id", state(F.coalesce("n", F.lit(0)) > 0).alias("category_found"), state(F.coalesce("ok", F.lit(True))).alias("confidence_in_range"))


DAILY_SQL = f"""{PRODUCT_SQL}, spine AS (SELECT p.product, CAST(d.d AS DATE) AS day FROM (SELECT DISTINCT product FROM bridge) p, (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS d) d),
c AS (SELECT product, day, count(*) AS n, count(*) FILTER (direction = 'bullish') AS bull, count(*) FILTER (direction = 'bearish') AS bear FROM pe GROUP BY 1, 2),
s AS (SELECT product, day, coalesce(n, 0) AS n, coalesce(bull, 0) AS bull, coalesce(bear, 0) AS bear FROM spine LEFT JOIN c USING (product, day)),
f AS (SELECT product, day, n AS events_1d, CAST(sum(n) OVER w7 AS BIGINT) AS events_7d, CAST(sum(n) OVER w30 AS BIGINT) AS events_30d, CAST(sum(bull) OVER w7 AS BIGINT) AS bullish_7d, CAST(sum(bear) OVER w7 AS BIGINT) AS bearish_7d FROM s
  WINDOW w7 AS (PARTITION BY product ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), w30 AS (PARTITION BY product ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW))"""


def daily(spark, sf_dir) -> DataFrame:
    """Dense product-day counts and calendar windows over them; the windows read one row a day."""
    pe = product_events(spark, sf_dir)
    counts = pe.groupBy("product", "day").agg(F.count("*").alias("n"), F.count_if(F.col("direction") == "bullish").alias("bull"), F.count_if(F.col("direction") == "bearish").alias("bear"))
    bounds = pe.agg(F.lit("2024-01-01").cast("date").alias("first"), F.lit("2024-01-30").cast("date").alias("last"))
    products = spark.range(1).select(F.explode(F.array(*map(F.lit, sorted({p for ps in BRIDGE.values() for p in ps})))).alias("product"))
    s = P.date_spine(products, bounds).join(counts, ["product", "day"], "left").fillna(0, ["n", "bull", "bear"])
    specs = {"events_1d": (F.sum("n"), 1), "events_7d": (F.sum("n"), 7), "events_30d": (F.sum("n"), 30), "bullish_7d": (F.sum("bull"), 7), "bearish_7d": (F.sum("bear"), 7)}
    return P.calendar_windows(s, ["product"], "day", specs)


@query("event_range_join", f"WITH {DAILY_SQL} SELECT product, day, events_1d, events_7d, events_30d FROM f")
def event_range_join(spark, sf_dir):
    return daily(spark, sf_dir).select("product", "day", "events_1d", "events_7d", "events_30d")


@query("conditional_counts", f"WITH {DAILY_SQL} SELECT product, day, bullish_7d, bearish_7d, round(CAST(bullish_7d - bearish_7d AS DOUBLE) / nullif(events_7d, 0), 6) AS sentiment FROM f")
def conditional_counts(spark, sf_dir):
    d = daily(spark, sf_dir)
    return d.select("product", "day", "bullish_7d", "bearish_7d", F.round(S.safe_ratio(F.col("bullish_7d") - F.col("bearish_7d"), F.col("events_7d")), 6).alias("sentiment"))


def _news_sql() -> str:
    over = {"articles": ("articles", (1, 7, 30)), "events": ("events", (1, 7, 30))} | {d: (d, (7,)) for d in ("bullish", "bearish", "mixed")} | {r.name: (f"n_{r.name}", (30,)) for r in RULES}
    windows = ", ".join(f"CAST(sum({column}) OVER w{n} AS BIGINT) AS {name}_{n}d" for name, (column, days) in over.items() for n in days)
    by_direction = ", ".join(f"count(*) FILTER (direction = '{d}') AS {d}" for d in ("bullish", "bearish", "mixed"))
    by_category = ", ".join(f"count(*) FILTER (category = '{r.name}') AS n_{r.name}" for r in RULES)
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c, _ in over.values())
    frames = ", ".join(f"w{n} AS (PARTITION BY product ORDER BY day RANGE BETWEEN INTERVAL {n - 1} DAY PRECEDING AND CURRENT ROW)" for n in (1, 7, 30))
    names = ", ".join(f"{name}_{n}d" for name, (_, days) in over.items() for n in days)
    return f"""{PRODUCT_SQL}, art AS (SELECT DISTINCT doc_id, day, product FROM x JOIN fam USING (doc_id) JOIN bridge USING (family)),
spine AS (SELECT p.product, CAST(d.d AS DATE) AS day FROM (SELECT DISTINCT product FROM bridge) p, (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS d) d),
ca AS (SELECT product, day, count(*) AS articles FROM art GROUP BY 1, 2), ce AS (SELECT product, day, count(*) AS events, {by_direction}, {by_category} FROM pe GROUP BY 1, 2),
dense AS (SELECT product, day, {zero} FROM spine LEFT JOIN ca USING (product, day) LEFT JOIN ce USING (product, day)),
w AS (SELECT product, day, {windows}, max(CASE WHEN articles > 0 THEN day END) OVER w30 AS as_of FROM dense WINDOW {frames})
SELECT product, day, {names}, as_of, round(CAST(bullish_7d - bearish_7d AS DOUBLE) / nullif(events_7d, 0), 6) AS sentiment,
  nullif(concat_ws(',', CASE WHEN NOT EXISTS (SELECT 1 FROM art) THEN 'no_news_articles' END, CASE WHEN NOT EXISTS (SELECT 1 FROM pe) THEN 'no_commodity_events' END,
    CASE WHEN EXISTS (SELECT 1 FROM pe) AND events_30d = 0 THEN 'no_matching_events' END, CASE WHEN articles_30d = 0 OR events_30d = 0 THEN 'partial_source_coverage' END), '') AS missing_flags FROM w"""


@query("news_daily", f"WITH {_news_sql()}")
def news_daily(spark, sf_dir):
    """Per product and day the articles and events of windows of days, by direction and category, sentiment and flags.

    The texts are read once; what follows has one row a product and day.
    """
    counts = T.news_counts(T.product_articles(articles(spark, sf_dir), "t", RULES, FAMILIES, BRIDGE), ["product", "day"], RULES)
    names = [c for c in counts.columns if c not in ("product", "day")]
    bounds = spark.range(1).select(F.lit("2024-01-01").cast("date").alias("first"), F.lit("2024-01-30").cast("date").alias("last"))
    products = spark.range(1).select(F.explode(F.array(*map(F.lit, sorted({p for ps in BRIDGE.values() for p in ps})))).alias("product"))
    dense = P.date_spine(products, bounds).join(counts, ["product", "day"], "left").fillna(0, names)
    specs = {f"{c}_{n}d": (F.sum(c), n) for c in ("articles", "events") for n in (1, 7, 30)} | {f"{d}_7d": (F.sum(d), 7) for d in ("bullish", "bearish", "mixed")}
    specs |= {f"{r.name}_30d": (F.sum(f"n_{r.name}"), 30) for r in RULES} | {"as_of": (F.max(F.when(F.col("articles") > 0, F.col("day"))), 30)}
    # One row for the whole table.
    totals = counts.agg(F.coalesce(F.sum("articles"), F.lit(0)).alias("all_articles"), F.coalesce(F.sum("events"), F.lit(0)).alias("all_events"))
    out = P.calendar_windows(dense, ["product"], "day", specs).crossJoin(F.broadcast(totals))
    flags = {
        "no_news_articles": F.col("all_articles") == 0, "no_commodity_events": F.col("all_events") == 0,
        "no_matching_events": (F.col("all_events") > 0) & (F.col("events_30d") == 0), "partial_source_coverage": (F.col("articles_30d") == 0) | (F.col("events_30d") == 0),
    }
    sentiment = F.round(S.safe_ratio(F.col("bullish_7d") - F.col("bearish_7d"), F.col("events_7d")), 6)
    return out.select("product", "day", *specs, sentiment.alias("sentiment"), S.true_flags(flags).alias("missing_flags"))
