"""Which reported values stand for a metric on a day: world totals, weighted baskets or the latest country.

An entity's metric is made of commodities with weights. For each commodity the first of
these counts: the world's row; else the configured basket of countries, if enough of its
weight is known; else the latest row of any country. A basket of which too little is
known vetoes the whole metric. Rows are looked up once for each commodity, country and
day, whatever entities share them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import pointintime as P

WORLD = "WLD"


def _holds(day: str) -> Column:
    return (F.col("effective_from") <= F.col(day)) & (F.col("effective_to").isNull() | (F.col("effective_to") >= F.col(day)))


def select_metrics(probes: DataFrame, observations: DataFrame, mappings: DataFrame, baskets: DataFrame, additive: tuple[str, ...], ratio: str | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """(entity, metric, day, known_by, value, as_of, mode, order) of each of ``probes`` (entity, metric, day, known_by) for which something is known.

    ``observations`` has (commodity, country, value, known, order), ``mappings`` (entity,
    metric, commodity, family, weight) and ``baskets`` (entity, family, metric or null for
    all, country, weight, least), both with effective_from and effective_to. Mappings and
    baskets are those of the day, rows those known on ``known_by`` or before; the latest by
    (known, order) counts. Metrics that aren't ``additive`` have no baskets: a commodity
    with one gives nothing. ``ratio`` names a metric that falls back to a country only where
    no basket of the family is for a single metric. ``mode`` lists what the commodities
    used, ``insufficient`` among them where the value is vetoed; ``as_of`` and ``order`` are
    those of the latest row used. Probes are distinct; nulls in commodity or country never match.
    """
    c = F.col
    values = ["value", *order]
    active = probes.join(mappings, ["entity", "metric"]).filter(_holds("day")).select("entity", "metric", "day", "known_by", "commodity", "family", "weight")
    wanted = active.select("commodity", "known_by").distinct()
    places = observations.select("commodity", "country").distinct()
    cells = wanted.join(places, "commodity")
    found = P.asof_backward(cells, observations, ["commodity", "country"], "known_by", "known", values, list(order)).filter("found is not null")
    # Of each commodity and day: the world's row, the latest row, and all rows by country.
    row = F.struct(c("found.found_at").alias("known"), *(c(f"found.{n}").alias(n) for n in order), c("country"), c("found.value").alias("value"))
    by = found.groupBy("commodity", "known_by").agg(
        F.max(F.when(c("country") == WORLD, row)).alias("world"), F.max(row).alias("latest"), F.map_from_entries(F.collect_list(F.struct("country", row.alias("row")))).alias("rows")
    )
    held = baskets.filter("weight > 0").withColumnsRenamed({"metric": "scope", "weight": "share"})
    dealt = active.join(held, ["entity", "family"], "left").filter(c("share").isNull() | _holds("day"))
    applies = c("scope").isNull() | (c("scope") == c("metric"))
    item = F.struct("country", "share", "least")
    configured = dealt.groupBy("entity", "metric", "day", "commodity").agg(
        F.collect_list(F.when(c("share").isNotNull() & applies, item)).alias("basket"), F.bool_or(c("scope").isNotNull()).alias("scoped")
    )
    parts = active.join(by, ["commodity", "known_by"]).join(configured, ["entity", "metric", "day", "commodity"], "left")
    parts = parts.withColumn("basket", F.coalesce("basket", F.array().cast("array<struct<country:string,share:double,least:double>>")))
    total = lambda items: F.aggregate(items, F.lit(0.0), lambda a, x: a + x["share"])
    there = F.filter("basket", lambda x: F.map_contains_key(c("rows"), x["country"]))
    parts = parts.withColumn("there", F.array_sort(there, lambda a, b: F.when(a["country"] < b["country"], -1).when(a["country"] > b["country"], 1).otherwise(0)))
    least = F.array_max(F.transform("basket", lambda x: x["least"]))
    enough = (F.size("there") > 0) & (total(c("there")) / total(c("basket")) >= least - 1e-9)
    mode = (
        F.when(c("world").isNotNull(), "world").when((F.size("basket") > 0) & ~c("metric").isin(*additive), "none").when((F.size("basket") > 0) & enough, F.when(F.size("there") < F.size("basket"), "partial").otherwise("basket"))
        .when(F.size("basket") > 0, "insufficient").when((c("metric") == F.lit(ratio)) & F.coalesce("scoped", F.lit(False)), "none").otherwise("latest")
    )
    parts = parts.withColumn("mode", mode)
    mean = F.aggregate("there", F.lit(0.0), lambda a, x: a + x["share"] * F.element_at("rows", x["country"])["value"]) / total(c("there"))
    in_basket = c("mode").isin("basket", "partial")
    value = F.when(c("mode") == "world", c("world.value")).when(in_basket, mean).when(c("mode") == "latest", c("latest.value"))
    used = F.when(c("mode") == "world", c("world")).when(in_basket, F.array_max(F.transform("there", lambda x: F.element_at("rows", x["country"])))).when(c("mode") == "latest", c("latest"))
    made = parts.filter("mode <> 'none'").withColumns({"v": value, "used": used})
    veto = F.bool_or(c("mode") == "insufficient")
    out = made.groupBy("entity", "metric", "day", "known_by").agg(
        F.when(~veto, F.try_divide(F.sum(c("v") * c("weight")), F.sum(F.when(c("v").isNotNull(), c("weight"))))).alias("value"), F.when(~veto, F.max("used")).alias("last"), F.array_join(F.array_sort(F.collect_set("mode")), ",").alias("mode")
    )
    return out.select("entity", "metric", "day", "known_by", "value", c("last.known").alias("as_of"), "mode", *(c(f"last.{n}").alias(n) for n in order))


def revisions(selected: DataFrame, observations: DataFrame, mappings: DataFrame, baskets: DataFrame, additive: tuple[str, ...], ratio: str | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """``selected`` with ``revision``: its value less what had been selected from rows known strictly before its as-of day, under the same day's weights."""
    keys = ["entity", "metric", "day"]
    probes = selected.filter("as_of is not null").select(*keys, F.date_sub("as_of", 1).alias("known_by"))
    before = select_metrics(probes, observations, mappings, baskets, additive, ratio, order).select(*keys, F.col("value").alias("__before"))
    return selected.join(before, keys, "left").withColumn("revision", F.col("value") - F.col("__before")).drop("__before")
