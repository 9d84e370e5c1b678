"""What a run covers: its entities, its days, the regions behind a value and what has to be collected."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import pointintime as P


def date_bounds(own: DataFrame, features: DataFrame | None = None, available: DataFrame | None = None, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """One row (first, last), or none where nothing has a day; each table has a column ``day``.

    The days are those of ``features``, else those of ``own``; the last is no earlier than
    the last day of ``available``. ``start`` and ``end`` override one side each. A first
    day after the last is an error when the row is read.
    """
    span = lambda df: df.agg(F.min("day").alias("a"), F.max("day").alias("z"), F.lit(1).alias("one"))
    rows = span(own).select("one", F.struct("a", "z").alias("own"))
    for name, other in (("features", features), ("available", available)):
        rows = rows.join(span(other if other is not None else own.limit(0)).select("one", F.struct("a", "z").alias(name)), "one")  # one row each
    # A side is taken from the features only if they have days; they have both or none.
    first = F.coalesce(F.lit(start).cast("date"), "features.a", "own.a")
    last = F.coalesce(F.lit(end).cast("date"), F.greatest(F.coalesce("features.z", "own.z"), "available.z"))
    checked = F.when(first > last, F.raise_error(F.lit("the first day is after the last")).cast("date")).otherwise(first)
    return rows.filter(first.isNotNull() & last.isNotNull()).select(checked.alias("first"), last.alias("last"))


def select_entities(entities: DataFrame, code: str | None = None, family: str | None = None, aliases: dict[str, str] | None = None, groups: dict[str, tuple[str, ...] | None] | None = None) -> DataFrame:
    """Active ``entities`` (code, family, active) of a code and a family, if given.

    An alias stands for another family's name; a group for several codes, or with None
    for all. A code that no active entity has is a ``ValueError``, a family without any
    gives no rows.
    """
    rows = entities.filter("active")
    if code is not None:
        rows = rows.filter(F.col("code") == code)
        if rows.isEmpty():
            raise ValueError(f"unknown code: {code}")
    if family is None:
        return rows
    family = (aliases or {}).get(family, family)
    if groups and family in groups:
        return rows if groups[family] is None else rows.filter(F.col("code").isin(*groups[family]))
    return rows.filter(F.col("family") == family)


def coverage(probes: DataFrame, weights: DataFrame, features: DataFrame, entity: str, region: str, as_of: str, used: Column, flags: dict[str, Column]) -> DataFrame:
    """Each of ``probes`` (entity, day; distinct) with the regions behind it: (as_of, used, flags).

    Regions are those whose weights hold on the day, each with its last row of ``features``
    (region, day, ``as_of``) on the day or before. A region is taken unless it has no row or
    one that was known later (``as_of`` after the day); ``used`` are the taken ones for which
    that column is true. Flags are joined in order of regions (``missing_region:``,
    ``future_as_of:``, or a taken row's own as ``region:flag``), then what holds for all:
    ``missing_all_regions`` or ``partial_regions``, ``missing_all_values``; an entity
    without weights has ``missing_weights`` only. Rows are looked up once for each region
    and day, whatever entities share it; the weights are a configured table.
    """
    held = P.interval_join(probes, weights.select(entity, region, "effective_from", "effective_to"), "day", [entity]).select(entity, region, "day")
    own = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in flags.items())))
    rows = features.select(region, "day", F.col(as_of).alias("at"), F.coalesce(used, F.lit(False)).alias("used"), own.alias("own"))
    found = P.asof_backward(held.select(region, "day").distinct(), rows, [region], "day", "day", ["at", "used", "own"])
    name, x = F.col(region).cast("string"), F.col("found")
    ahead = x["at"] > F.col("day")
    said = F.when(x.isNull(), F.array(F.concat(F.lit("missing_region:"), name))).when(ahead, F.array(F.concat(F.lit("future_as_of:"), name)))
    said = said.otherwise(F.transform(x["own"], lambda f: F.concat(name, F.lit(":"), f)))
    taken = x.isNotNull() & ~F.coalesce(ahead, F.lit(False))
    judged = found.select(region, "day", said.alias("said"), taken.alias("taken"), F.when(taken, x["at"]).alias("at"), (taken & x["used"]).alias("used"))
    agg = held.join(judged, [region, "day"]).groupBy(entity, "day").agg(
        F.max("at").alias("as_of"), F.array_sort(F.collect_list(F.when(F.col("used"), F.col(region)))).alias("regions"),
        F.array_sort(F.collect_list(F.struct(region, "said"))).alias("each"), F.count("*").alias("n"), F.count_if("taken").alias("n_taken"),
    )
    whole = F.array_compact(F.array(
        F.when(F.col("n_taken") == 0, "missing_all_regions").when(F.col("n_taken") < F.col("n"), "partial_regions"),
        F.when((F.col("n_taken") > 0) & (F.size("regions") == 0), "missing_all_values"),
    ))
    joined = F.array_join(F.array_distinct(F.concat(F.flatten(F.col("each.said")), whole)), ",")
    agg = agg.select(entity, "day", "as_of", F.nullif(F.array_join(F.col("regions").cast("array<string>"), ","), F.lit("")).alias("used"), joined.alias("flags"))
    out = probes.select(entity, "day").join(agg, [entity, "day"], "left")
    return out.withColumn("flags", F.nullif(F.coalesce("flags", F.lit("missing_weights")), F.lit("")))


def contract_cells(required: DataFrame, raw: DataFrame, keys: list[str], name: str, problems: dict[str, Column]) -> DataFrame:
    """Each of ``required`` (keys; distinct) with its raw rows: (raw_rows, normalized_rows, names, status).

    ``problems`` gives a condition for each status, the worst first; a cell has the worst
    that any of its rows meets, ``missing_raw_row`` without rows, else ``available``. Only an
    available cell's rows count as normalized. ``names`` are the distinct names, sorted and
    joined. Null keys match nothing.
    """
    worst = F.coalesce(*(F.when(c, F.lit(i)) for i, c in enumerate(problems.values())))
    have = raw.groupBy(*keys).agg(F.count("*").alias("raw_rows"), F.array_join(F.array_sort(F.collect_set(name)), ",").alias("names"), F.min(worst).alias("worst"))
    found = F.element_at(F.array(*map(F.lit, problems)), F.col("worst") + 1)
    status = F.when(F.col("raw_rows").isNull(), "missing_raw_row").when(F.col("worst").isNotNull(), found).otherwise("available")
    cells = required.select(*keys).join(have, keys, "left").withColumn("status", status)
    return cells.select(
        *keys, F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"), F.when(F.col("status") == "available", F.col("raw_rows")).otherwise(0).alias("normalized_rows"), F.nullif("names", F.lit("")).alias("names"), "status"
    )


def contract_metrics(cells: DataFrame, metric: str, expected: tuple[str, ...] = ("available", "missing_raw_row")) -> DataFrame:
    """Per metric of ``contract_cells``: cells available and not, and those whose status isn't an ``expected`` one."""
    status = F.col("status")
    return cells.groupBy(metric).agg(F.count_if(status == "available").alias("available"), F.count_if(status != "available").alias("missing"), F.count_if(~status.isin(*expected)).alias("unexpected"))


def collection_plan(cells: DataFrame, threshold: float) -> DataFrame:
    """(country, marketing_year, metrics, impact, gap_reduction, rank): what to collect so that every basket reaches ``threshold``.

    ``cells`` has (metric, country, marketing_year, weight, there) of a configured grid. For
    each metric and year the weightiest missing countries count, as many as the gap needs;
    a country's share is its impact, and what of it the gap takes its reduction. Both are
    the largest over the metrics; the rank goes by reduction, impact, year and country.
    """
    basket = Window.partitionBy("metric", "marketing_year")
    w = F.col("weight")
    c = cells.withColumns({"total": F.sum(w).over(basket), "have": F.sum(F.when(F.col("there"), w).otherwise(0.0)).over(basket)}).filter(~F.col("there") & (F.col("total") > 0))
    before = F.col("have") + F.sum(w).over(basket.orderBy(F.desc("weight"), "country").rowsBetween(Window.unboundedPreceding, 0)) - w
    impact, gap = w / F.col("total"), F.greatest(threshold - F.col("have") / F.col("total"), F.lit(0.0))
    need = c.select("*", F.round(before / F.col("total"), 9).alias("before"), impact.alias("impact"), F.least(impact, gap).alias("reduction")).filter(F.col("before") < threshold)
    plan = need.groupBy("country", "marketing_year").agg(
        F.array_join(F.array_sort(F.collect_set("metric")), ",").alias("metrics"), F.round(F.max("impact"), 6).alias("impact"), F.round(F.max("reduction"), 6).alias("gap_reduction")
    )
    return plan.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("gap_reduction"), F.desc("impact"), "marketing_year", "country")))
