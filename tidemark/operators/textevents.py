"""Rule-based events from text: categories, families, confidence; rules are data, not code."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import keyword_hits


@dataclass(frozen=True)
class Rule:
    """A category holds if every group has a keyword in the text and no negative one is there."""

    name: str
    groups: tuple[tuple[str, ...], ...]
    negative: tuple[str, ...] = ()
    strong: tuple[str, ...] = ()
    direction: str = "mixed"


# An event's confidence, what a strong keyword and several keywords add, and the most.
BASE, STRONG, SEVERAL, MOST = 0.70, 0.10, 0.05, 0.95
HITS = "__hits"


def with_hits(rows: DataFrame, text: str, rules: list[Rule], words: dict[str, tuple[str, ...]]) -> DataFrame:
    """``rows`` with the keywords that the text holds; the text is searched once for all rules and families."""
    every = {k for r in rules for k in (*(w for g in r.groups for w in g), *r.negative, *r.strong)} | {k for w in words.values() for k in w}
    return rows.withColumn(HITS, keyword_hits(F.col(text), sorted(every)))


def _any(words: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, (F.array_contains(HITS, w) for w in words), F.lit(False))


def _number(words: tuple[str, ...]) -> Column:
    return reduce(Column.__add__, (F.array_contains(HITS, w).cast("int") for w in words), F.lit(0))


def _events(rules: list[Rule]) -> Column:
    """array<struct<category, direction, confidence>> of the rules that hold."""
    found = []
    for r in rules:
        every = reduce(Column.__and__, (_any(g) for g in r.groups))
        many = _number(tuple(dict.fromkeys(w for g in r.groups for w in g))) > 1
        score = BASE + STRONG * _any(r.strong).cast("int") + SEVERAL * many.cast("int")
        held = every & ~_any(r.negative)
        found.append(F.when(held, F.struct(F.lit(r.name).alias("category"), F.lit(r.direction).alias("direction"), F.round(F.least(F.lit(MOST), score), 2).alias("confidence"))))
    return F.array_compact(F.array(*found))


def _families(words: dict[str, tuple[str, ...]]) -> Column:
    return F.array_compact(F.array(*(F.when(_any(w), F.lit(n)) for n, w in words.items())))


def detect(rows: DataFrame, text: str, rules: list[Rule]) -> DataFrame:
    """One row per article and category that holds, with its direction and confidence."""
    return with_hits(rows, text, rules, {}).select("*", F.inline(_events(rules))).drop(HITS)


def families(rows: DataFrame, text: str, words: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row per article and family with any of its keywords."""
    return with_hits(rows, text, [], words).select("*", F.explode(_families(words)).alias("family")).drop(HITS)


def extract(rows: DataFrame, text: str, rules: list[Rule], words: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row per article, category and family, without the text: one pass over it and no join."""
    found = with_hits(rows, text, rules, words).drop(text)
    return found.select("*", F.inline(_events(rules))).select("*", F.explode(_families(words)).alias("family")).drop(HITS)


def event_products(events: DataFrame, family: str, bridge: dict[str, tuple[str, ...]]) -> DataFrame:
    """Events with each product of their family, by a small bridge table; repeats count once."""
    spark = events.sparkSession
    pairs = spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(f).alias(family), F.lit(p).alias("product")) for f, ps in bridge.items() for p in ps))))
    return events.join(F.broadcast(pairs.distinct()), family).distinct()


def product_articles(rows: DataFrame, text: str, rules: list[Rule], words: dict[str, tuple[str, ...]], bridge: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row per article and product of its families, without the text, with its ``events`` (none too); one pass and no join."""
    of_family = F.create_map(*(x for f, ps in bridge.items() for x in (F.lit(f), F.array(*map(F.lit, ps)))))
    found = with_hits(rows, text, rules, words).drop(text).select("*", _events(rules).alias("events"), _families(words).alias("families"))
    products = F.array_distinct(F.flatten(F.transform("families", lambda f: F.coalesce(F.element_at(of_family, f), F.array().cast("array<string>")))))
    return found.select("*", F.explode(products).alias("product")).drop(HITS, "families")


def news_counts(articles: DataFrame, keys: list[str], rules: list[Rule]) -> DataFrame:
    """By ``keys`` the articles, their events, and these by direction and by category (``n_`` and the name)."""
    having = lambda field, value: F.sum(F.size(F.filter("events", lambda e: e[field] == value)))
    directions, categories = dict.fromkeys(("bullish", "bearish", "mixed")), dict.fromkeys(r.name for r in rules)
    return articles.groupBy(*keys).agg(
        F.count("*").alias("articles"), F.sum(F.size("events")).alias("events"),
        *(having("direction", d).alias(d) for d in directions), *(having("category", c).alias(f"n_{c}") for c in categories),
    )
