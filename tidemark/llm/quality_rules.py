"""Quality rules learned as a decision list, in SQL functions only (operator 10).

Text statistics are computed for every document. Labelled ones teach the list by
sequential covering: a rule grows by the threshold condition with the best gain on two
thirds of the labelled rows, is pruned backwards on the other third, and what it covers
is set aside before the next rule. Each step is one aggregation over the labelled
statistics; only counts per feature and threshold reach the driver. The list becomes
one ordered conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Labelled rows that are learned from at most, the smallest by a hash of the id.
MAX_LABELLED = 50_000
#: Thresholds tried for each feature: quantiles of the labelled rows.
CUTS = 24
MAX_RULES, MAX_CONDITIONS = 8, 4
#: A rule must cover so many rows, and be right in so large a part of those it is pruned on.
LEAST_ROWS, LEAST_PURITY = 20, 0.8

# What separates words, and the characters counted as symbols.
BLANK = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words", "mean_word", "symbols_per_word", "dup_lines_part", "repeat_part", "digit_part", "upper_part", "stop_part")
#: Frequent short words of several languages.
STOP = ("the", "of", "and", "to", "in", "that", "is", "it", "le", "la", "de", "et", "les", "der", "die", "und", "den", "el", "los", "que", "y")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with the array ``value`` as a column that is worked out once a row.

    A filter that a caller puts on the result moves below projections, and their
    expressions with it into lambdas, where they run for each element. It can't move
    below a generator, so what comes out of one stays a plain column.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts and the features of every row of ``docs``; a null text has none of anything."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
    trimmed = F.btrim("t", F.lit(BLANK))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    # Windows are told apart by 64-bit hashes, sorted with their places: equal neighbours
    # are repeats. Their places, in order, cover three words each, less the overlap.
    step = _once(base, "w", words)
    step = step.withColumn("n_words", F.size("w").cast("long"))
    windows = F.expr("CASE WHEN size(w) >= 3 THEN transform(sequence(0, size(w) - 3), i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, i AS i)) END")
    step = _once(step, "s", F.coalesce(F.sort_array(windows), F.array().cast("array<struct<h:bigint,i:int>>")))
    step = _once(step, "r", F.expr("sort_array(transform(filter(s, (x, k) -> get(s, k - 1).h <=> x.h OR get(s, k + 1).h <=> x.h), x -> x.i))"))
    step = step.withColumn("n_repeat_words", F.expr("aggregate(transform(r, (i, k) -> least(3, coalesce(get(r, k + 1) - i, 3))), 0L, (a, x) -> a + x)"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")
    step = step.withColumn("l", lines).withColumn("n_dup_lines", (F.size("l") - F.size(F.array_distinct("l"))).cast("long")).withColumn("n_lines", F.size("l"))
    step = step.withColumn("n_stop", F.size(F.filter("w", lambda x: x.isin(*STOP))))
    step = step.withColumn("word_chars", F.length(_without(F.col("t"), BLANK)).cast("long"))
    step = step.withColumn("n_symbols", (F.length("t") - F.length(_without(F.col("t"), SYMBOLS))).cast("long"))
    step = step.withColumn("n_digits", F.length("t") - F.length(_without(F.col("t"), "0123456789")))
    step = step.withColumn("n_upper", F.length("t") - F.length(F.regexp_replace("t", "[A-Z]", "")))
    part = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return step.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        part("word_chars", "n_words").alias("mean_word"),
        part("n_symbols", "n_words").alias("symbols_per_word"),
        part("n_dup_lines", "n_lines").alias("dup_lines_part"),
        part("n_repeat_words", "n_words").alias("repeat_part"),
        part("n_digits", "word_chars").alias("digit_part"),
        part("n_upper", "word_chars").alias("upper_part"),
        part("n_stop", "n_words").alias("stop_part"),
    )


def base_failed() -> Column:
    """The fixed rule: too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule) -> Column:
    return reduce(Column.__and__, (c.column() for c in rule), F.lit(True))


def _counts(rows: DataFrame, conditions: dict[str, Column]) -> dict[str, tuple[int, int]]:
    """(bad, good) rows under each condition, in one aggregation."""
    aggs = [F.count_if(c & (F.col("bad") == b)).alias(f"{name}|{b}") for name, c in conditions.items() for b in (1, 0)]
    found = rows.agg(*aggs).first()
    return {name: (found[f"{name}|1"], found[f"{name}|0"]) for name in conditions}


def _steps(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[Condition, tuple[int, int]]:
    """(bad, good) rows under each single condition, from one count per feature and interval."""
    interval = lambda f: F.size(F.filter(F.array(*(F.lit(c) for c in cuts[f])), lambda c: F.col(f) > c))
    cells = rows.select("bad", F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), interval(f).alias("cell")) for f in cuts))))
    table = {f: [[0, 0] for _ in range(len(c) + 1)] for f, c in cuts.items()}
    for row in cells.groupBy("feature", "cell", "bad").count().collect():  # features x intervals x 2 rows at most
        table[row["feature"]][row["cell"]][1 - row["bad"]] += row["count"]
    found = {}
    for feature, cells_of in table.items():
        for k, cut in enumerate(cuts[feature]):
            below = tuple(sum(c[i] for c in cells_of[: k + 1]) for i in (0, 1))
            over = tuple(sum(c[i] for c in cells_of[k + 1 :]) for i in (0, 1))
            found[Condition(feature, False, cut)], found[Condition(feature, True, cut)] = below, over
    return found


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """How much surer the rule becomes of its bad rows, times their number."""
    if not after[0]:
        return 0.0
    return after[0] * (log2(after[0] / sum(after)) - log2(before[0] / sum(before)))


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        inside = rows.filter(_covered(rule))
        steps = _steps(inside, cuts)
        some = next(iter(steps))
        before = tuple(a + b for a, b in zip(steps[some], steps[Condition(some.feature, not some.above, some.cut)], strict=True))
        if not before[0] or not before[1]:
            break
        best = max((c for c in steps if sum(steps[c]) >= LEAST_ROWS), key=lambda c: (_gain(before, steps[c]), str(c)), default=None)
        if best is None or _gain(before, steps[best]) <= 0:
            break
        rule += (best,)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, tuple[int, int]]:
    """The beginning of the rule with the best balance of bad over good rows."""
    counts = _counts(rows, {str(k): _covered(rule[:k]) for k in range(1, len(rule) + 1)})
    worth = lambda k: (counts[str(k)][0] - counts[str(k)][1]) / max(1, sum(counts[str(k)]))
    best = max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))
    return rule[:best], counts[str(best)]


def learn(docs: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules for bad documents, in order, from ``labels`` (doc_id, quality 0 or 1) and their texts.

    At most ``MAX_LABELLED`` labelled rows are used. Rows with null labels, and ids
    labelled both ways, are left out; without rows of both kinds there are no rules.
    """
    clear = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    clear = clear.agg(F.min("quality").alias("q"), F.max("quality").alias("q1")).filter("q = q1").select("doc_id", (1 - F.col("q")).cast("int").alias("bad"))
    order = F.xxhash64("doc_id")
    chosen = F.broadcast(materialize(clear.orderBy(order, "doc_id").limit(MAX_LABELLED), "chosen"))  # bounded
    known = docs.join(chosen.select(F.col("doc_id").alias("known")), F.col("doc_id").cast("long") == F.col("known"), "left_semi")
    rows = materialize(statistics(known).select("doc_id", *FEATURES).join(chosen, "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3))), "labelled")
    grow, prune = rows.filter("part < 2"), rows.filter("part = 2")
    quantiles = grow.agg(*(F.percentile_approx(f, [k / (CUTS + 1) for k in range(1, CUTS + 1)], 1000).alias(f) for f in FEATURES)).first()
    cuts = {f: sorted({float(x) for x in quantiles[f]}) for f in FEATURES if quantiles[f]}
    rules: list[Rule] = []
    while cuts and len(rules) < MAX_RULES:
        rule = _grow(grow, cuts)
        if not rule:
            break
        rule, (bad, good) = _prune(prune, rule)
        if bad + good == 0 or bad < LEAST_PURITY * (bad + good):
            break
        rules.append(rule)
        grow, prune = grow.filter(~_covered(rule)), prune.filter(~_covered(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """1-based number of the first rule that a document meets; 0 if none."""
    out = F.lit(0)
    for number, rule in reversed([*enumerate(rules, 1)]):
        out = F.when(_covered(rule), number).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, the base counts, base_failed, kept, rule) of every row of ``docs``.

    ``kept`` is false where the base rule or a learned one fails the document; ``rule``
    names the learned one. Null and empty texts have no words and fail. Repeated rows
    are judged each.
    """
    rules = learn(docs, labels)
    stats = statistics(docs)
    number = verdict(rules)
    names = F.array(F.lit(""), *(F.lit(" and ".join(map(str, rule))) for rule in rules))
    return stats.withColumn("base_failed", base_failed()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (number == 0)).alias("kept"), F.element_at(names, number + 1).alias("rule"),
    )
