"""Idempotent ingest, change detection, quality rules and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalars as S

#: Statuses that need no attention.
OK_STATUSES = ("pass", "skip", "info")


def _folded(existing: DataFrame, incoming: DataFrame, keys: list[str], digest: str, order: list[str]) -> DataFrame:
    """Stored rows (one a key: the least digest) and deliveries as one table with ``__side`` (0 stored) and ``__d``."""
    stored = existing.groupBy(*keys).agg(F.min(digest).alias("__d")).withColumn("__side", F.lit(0))
    delivered = incoming.withColumn("__d", F.col(digest)).withColumn("__side", F.lit(1))
    return stored.unionByName(delivered, allowMissingColumns=True).withColumn("__nth", F.row_number().over(Window.partitionBy(*keys).orderBy("__side", *order, "__d")))


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Incoming rows whose key is new, the first of each by ``order``; nulls equal nulls."""
    none = F.lit(None).cast("string")
    fresh = _folded(existing.withColumn("__none", none), incoming.withColumn("__none", none), keys, "__none", order)
    return fresh.filter("__side = 1 and __nth = 1").select(*incoming.columns)


def identity_match(incoming: DataFrame, existing: DataFrame, keys: list[str], found: str) -> DataFrame:
    """Adds ``found`` of the existing row with the same key, nulls equal to nulls; the least where keys repeat."""
    other = existing.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min(found).alias("found"))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    return incoming.join(other, same, "left").drop(*(f"__{k}" for k in keys))


def merge_actions(existing: DataFrame, incoming: DataFrame, keys: list[str], digest: str, order: list[str] | None = None) -> DataFrame:
    """Incoming rows with ``action``: insert, skip (same digest) or conflict (never overwritten).

    Deliveries are taken in ``order`` (ties: by digest), so the first of a new key is
    inserted and those after it are compared with it. A stored row counts as there whatever
    its digest; of stored rows that repeat a key the least digest counts. Nulls equal
    nulls, in keys and digests. Each incoming row comes out once. Rows of a key are
    streamed through one task in this order; nothing of them is held.
    """
    rows = _folded(existing, incoming, keys, digest, order or [])
    run = Window.partitionBy(*keys).orderBy("__nth").rowsBetween(Window.unboundedPreceding, 0)
    held = F.first(F.struct("__d")).over(run)["__d"]
    action = F.when(F.col("__nth") == 1, "insert").when(held.eqNullSafe(F.col("__d")), "skip").otherwise("conflict")
    return rows.withColumn("action", action).filter("__side = 1").select(*incoming.columns, "action")


def bar_revisions(existing: DataFrame, incoming: DataFrame, keys: list[str], day: str, digest: str, order: list[str] | None = None) -> DataFrame:
    """As ``merge_actions``, but a change of the newest bar of a key is an update, an older one is rejected.

    What is newest moves with the bars that earlier deliveries bring, and an update is
    what later deliveries of its bar are compared with.
    """
    rows = _folded(existing, incoming, [*keys, day], digest, order or [])
    moment = ["__side", *(order or []), day, "__d"]
    rows = rows.withColumn("__newest", F.max(day).over(Window.partitionBy(*keys).orderBy(*moment).rowsBetween(Window.unboundedPreceding, 0)))
    newest = F.coalesce(F.col(day) == F.col("__newest"), F.lit(False))
    before = Window.partitionBy(*keys, day).orderBy("__nth").rowsBetween(Window.unboundedPreceding, -1)
    held = F.last(F.when((F.col("__nth") == 1) | newest, F.struct("__d")), ignorenulls=True).over(before)["__d"]
    action = F.when(F.col("__nth") == 1, "insert").when(held.eqNullSafe(F.col("__d")), "skip").when(newest, "update").otherwise("reject")
    return rows.withColumn("action", action).filter("__side = 1").select(*incoming.columns, "action")


def revision_numbers(changes: DataFrame, stored: DataFrame, keys: list[str], order: list[str], number: str = "revision") -> DataFrame:
    """``changes`` numbered on from the highest stored number of their key; nulls equal nulls."""
    last = stored.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.max(number).alias("__last"))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return changes.withColumn("__n", nth).join(last, same, "left").select(*changes.columns, (F.coalesce("__last", F.lit(0)) + F.col("__n")).cast("int").alias(number))


def field_diff(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, changed, diff): names of the fields that differ, in order, and each one's old and new value as JSON.

    Decimals are told apart and written without trailing zeros; where both are there, their
    difference and its share of the old value (8 digits, null for 0) are added. Nulls equal
    nulls. Rows without a difference are left out, as are keys on one side only.
    """
    exact = {c for c, t in old.dtypes if t.startswith("decimal")}
    right = new.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), *(F.col(f).alias(f"__new_{f}") for f in fields))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)))
    left, after = (lambda f: F.col(f)), (lambda f: F.col(f"__new_{f}"))
    differ = {f: ~left(f).eqNullSafe(after(f)) for f in fields}

    def piece(f: str) -> Column:
        if f not in exact:
            return S.canonical_json({"old": left(f), "new": after(f)}, ordered=False)
        pair = {"old": S.canonical_decimal(left(f)), "new": S.canonical_decimal(after(f))}
        change = after(f) - left(f)
        more = {"diff_abs": S.canonical_decimal(change), "diff_pct": S.canonical_decimal(F.round(F.try_divide(change, left(f)), 8))}
        return F.when(change.isNull(), S.canonical_json(pair, ordered=False)).otherwise(S.canonical_json(pair | more, ordered=False))

    changed = F.concat_ws(",", *(F.when(d, F.lit(f)) for f, d in differ.items()))
    diff = F.concat(F.lit("{"), F.concat_ws(",", *(F.when(d, F.concat(F.lit(f'"{f}":'), piece(f))) for f, d in differ.items())), F.lit("}"))
    return old.join(right, same).select(*keys, changed.alias("changed"), diff.alias("diff")).filter("changed <> ''")


def feature_upsert(existing: DataFrame, built: DataFrame, keys: list[str], same: Column, order: list[str] | None = None) -> DataFrame:
    """Keys of ``built`` with created, updated or skipped; ``same`` compares columns of x (old) and y (new), null-safe.

    Rows that are built more than once for a key are taken in ``order``: each is compared
    with the one before it. Of stored rows that repeat a key the greatest counts; nulls
    equal nulls. Each built row gives one row.
    """
    values = [c for c in existing.columns if c not in keys]
    stored = existing.groupBy(*keys).agg(F.max(F.struct(*values) if values else F.lit(1)).alias("y")).withColumn("__side", F.lit(0))
    built_ = built.select(*keys, F.struct(*(values or [F.lit(1)])).alias("y"), *(F.col(c).alias(f"__o{i}") for i, c in enumerate(order or [])), F.lit(1).alias("__side"))
    if not values:
        built_ = built_.withColumn("y", F.lit(1))
    w = Window.partitionBy(*keys).orderBy("__side", *(f"__o{i}" for i in range(len(order or []))), "y")
    pairs = stored.unionByName(built_, allowMissingColumns=True).withColumn("x", F.lag("y").over(w)).withColumn("__nth", F.row_number().over(w))
    return pairs.filter("__side = 1").select(*keys, F.when(F.col("__nth") == 1, "created").when(same, "skipped").otherwise("updated").alias("action"))


def compare_sources(history: DataFrame, current: DataFrame, key: str, day: str, value: str, price: str) -> DataFrame:
    """(key, day, value, price, diff_abs, diff_pct, status) of days that both have, and one row of each key of ``history`` with none.

    A match is exact, a small difference at most a hundredth of the price, any other
    large, as one from a price of 0. Keys without a common day are ``no_overlap``, those
    without any value and day ``not_comparable``; their other columns are null.
    """
    usable = history.filter(F.col(day).isNotNull() & F.col(value).isNotNull()).select(key, day, value)
    both = usable.join(current.filter(F.col(price).isNotNull()).select(key, day, price), [key, day])
    gap = F.col(value) - F.col(price)
    share = F.try_divide(gap, F.col(price))
    status = F.when(gap == 0, "match_close").when(F.abs(share) <= 0.01, "small_diff").otherwise("large_diff")
    matched = both.select(key, day, value, price, gap.alias("diff_abs"), share.alias("diff_pct"), status.alias("status"))
    none = history.groupBy(key).agg(F.count_if(F.col(day).isNotNull() & F.col(value).isNotNull()).alias("__n")).join(matched.select(key).distinct(), key, "left_anti")
    return matched.unionByName(none.select(key, F.when(F.col("__n") > 0, "no_overlap").otherwise("not_comparable").alias("status")), allowMissingColumns=True)


def run_summary(actions: DataFrame, run: str) -> DataFrame:
    """Counts of each action by run, and success, partial_success or error.

    ``actions`` has (run, action); actions are insert, skip, conflict, malformed, unmapped
    and error. A run is a success if none of the last four occurred, and an error if they
    are all it has (conflicts are rows found).
    """
    n = lambda x: F.count_if(F.col("action") == x)
    out = actions.groupBy(run).agg(
        F.count_if(~F.col("action").isin("error")).alias("found"), n("insert").alias("written"), n("skip").alias("skipped"), n("conflict").alias("conflicts"),
        n("malformed").alias("malformed"), n("unmapped").alias("unmapped"), n("error").alias("errors"),
    )
    bad = F.col("conflicts") + F.col("malformed") + F.col("unmapped") + F.col("errors")
    some = F.col("written") + F.col("skipped") + F.col("conflicts")
    return out.withColumn("status", F.when(bad == 0, "success").when(some > 0, "partial_success").otherwise("error"))


def row_checks(rows: DataFrame, row_id: list[Column], rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """One row per rule and input row, in one pass: name, status and severity. A null predicate fails."""
    checks = F.array(*(
        F.struct(F.lit(n).alias("check_name"), F.when(F.coalesce(p, F.lit(False)), "pass").otherwise("fail").alias("status"), F.lit(s).alias("severity"))
        for n, (p, s) in rules.items()
    ))
    return rows.select(*row_id, F.inline(checks))


def feature_checks(rows: DataFrame, by: list[str], keys: list[str], value: Column, day: Column, last_day: Column) -> DataFrame:
    """Per group of ``by``: rows without the value, with one that isn't positive, of a repeated key, from after ``last_day``, and the coverage."""
    copies = F.count("*").over(Window.partitionBy(*keys))
    seen = rows.select(*by, value.alias("__v"), (day > last_day).alias("__late"), copies.alias("__copies"))
    return seen.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(F.col("__v").isNull()).alias("missing"), F.count_if(F.col("__v") <= 0).alias("not_positive"),
        F.count_if(F.col("__copies") > 1).alias("repeated"), F.count_if("__late").alias("future"), F.round(F.count("__v") / F.count("*"), 6).alias("coverage"),
    )


def coverage(rows: DataFrame, name: str, keys: list[str], day: Column, values: list[Column], fresh_from: Column) -> DataFrame:
    """One row about a table: rows, distinct keys, first and last day, freshness, rows with all and with any of the values, last day with any."""
    any_ = F.coalesce(*(v.cast("string") for v in values)).isNotNull()
    all_ = reduce(Column.__and__, (v.isNotNull() for v in values))
    return rows.agg(
        F.lit(name).alias("table_name"), F.count("*").alias("n"), F.count_distinct(*keys).alias("keys"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.coalesce(F.max(day) >= fresh_from, F.lit(False)).alias("fresh"), F.count_if(all_).alias("complete"), F.count_if(any_).alias("with_any"), F.max(F.when(any_, day)).alias("last_with_any"),
    )


def source_health(rows: DataFrame, source: str, key: str, time: str, good: Column, since: Column) -> DataFrame:
    """Per source: last success and failure, both counts since a time, keys not seen since then, and ok or degraded."""
    per_key = rows.groupBy(source, key).agg(
        F.max(F.when(good, F.col(time))).alias("s"), F.max(F.when(~good, F.col(time))).alias("f"),
        F.count_if(good & (F.col(time) >= since)).alias("ns"), F.count_if(~good & (F.col(time) >= since)).alias("nf"), F.max(time).alias("t"),
    )
    out = per_key.groupBy(source).agg(
        F.max("s").alias("last_success"), F.max("f").alias("last_failure"), F.sum("ns").alias("recent_successes"), F.sum("nf").alias("recent_failures"), F.count_if(F.col("t") < since).alias("stale_keys")
    )
    bad = F.col("last_success").isNull() | (F.col("recent_successes") <= F.col("recent_failures")) | (F.col("stale_keys") > 0)
    return out.withColumn("status", F.when(bad, "degraded").otherwise("ok"))


def problem_checks(checks: DataFrame) -> DataFrame:
    return checks.filter(~F.col("status").isin(*OK_STATUSES))


def route(rows: DataFrame, malformed: Column, skipped: Column) -> DataFrame:
    """Adds ``route``: malformed, skipped or parsed; each row goes one way."""
    return rows.withColumn("route", F.when(F.coalesce(malformed, F.lit(True)), "malformed").when(skipped, "skipped").otherwise("parsed"))


def leaks(rows: DataFrame, known: str, as_of: str) -> DataFrame:
    """Rows that use what was known only after their as-of time."""
    return rows.filter(F.col(known) > F.col(as_of))


def anti_gaps(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(present.select(*keys), keys, "left_anti")


def stale_keys(rows: DataFrame, key: str, time: str, cutoff: Column) -> DataFrame:
    """Keys whose last row is before the cutoff."""
    return rows.groupBy(key).agg(F.max(time).alias("last_seen")).filter(F.col("last_seen") < cutoff)


def size_anomaly(rows: DataFrame, keys: list[str], order: str, size: str, back: int = 20, factor: int = 3, ranges: int = 64) -> DataFrame:
    """Status of each size against the mean of up to ``back`` earlier ones of its key.

    A key's rows are dealt into about equal ranges of ``order`` (a number or time), so
    that no key, however frequent, meets in one task. Each range also gets the last
    ``back`` rows before it, at most ``ranges * back`` of a key being looked at for that.
    """
    steps = F.array(*(F.lit(n / ranges) for n in range(1, ranges)))
    cuts = rows.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.array_distinct(F.percentile_approx(order, steps)).alias("__cuts"))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    at = F.size(F.filter("__cuts", lambda c: c < F.col(order)))
    dealt = rows.join(cuts, same, "left").withColumn("__range", F.coalesce(F.when(F.col(order).isNotNull(), at), F.lit(0)))
    dealt = dealt.select(*rows.columns, "__range")
    late = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(F.desc(order)))
    tail = F.struct("__range", *(F.col(c) for c in dict.fromkeys((order, size))))
    tails = dealt.withColumn("__late", late).filter(F.col("__late") <= back).groupBy(*keys).agg(F.array_sort(F.collect_list(tail)).alias("__tails"))
    # The last rows before a range may come from several ranges; a range without rows takes its share in vain.
    before = lambda r: F.filter("__tails", lambda t: t["__range"] < r)
    last = lambda x: F.slice(x, F.greatest(F.size(x) - back + 1, F.lit(1)), back)
    carried = tails.select(*keys, "__tails", F.explode(F.sequence(F.lit(1), F.lit(ranges - 1))).alias("__to"))
    carried = carried.select(*keys, "__to", F.explode(last(before(F.col("__to")))).alias("__t"))
    carried = carried.select(*keys, F.col("__to").alias("__range"), *(F.col(f"__t.{c}").alias(c) for c in dict.fromkeys((order, size))))
    every = dealt.withColumn("__own", F.lit(True)).unionByName(carried.withColumn("__own", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(*keys, "__range").orderBy(order).rowsBetween(-back, -1)
    out = every.withColumn("mean_before", F.avg(F.col(size).cast("double")).over(w)).filter("__own").select(*rows.columns, "mean_before")
    odd = (F.col(size) > factor * F.col("mean_before")) | (F.col(size) * factor < F.col("mean_before"))
    return out.withColumn("status", F.when(F.col("mean_before").isNull(), "skip").when(odd, "fail").otherwise("pass"))
