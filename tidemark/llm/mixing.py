"""Mixing sources to target weights by Pfair scheduling, in SQL functions only (operator 2).

Each source's rows are cut into blocks of about equal size. With a weight of u in U,
its j-th block is released at slot floor(j U / u) and due at ceil((j + 1) U / u). One
block a slot, earliest deadline first among those released, meets every deadline; so
after any number of slots each source is less than one block from its target share.
The schedule repeats after U slots: one period is worked out from the weights alone,
and a block's slot follows from its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Chunks of a source whose rows are counted apart, so no source meets in one task.
CHUNKS = 256
#: The most sources and the longest period; both come from the configuration, not the data.
MAX_UNITS = 10_000
OTHER = "other"
#: Stretches of slots whose rows are counted, to deal the schedule into partitions.
STEPS = 1 << 16


def period(spark: SparkSession, units: dict[str, int]) -> DataFrame:
    """(source, unit, turn, at): the slot of each source's turns within one period.

    ``units`` holds whole weights; the period is their sum, at most ``MAX_UNITS``.
    """
    total = sum(units.values())
    if not units or min(units.values()) < 1 or total > MAX_UNITS:
        raise ValueError(f"weights must be whole, positive and sum to at most {MAX_UNITS}")
    names = F.array(*(F.lit(name) for name in units))
    share = F.array(*(F.lit(n).cast("long") for n in units.values()))
    state = F.struct(F.transform(share, lambda _: F.lit(0).cast("long")).alias("done"), F.array().cast("array<struct<i:int,turn:long,at:long>>").alias("out"))

    def slot(s: Column, t: Column) -> Column:
        def due(u: Column, i: Column) -> Column:
            done = F.element_at(s["done"], i + 1)
            open_ = (done < u) & (F.floor(done * total / u) <= t)
            return F.when(open_, F.struct(F.ceil((done + 1) * total / u).alias("due"), i.alias("i"), done.alias("turn")))

        first = F.array_min(F.transform(share, due))
        done = F.transform(s["done"], lambda d, i: d + F.when(i == first["i"], F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))
        pick = F.struct(first["i"].alias("i"), first["turn"].alias("turn"), t.alias("at"))
        return F.struct(done.alias("done"), F.concat(s["out"], F.array(pick)).alias("out"))

    slots = F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(total - 1).cast("long")), state, slot, lambda s: s["out"])
    picks = spark.range(1).select(F.inline(slots))
    return picks.select(
        F.element_at(names, F.col("i") + 1).alias("mix_source"), F.element_at(share, F.col("i") + 1).alias("unit"), "turn", "at"
    )


def _chunk(key: Column) -> Column:
    """A chunk by the id's residues, without an id by the text's hash; equal rows stay together, strides are spread."""
    prime = 2_147_483_647
    key = F.coalesce(key.cast("long"), F.xxhash64(F.col("text").cast("string")))
    return F.pmod(F.pmod(F.pmod(key, F.lit(prime)) * 48_271, F.lit(prime)), F.lit(CHUNKS))


def mix(docs: DataFrame, units: dict[str, int], block_chars: int = 20_000) -> DataFrame:
    """(doc_id, mix_source, n_mixed, block, slot, place, in_mix) of every row of ``docs``.

    Read in order of (slot, place), the rows follow the weights. Sources without a
    weight, null among them, share that of ``other``, which must then be given. Sizes
    are characters; a null text has none. A row belongs to the block in which it starts,
    and ``place`` is its start within the source. Equal rows follow one another. No row
    is dropped or repeated: ``in_mix`` is false from the slot on at which some source
    of ``units`` has no more blocks (one without rows: its first), where the weights
    can't hold any longer.
    """
    return _placed(docs, units, block_chars).select("doc_id", "mix_source", "n_mixed", "block", "slot", "place", "in_mix")


def _placed(docs: DataFrame, units: dict[str, int], block_chars: int, whole: bool = False) -> DataFrame:
    """The columns of ``mix``; with ``whole``, also the row itself as ``doc``."""
    spark = docs.sparkSession
    total = sum(units.values())
    kept = [F.struct(*(docs[c] for c in docs.columns)).alias("doc")] if whole else []
    named = F.when(F.col("source").isin(*units), F.col("source").cast("string")).otherwise(F.lit(OTHER))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        named.alias("mix_source"),
        F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_mixed"),
        _chunk(F.col("doc_id")).alias("chunk"),
        *kept,
    )
    key = ["mix_source", "chunk"]
    sums = rows.groupBy(*key).agg(F.sum("n_mixed").alias("size"))
    ahead = Window.partitionBy("mix_source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*key, F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*key).orderBy("doc_id", "n_mixed", *([F.xxhash64("doc")] if whole else [])).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.broadcast(period(spark, units))  # at most MAX_UNITS rows, by the weights alone
    share = F.broadcast(turns.select("mix_source", "unit").distinct())
    placed = (
        rows.withColumn("before", F.coalesce(F.sum("n_mixed").over(inside), F.lit(0)))
        .join(starts, key)
        .withColumn("place", F.col("start") + F.col("before"))
        .withColumn("block", F.floor(F.col("place") / block_chars))
        .join(share, "mix_source", "left")
    )
    placed = placed.withColumn("unit", F.coalesce("unit", F.raise_error(F.lit("a source has no weight: give 'other' one")).cast("long")))
    slotted = placed.withColumn("turn", F.col("block") % F.col("unit")).join(turns.drop("unit"), ["mix_source", "turn"])
    slotted = slotted.withColumn("slot", F.floor(F.col("block") / F.col("unit")) * total + F.col("at"))
    # A source ends with its characters, one without rows before its first turn; sums has a row for each source and chunk.
    ends = sums.groupBy("mix_source").agg((F.floor(F.greatest(F.sum("size") - 1, F.lit(0)) / block_chars) + 1).alias("next"))
    ends = share.join(ends, "mix_source", "left").withColumn("next", F.coalesce("next", F.lit(0))).withColumn("turn", F.col("next") % F.col("unit"))
    ends = ends.join(turns.drop("unit"), ["mix_source", "turn"])
    horizon = ends.agg(F.min(F.floor(F.col("next") / F.col("unit")) * total + F.col("at")).alias("horizon"))
    return slotted.join(F.broadcast(horizon)).withColumn("in_mix", F.col("slot") < F.col("horizon"))


def mixed_documents(docs: DataFrame, units: dict[str, int], block_chars: int = 20_000) -> DataFrame:
    """All rows of ``docs`` in mixed order, with their columns.

    The n-th partition holds the n-th stretch of slots, with about equally many rows, so
    that files written from it follow the schedule by name. Rows are placed one by one:
    repeated and null ids stay as often as they are there.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = materialize(mix(docs, units, block_chars).groupBy("slot").agg(F.count("*").alias("n")), "slots")
    end = (held.agg(F.max("slot")).first()[0] or 0) + 1
    step = F.floor(F.col("slot") * F.lit(STEPS) / F.lit(end))
    rows = sorted(map(tuple, held.groupBy(step.alias("step")).agg(F.sum("n")).collect()))  # at most STEPS rows
    total, before, parts = sum(r[1] for r in rows), 0, []
    for at, count in rows:
        parts.append((at, before * n // total))
        before += count
    parts = F.broadcast(spark.createDataFrame(parts, "step long, part int"))
    placed = _placed(docs, units, block_chars, whole=True).withColumn("step", step).join(parts, "step")
    return placed.repartitionById(n, "part").sortWithinPartitions("slot", "place").select("doc.*")


def oracle(units: dict[str, int], block_chars: int) -> str:
    """The same rows in DuckDB SQL."""
    total = sum(units.values())
    values = ", ".join(f"({i}, '{s}', {u})" for i, (s, u) in enumerate(units.items(), 1))
    names = ", ".join(f"'{s}'" for s in units)
    return f"""
WITH RECURSIVE units(i, mix_source, unit) AS (VALUES {values}),
shares AS (SELECT list(unit ORDER BY i) AS us FROM units),
sched AS (
  SELECT CAST(0 AS BIGINT) AS t, list_transform(us, lambda u: CAST(0 AS BIGINT)) AS done, us, CAST(NULL AS BIGINT) AS pick, CAST(NULL AS BIGINT) AS turn FROM shares
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(us) + 1), lambda i: done[i] + CASE WHEN i = p THEN 1 ELSE 0 END), us, p, done[p]
  FROM (SELECT t, done, us, list_min(list_filter(list_transform(range(1, len(us) + 1), lambda i:
          CASE WHEN done[i] < us[i] AND (done[i] * {total}) // us[i] <= t
               THEN (((done[i] + 1) * {total} + us[i] - 1) // us[i]) * 1000 + i END), lambda x: x IS NOT NULL)) % 1000 AS p
        FROM sched WHERE t < {total})),
turns AS (SELECT u.mix_source, u.unit, s.turn, s.t - 1 AS spot FROM sched s JOIN units u ON u.i = s.pick),
rows AS (
  SELECT doc_id, CASE WHEN source IN ({names}) THEN source ELSE '{OTHER}' END AS mix_source, CAST(coalesce(length(text), 0) AS BIGINT) AS n_mixed,
         ((((doc_id % 2147483647) * 48271) % 2147483647) % {CHUNKS}) AS chunk FROM documents),
sums AS (SELECT mix_source, chunk, sum(n_mixed) AS size FROM rows GROUP BY ALL),
starts AS (SELECT mix_source, chunk, coalesce(sum(size) OVER (PARTITION BY mix_source ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sums),
placed AS (
  SELECT r.*, CAST(start + coalesce(sum(n_mixed) OVER (PARTITION BY mix_source, chunk ORDER BY doc_id, n_mixed ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM rows r JOIN starts USING (mix_source, chunk)),
blocks AS (SELECT *, place // {block_chars} AS block FROM placed JOIN units USING (mix_source)),
ends AS (SELECT mix_source, CAST(greatest(sum(size) - 1, 0) AS BIGINT) // {block_chars} + 1 AS next FROM sums GROUP BY 1),
horizon AS (SELECT min((coalesce(next, 0) // unit) * {total} + spot) AS horizon FROM turns LEFT JOIN ends USING (mix_source) WHERE turn = coalesce(next, 0) % unit)
SELECT doc_id, b.mix_source, n_mixed, CAST(block AS BIGINT) AS block, CAST((block // b.unit) * {total} + spot AS BIGINT) AS slot, place,
       (block // b.unit) * {total} + spot < horizon AS in_mix
FROM blocks b JOIN turns t ON t.mix_source = b.mix_source AND t.turn = block % b.unit, horizon"""
