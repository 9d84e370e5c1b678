"""Structured Streaming forms of the ingest operators; each equals its batch form on the same rows."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.operators import ingest as I


def slot_dedupe(stream: DataFrame, keys: list[str], time: str, slot: str, delay: str) -> DataFrame:
    """The first row of each key and time slot; state is dropped behind the watermark."""
    slotted = stream.withColumn("slot", F.window(time, slot)["start"]).withWatermark("slot", delay)
    return slotted.dropDuplicatesWithinWatermark([*keys, "slot"])


def daily_bars(stream: DataFrame, keys: list[str], time: str, value: str, row_id: str, delay: str, start: str = "0 hours") -> DataFrame:
    """Daily bars per key; ``start`` shifts the day, as local days need. State is dropped once a day is behind the watermark."""
    at = F.struct(F.col(time), F.col(row_id))
    day = F.window(time, "1 day", startTime=start)
    agg = stream.withWatermark(time, delay).groupBy(*keys, day.alias("w")).agg(
        F.min_by(value, at).alias("first"), F.max_by(value, at).alias("last"), F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n")
    )
    return agg.select(*keys, F.col("w.start").alias("day_start"), "first", "last", "low", "high", "n")


class BatchStore:
    """Rows that micro-batches have accepted, so that each batch reads what those before it left.

    Every batch writes a folder of its own and never reads it, nor later ones, so a batch
    that runs again gives the same rows. At the end of every ``every``-th batch all rows
    are written together; later batches begin from there and read fewer than ``every``
    folders more. Which snapshot a batch begins from follows from its number.
    """

    def __init__(self, stored: DataFrame, root: str, every: int = 20):
        self.spark, self.schema, self.root, self.every = stored.sparkSession, stored.schema, root, every
        stored.write.mode("ignore").parquet(f"{root}/upto=-1")

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/{f}" for f in folders))

    def before(self, batch: int) -> DataFrame:
        """The rows that were stored when the batch began."""
        snapshot = batch // self.every * self.every - 1
        return self._read([f"upto={snapshot}", *(f"batch={n}" for n in range(snapshot + 1, batch))])

    def accept(self, batch: int, rows: DataFrame) -> None:
        """Keep the rows of a batch; what it kept when it ran before is replaced."""
        names = self.schema.fieldNames()
        rows.select(*names).write.mode("overwrite").parquet(f"{self.root}/batch={batch}")
        if (batch + 1) % self.every == 0:
            self.before(batch).unionByName(self._read([f"batch={batch}"])).write.mode("overwrite").parquet(f"{self.root}/upto={batch}")


def merge_batch(store: BatchStore, batch: DataFrame, number: int, keys: list[str], digest: str, order: list[str], out: str) -> None:
    """``merge_actions`` of one micro-batch against what was stored before it; inserts are stored, actions written under ``out``."""
    path = f"{out}/batch={number}"
    I.merge_actions(store.before(number), batch, keys, digest, order).write.mode("overwrite").parquet(path)
    written = batch.sparkSession.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in batch.schema)}, action string").parquet(path)
    store.accept(number, written.filter("action = 'insert'"))


class _Alerts(StatefulProcessor):
    """Per key the last time it was seen and whether it is known to be silent."""

    def __init__(self, limit_ms: int):
        self.limit_ms = limit_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "last long, silent boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, silent = self.seen.get() if self.seen.exists() else (None, False)
        # Sorted: a batch holds a key's rows in any order.
        for at in sorted({_millis(row.at) for row in rows}):
            if last is not None and at > last + self.limit_ms:
                if not silent:
                    yield self._row(key, last + self.limit_ms, "stale", last)
                yield self._row(key, at, "recovered", last)
                silent = False
            last = at if last is None else max(last, at)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if not silent:
            self.handle.registerTimer(last + self.limit_ms)
        self.seen.update((last, silent))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, silent = self.seen.get()
        if not silent:
            self.seen.update((last, True))
            yield self._row(key, last + self.limit_ms, "stale", last)

    def _row(self, key, at: int, status: str, last: int) -> Row:
        return Row(key=key[0], at=_moment(at), status=status, last_seen=_moment(last))

    def close(self) -> None:
        pass


def _millis(at: datetime.datetime) -> int:
    return round(at.replace(microsecond=0).timestamp()) * 1000 + at.microsecond // 1000


def _moment(millis: int) -> datetime.datetime:
    return datetime.datetime.fromtimestamp(millis / 1000, datetime.timezone.utc)


def silence_alerts(stream: DataFrame, key: str, time: str, limit: datetime.timedelta, delay: str) -> DataFrame:
    """(key, at, status, last_seen): one ``stale`` row when a key has been silent for ``limit``, one ``recovered`` row when it returns.

    Times count in milliseconds. A timer on the watermark raises the alert of a key of
    which nothing comes any more; a gap that lies within the rows of a batch is seen
    there. State is one small row a key. Needs the RocksDB state store. Rows without a
    key or time are left out.
    """
    rows = stream.select(F.col(key).alias("key"), F.col(time).alias("at")).filter("key is not null and at is not null").withWatermark("at", delay)
    schema = f"key {stream.schema[key].dataType.simpleString()}, at timestamp, status string, last_seen timestamp"
    return rows.groupBy("key").transformWithState(_Alerts(round(limit.total_seconds() * 1000)), schema, "Append", "EventTime")


def silence_gaps(rows: DataFrame, key: str, time: str, limit: datetime.timedelta, until: DataFrame) -> DataFrame:
    """What ``silence_alerts`` gives once the watermark has passed the time of the one-row ``until`` (column ``until``), from all rows at once."""
    seen = rows.select(F.col(key).alias("key"), F.date_trunc("millisecond", time).alias("last_seen")).filter("key is not null and last_seen is not null").distinct()
    step = F.make_dt_interval(secs=F.lit(limit.total_seconds()))
    gaps = seen.withColumn("next", F.lead("last_seen").over(Window.partitionBy("key").orderBy("last_seen"))).withColumn("due", F.col("last_seen") + step)
    stale = F.when(F.coalesce("next", "until") > F.col("due"), F.struct(F.col("due").alias("at"), F.lit("stale").alias("status")))
    back = F.when(F.col("next") > F.col("due"), F.struct(F.col("next").alias("at"), F.lit("recovered").alias("status")))
    return gaps.join(until).select("key", F.inline(F.array_compact(F.array(stale, back))), "last_seen").select("key", "at", "status", "last_seen")


def freshness(stream: DataFrame, key: str, time: str) -> DataFrame:
    """The last time each key was seen, for update or complete mode."""
    return stream.groupBy(key).agg(F.max(time).alias("last_seen"))


def each_batch(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]):
    """Run all available data through ``handle``, batch by batch."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
