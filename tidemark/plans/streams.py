"""Streaming jobs over ``events`` run to their end, written as Parquet and read back."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans.registry import query
from tidemark.session import scratch_root, table
from tidemark.streaming import jobs as J


def _stream(spark, sf_dir) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _folder(spark) -> str:
    return f"{scratch_root(spark)}/tidemark/stream-{uuid.uuid4().hex}"


def _write(batch: DataFrame, number: int, base: str) -> None:
    """Each batch has a folder of its own, so one that runs again replaces what it wrote."""
    batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")


def _read(spark, base: str, schema: StructType | str, keys: list[str] | None = None) -> DataFrame:
    """What the batches wrote; with ``keys``, the last batch's row of each."""
    rows = spark.read.schema(schema).parquet(f"{base}/out/batch=*")
    if not keys:
        return rows
    batch = F.regexp_extract(F.col("_metadata.file_path"), "batch=([0-9]+)", 1).cast("long").alias("__batch")
    values = F.struct(*(c for c in rows.columns if c not in keys)).alias("v")
    last = rows.select(*keys, batch, values).groupBy(*keys).agg(F.max_by("v", "__batch").alias("v"))
    return last.select(*keys, "v.*")


def _run(stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Write the stream's output batch by batch and read it back; in update mode the last row of each key counts."""
    spark, base = stream.sparkSession, _folder(stream.sparkSession)
    writer = stream.writeStream.outputMode(mode).foreachBatch(lambda batch, number: _write(batch, number, base)).option("checkpointLocation", f"{base}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    return _read(spark, base, stream.schema, keys)


@query("stream_slot_dedupe", "SELECT user_id, event_type, date_trunc('day', ts) AS slot FROM events GROUP BY ALL")
def stream_slot_dedupe(spark, sf_dir):
    out = _run(J.slot_dedupe(_stream(spark, sf_dir), ["user_id", "event_type"], "ts", "1 day", "2 days"), "append")
    return out.select("user_id", "event_type", F.date_format("slot", "yyyy-MM-dd").cast("date").alias("slot"))


@query("stream_daily_bar", "SELECT user_id % 20 AS product, CAST(ts AS DATE) AS day, arg_min(value, (ts, event_id)) AS first, arg_max(value, (ts, event_id)) AS last, min(value) AS low, max(value) AS high, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_bar(spark, sf_dir):
    s = _stream(spark, sf_dir).withColumn("product", F.col("user_id") % 20)
    out = _run(J.daily_bars(s, ["product"], "ts", "value", "event_id", "2 days"), "update", ["product", "day_start"])
    return out.select("product", F.date_format("day_start", "yyyy-MM-dd").cast("date").alias("day"), "first", "last", "low", "high", "n")


@query("stream_freshness", "SELECT user_id, CAST(max(ts) AS DATE) AS last_day FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'")
def stream_freshness(spark, sf_dir):
    out = _run(J.freshness(_stream(spark, sf_dir), "user_id", "ts"), "update", ["user_id"])
    stale = out.filter(F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss.SSSSSS") < "2024-01-30 12:00:00")
    return stale.select("user_id", F.date_format("last_seen", "yyyy-MM-dd").cast("date").alias("last_day"))


def _in_deliveries(deliveries: list[DataFrame], base: str) -> DataFrame:
    """A stream of the given tables, one after another; every file is a micro-batch of its own."""
    for rows in deliveries:
        rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
    return deliveries[0].sparkSession.readStream.schema(deliveries[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")


_MERGE_SQL = """WITH d AS (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS h FROM events),
x AS (SELECT event_id, h, CASE WHEN event_id % 3 <> 0 THEN h END AS s0, h + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS h1, h + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS h3 FROM d),
y AS (SELECT *, coalesce(s0, CASE WHEN event_id % 2 = 0 THEN h1 END) AS s1, coalesce(s0, CASE WHEN event_id % 2 = 0 THEN h1 END, h) AS s2 FROM x)
SELECT 1 AS n, event_id, CASE WHEN s0 IS NULL THEN 'insert' WHEN s0 = h1 THEN 'skip' ELSE 'conflict' END AS action FROM y WHERE event_id % 2 = 0
UNION ALL SELECT 2, event_id, CASE WHEN s1 IS NULL THEN 'insert' WHEN s1 = h THEN 'skip' ELSE 'conflict' END FROM y
UNION ALL SELECT 3, event_id, CASE WHEN s2 = h3 THEN 'skip' ELSE 'conflict' END FROM y"""


@query("stream_merge_actions", _MERGE_SQL)
def stream_merge_actions(spark, sf_dir):
    """Three deliveries of all events as a stream of several batches; each is merged with what those before it left stored."""
    rows = table(spark, sf_dir, "events").select("event_id", F.round(F.col("value") * 100).cast("long").alias("h"))
    moved = lambda k: F.col("h") + F.when(F.col("event_id") % k == 0, 1).otherwise(0)
    parts = [rows.filter("event_id % 2 = 0").withColumn("h", moved(5)), rows, rows.withColumn("h", moved(7))]
    base = _folder(spark)
    stream = _in_deliveries([x.withColumn("n", F.lit(n)) for n, x in enumerate(parts, 1)], base)
    store = J.BatchStore(rows.filter("event_id % 3 <> 0"), f"{base}/store", every=2)
    J.each_batch(stream, f"{base}/state", lambda batch, number: J.merge_batch(store, batch, number, ["event_id"], "h", ["n"], f"{base}/out"))
    return _read(spark, base, "event_id long, h long, n int, action string").select("n", "event_id", "action")


_LIMIT = datetime.timedelta(hours=60)


@query("stream_silence_alerts", """WITH g AS (SELECT DISTINCT user_id, date_trunc('millisecond', ts) AS t FROM events), n AS (SELECT *, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS nx FROM g), m AS (SELECT max(t) - INTERVAL 1 HOUR AS z FROM g)
SELECT user_id, 'stale' AS status, epoch_ms(t + INTERVAL 60 HOUR) AS at_ms, epoch_ms(t) AS last_ms FROM n, m WHERE coalesce(nx, z) > t + INTERVAL 60 HOUR UNION ALL SELECT user_id, 'recovered', epoch_ms(nx), epoch_ms(t) FROM n WHERE nx > t + INTERVAL 60 HOUR""")
def stream_silence_alerts(spark, sf_dir):
    """Users of whom nothing came for 60 hours, and their return: a timer for each user over a stream in the order of time."""
    rows = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    base = _folder(spark)
    first, last = rows.agg(F.unix_micros(F.min("ts")).alias("a"), F.unix_micros(F.max("ts")).alias("z")).first()
    part = F.least(F.floor((F.unix_micros("ts") - first) * 4 / max(last - first, 1)), F.lit(3)) if first is not None else F.lit(0)
    stream = _in_deliveries([rows.filter(part == n) for n in range(4)], base)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        out = _run(J.silence_alerts(stream, "user_id", "ts", _LIMIT, "1 hour"), "append")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return out.select(F.col("key").alias("user_id"), "status", F.unix_millis("at").alias("at_ms"), F.unix_millis("last_seen").alias("last_ms"))
