"""A table of landed payloads, addressed by their content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: File extensions of media types; any other is bin.
EXTENSIONS = {
    "application/json": "json", "text/json": "json", "text/html": "html", "application/xhtml+xml": "html", "text/csv": "csv", "application/csv": "csv",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx", "application/vnd.ms-excel": "xls",
}
LANDED = "run_id string, fetched_at timestamp, sha256 string, bytes_size long, extension string, path string, payload binary, source_code string, fetch_date date"
_IDENTITY = ["source_code", "fetch_date", "run_id", "sha256"]


def extension(mime: Column) -> Column:
    """The extension of a media type, its parameters aside."""
    media = F.lower(F.trim(F.split_part(F.coalesce(mime, F.lit("")), F.lit(";"), F.lit(1))))
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in EXTENSIONS.items() for x in kv)), media), F.lit("bin"))


def safe_part(text: Column) -> Column:
    """Text as a part of a path: runs of other characters become one underscore; unknown where nothing is left."""
    clean = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z0-9_.-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(clean == "", "unknown").otherwise(clean)


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """What has landed in ``folder``; nothing where nothing has."""
    spark.createDataFrame([], LANDED).write.mode("ignore").partitionBy("source_code", "fetch_date").parquet(folder)
    return spark.read.schema(LANDED).option("basePath", folder).parquet(folder)


def land(payloads: DataFrame, folder: str) -> DataFrame:
    """Append payloads (source_code, run_id, fetched_at, content_type, payload) that haven't landed; (found, written) in one row.

    A payload is known by source, day of fetching, run and digest; of equal ones the first
    fetched lands. Landing the same again writes nothing. Null payloads count as empty.
    Stored rows are compared without their payloads, in the sources and days that are there.
    """
    spark = payloads.sparkSession
    body = F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary"))
    rows = payloads.select(
        safe_part(F.col("run_id").cast("string")).alias("run_id"), "fetched_at", F.sha2(body, 256).alias("sha256"), F.octet_length(body).cast("long").alias("bytes_size"), extension(F.col("content_type")).alias("extension"),
        body.alias("payload"), safe_part(F.col("source_code").cast("string")).alias("source_code"), F.to_date("fetched_at").alias("fetch_date"),
    )
    path = F.concat_ws("/", "source_code", F.date_format("fetch_date", "yyyy/MM/dd"), "run_id", F.concat("sha256", F.lit("."), "extension"))
    found = rows.count()
    first = rows.groupBy(*_IDENTITY).agg(F.min_by(F.struct("fetched_at", "bytes_size", "extension", "payload"), F.struct("fetched_at", "extension")).alias("r"))
    single = first.select(*_IDENTITY, "r.*").withColumn("path", path)
    stored = landed(spark, folder)
    present = stored.join(rows.select("source_code", "fetch_date").distinct(), ["source_code", "fetch_date"], "left_semi").select(*_IDENTITY)
    before = stored.count()
    new = single.join(present, _IDENTITY, "left_anti")
    new.select(*stored.columns).write.mode("append").partitionBy("source_code", "fetch_date").parquet(folder)
    after = landed(spark, folder).count()
    return spark.createDataFrame([(found, after - before)], "found long, written long")
