"""Writing a dataset as Parquet and CSV, checking what was written, and its manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_features(rows: DataFrame, dimension: DataFrame, key: str, day: str, columns: list[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """The named ``columns`` of feature rows whose entity the dimension knows, days within both ends where given.

    Days are filtered, and other columns left out, before the join. Rows have no order; a
    writer sorts where it is wanted. A row with a null key or day (where an end is given) isn't there.
    """
    if first is not None:
        rows = rows.filter(F.col(day) >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.filter(F.col(day) <= F.lit(last).cast("date"))
    own = [c for c in rows.columns if c == key or (c in columns and c not in dimension.columns)]
    names = dimension.select(key, *(c for c in dimension.columns if c in columns and c != key))
    return rows.select(*own).join(names, key).select(*columns)


def row_checks(rows: DataFrame, entity: str, day: str) -> DataFrame:
    """(check, status, n) of rows that are to be exported: ``has_rows``, ``entity_present``, ``day_present``, ``keys_unique``.

    ``n`` is the number of rows at fault, of keys at fault for ``keys_unique``, and of all
    rows for ``has_rows``. A blank entity counts as absent. Keys are counted in one
    aggregation, whose partial sums leave each task as one row a key.
    """
    name = F.nullif(F.trim(F.col(entity).cast("string")), F.lit(""))
    keys = rows.groupBy(name.alias("entity"), F.col(day).alias("day")).agg(F.count("*").alias("n"))
    whole = F.col("entity").isNotNull() & F.col("day").isNotNull()
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    sums = keys.agg(total(F.lit(True)).alias("all"), total(F.col("entity").isNull()).alias("entity"), total(F.col("day").isNull()).alias("day"), F.count_if(whole & (F.col("n") > 1)).alias("keys"))
    state = lambda check, n, fault: F.struct(F.lit(check).alias("check"), F.when(fault, "fail").otherwise("pass").alias("status"), n.alias("n"))
    c = F.col
    return sums.select(F.inline(F.array(
        state("has_rows", c("all"), c("all") == 0), state("entity_present", c("entity"), c("entity") > 0),
        state("day_present", c("day"), c("day") > 0), state("keys_unique", c("keys"), c("keys") > 0),
    )))


def write_dataset(rows: DataFrame, folder: str, keys: list[str]) -> dict[str, str]:
    """Writes ``rows`` to ``folder``/parquet (typed) and /csv (text, nulls as empty) and gives both paths.

    The CSV is written from the Parquet, so the rows are worked out once. A null or
    repeated key, or no rows at all, is an error, found on what was written.
    """
    files = {kind: f"{folder}/{kind}" for kind in ("parquet", "csv")}
    rows.write.parquet(files["parquet"])
    written = rows.sparkSession.read.schema(rows.schema).parquet(files["parquet"])
    some = written.limit(1).count()
    null = written.filter(" or ".join(f"`{k}` is null" for k in keys)).limit(1).count()
    repeated = written.groupBy(*keys).count().filter("count > 1").limit(1).count()
    if not some or null or repeated:
        raise ValueError("the dataset is empty" if not some else "a key is null" if null else "a key is repeated")
    written.write.option("header", True).option("nullValue", "").option("emptyValue", "").csv(files["csv"])
    return files


def read_csv(spark: SparkSession, files: dict[str, str], columns: list[str]) -> DataFrame:
    """The CSV as text, empty where a value was null."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(text).option("header", True).csv(files["csv"])
    return rows.select(*(F.coalesce(c, F.lit("")).alias(c) for c in columns))


# What no exported file may hold.
MARKERS = ("DATABASE_URL", "postgresql+psycopg2://", "collector_password", "TELEGRAM_TOKEN")


def file_entries(spark: SparkSession, files: dict[str, str], markers: tuple[str, ...] = MARKERS) -> DataFrame:
    """(format, path, bytes_size, sha256, markers) of every file of a written dataset; ``markers`` are those of the given texts that it holds.

    A task reads one file at a time; the writer's ``maxRecordsPerFile`` bounds their size.
    """
    out = None
    for kind, folder in files.items():
        rows = spark.read.format("binaryFile").option("pathGlobFilter", f"part-*.{kind}").option("recursiveFileLookup", True).load(folder)
        held = F.array_compact(F.array(*(F.when(F.contains("content", F.lit(m).cast("binary")), F.lit(m)) for m in markers)))
        own = rows.select(F.lit(kind).alias("format"), "path", F.col("length").alias("bytes_size"), F.sha2("content", 256).alias("sha256"), held.alias("markers"))
        out = own if out is None else out.unionByName(own)
    return out


def checked_manifest(spark: SparkSession, files: dict[str, str], schema: T.StructType, entity: str, day: str, flags: str) -> DataFrame:
    """``manifest`` with the number and size of the files, one digest of their digests, and whether every CSV has the header.

    An error if there are no rows or files, if days are out of order, if CSV and Parquet
    differ, if a header isn't that of the schema, or if a file holds one of ``MARKERS``.
    """
    about = manifest(spark, files, schema, entity, day, flags)
    entries = file_entries(spark, files)
    listed = entries.agg(
        F.count("*").alias("n_files"), F.sum("bytes_size").alias("bytes_size"), F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ","), 256).alias("files_sha256"), F.array_distinct(F.flatten(F.collect_list("markers"))).alias("markers"), F.count_distinct("format").alias("formats")
    )
    lines = spark.read.text(files["csv"]).filter(F.col("value") == ",".join(schema.names)).agg(F.count("*").alias("n_headers"))
    csvs = entries.filter("format = 'csv'").agg(F.count("*").alias("n_csv_files"))
    row = about.crossJoin(listed).crossJoin(lines).crossJoin(csvs)  # one row each
    (one,) = row.collect()
    wrong = {
        "it has no rows": one["n_rows"] <= 0, "its days are out of order": one["first_day"] is not None and one["first_day"] > one["last_day"], "it lists no files": one["n_files"] <= 0, "CSV and Parquet differ": not one["csv_equals_parquet"],
        "a CSV file lacks its header": one["n_headers"] < one["n_csv_files"], f"files hold {', '.join(one['markers'])}": bool(one["markers"]),
    }
    if any(wrong.values()):
        raise ValueError("; ".join(k for k, v in wrong.items() if v))
    return row


def manifest(spark: SparkSession, files: dict[str, str], schema: T.StructType, entity: str, day: str, flags: str) -> DataFrame:
    """One row about a written dataset: counts, columns, entities, days, a digest free of order, and whether both forms hold the same text."""
    typed = spark.read.schema(schema).parquet(files["parquet"])
    columns = schema.names
    digest = F.bit_xor(F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))
    about = typed.agg(
        F.count("*").alias("n_rows"), F.array_join(F.array_sort(F.collect_set(F.col(entity).cast("string"))), ",").alias("entities"),
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_if(F.col(flags).isNull()).alias("unflagged"), digest.alias("digest"),
    )
    text = read_csv(spark, files, columns).agg(F.count("*").alias("n_csv"), digest.alias("csv_digest"))
    both = about.crossJoin(text)  # one row each
    return both.select(
        "*", F.lit(len(columns)).alias("n_columns"), F.lit(",".join(sorted(columns))).alias("columns"),
        ((F.col("n_rows") == F.col("n_csv")) & F.col("digest").eqNullSafe(F.col("csv_digest"))).alias("csv_equals_parquet"),
    )
