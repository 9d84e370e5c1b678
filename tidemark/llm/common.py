"""Helpers shared by the operators: tables, shared scratch space and clash-free columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no shared folder and runs in a single process (tests).
LOCAL_SCRATCH = "/tmp/checkpoints"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session without that setting may use a local folder only if driver and
    executors are one process; on a cluster the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.conf.get("spark.master", "")
    if not (master.startswith("local") and not master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return LOCAL_SCRATCH


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage, so a lost executor never repeats the work before it.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tidemark/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return written_in(spark.read.schema(df.schema).parquet(path), path)


def written_in(df: DataFrame, folder: str) -> DataFrame:
    """``df``, marked as reading the written ``folder`` and no other."""
    df.written_folder = folder
    return df


def discard(df: DataFrame) -> None:
    """Delete the folder that ``materialize`` wrote for ``df``; nothing may read it any more."""
    session = df.sparkSession
    path = session._jvm.org.apache.hadoop.fs.Path(df.written_folder)
    path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    """Partitions so that each holds about ``per_part`` rows."""
    return max(least, -(-rows // per_part))
