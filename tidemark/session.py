"""Session and table helpers shared by every driver query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session with the settings the library assumes (UTC, ANSI, AQE)."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """A folder that driver and executors share: ``spark.checkpoint.dir``, or a local one in a single process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "/tmp/checkpoints"
