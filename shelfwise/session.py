"""SparkSession helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "shelfwise", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark (UI off, AQE on)."""
    master = master or os.environ.get("SHELFWISE_MASTER", "local[*]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SHELFWISE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table_dir(spark: SparkSession) -> str:
    """Folder for tables that a sink is asked to write without a path: what the session's
    ``spark.checkpoint.dir`` names, else its warehouse."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir or spark.sql.warehouse.dir, or give a path")
    return path.rstrip("/")


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """Write a table to :func:`table_dir` and read it back: the lineage is cut there."""
    path = f"{table_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
