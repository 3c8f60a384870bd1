"""Session settings and scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "gridtide", **conf) -> SparkSession:
    """A single-machine session for tests and benchmarks. On a cluster, bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores) if cores != "*" else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder of ``spark.checkpoint.dir``; a local one only where all runs on one machine (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not (spark.sparkContext.master or "").split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share: intermediate tables go there")
    base = shared or tempfile.mkdtemp(prefix="gridtide-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch space and read again: it is computed once, and what follows has a short plan."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
