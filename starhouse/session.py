"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Of the library's parquet files: about a quarter smaller than Spark's default.
COMPRESSION = "zstd"


def local_session(cores: int | str = "*", name: str = "starhouse", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the cluster's shared folder (``spark.checkpoint.dir``).

    Every executor must reach it, so a machine-local folder is accepted only
    when the whole session is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster is a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.gettempdir()
    app = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/starhouse/{app}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Used where a later plan should know the real size of a derived frame, or
    read it several times without recomputing it.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)
