"""Folders for intermediate tables that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from lumentrace.session import no_shuffles_left, ready

_local: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, one in a temporary folder with a local master; on a cluster an error."""
    ready(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _local:
            keep = tempfile.TemporaryDirectory(prefix="lumentrace-work-")
            atexit.register(keep.cleanup)
            _local.append(f"file://{keep.name}")
        root = _local[0]
    return f"{root.rstrip('/')}/lumentrace-work/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """df, computed once and read from a table from then on."""
    path = scratch(df.sparkSession)
    with no_shuffles_left(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
