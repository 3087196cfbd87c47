"""Sessions and worker set-up."""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def local_session(name: str = "lumentrace", cores: int | str = "*", shuffle: int = 8) -> SparkSession:
    """A single-node session with the settings that the library expects everywhere."""
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([ROOT, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LUMENTRACE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers of this application import the library from where the driver has it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


@contextmanager
def no_shuffles_left(spark: SparkSession) -> Iterator[None]:
    """What is run in here leaves no shuffle files when it ends. Otherwise they stay until the driver happens to collect its garbage, which it does the later the less it has to do."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
