"""What the corpus operators share: staged tables, byte-level words, column names."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumentrace.session import no_shuffles_left, ready

#: What stands for a missing id wherever ids are compared or joined.
NO_ID = -(2**63)

_local_root: list[str] = []
_staged: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a temporary folder on a local master; on a cluster an error."""
    ready(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local_root:
        keep = tempfile.TemporaryDirectory(prefix="lumentrace-")
        atexit.register(keep.cleanup)
        _local_root.append(f"file://{keep.name}")
    return _local_root[0]


def work_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables, among those of this application."""
    return f"{shared_root(spark)}/lumentrace/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def staged(df: DataFrame, scope: str = "") -> DataFrame:
    """df, computed once, written to the shared folder and read from there: a lost executor costs nothing, and no later plan computes it again.

    scope names a group of tables that release() deletes together; what is left of an application is in one folder of its id."""
    path = work_folder(df.sparkSession)
    with no_shuffles_left(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    _staged.setdefault(scope, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one column, long: rows, their sum modulo 2^64, the least and the greatest."""
    n, total, ends = 0, 0, []
    for batch in batches:
        x = batch.column(0).to_numpy()
        if len(x):
            n, total, ends = n + len(x), (total + int(x.view(np.uint64).sum(dtype=np.uint64))) % 2**64, [min([*ends[:1], int(x.min())]), max([*ends[1:], int(x.max())])]
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (n, total - 2**63, *ends)], ["n", "total", "least", "most"])


def tally(df: DataFrame, of: Column) -> tuple[int, int, int | None, int | None]:
    """Rows of a staged table, and of a long column that has no nulls the sum modulo 2^64, the least and the greatest; four numbers a task go to the driver, without a shuffle."""
    rows = df.select(of.alias("x")).mapInArrow(_tallies, "n long, total long, least long, most long").collect()
    return sum(r.n for r in rows), sum(r.total + 2**63 for r in rows) % 2**64, min((r.least for r in rows), default=None), max((r.most for r in rows), default=None)


def delete_folder(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def release(spark: SparkSession, scope: str) -> None:
    """Deletes the staged tables of a scope, whose results must have been written by now."""
    for path in _staged.pop(scope, []):
        delete_folder(spark, path)


def release_all(spark: SparkSession) -> None:
    """Deletes all staged tables of this application; results that were not written or collected cannot be read any more."""
    for scope in list(_staged):
        release(spark, scope)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df has not got, in any spelling of its case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run over the batches of a task; what it has freed by the end goes back to the system, as workers live on and wait for other tasks."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return whole


def id_key(col: str) -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")
