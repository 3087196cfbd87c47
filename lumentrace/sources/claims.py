"""Names that only one of several writers can take, on any file system that Spark reaches.

A claim is a small file that appears whole and at once, or not at all because another has it: a hard link on local disks, a rename that
replaces nothing on HDFS and its like, a conditional put in object stores."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Stores whose rename is no single step, and whose create() without overwriting is one.
OBJECT_STORES = ("s3a", "s3", "gs", "abfs", "abfss", "wasbs", "oss", "cosn")


class Conflict(ValueError):
    """Something else is there under the same key."""


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, p, p.getFileSystem(conf)


def exists(spark: SparkSession, path: str) -> bool:
    _, _, p, fs = _hadoop(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    _, _, p, fs = _hadoop(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    _, _, p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def _put(jvm, fs, p, text: str, overwrite: bool) -> None:
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the name could be taken; its file then holds text."""
    jvm, conf, p, fs = _hadoop(spark, path)
    scheme = fs.getUri().getScheme()
    if scheme == "file":
        target = p.toUri().getPath()
        folder, own = os.path.dirname(target), f"{target}.{uuid.uuid4().hex}.tmp"
        os.makedirs(folder, exist_ok=True)
        with open(own, "x", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(own, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
        return True
    if scheme in OBJECT_STORES:
        try:
            _put(jvm, fs, p, text, False)
        except Exception as e:  # the store's own class says that the name is taken; anything else is an error
            if fs.exists(p) and taken(spark, path) != text:
                return False
            if fs.exists(p):
                return True
            raise e
        return True
    own = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs.mkdirs(p.getParent())
    _put(jvm, fs, own, text, False)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(own, p, how)
    except Exception as e:
        fs.delete(own, False)
        if fs.exists(p):
            return False
        raise e
    return True


def taken(spark: SparkSession, path: str) -> str | None:
    """What the file of a claim holds; None if nobody has it."""
    jvm, _, p, fs = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


class Commits:
    """Commits of a folder, numbered from 1 without gaps: each names a pending folder, which becomes commit=<number>.

    A writer that has claimed a number and died before its folder was renamed is completed by whoever comes next."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def pending(self) -> str:
        """The name of a new folder that no reader sees."""
        return f"_pending-{uuid.uuid4().hex}"

    def last(self) -> int:
        return max((int(n) for n in names(self.spark, f"{self.root}/_claims") if n.isdigit()), default=0)

    def place(self, number: int) -> str:
        return f"{self.root}/commit={number}"

    def settle(self) -> int:
        """The last commit, after all have their folders. Only the latest can lack theirs, as every writer settles first."""
        last = self.last()
        for number in range(last, 0, -1):
            if exists(self.spark, self.place(number)):
                break
            own = f"{self.root}/{taken(self.spark, f'{self.root}/_claims/{number}')}"
            jvm, _, p, fs = _hadoop(self.spark, own)
            # whoever comes second finds the folder gone, before the renaming or in the middle of it, and the commit's there
            try:
                done = fs.exists(p) and fs.rename(p, jvm.org.apache.hadoop.fs.Path(self.place(number)))
            except Py4JJavaError:
                if not exists(self.spark, self.place(number)):
                    raise
                done = True
            if not done and not exists(self.spark, self.place(number)):
                raise Conflict(f"commit {number} has no folder")
        return last

    def commit(self, after: int, pending: str) -> bool:
        """Whether pending has become the commit behind `after`; false if another writer was first."""
        if not claim(self.spark, f"{self.root}/_claims/{after + 1}", pending):
            return False
        self.settle()
        return True
