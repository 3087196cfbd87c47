"""Sinks: write once, bounded, ordered, versioned."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumentrace.sources.claims import Commits, Conflict, claim, delete, names, taken

MOST_ROWS, MOST_BYTES = 200_000, 1_000_000_000


def write_once(df: DataFrame, path: str, key: str, content: str, tries: int = 100) -> int:
    """Appends rows whose key is new. Rows that are there with the same content are fine, others a Conflict; returns the rows written.

    Keys that repeat within df must agree too. df is computed once, into a folder that readers do not see. Rows appear by a commit that names the one
    before it; if another writer was first, keys are compared anew, so that of several writers each key has one. Null is a key like others, as is null content."""
    spark, commits = df.sparkSession, Commits(df.sparkSession, path)
    sha = F.sha2(F.coalesce(F.concat(F.lit("1"), F.col(content).cast("string")), F.lit("0")), 256)
    own = commits.pending()
    df.withColumn("_sha", sha).write.parquet(f"{commits.root}/{own}")
    mine = spark.read.parquet(f"{commits.root}/{own}")
    try:
        if mine.groupBy(key).agg(F.count_distinct("_sha").alias("n")).where("n > 1").take(1):
            raise Conflict("keys with several contents")
        all_rows = mine.count()
        single = mine.groupBy(key).agg(F.min(F.struct("_sha", *(c for c in mine.columns if c not in ("_sha", key)))).alias("r")).select(key, "r.*") if _plain(mine, key) else mine.dropDuplicates([key])
        for _ in range(tries):
            last = commits.settle()
            new = single
            if last:
                there = spark.read.parquet(commits.root).select(F.col(key).alias("_k"), F.col("_sha").alias("_there"))
                met = F.col(key).eqNullSafe(F.col("_k"))
                if mine.join(there, met).where("_sha <> _there").take(1):
                    raise Conflict("other content under a key that is there")
                new = single.join(there, met, "left_anti")
            n = new.count()
            if not n:
                return 0
            if n == all_rows:
                if commits.commit(last, own):
                    return n
                continue
            part = commits.pending()
            new.select(*mine.columns).write.parquet(f"{commits.root}/{part}")
            if commits.commit(last, part):
                return n
            delete(spark, f"{commits.root}/{part}")
        raise Conflict(f"{tries} other commits came first")
    finally:
        delete(spark, f"{commits.root}/{own}")


def _plain(df: DataFrame, key: str) -> bool:
    """Whether all columns but the key can be ordered, so that of equal keys the same row is taken always."""
    from pyspark.sql import types as T

    return not any(isinstance(f.dataType, (T.MapType, T.VariantType)) for f in df.schema.fields if f.name != key)


def read_back(expected: DataFrame, published: DataFrame, key: str, content: str) -> DataFrame:
    """(key, kind): what is missing from a published table, differs in it, or is there unexpected, by one full join; keys are compared as they are, and each should come once a side."""
    a = expected.select(F.col(key).alias("_a"), F.col(content).alias("_x"), F.lit(True).alias("_ha"))
    b = published.select(F.col(key).alias("_b"), F.col(content).alias("_y"), F.lit(True).alias("_hb"))
    kind = F.when(F.col("_hb").isNull(), "missing").when(F.col("_ha").isNull(), "unexpected").when(~F.col("_x").eqNullSafe(F.col("_y")), "differs")
    return a.join(b, F.col("_a") == F.col("_b"), "full").select(F.coalesce("_a", "_b").alias(key), kind.alias("kind")).where("kind IS NOT NULL")


def write_bounded(df: DataFrame, path: str, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> None:
    """JSON lines, or an error before anything is written where there are too many rows or bytes."""
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    n, size = lines.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0))).first()
    if n > most_rows or size > most_bytes:
        raise ValueError(f"{n} rows, {size} bytes")
    lines.write.mode("errorifexists").text(path)


def finite_json(df: DataFrame, json: str = "value") -> DataFrame:
    """(json): each row as a JSON object; a number that is not finite fails the query, as JSON has none."""
    from pyspark.sql import types as T

    def checked(c, kind):
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.when(c.isNull() | ~(F.isnan(c) | (F.abs(c) == float("inf"))), c).otherwise(F.raise_error(F.lit("a number that is not finite")).cast(kind))
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*(checked(c[f.name], f.dataType).alias(f.name) for f in kind.fields)))
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: checked(x, kind.elementType))
        return c

    return df.select(F.to_json(F.struct(*(checked(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))).alias(json))


def write_documents(df: DataFrame, path: str) -> None:
    """JSON lines that are there whole or not at all: the files of a job appear when all of it has succeeded, and nothing is replaced."""
    finite_json(df).write.mode("errorifexists").text(path)


def export_finals(finals: DataFrame, fingerprint: str, path: str) -> None:
    """The valid final documents of a run (clip_index, fingerprint, ok, document) as JSON lines in the order of their clips."""
    valid_finals(finals, fingerprint).select("document").write.mode("errorifexists").text(path)


def valid_finals(finals: DataFrame, fingerprint: str) -> DataFrame:
    """Finals that are sound and of the run's fingerprint, in the order of their clips."""
    return finals.where(F.col("ok") & (F.col("fingerprint") == fingerprint) & F.try_parse_json("document").isNotNull()).orderBy("clip_index")


def write_outputs(recordings: DataFrame, segments: DataFrame, root: str) -> None:
    """The outputs of a day: recordings as JSON, their segments as JSON lines in order, and as text (recording, start, text)."""
    write_documents(recordings, f"{root}/recordings")
    finite_json(segments.orderBy("recording", "start")).write.mode("errorifexists").text(f"{root}/segments")
    line = F.concat_ws(" ", F.concat(F.lit("["), F.col("start").cast("string"), F.lit("]")), "text")
    segments.orderBy("recording", "start").select("recording", line.alias("value")).write.mode("errorifexists").partitionBy("recording").text(f"{root}/text")


def write_ordered(frames: dict[str, DataFrame], root: str, order: str) -> None:
    """Each table as JSON lines in the order of one column, in files whose names sort the same way."""
    for name, df in frames.items():
        df.orderBy(order).write.mode("overwrite").json(f"{root}/{name}")


class VersionedState:
    """A small state table with a generation; a write names the generation it has read, and fails if another came between.

    A generation is a name that one writer only can claim, and refers to a folder that was written before. What a loser has written is deleted."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self) -> tuple[int, DataFrame | None]:
        last = max((int(n) for n in names(self.spark, f"{self.root}/_generations") if n.isdigit()), default=0)
        if not last:
            return 0, None
        return last, self.spark.read.json(f"{self.root}/{taken(self.spark, f'{self.root}/_generations/{last}')}")

    def write(self, state: DataFrame, generation: int) -> int:
        if not isinstance(generation, int) or generation < 0:
            raise ValueError("a generation is a whole number from 0")
        if self.read()[0] != generation:
            raise Conflict("generation has moved on")
        own = f"state-{uuid.uuid4().hex}"
        state.coalesce(1).write.json(f"{self.root}/{own}")
        if not claim(self.spark, f"{self.root}/_generations/{generation + 1}", own):
            delete(self.spark, f"{self.root}/{own}")
            raise Conflict("generation has moved on")
        return generation + 1

    def update(self, change: Callable[[DataFrame | None], DataFrame], tries: int = 100) -> int:
        """Writes what change() makes of the state; if another writer was first, of the state that it left."""
        for _ in range(tries):
            generation, state = self.read()
            try:
                return self.write(change(state), generation)
            except Conflict:
                continue
        raise Conflict(f"{tries} other writers came first")
