"""Ordered computations: gaps and islands, latest rows, blocks of indices, trailing counts, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentrace.functions.scalars import piece_count
from lumentrace.sources.work import kept


def _w(by: list[str], order: list):
    return Window.partitionBy(*by).orderBy(*order)


def with_breaks(df: DataFrame, by: list[str], start: str, gap: float, order: list | None = None, name: str = "is_break") -> DataFrame:
    """name: whether a row begins a recording, as the first of its group or more than gap after the one before."""
    before = F.lag(start).over(_w(by, order or [start]))
    return df.withColumn(name, before.isNull() | (F.col(start) - before > gap))


def with_islands(df: DataFrame, by: list[str], begins: str, order: list, name: str = "island") -> DataFrame:
    """name: number of the island, from 1, that rows belong to; begins marks the first of each."""
    return df.withColumn(name, F.sum(F.col(begins).cast("long")).over(_w(by, order).rowsBetween(Window.unboundedPreceding, 0)))


def merge_gaps(df: DataFrame, by: list[str], start: str, end: str, gap: float) -> DataFrame:
    """Intervals of a group joined where one begins at most gap after the end of the one before; a joined interval ends with its last member."""
    w = _w(by, [start, end])
    flagged = df.withColumn("_new", F.coalesce((F.col(start) - F.lag(end).over(w) > gap).cast("long"), F.lit(1)))
    marked = flagged.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = marked.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max_by(end, F.struct(start, end)).alias(end), F.count("*").alias("members"))
    return out.drop("_island")


def runs_above(df: DataFrame, by: list[str], order: str, flag: Column) -> DataFrame:
    """(by, first, last, length) of maximal runs of consecutive rows where flag holds."""
    w = _w(by, [order])
    x = df.withColumn("_f", F.coalesce(flag, F.lit(False))).withColumn("_c", F.coalesce((F.col("_f") != F.lag("_f").over(w)).cast("long"), F.lit(1)))
    x = x.withColumn("_r", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_f")
    return x.groupBy(*by, "_r").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("length")).drop("_r")


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the order of these columns; one hash aggregation."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*key, *(F.col(f"_r.{c}").alias(c) for c in rest))


def keep_best(df: DataFrame, key: list[str], ok: str, turn: str) -> DataFrame:
    """The first successful row of each key, or its first row where none succeeded."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(F.col(ok).cast("int"), -F.col(turn))).alias("_r")).select(*key, *(F.col(f"_r.{c}").alias(c) for c in rest))


def sums_before(df: DataFrame, by: list[str], order: list[str], n: str, name: str, parts: int | None = None) -> DataFrame:
    """name: the sum of n over the rows of the group that come before, in two levels: within ranges of the order, and over the sums of ranges.

    No task sees more than a range of a group, however large groups are. by and order together should be unique."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges are drawn from samples, anew each time: both uses read them from one table
    spread = kept(df.repartitionByRange(parts, *by, *order).withColumn("_p", F.spark_partition_id()))
    inside = Window.partitionBy("_p", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    spread = spread.withColumn("_in", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    # a row for each range of a group
    sums = spread.groupBy("_p", *by).agg(F.sum(n).alias("_n"))
    ahead = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_p", *(F.col(c).alias(f"_by_{c}") for c in by), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before")) if by else sums.select("_p", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    sums = sums.withColumnRenamed("_p", "_q")
    same = F.col("_p") == F.col("_q")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return spread.join(sums, same).withColumn(name, F.col("_before") + F.col("_in")).drop("_p", "_q", "_in", "_before", *(f"_by_{c}" for c in by))


def index_blocks(df: DataFrame, by: list[str], order: list[str], n: str, name: str = "idx_base") -> DataFrame:
    """name: 1 and what the rows before take, so that blocks of n numbers lie end to end."""
    return sums_before(df, by, order, n, name).withColumn(name, F.col(name) + 1)


def trail(df: DataFrame, by: list[str], order: list, valid: Column, value: Column, points: int) -> DataFrame:
    """trail: the values of the last `points` valid rows up to each valid row; empty for others, which do not break the series."""
    good = df.where(valid).withColumn("trail", F.collect_list(value).over(_w(by, order).rowsBetween(-(points - 1), 0)))
    bad = df.where(~F.coalesce(valid, F.lit(False)))
    kind = good.schema["trail"].dataType
    return good.unionByName(bad.withColumn("trail", F.array().cast(kind)))


def trailing_count(df: DataFrame, by: list[str], micros: str, width: int, name: str = "recent") -> DataFrame:
    """name: rows of the group in the width microseconds up to each row, the far end excluded."""
    w = Window.partitionBy(*by).orderBy(micros).rangeBetween(-(width - 1), 0)
    return df.withColumn(name, F.count("*").over(w))


def fixed_windows(df: DataFrame, duration: str, width: float) -> DataFrame:
    """(index, offset, length) windows of each row's duration; the tail is kept, none is empty."""
    n = F.ceil(F.col(duration) / width).cast("long")
    x = df.where(F.col(duration) > 0).withColumn("index", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    return x.withColumn("offset", F.col("index") * F.lit(width)).withColumn("length", F.least(F.lit(width), F.col(duration) - F.col("offset")))


def even_pieces(df: DataFrame, duration: str, target: float) -> DataFrame:
    """(piece, pieces, offset, length): the fewest equal pieces of about target."""
    x = df.withColumn("pieces", piece_count(F.col(duration), target)).withColumn("piece", F.explode(F.sequence(F.lit(1).cast("long"), F.col("pieces"))))
    size = F.col(duration) / F.col("pieces")
    return x.withColumn("offset", (F.col("piece") - 1) * size).withColumn("length", size)


def shard(df: DataFrame, order: str, count: int, index: int) -> DataFrame:
    """Every count-th row in a global order, from index. The order is found by counts of range partitions, not in one task."""
    return ranked(df, [order], "_row").where(F.pmod(F.col("_row") - 1, F.lit(count)) == index).drop("_row")


def ranked(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """name: place in a global order, from 1, in two levels: buckets by leading quantiles of the first order column, then places within buckets.

    Ties in the first column stay in one bucket; rows are spread as the quantiles spread them."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges are drawn from samples, anew each time: both uses read them from one table
    spread = kept(df.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()))
    spread = spread.select("*", F.row_number().over(Window.partitionBy("_p").orderBy(*order)).alias("_i"))
    sizes = spread.groupBy("_p").agg(F.max("_i").alias("_n"))
    # a row for each of the n partitions
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return spread.join(F.broadcast(before), "_p").withColumn(name, F.col("_before") + F.col("_i")).drop("_p", "_i", "_before")


def top_then_order(df: DataFrame, by: list[str], k: int, rank: list, order: list) -> DataFrame:
    """The k first rows of each group by rank, in another order."""
    return df.withColumn("_k", F.row_number().over(_w(by, rank))).where(F.col("_k") <= k).drop("_k").orderBy(*order)


def per_group_limit(df: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(_w(by, order))).where(F.col("_k") <= most).drop("_k")
