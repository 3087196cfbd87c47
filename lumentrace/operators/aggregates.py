"""Grouped figures: status rollups, two-level rollups, index quantiles, audits, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_counts(df: DataFrame, by: list[str], status: str, names: list[str]) -> DataFrame:
    """A column for each status with its number of rows, and total."""
    return df.groupBy(*by).agg(F.count("*").alias("total"), *(F.count_if(F.col(status) == n).alias(n) for n in names))


def index_quantile(df: DataFrame, by: list[str], value: str, index: Column, name: str) -> DataFrame:
    """The value at a place (from 0, an expression of n) in the sorted values of each group, without collecting groups.

    Values are counted first; places come from sums over ranges of distinct values, so that a group is spread over many tasks."""
    from lumentrace.operators.windows import sums_before

    some = df.where(F.col(value).isNotNull())
    total = some.groupBy(*by).agg(F.count("*").alias("n"))
    counted = some.groupBy(*by, value).agg(F.count("*").alias("_c"))
    placed = sums_before(counted, by, [value], "_c", "_from").join(total, by)
    return placed.where((F.col("_from") <= index) & (F.col("_from") + F.col("_c") > index)).select(*by, "n", F.col(value).alias(name))


def two_levels(df: DataFrame, inner: list[str], outer: list[str], sums: dict[str, Column], digits: int) -> DataFrame:
    """Sums by the inner groups, rounded half to even, and then sums of these by the outer groups, rounded again."""
    first = df.groupBy(*inner).agg(*(F.bround(F.sum(v), digits).alias(k) for k, v in sums.items()))
    return first.groupBy(*outer).agg(F.count("*").alias("members"), *(F.bround(F.sum(k), digits).alias(k) for k in sums))


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """Null where the whole is zero."""
    return F.bround(F.try_divide(part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0))), digits)


def prefix_counts(df: DataFrame, path: Column, prefixes: list[str]) -> DataFrame:
    """Objects under each of the prefixes, zeros included."""
    counted = df.groupBy(path.alias("prefix")).agg(F.count("*").alias("n"))
    keys = df.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix string")
    return keys.join(counted, "prefix", "left").select("prefix", F.coalesce("n", F.lit(0)).alias("n"))


def pattern_counts(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """A row of the number of matches of each pattern in all texts."""
    return df.agg(*(F.coalesce(F.sum(F.regexp_count(F.col(text), F.lit(p))), F.lit(0)).cast("long").alias(n) for n, p in patterns.items()))


def map_fingerprint(df: DataFrame, by: list[str], name: str, digest: str) -> DataFrame:
    """SHA-256 of the sorted "name": "digest" pairs of a group, as a JSON object with a space behind colons and commas."""
    pair = F.struct(F.col(name).alias("n"), F.concat(F.lit('"'), F.col(name), F.lit('": "'), F.col(digest), F.lit('"')).alias("t"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(pair)), lambda p: p["t"]), ", ")
    return df.groupBy(*by).agg(F.sha2(F.concat(F.lit("{"), joined, F.lit("}")), 256).alias("fingerprint"), F.count("*").alias("files"))


def regrouped(df: DataFrame, key: str, sub: str, value: str, order: str) -> DataFrame:
    """(key, values): a map from sub to its last value."""
    last = df.groupBy(key, sub).agg(F.max_by(value, order).alias("_v"))
    return last.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(sub, "_v")))).alias("values"))


def smallest(df: DataFrame, by: list[str], value: str, k: int) -> DataFrame:
    """The rows of the k smallest values of each group; each task passes on k a group at most."""
    from pyspark.sql import Window

    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(value))).where(F.col("_k") <= k).drop("_k")
