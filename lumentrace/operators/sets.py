"""Differences between keyed tables, and unions with precedence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differences(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """(key, difference) over the union of keys: missing on the right, unrecorded on the left, or differs."""
    a = left.select(key, F.col(value).alias("_a"), F.lit(True).alias("_l"))
    b = right.select(key, F.col(value).alias("_b"), F.lit(True).alias("_r"))
    what = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "unrecorded").when(~F.col("_a").eqNullSafe(F.col("_b")), "differs")
    return a.join(b, key, "full_outer").withColumn("difference", what).where("difference IS NOT NULL").select(key, "difference")


def audit(expected: DataFrame, found: DataFrame, key: list[str], category: Column) -> DataFrame:
    """(category, missing, extra): keys of either side that the other has not."""
    a = expected.join(found, key, "left_anti").select(category.alias("category"), F.lit(1).alias("missing"), F.lit(0).alias("extra"))
    b = found.join(expected, key, "left_anti").select(category.alias("category"), F.lit(0).alias("missing"), F.lit(1).alias("extra"))
    return a.unionAll(b).groupBy("category").agg(F.sum("missing").alias("missing"), F.sum("extra").alias("extra"))


def pooled(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """Rows of all parts, for each key those of the first part that has it, by one aggregation."""
    tagged = [p.withColumn("_turn", F.lit(i)) for i, p in enumerate(parts)]
    all_rows = reduce(lambda x, y: x.unionByName(y), tagged)
    rest = [c for c in parts[0].columns if c not in key]
    return all_rows.groupBy(*key).agg(F.min_by(F.struct(*rest, F.col("_turn").alias("origin")), "_turn").alias("_r")).select(*key, *(F.col(f"_r.{c}") for c in [*rest, "origin"]))


def backfilled(facts: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Keys of facts that have not got a row yet, once each."""
    return facts.select(key).distinct().join(have.select(key).distinct(), key, "left_anti")
