"""Joins: correlation of responses, intervals, patches, votes by containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentrace.operators.containment import held_by


def overlap(left: DataFrame, right: DataFrame, keys: list[str], l: tuple[str, str], r: tuple[str, str], bucket: int) -> DataFrame:  # noqa: E741
    """Pairs of half-open integer intervals of equal keys that share a point.

    Each interval is entered under every bucket it reaches, and a pair is taken in the bucket where the later of both begins, so
    that it is an equi-join and each pair comes once. bucket should be about the length of the longer intervals."""
    lo = lambda s: F.floor(F.col(s) / bucket)
    hi = lambda e: F.floor((F.col(e) - 1) / bucket)
    a = left.where(F.col(l[1]) > F.col(l[0])).withColumn("_bucket", F.explode(F.sequence(lo(l[0]), hi(l[1]))))
    b = right.where(F.col(r[1]) > F.col(r[0])).withColumn("_bucket", F.explode(F.sequence(lo(r[0]), hi(r[1]))))
    hit = (F.col(l[0]) < F.col(r[1])) & (F.col(r[0]) < F.col(l[1])) & (F.col("_bucket") == F.floor(F.greatest(F.col(l[0]), F.col(r[0])) / bucket))
    return a.join(b, [*keys, "_bucket"]).where(hit).drop("_bucket")


def points_in(points: DataFrame, spans: DataFrame, keys: list[str], at: str, span: tuple[str, str], bucket: int) -> DataFrame:
    """Points within closed integer intervals of equal keys."""
    p = points.withColumn("_bucket", F.floor(F.col(at) / bucket))
    s = spans.where(F.col(span[1]) >= F.col(span[0])).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(span[0]) / bucket), F.floor(F.col(span[1]) / bucket))))
    return p.join(s, [*keys, "_bucket"]).where(F.col(at).between(F.col(span[0]), F.col(span[1]))).drop("_bucket")


def clipped(df: DataFrame, start: str, end: str, of_start: str, of_end: str) -> DataFrame:
    """t_start and t_end: the shared part, counted from of_start."""
    return df.withColumn("t_start", F.greatest(F.col(start), F.col(of_start)) - F.col(of_start)).withColumn("t_end", F.least(F.col(end), F.col(of_end)) - F.col(of_start))


def correlate(expected: DataFrame, responses: DataFrame, key: str, bad_row: Column, invalid: Column) -> DataFrame:
    """expected with n_responses and code: null for one sound response, else the first failure that holds.

    bad_row and invalid are conditions on a response. Responses are reduced to one row a key before the join."""
    r = responses.groupBy(key).agg(F.count("*").alias("n_responses"), F.max(bad_row.cast("int")).alias("_bad"), F.max(invalid.cast("int")).alias("_invalid"))
    code = F.when(F.col("n_responses") == 0, "MISSING_RESPONSE").when(F.col("n_responses") > 1, "DUPLICATE_RESPONSE").when(F.col("_bad") == 1, "ROW_ERROR").when(F.col("_invalid") == 1, "INVALID_OUTPUT")
    return expected.join(r, key, "left").withColumn("n_responses", F.coalesce("n_responses", F.lit(0))).withColumn("code", code).drop("_bad", "_invalid")


def unmatched(responses: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """One row with the number of responses that nobody asked for."""
    return responses.join(expected.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("n")).select(F.lit("UNMATCHED_RESPONSE").alias("code"), "n")


def patched(base: DataFrame, patch: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """base, with the fields of a patch row of the same key where the patch has them; is_patched says whether it had a row."""
    p = patch.select(*key, *(F.col(f).alias(f"_p_{f}") for f in fields), F.lit(True).alias("_p"))
    out = base.join(p, key, "left").withColumns({f: F.coalesce(f"_p_{f}", f) for f in fields}).withColumn("is_patched", F.coalesce("_p", F.lit(False)))
    return out.drop("_p", *(f"_p_{f}" for f in fields))


def patch_faults(base: DataFrame, patch: DataFrame, key: list[str], fixed: list[str]) -> DataFrame:
    """(key, fault): patch rows that name an unknown key, name one twice, or change a fixed field."""
    counted = patch.groupBy(*key).agg(F.count("*").alias("_n"), *(F.first(f).alias(f"_p_{f}") for f in fixed))
    j = counted.join(base.select(*key, *fixed, F.lit(True).alias("_known")), key, "left")
    moved = F.lit(False)
    for f in fixed:
        moved = moved | ~F.col(f).eqNullSafe(F.col(f"_p_{f}"))
    fault = F.when(F.col("_known").isNull(), "unknown").when(F.col("_n") > 1, "duplicate").when(moved, "changed")
    return j.withColumn("fault", fault).where("fault IS NOT NULL").select(*key, "fault")


def by_hash(rows: DataFrame, key: str, values: list[str], order: list[str]) -> DataFrame:
    """(key, releases): all rows of a key, the newest first."""
    names = [*order, *(v for v in values if v not in order)]
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*names)), asc=False).alias("releases"))


def contained(left: DataFrame, left_id: str, right: DataFrame, right_id: str, text: str) -> DataFrame:
    """(left_id, right_id) of every pair of which one text holds the other or equals it; null and empty texts take no part.

    Candidates of any length, with words or without, come from equi-joins, see containment; contains() verifies."""
    a, b = (df.select(F.col(i).alias("id"), F.col(text).alias("t")).where("t <> ''") for df, i in ((left, left_id), (right, right_id)))
    named = lambda d, n: d.select(F.col("id").alias(n), "t")
    both = held_by(named(a, "i"), named(b, "o")).select(F.col("i").alias(left_id), F.col("o").alias(right_id))
    return both.unionAll(held_by(named(b, "i"), named(a, "o")).select(F.col("o").alias(left_id), F.col("i").alias(right_id))).distinct()


def short_contained(left: DataFrame, a: str, right: DataFrame, b: str) -> DataFrame:
    """(a, b): pairs of distinct short texts of which one holds the other or equals it; null and empty ones take no part.

    Each text is entered under its substrings of those lengths that the texts of the other side have: equi-joins both ways. The
    lengths, no more than the longest text has characters, are the only thing that is gathered."""

    def held(inner: DataFrame, i: str, outer: DataFrame, o: str) -> DataFrame:
        lengths = sorted(r[0] for r in inner.select(F.length(i)).distinct().collect())

        def of_length(n: int) -> Column:
            starts = F.sequence(F.lit(1), F.greatest(F.length(o) - n + 1, F.lit(1)))
            return F.when(F.length(o) >= n, F.transform(starts, lambda at: F.substr(F.col(o), at, F.lit(n)))).otherwise(F.array().cast("array<string>"))

        cut = [of_length(n) for n in lengths]
        parts = F.array_distinct(F.flatten(F.array(*cut))) if cut else F.array().cast("array<string>")
        return outer.select(o, F.explode(parts).alias(i)).join(inner, i).select(a, b)

    x, y = (d.select(c).where(F.col(c) != "").distinct() for d, c in ((left, a), (right, b)))
    return held(x, a, y, b).unionAll(held(y, b, x, a)).distinct()
