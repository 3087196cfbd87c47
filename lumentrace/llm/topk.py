"""Exact top-k by inner product with a pivot-distance index.

One more coordinate, sqrt(M - |x|^2) for candidates and 0 for queries, with M the largest squared norm, turns the largest inner
products into the smallest distances. Every candidate is keyed by its nearest pivot and its distance to it, and the keys, in order,
are cut into annuli: packed blocks of up to `annulus_rows` candidates of one pivot whose distances lie between two radii.
Neighbouring annuli form groups, the unit that is opened.

A query first opens the group where its own distance falls, which gives a lower bound for its k-th score. By the triangle
inequality a group whose radii lie further from the query's own distance to the pivot than the distance that matches this
score holds nothing better. The other groups are put in the order of that bound and opened in rounds, 4, 16, 64, ... of them
at a time. After each round the k-th scores of all tasks are brought together; a query stops when its next group lies beyond
the distance that matches its k-th score, and the search stops when no query has a group left.

In a round each opened group is read once, and the queries that open it come to it; only ids and bounds are joined before. Groups
that very many queries open are dealt to several tasks. All scores are exact integers: products are taken in floating point
or in longs where every partial sum is exact there, else in Python's integers.

Pivots come from a bounded sample (`most_sample` rows); every row is indexed, and results never depend on the sample. Vectors
with a component of 2^43 or more in size have no useful distances. They take part as all others do, but without bounds: as
candidates every query opens them, as queries they open every group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumentrace.llm.common import staged

#: Components from here on are integers already, and their squares leave no room for exact bounds.
LARGE = float(1 << 43)
#: The pivot of vectors with such components.
NO_PIVOT = -1
#: Queries that one task takes to a group.
MOST_QUERIES = 1 << 16


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, large): floor(1024 * x) / 1024 of the valid vectors, which a double holds exactly, and whether a component is LARGE."""
    v = F.col(vector_col).cast("array<double>")
    ok = F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    exact = F.transform(v, lambda x: F.when(F.abs(x) < LARGE, F.floor(x * 1024) / F.lit(1024.0)).otherwise(x))
    return vectors.where(F.coalesce(ok, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), exact.alias("v"), F.exists(v, lambda x: F.abs(x) >= LARGE).alias("large"))


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def pivots_of(sample: np.ndarray, count: int, steps: int = 6) -> np.ndarray:
    """Centres of a few Lloyd steps from farthest-first starts."""
    centres = sample[:1]
    far = ((sample - centres[0]) ** 2).sum(axis=1)
    while len(centres) < min(count, len(sample)) and far.max() > 0:
        centres = np.vstack([centres, sample[far.argmax()]])
        far = np.minimum(far, ((sample - centres[-1]) ** 2).sum(axis=1))
    for _ in range(steps):
        near = distances(sample, centres).argmin(axis=1)
        for k in np.unique(near):
            centres[k] = sample[near == k].mean(axis=0)
    return centres


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between rows."""
    return np.sqrt(np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T, 0.0))


def _augmented(x: np.ndarray, largest: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(largest - (x * x).sum(axis=1), 0.0))[:, None]])


def _as_query(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.zeros((len(x), 1))])


#: square is |v|^2, null where a component is LARGE.
_KEYED = "id long, v binary, pivot int, radius double, query_pivot int, query_radius double, square double"


def _key(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, width, largest = shared.value
        for batch in batches:
            x, large = _matrix(batch.column(1).to_pylist(), width), np.array(batch.column(2).to_pylist(), bool)
            kept = np.where(large[:, None], 0.0, x)
            d, q = distances(_augmented(kept, largest), centres), distances(_as_query(kept), centres)
            at, own, row = d.argmin(axis=1), q.argmin(axis=1), np.arange(len(x))
            cols = [np.where(large, NO_PIVOT, at).astype(np.int32), np.where(large, 0.0, d[row, at]), np.where(large, NO_PIVOT, own).astype(np.int32), np.where(large, 0.0, q[row, own])]
            square = pa.array((kept * kept).sum(axis=1), mask=large)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary()), *map(pa.array, cols), square], [c.split()[0] for c in _KEYED.split(", ")])

    return run


_INDEX = "group long, pivot int, low double, high double, ids binary, vectors binary"


def _packed(annulus_rows: int, group_annuli: int):
    """Annuli of the candidates of a task, which come in the order of pivot and radius; and, with a null pivot, the queries whose own distance falls into a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, annuli = TaskContext.get().partitionId() << 32, 0
        rows: list[tuple[int, bytes, float]] = []
        asked: list[int] = []
        pivot = None

        def row(*values) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], [c.split()[0] for c in _INDEX.split(", ")])

        def annulus() -> pa.RecordBatch:
            nonlocal annuli, rows
            radii = [r[2] for r in rows]
            out = row(group, pivot, min(radii), max(radii), np.array([r[0] for r in rows], "<i8").tobytes(), b"".join(r[1] for r in rows))
            rows, annuli = [], annuli + 1
            return out

        for batch in batches:
            for i, v, p, r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if v is None:
                    asked.append(i)
                    continue
                if rows and (p != pivot or len(rows) >= annulus_rows):
                    yield annulus()
                    if annuli >= group_annuli:
                        yield row(group, None, None, None, np.array(asked, "<i8").tobytes(), None)
                        group, annuli, asked = group + 1, 0, []
                pivot = p
                rows.append((i, v, r))
        if rows:
            yield annulus()
        if asked:
            yield row(group, None, None, None, np.array(asked, "<i8").tobytes(), None)

    return run


def _first_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query_id, group) of packed queries."""
    for batch in batches:
        for group, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = np.frombuffer(ids, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), group))], ["query_id", "group"])


def reach_of(square, least, largest: float):
    """The distance at which a candidate has the score `least` (of floor(1024 x)), a little more to cover rounding; infinite where there is no such score. square: |q|^2."""
    with np.errstate(over="ignore", invalid="ignore"):
        size = square + largest + 1
        out = np.sqrt(np.maximum(size - 1 - 2 * least / 2.0**20, 0.0) + 1e-9 * size) + 1e-6 * np.sqrt(size)
    return np.where(np.isfinite(out), out, np.inf)


def _reaches(shared):
    """(query_id, pivot, d, reach): what each query can profit from, with a row for vectors without a pivot. Input: (id, v, least)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, width, largest = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            q, d, reach = _measured(batch.column(1).to_pylist(), [-np.inf if x is None else float(x) for x in batch.column(2).to_pylist()], shared.value)
            n, own = len(centres) + 1, len(q)
            d = np.hstack([np.zeros((own, 1)), d])
            reach = np.repeat(reach[:, None], n, axis=1)
            reach[:, 0] = np.inf
            pivots = np.tile(np.concatenate([[NO_PIVOT], np.arange(n - 1)]).astype(np.int32), own)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(pivots), pa.array(d.ravel()), pa.array(reach.ravel())], ["query_id", "pivot", "d", "reach"])

    return run


def _measured(vectors: list[bytes], least: list[float], shared) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, their distances to the pivots and their reach, infinite for large ones."""
    centres, width, largest = shared
    q = np.frombuffer(b"".join(vectors), float).reshape(-1, width)
    large = (np.abs(q) >= LARGE).any(axis=1)
    kept = np.where(large[:, None], 0.0, q)
    reach = reach_of((kept * kept).sum(axis=1), np.array(least, float), largest)
    return q, distances(_as_query(kept), centres), np.where(large, np.inf, reach)


_whole = np.frompyfunc(lambda v: int(v) * 1024 if abs(v) >= LARGE else int(v * 1024), 1, 1)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of 1024 q and 1024 x, integers; of longs, or of Python's integers where longs could overflow."""
    with np.errstate(over="ignore"):
        a, b = float(np.abs(q).max(initial=0)) * 1024, float(np.abs(x).max(initial=0)) * 1024
        most = a * b * q.shape[1]
    if most < 2.0**53:
        return np.rint((q * 1024) @ (x * 1024).T).astype(np.int64)
    if max(a, b, most) < 2.0**62:
        return (q * 1024).astype(np.int64) @ (x * 1024).astype(np.int64).T
    return _whole(q) @ _whole(x).T


def best_of(scores: np.ndarray, ids: np.ndarray, k: int, least: int | None, own: int) -> list[tuple[int, int]]:
    """The k best (score, id) of one query in a block, ties to the smaller id; none below least."""
    ok = ids != own
    if least is not None:
        ok &= (scores >= least).astype(bool)
    at = np.nonzero(ok)[0]
    if scores.dtype == object:
        return sorted(((scores[i], int(ids[i])) for i in at), key=lambda x: (-x[0], x[1]))[:k]
    if len(at) > 4 * k:
        at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
    if len(at) > k:
        at = at[np.lexsort((ids[at], -scores[at]))[:k]]
    return [(int(scores[i]), int(ids[i])) for i in at]


def _search(shared, k: int, batch_rows: int):
    """(query_id, id, score): the k best of each query in a group, whose annuli come before its queries. A score below all longs is null; one beyond them fails the query.

    Input: (group, part, pivot, low, high, ids, vectors, query_id, least); annuli have a null query_id."""

    def search(annuli: list, queries: list) -> pa.RecordBatch:
        ids, least = [x[0] for x in queries], [x[2] for x in queries]
        found: list[list[tuple[int, int]]] = [[] for _ in queries]
        q, d, reach = _measured([x[1] for x in queries], [-np.inf if x is None else float(x) for x in least], shared.value)
        square = (np.where(np.isinf(reach)[:, None], 0.0, q) ** 2).sum(axis=1)
        unbounded = (np.abs(q) >= LARGE).any(axis=1)
        largest = shared.value[2]
        # the nearest annuli first
        middle = d.mean(axis=0)
        for pivot, low, high, own, x in sorted(annuli, key=lambda a: -1.0 if a[0] == NO_PIVOT else max(a[1] - middle[a[0]], middle[a[0]] - a[2], 0.0)):
            near = np.arange(len(q)) if pivot == NO_PIVOT else np.nonzero((d[:, pivot] - reach <= high) & (d[:, pivot] + reach >= low))[0]
            if not len(near):
                continue
            for i, s in zip(near.tolist(), exact_scores(q[near], x), strict=True):
                got = best_of(s, own, k, least[i], ids[i])
                if got:
                    found[i] = sorted([*found[i], *got], key=lambda p: (-p[0], p[1]))[:k]
                    if len(found[i]) == k and not unbounded[i]:
                        least[i] = found[i][-1][0] if least[i] is None else max(least[i], found[i][-1][0])
                        if np.isfinite(square[i]):
                            reach[i] = reach_of((q[i] * q[i]).sum(), float(least[i]), largest)
        rows = [(i, c, s) for i, own in zip(ids, found, strict=True) for s, c in own]
        if any(s >= 1 << 63 for _, _, s in rows):
            raise OverflowError("a score of the k best does not fit a long")
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] if r[2] >= -(1 << 63) else None for r in rows], pa.int64())], ["query_id", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = shared.value[1]
        place, annuli, queries = None, [], []
        for batch in batches:
            for group, part, pivot, low, high, ids, vectors, query, least in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (group, part) != place or len(queries) >= batch_rows:
                    if queries:
                        yield search(annuli, queries)
                    queries = []
                    if (group, part) != place:
                        place, annuli = (group, part), []
                if query is None:
                    annuli.append((pivot, low, high, np.frombuffer(ids, "<i8"), np.frombuffer(vectors, float).reshape(-1, width)))
                else:
                    queries.append((query, vectors, least))
        if queries:
            yield search(annuli, queries)

    return run


def top_k(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, queries: str = "vec_id % 100 = 0", k: int = 10, pivots: int = 64,
    annulus_rows: int = 1024, group_annuli: int = 8, query_rows: int = 512, most_sample: int = 8192, scope: str = "topk",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that the condition `queries` on id_col picks, its k best other rows by the integer inner product of floor(1024 * x); ties go to the smaller id.

    Vectors that are null, hold nulls or non-finite components, or have a null id take no part; all finite components do, of any
    size. A score among the k best that a long cannot hold fails the query. Shorter vectors count as padded with zeros, and vectors
    may be of any length. Rows with the query's id are its own; a query id that repeats is one query (any of its vectors);
    repeated candidates are candidates each. Fewer than k candidates give fewer rows, an empty table none. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    valid = quantised(vectors, id_col, vector_col).where("id IS NOT NULL")
    norm = F.when(~F.col("large"), F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    facts = valid.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(norm).alias("largest")).first()
    shape = "query_id long, rank int, vec_id long, score long"
    if not facts["n"]:
        return spark.createDataFrame([], shape)
    width, largest = max(facts["width"], 1), float(facts["largest"] or 0.0) * (1 + 1e-12) + 1e-6
    share = int(min(1.0, most_sample / facts["n"]) * (1 << 20)) + 1
    small = valid.where("NOT large").select("id", "v")
    picked = small.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share).limit(2 * most_sample).toPandas()
    if not len(picked):
        picked = small.limit(pivots).toPandas()
    sample = _matrix(picked.sort_values("id")["v"].tolist(), width) if len(picked) else np.zeros((1, width))
    shared = spark.sparkContext.broadcast((pivots_of(_augmented(sample, largest), pivots), width, largest))

    keyed = staged(valid.mapInArrow(_key(shared), _KEYED), scope)
    asked = keyed.withColumnRenamed("id", id_col).where(queries).withColumnRenamed(id_col, "id").groupBy("id").agg(F.min_by(F.struct("v", "query_pivot", "query_radius", "square"), "v").alias("x"))
    asked = staged(asked.select("id", "x.*"), scope)
    # candidates and, without vectors, queries in one order; equal vectors differ in their ids, so no range holds more than its share
    both = keyed.select("id", "v", "pivot", "radius").unionAll(asked.select("id", F.lit(None).cast("binary"), "query_pivot", "query_radius"))
    ordered = both.repartitionByRange(parts, "pivot", "radius", "id").sortWithinPartitions("pivot", "radius", "id")
    packed = staged(ordered.mapInArrow(_packed(annulus_rows, group_annuli), _INDEX), scope)
    index = packed.where("pivot IS NOT NULL")
    # a group has annuli of few pivots; ids and radii only
    directory = index.groupBy("group", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"))

    def opened(turn: DataFrame) -> DataFrame:
        """turn: (query_id, group, least), staged."""
        busy = turn.groupBy("group").agg(F.ceil(F.count("*") / MOST_QUERIES).cast("int").alias("parts"))
        own = asked.select(F.col("id").alias("query_id"), F.col("v").alias("vectors"))
        nothing = {c: F.lit(None).cast(t) for c, t in (("pivot", "int"), ("low", "double"), ("high", "double"), ("ids", "binary"))}
        cols = ("group", "part", "pivot", "low", "high", "ids", "vectors", "query_id", "least")
        come = turn.join(own, "query_id").join(busy, "group").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int")).withColumns(nothing).select(*cols)
        there = index.join(busy, "group").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("query_id", F.lit(None).cast("long")).withColumn("least", F.lit(None).cast("long")).select(*cols)
        dealt = there.unionAll(come).repartition(parts, "group", "part").sortWithinPartitions("group", "part", F.col("query_id").asc_nulls_first())
        return dealt.mapInArrow(_search(shared, k, query_rows), "query_id long, id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), "id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    def least_of(best: DataFrame) -> DataFrame:
        return best.where((F.col("rank") == k) & F.col("score").isNotNull()).select("query_id", F.col("score").alias("least"))

    home = staged(packed.where("pivot IS NULL").select("group", "ids").mapInArrow(_first_groups, "query_id long, group long"), scope)
    best = staged(ranked(opened(home.withColumn("least", F.lit(None).cast("long")))), scope)
    bounded = asked.select(F.col("id").alias("query_id"), "v").join(least_of(best), "query_id", "left").select("query_id", "v", "least")
    reaches = bounded.mapInArrow(_reaches(shared), "query_id long, pivot int, d double, reach double")
    salts = 16  # few pivots would be few keys
    reaches = reaches.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(salts)))
    salted = directory.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    gap = F.greatest(F.col("low") - F.col("d"), F.col("d") - F.col("high"), F.lit(0.0))
    pairs = reaches.join(salted, ["pivot", "salt"]).withColumn("gap", F.when(F.col("reach") == float("inf"), F.lit(0.0)).otherwise(gap)).where("gap <= reach")
    pairs = pairs.groupBy("query_id", "group").agg(F.min("gap").alias("gap")).join(home, ["query_id", "group"], "left_anti")
    turn = F.row_number().over(Window.partitionBy("query_id").orderBy("gap", "group"))
    pairs = staged(pairs.withColumn("turn", turn), scope)
    square = asked.select(F.col("id").alias("query_id"), "square")
    first, step = 1, 4
    while True:
        now = pairs.where((F.col("turn") >= first) & (F.col("turn") < first + step)).join(least_of(best), "query_id", "left").join(square, "query_id")
        size = F.col("square") + largest + 1
        reach = F.sqrt(F.greatest(size - 1 - 2 * F.col("least").cast("double") / 2.0**20, F.lit(0.0)) + 1e-9 * size) + 1e-6 * F.sqrt(size)
        now = staged(now.where(F.col("least").isNull() | F.col("square").isNull() | (F.col("gap") <= reach)).select("query_id", "group", "least"), scope)
        # gaps grow with the turn and reaches only shrink: a round without a group is the last
        if now.isEmpty():
            break
        best = staged(ranked(best.drop("rank").unionAll(opened(now))), scope)
        first, step = first + step, step * 4
    score = F.when(F.col("score").isNull(), F.raise_error(F.lit("a score of the k best does not fit a long")).cast("long")).otherwise(F.col("score"))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), score.alias("score"))
