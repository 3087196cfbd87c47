"""Correlation, patches, audits and rollups, on the order tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lumentrace.functions import scalars as S
from lumentrace.operators import aggregates as A
from lumentrace.operators import joins as J
from lumentrace.operators import sets as U
from lumentrace.operators import windows as W
from lumentrace.plans.tables import Book, table

book = Book()


@book.add(
    "attrition_funnel",
    """
WITH x AS (SELECT o_orderkey AS rid FROM orders),
r AS (SELECT l_orderkey AS rid, l_quantity AS q, l_discount AS d FROM lineitem),
c AS (SELECT x.rid, count(r.rid) AS n, max(CASE WHEN q > 49 THEN 1 ELSE 0 END) AS bad, max(CASE WHEN d >= 0.1 THEN 1 ELSE 0 END) AS inv FROM x LEFT JOIN r USING (rid) GROUP BY x.rid),
k AS (SELECT CASE WHEN n = 0 THEN 'MISSING_RESPONSE' WHEN n > 1 THEN 'DUPLICATE_RESPONSE' WHEN bad = 1 THEN 'ROW_ERROR' WHEN inv = 1 THEN 'INVALID_OUTPUT' ELSE 'COMPLETED' END AS code FROM c)
SELECT code, count(*) AS n FROM k GROUP BY code
UNION ALL SELECT 'UNMATCHED_RESPONSE', count(*) FROM r WHERE rid NOT IN (SELECT rid FROM x)""",
)
def attrition_funnel(spark, sf):
    """Requests against responses in any order: one failure code each, and the responses nobody asked for."""
    x = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rid"))
    r = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("rid"), "l_quantity", "l_discount")
    c = J.correlate(x, r, "rid", F.col("l_quantity") > 49, F.col("l_discount") >= 0.1)
    counts = c.groupBy(F.coalesce("code", F.lit("COMPLETED")).alias("code")).agg(F.count("*").alias("n"))
    return counts.unionAll(J.unmatched(r, x, "rid"))


@book.add(
    "attrition_stages",
    """
WITH s0 AS (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice AS p FROM orders),
a AS (SELECT *, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = k) AS ok1, p > 50000 AS ok2, c % 10 <> 0 AS ok3 FROM s0)
SELECT 'audio' AS stage, count(*) AS eligible, count(*) FILTER (NOT ok1) AS failed FROM a
UNION ALL SELECT 'annotation', count(*), count(*) FILTER (NOT ok2) FROM a WHERE ok1
UNION ALL SELECT 'review', count(*), count(*) FILTER (NOT ok3) FROM a WHERE ok1 AND ok2""",
)
def attrition_stages(spark, sf):
    """Three stages in a row; what fails in one is not eligible for the next. One pass, three conditional counts."""
    have = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("ok1", F.lit(True))
    a = table(spark, sf, "orders").join(have, "o_orderkey", "left").select(F.coalesce("ok1", F.lit(False)).alias("a"), (F.col("o_totalprice") > 50000).alias("b"), (F.col("o_custkey") % 10 != 0).alias("c"))
    n = a.agg(
        F.count("*").alias("e1"), F.count_if(~F.col("a")).alias("f1"), F.count_if(F.col("a")).alias("e2"), F.count_if(F.col("a") & ~F.col("b")).alias("f2"),
        F.count_if(F.col("a") & F.col("b")).alias("e3"), F.count_if(F.col("a") & F.col("b") & ~F.col("c")).alias("f3"),
    )
    return n.selectExpr("stack(3, 'audio', e1, f1, 'annotation', e2, f2, 'review', e3, f3) AS (stage, eligible, failed)")


@book.add(
    "patch_apply",
    """
WITH p AS (SELECT o_orderkey, 'X' AS o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE round(o_totalprice * 2, 2) END AS price FROM orders WHERE o_orderkey % 5 = 0)
SELECT o.o_orderkey, coalesce(p.o_orderstatus, o.o_orderstatus) AS status, round(coalesce(p.price, o.o_totalprice), 2) AS price, p.o_orderkey IS NOT NULL AS is_patched FROM orders o LEFT JOIN p USING (o_orderkey)""",
)
def patch_apply(spark, sf):
    """Keyed review patches: fields a patch has replace those of the record."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    p = o.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("X").alias("status"), F.when(F.col("o_orderkey") % 3 != 0, F.round(F.col("price") * 2, 2)).alias("price"))
    return J.patched(o, p, ["o_orderkey"], ["status", "price"]).withColumn("price", F.round("price", 2))


@book.add(
    "patch_contract",
    """
WITH p AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 4 = 0 UNION ALL SELECT o_orderkey, 'Z' FROM orders WHERE o_orderkey % 12 = 0 AND o_orderkey % 24 <> 0
  UNION ALL SELECT -o_orderkey, 'Q' FROM orders WHERE o_orderkey % 100 = 1 UNION ALL SELECT o_orderkey, 'Z' FROM orders WHERE o_orderkey % 50 = 1),
c AS (SELECT k, count(*) AS n, any_value(s) AS s FROM p GROUP BY k)
SELECT fault, count(*) AS n FROM (
  SELECT CASE WHEN o.o_orderkey IS NULL THEN 'unknown' WHEN n > 1 THEN 'duplicate' WHEN o.o_orderstatus <> c.s THEN 'changed' END AS fault FROM c LEFT JOIN orders o ON o.o_orderkey = c.k) WHERE fault IS NOT NULL GROUP BY fault""",
)
def patch_contract(spark, sf):
    """Patches must name known keys once and leave identity fields alone."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("s"))
    k = F.col("o_orderkey")
    p = o.where(k % 4 == 0).unionAll(o.where((k % 12 == 0) & (k % 24 != 0)).withColumn("s", F.lit("Z")))
    p = p.unionAll(o.where(k % 100 == 1).select((-k).alias("o_orderkey"), F.lit("Q").alias("s"))).unionAll(o.where(k % 50 == 1).withColumn("s", F.lit("Z")))
    return J.patch_faults(o, p, ["o_orderkey"], ["s"]).groupBy("fault").agg(F.count("*").alias("n"))


@book.add(
    "revision_merge",
    """
WITH b AS (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS i, l_partkey AS k, l_returnflag AS v FROM lineitem),
r AS (SELECT doc, k, max_by(v || 'r', i) AS v FROM b WHERE k % 2 = 0 GROUP BY doc, k),
q AS (SELECT doc, i, v || 'p' AS v FROM b WHERE i % 3 = 0)
SELECT b.doc, b.i, coalesce(r.v, q.v, b.v) AS v FROM b LEFT JOIN r ON r.doc = b.doc AND r.k = b.k LEFT JOIN q ON q.doc = b.doc AND q.i = b.i""",
)
def revision_merge(spark, sf):
    """A second pass revises by key, the last revision of a key winning, else by position."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    b = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), (F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)) - 1).alias("i"), F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("v"))
    r = b.where("k % 2 = 0").groupBy("doc", "k").agg(F.max_by(F.concat("v", F.lit("r")), "i").alias("rv"))
    q = b.where("i % 3 = 0").select("doc", "i", F.concat("v", F.lit("p")).alias("qv"))
    return b.join(r, ["doc", "k"], "left").join(q, ["doc", "i"], "left").select("doc", F.col("i").cast("long").alias("i"), F.coalesce("rv", "qv", "v").alias("v"))


@book.add(
    "manifest_diff",
    """
WITH a AS (SELECT p_partkey AS k, p_size AS v FROM part WHERE p_partkey % 7 <> 0), b AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 11 = 0 THEN p_size + 1 ELSE p_size END AS v FROM part WHERE p_partkey % 5 <> 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'unrecorded' ELSE 'differs' END AS difference
FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.v <> b.v""",
)
def manifest_diff(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("v"))
    b = p.where("k % 5 <> 0").withColumn("v", F.when(F.col("k") % 11 == 0, F.col("v") + 1).otherwise(F.col("v")))
    return U.differences(p.where("k % 7 <> 0"), b, "k", "v")


@book.add(
    "mirror_audit",
    """
WITH a AS (SELECT DISTINCT p_partkey AS k, p_brand AS c FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT DISTINCT p_partkey AS k, p_brand AS c FROM part WHERE p_partkey % 4 <> 0)
SELECT c AS category, CAST(sum(m) AS BIGINT) AS missing, CAST(sum(x) AS BIGINT) AS extra FROM (
  SELECT c, 1 AS m, 0 AS x FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT c, 0, 1 FROM b WHERE k NOT IN (SELECT k FROM a)) GROUP BY c""",
)
def mirror_audit(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("c"))
    return U.audit(p.where("k % 3 <> 0"), p.where("k % 4 <> 0"), ["k"], F.col("c"))


@book.add(
    "usage_backfill",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def usage_backfill(spark, sf):
    o, item = table(spark, sf, "orders"), table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return U.backfilled(o, item, "o_orderkey")


@book.add(
    "usage_reconciled",
    """
WITH u AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderstatus, count(*) AS clips, count(*) FILTER (u.n IS NULL) AS backfilled, CAST(sum(coalesce(u.n, 1)) AS BIGINT) AS records, min(coalesce(u.n, 1)) >= 1 AS reconciled FROM orders LEFT JOIN u ON k = o_orderkey GROUP BY 1""",
)
def usage_reconciled(spark, sf):
    """Every clip has a usage record once the missing ones are filled in."""
    u = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    j = table(spark, sf, "orders").join(u, "o_orderkey", "left").withColumn("m", F.coalesce("n", F.lit(1)))
    return j.groupBy("o_orderstatus").agg(F.count("*").alias("clips"), F.count_if(F.col("n").isNull()).alias("backfilled"), F.sum("m").alias("records"), (F.min("m") >= 1).alias("reconciled"))


_COST = "round_even((l_quantity * 1000 / 1e6 * 0.75 + l_extendedprice / 1e6 * 3.75) * CASE WHEN l_returnflag = 'R' THEN 0.5 ELSE 1.0 END, 4)"


@book.add("cost_rollup", f"SELECT l_orderkey, count(*) AS calls, round(sum({_COST}), 4) AS usd FROM lineitem GROUP BY l_orderkey")
def cost_rollup(spark, sf):
    c = S.cost(F.col("l_quantity") * 1000, F.col("l_extendedprice"), F.col("l_returnflag") == "R")
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("calls"), F.round(F.sum(c), 4).alias("usd"))


@book.add(
    "cost_rollup_day",
    f"""
WITH r AS (SELECT l_orderkey, CAST(epoch_us(l_shipdate) // 86400000000 AS BIGINT) AS day, round_even(sum({_COST}), 4) AS usd FROM lineitem GROUP BY 1, 2)
SELECT day, count(*) AS members, round(round_even(sum(usd), 4), 4) AS usd FROM r GROUP BY day""",
)
def cost_rollup_day(spark, sf):
    """Recordings first, then days; each level rounds."""
    c = S.cost(F.col("l_quantity") * 1000, F.col("l_extendedprice"), F.col("l_returnflag") == "R")
    x = table(spark, sf, "lineitem").withColumn("day", F.floor(S.micros("l_shipdate") / 86_400_000_000))
    return A.two_levels(x, ["l_orderkey", "day"], ["day"], {"usd": c}, 4)


@book.add(
    "cache_hit_ratio",
    """
SELECT l_returnflag AS turn, CAST(sum(l_quantity) AS BIGINT) AS prompt, CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS BIGINT) AS cached,
  round_even(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) / nullif(sum(l_quantity), 0), 4) AS ratio FROM lineitem GROUP BY 1""",
)
def cache_hit_ratio(spark, sf):
    q, hit = F.sum("l_quantity"), F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0))
    return table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("turn")).agg(q.cast("long").alias("prompt"), hit.cast("long").alias("cached"), A.share(hit, q).alias("ratio"))


@book.add(
    "stage_timing_means",
    """
WITH r AS (SELECT l_orderkey AS run, l_returnflag AS stage, round_even(avg((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0), 1) AS per_clip, max((epoch_us(l_shipdate) - epoch_us(o_orderdate)) // 86400000000) AS queue
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT stage, count(*) AS runs, round(avg(per_clip), 6) AS mean, CAST(max(queue) AS BIGINT) AS longest FROM r GROUP BY stage""",
)
def stage_timing_means(spark, sf):
    """Means of the rounded means of runs, and the longest wait."""
    x = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    us = S.micros("l_shipdate") - S.micros("o_orderdate")
    r = x.groupBy("l_orderkey", F.col("l_returnflag").alias("stage")).agg(F.bround(F.avg(us / 86_400_000_000.0), 1).alias("p"), F.max(F.floor(us / 86_400_000_000)).alias("q"))
    return r.groupBy("stage").agg(F.count("*").alias("runs"), F.round(F.avg("p"), 6).alias("mean"), F.max("q").alias("longest"))


@book.add(
    "upper_median",
    "SELECT l_returnflag, count(*) AS n, list_sort(list(l_extendedprice))[count(*) // 2 + 1] AS median FROM lineitem GROUP BY 1",
)
def upper_median(spark, sf):
    return A.index_quantile(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", F.floor(F.col("n") / 2), "median")


@book.add(
    "p95_index",
    "SELECT l_shipmode, n, p95 FROM (SELECT l_linestatus AS l_shipmode, count(*) AS n, list_sort(list(l_extendedprice))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p95 FROM lineitem GROUP BY 1)",
)
def p95_index(spark, sf):
    x = A.index_quantile(table(spark, sf, "lineitem"), ["l_linestatus"], "l_extendedprice", F.floor(F.col("n") * 0.95), "p95")
    return x.withColumnRenamed("l_linestatus", "l_shipmode")


@book.add(
    "vote_merge",
    """
WITH v AS (SELECT l_orderkey AS clip, l_partkey % 20 AS object, l_linenumber AS run FROM lineitem),
k AS (SELECT clip, count(DISTINCT run) AS k FROM v GROUP BY clip),
o AS (SELECT clip, object, count(DISTINCT run) AS n FROM v GROUP BY 1, 2),
b AS (SELECT o.clip, object, n, k, CASE WHEN n <= 1 THEN 'low' WHEN n >= k THEN 'high' ELSE 'mid' END AS bucket FROM o JOIN k USING (clip))
SELECT bucket, count(*) AS objects, count(*) FILTER (n <> k) AS to_arbitrate FROM b GROUP BY bucket""",
)
def vote_merge(spark, sf):
    """Votes of runs for objects: bucket of each, and those that need arbitration."""
    v = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("clip"), (F.col("l_partkey") % 20).alias("object"), F.col("l_linenumber").alias("run")).distinct()
    k = v.select("clip", "run").distinct().groupBy("clip").agg(F.count("*").alias("k"))
    b = v.groupBy("clip", "object").agg(F.count("*").alias("n")).join(k, "clip")
    b = b.withColumn("bucket", S.vote_bucket(F.concat_ws("/", F.col("n").cast("string"), F.col("k").cast("string"))))
    return b.groupBy("bucket").agg(F.count("*").alias("objects"), F.count_if(F.col("n") != F.col("k")).alias("to_arbitrate"))


@book.add(
    "best_of_n",
    """
WITH c AS (SELECT l_orderkey AS clip, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS i,
    CAST(l_quantity % 11 AS DOUBLE) AS f, CAST(l_partkey % 11 AS DOUBLE) AS c, CAST(l_suppkey % 11 AS DOUBLE) AS t, CAST(l_linenumber % 11 AS DOUBLE) AS r, l_returnflag = 'R' AS fatal FROM lineitem),
h AS (SELECT *, CAST(45 * (CASE WHEN fatal THEN least(f, 3.0) ELSE f END) + 25 * c + 15 * t + 15 * r AS BIGINT) AS h FROM c),
s AS (SELECT *, (h // 10 + CASE WHEN h % 10 > 5 OR h % 10 = 5 AND h // 10 % 2 = 1 THEN 1 ELSE 0 END) / 10.0 AS total FROM h),
b AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY total DESC, fatal, f DESC, i) AS k FROM s)
SELECT clip, i AS best_index, total, total < 7.0 OR fatal AS regenerate FROM b WHERE k = 1""",
)
def best_of_n(spark, sf):
    """The best of the scored candidates: total, then no fatal issue, faithfulness, lowest index; and whether to try again."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    mod = lambda c: (F.col(c) % 11).cast("double")
    c = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("clip"), (F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)) - 1).alias("i"), mod("l_quantity").alias("f"), mod("l_partkey").alias("c"),
        mod("l_suppkey").alias("t"), mod("l_linenumber").alias("r"), (F.col("l_returnflag") == "R").alias("fatal"),
    )
    c = c.withColumn("total", S.weighted_total(F.col("f"), F.col("c"), F.col("t"), F.col("r"), F.col("fatal")))
    best = c.groupBy("clip").agg(F.max_by(F.struct("i", "total", "fatal"), F.struct("total", -F.col("fatal").cast("int"), "f", -F.col("i"))).alias("b"))
    return best.select("clip", F.col("b.i").cast("long").alias("best_index"), F.col("b.total").alias("total"), ((F.col("b.total") < 7.0) | F.col("b.fatal")).alias("regenerate"))


@book.add(
    "candidate_pool",
    """
WITH a AS (SELECT o_orderkey AS k, 'adopted' AS s, 0 AS t FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT o_orderkey AS k, 'sidecar' AS s, 1 AS t FROM orders WHERE o_orderkey % 3 = 0), c AS (SELECT o_orderkey AS k, 'generated' AS s, 2 AS t FROM orders)
SELECT s AS stage, count(*) AS n, min(k) AS first_key FROM (SELECT k, arg_min(s, t) AS s FROM (SELECT * FROM b UNION ALL SELECT * FROM a UNION ALL SELECT * FROM c) GROUP BY k) GROUP BY s"""
    .replace("'adopted' AS s, 0 AS t", "'adopted' AS s, 1 AS t").replace("'sidecar' AS s, 1 AS t", "'sidecar' AS s, 0 AS t"),
)
def candidate_pool(spark, sf):
    """Adopted, stored and generated candidates in one pool: stored ones take the place of adopted ones, generated ones fill holes."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    parts = [o.where("k % 3 = 0").withColumn("stage", F.lit("sidecar")), o.where("k % 2 = 0").withColumn("stage", F.lit("adopted")), o.withColumn("stage", F.lit("generated"))]
    return U.pooled(parts, ["k"]).groupBy("stage").agg(F.count("*").alias("n"), F.min("k").alias("first_key"))


@book.add(
    "release_lookup",
    """
SELECT p_brand AS code_hash, count(*) AS releases, max_by(p_partkey, (p_size, p_partkey)) AS newest, min_by(p_partkey, (p_size, p_partkey)) AS oldest FROM part GROUP BY 1""",
)
def release_lookup(spark, sf):
    """How many releases a hash has, the newest and the oldest; no list of them is gathered."""
    newest = F.struct("p_size", "p_partkey")
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("code_hash")).agg(F.count("*").alias("releases"), F.max_by("p_partkey", newest).alias("newest"), F.min_by("p_partkey", newest).alias("oldest"))


@book.add(
    "crop_histogram",
    "SELECT least(n, 8) AS crops, count(*) AS clips FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) GROUP BY 1",
)
def crop_histogram(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.least(F.count("*"), F.lit(8)).alias("crops")).groupBy("crops").agg(F.count("*").alias("clips"))


@book.add(
    "inventory_by_day",
    """
SELECT epoch_us(o_orderdate) // 86400000000 AS day, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, CAST(sum(4 * ((o_orderkey + 2) // 3)) AS BIGINT) AS payload FROM orders GROUP BY 1""",
)
def inventory_by_day(spark, sf):
    o = table(spark, sf, "orders").withColumn("day", F.floor(S.micros("o_orderdate") / 86_400_000_000))
    return o.groupBy("day").agg(F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"), F.sum(S.base64_size(F.col("o_orderkey"))).alias("payload"))


@book.add(
    "box_geometry",
    """
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey % 1100 AS t, l_suppkey % 1000 AS l, (l_partkey * 7) % 1100 AS b, (l_suppkey * 3) % 1000 AS r FROM lineitem)
SELECT count(*) AS boxes, count(*) FILTER (ok) AS valid, CAST(sum(CASE WHEN ok THEN (ceil(r * 1920 / 1000.0) - floor(l * 1920 / 1000.0)) * (ceil(b * 1080 / 1000.0) - floor(t * 1080 / 1000.0)) END) AS BIGINT) AS area
FROM (SELECT *, t >= 0 AND l >= 0 AND t < b AND l < r AND b <= 1000 AND r <= 1000 AS ok FROM b)""",
)
def box_geometry(spark, sf):
    """Pixel boxes rounded outwards, and how many are out of range."""
    x = table(spark, sf, "lineitem")
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    box = S.box_pixels(p % 1100, s % 1000, (p * 7) % 1100, (s * 3) % 1000, F.lit(1920), F.lit(1080))
    x = x.select(box.alias("b"))
    area = (F.col("b.x1") - F.col("b.x0")) * (F.col("b.y1") - F.col("b.y0"))
    return x.agg(F.count("*").alias("boxes"), F.count("b").alias("valid"), F.sum(area).cast("long").alias("area"))


@book.add(
    "backoff_schedule",
    """
SELECT l_linenumber AS attempt, max(least(1800, greatest(CAST(pow(2, least(l_linenumber * 2, 8)) AS BIGINT), CAST(l_quantity * 40 AS BIGINT)))) AS longest,
  CAST(sum(least(1800, greatest(CAST(pow(2, least(l_linenumber * 2, 8)) AS BIGINT), CAST(l_quantity * 40 AS BIGINT)))) AS BIGINT) AS waited FROM lineitem GROUP BY 1""",
)
def backoff_schedule(spark, sf):
    w = S.backoff(F.col("l_linenumber") * 2, F.col("l_quantity") * 40)
    return table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("attempt")).agg(F.max(w).alias("longest"), F.sum(w).alias("waited"))


@book.add(
    "ledger_check",
    """
WITH l AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, count(*) OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority, epoch_us(o_orderdate)) AS n FROM orders)
SELECT rule, count(*) AS n FROM (SELECT CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'enum' WHEN o_totalprice < 20000 THEN 'range' WHEN n > 1 THEN 'duplicate' ELSE 'ok' END AS rule FROM l) GROUP BY rule""",
)
def ledger_check(spark, sf):
    """The first rule a row of the append-only ledger breaks."""
    key = Window.partitionBy("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    o = table(spark, sf, "orders").withColumn("n", F.count("*").over(key))
    rule = S.classed([(~F.col("o_orderstatus").isin("F", "O"), "enum"), (F.col("o_totalprice") < 20000, "range"), (F.col("n") > 1, "duplicate")], "ok")
    return o.groupBy(rule.alias("rule")).agg(F.count("*").alias("n"))


@book.add(
    "binding_conflicts",
    """
WITH n AS (SELECT s_suppkey AS a, s_nationkey AS b FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey % 10 = 0 UNION ALL SELECT s_suppkey, s_nationkey + 1 FROM supplier WHERE s_suppkey % 14 = 0)
SELECT CASE WHEN k > 1 THEN 'conflict' WHEN n > 1 THEN 'repeated' ELSE 'new' END AS outcome, count(*) AS bindings FROM (SELECT a, count(DISTINCT b) AS k, count(*) AS n FROM n GROUP BY a) GROUP BY 1""",
)
def binding_conflicts(spark, sf):
    """Bindings written again: the same values are fine, other values under a unique key conflict."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("a"), F.col("s_nationkey").alias("b"))
    n = s.where("a % 2 = 0").unionAll(s.where("a % 10 = 0")).unionAll(s.where("a % 14 = 0").withColumn("b", F.col("b") + 1))
    g = n.groupBy("a").agg(F.count_distinct("b").alias("k"), F.count("*").alias("n"))
    return g.groupBy(S.classed([(F.col("k") > 1, "conflict"), (F.col("n") > 1, "repeated")], "new").alias("outcome")).agg(F.count("*").alias("bindings"))


@book.add(
    "causal_weights",
    """
SELECT l_linestatus AS type, count(*) AS edges, round(sum(CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'N' THEN 0.5 ELSE 0.25 END), 4) AS weight FROM lineitem GROUP BY 1""",
)
def causal_weights(spark, sf):
    """Edges of the causal graph weighted by their strength."""
    w = S.STRENGTH_WEIGHTS
    strength = F.when(F.col("l_returnflag") == "A", "strong").when(F.col("l_returnflag") == "N", "moderate").otherwise("weak")
    weight = F.create_map(*[F.lit(x) for kv in w.items() for x in kv])[strength]
    return table(spark, sf, "lineitem").groupBy(F.col("l_linestatus").alias("type")).agg(F.count("*").alias("edges"), F.round(F.sum(weight), 4).alias("weight"))


@book.add(
    "resume_split",
    """
WITH done AS (SELECT l_orderkey AS k FROM lineitem GROUP BY 1 HAVING bool_and(l_quantity < 48) AND count(*) > 1)
SELECT CASE WHEN done.k IS NULL THEN 'pending' ELSE 'completed' END AS state, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders LEFT JOIN done ON done.k = o_orderkey GROUP BY 1""",
)
def resume_split(spark, sf):
    """What a checkpoint completes and what is still to do."""
    done = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_and(F.col("l_quantity") < 48).alias("a"), F.count("*").alias("n")).where("a AND n > 1").select("o_orderkey", F.lit("completed").alias("state"))
    j = table(spark, sf, "orders").join(done, "o_orderkey", "left")
    return j.groupBy(F.coalesce("state", F.lit("pending")).alias("state")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@book.add(
    "turn_chain",
    """
WITH t AS (SELECT o_orderkey AS clip, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 1) AS t1, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS screen,
  EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 2) AS t2 FROM orders)
SELECT CASE WHEN NOT t1 THEN 'failed_t1' WHEN NOT t2 THEN 'failed_t2' WHEN NOT screen THEN 'final_without_screen' ELSE 'final' END AS outcome, count(*) AS clips FROM t GROUP BY 1""",
)
def turn_chain(spark, sf):
    """Mandatory turns end a chain when they fail, the screen turn does not."""
    turns = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_or(F.col("l_linenumber") == 1).alias("t1"), F.bool_or(F.col("l_linenumber") == 2).alias("t2"), F.bool_or(F.col("l_returnflag") == "R").alias("s"))
    j = table(spark, sf, "orders").join(turns, "o_orderkey", "left").fillna(False, ["t1", "t2", "s"])
    outcome = S.classed([(~F.col("t1"), "failed_t1"), (~F.col("t2"), "failed_t2"), (~F.col("s"), "final_without_screen")], "final")
    return j.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("clips"))


@book.add(
    "task_grid",
    "SELECT r_name AS participant, n_name AS day, k AS kind FROM region, nation, (SELECT unnest(['audio', 'video']) AS k) WHERE n_regionkey = r_regionkey",
)
def task_grid(spark, sf):
    """Tasks of each participant, day and kind; the kinds are a literal list."""
    r, n = table(spark, sf, "region"), table(spark, sf, "nation")
    x = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return x.select(F.col("r_name").alias("participant"), F.col("n_name").alias("day"), F.explode(F.array(F.lit("audio"), F.lit("video"))).alias("kind"))


@book.add(
    "shard_assign",
    "SELECT page_id FROM (SELECT page_id, (row_number() OVER (ORDER BY url, page_id) - 1) % 4 AS shard FROM pages) WHERE shard = 1",
)
def shard_assign(spark, sf):
    """Every fourth page in the order of their addresses."""
    p = table(spark, sf, "pages").select("url", "page_id")
    return W.ranked(p, ["url", "page_id"], "r").where((F.col("r") - 1) % 4 == 1).select("page_id")
