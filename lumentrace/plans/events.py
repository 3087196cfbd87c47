"""Recordings, windows and logs, on the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumentrace.functions import scalars as S
from lumentrace.operators import aggregates as A
from lumentrace.operators import joins as J
from lumentrace.operators import windows as W
from lumentrace.plans.tables import Book, table

book = Book()
HOUR = 3_600_000_000
LATE = 8 * HOUR


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("us", S.micros("ts"))


@book.add(
    "event_gap_segments",
    f"""
WITH e AS (SELECT *, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR us - prev > {LATE} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS segment FROM e)
SELECT user_id, CAST(segment AS BIGINT) AS segment, count(*) AS n, min(us) AS first_us, max(us) AS last_us, round(sum(value), 4) AS total,
  count(*) FILTER (event_type = 'error') AS errors, arg_max(event_type, (us, event_id)) AS last_type
FROM s GROUP BY user_id, segment""",
)
def event_gap_segments(spark, sf):
    """Recordings of a user split at gaps, with the latest state and a rollup of each."""
    e = W.with_breaks(_events(spark, sf), ["user_id"], "us", LATE, ["ts", "event_id"])
    e = W.with_islands(e, ["user_id"], "is_break", ["ts", "event_id"], "segment")
    return e.groupBy("user_id", "segment").agg(
        F.count("*").alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.round(F.sum("value"), 4).alias("total"),
        F.count_if(F.col("event_type") == "error").alias("errors"), F.max_by("event_type", F.struct("us", "event_id")).alias("last_type"),
    )


@book.add(
    "event_merge_gaps",
    f"""
WITH i AS (SELECT user_id, epoch_us(ts) AS s, epoch_us(ts) + 60000000 * (1 + event_id % 90) AS e FROM events),
f AS (SELECT *, CASE WHEN s - lag(e) OVER (PARTITION BY user_id ORDER BY s, e) <= {HOUR} THEN 0 ELSE 1 END AS fresh FROM i),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT user_id, min(s) AS start_us, arg_max(e, (s, e)) AS end_us, count(*) AS members FROM g GROUP BY user_id, island""",
)
def event_merge_gaps(spark, sf):
    """Intervals joined across small gaps; the end is that of the last member, not the largest."""
    e = _events(spark, sf).select("user_id", F.col("us").alias("start_us"), (F.col("us") + 60_000_000 * (1 + F.col("event_id") % 90)).alias("end_us"))
    return W.merge_gaps(e, ["user_id"], "start_us", "end_us", HOUR)


@book.add(
    "event_fixed_windows",
    """
SELECT user_id, epoch_us(ts) // 86400000000 AS window_index, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""",
)
def event_fixed_windows(spark, sf):
    e = _events(spark, sf).withColumn("window_index", F.floor(F.col("us") / 86_400_000_000))
    return e.groupBy("user_id", "window_index").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@book.add(
    "clip_windows",
    """
WITH o AS (SELECT o_orderkey, CAST(o_totalprice / 1000 AS DOUBLE) AS d FROM orders),
w AS (SELECT o_orderkey, d, unnest(range(0, CAST(ceil(d / 30.0) AS BIGINT))) AS i FROM o WHERE d > 0)
SELECT o_orderkey AS source, i AS index, round(i * 30.0, 6) AS "offset", round(least(30.0, d - i * 30.0), 6) AS length FROM w""",
)
def clip_windows(spark, sf):
    """Windows of 30 units over each source, the tail kept."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("source"), (F.col("o_totalprice") / 1000).alias("d"))
    x = W.fixed_windows(o, "d", 30.0)
    return x.select("source", "index", F.round("offset", 6).alias("offset"), F.round("length", 6).alias("length"))


@book.add(
    "event_piece_split",
    """
WITH s AS (SELECT user_id, (max(epoch_us(ts)) - min(epoch_us(ts))) / 3600000000.0 AS d FROM events GROUP BY user_id),
n AS (SELECT *, round_even(d / 24.0, 0) * 24.0 AS near FROM s),
a AS (SELECT user_id, CASE WHEN near > 0 AND abs(d - near) <= 0.5 THEN near ELSE d END AS snapped, d FROM n),
p AS (SELECT user_id, d, CAST(CASE WHEN snapped <= 24.0 THEN 1 ELSE greatest(2, ceil(snapped / 24.0 - 1e-9)) END AS BIGINT) AS pieces FROM a),
b AS (SELECT *, CAST(1 + coalesce(sum(pieces) OVER (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS idx_base FROM p),
e AS (SELECT *, unnest(range(1, pieces + 1)) AS piece FROM b)
SELECT user_id, piece, pieces, idx_base + piece - 1 AS global_idx, round((piece - 1) * (d / pieces), 6) AS "offset" FROM e""",
)
def event_piece_split(spark, sf):
    """Even pieces of each span with numbers that run on across spans, by sums over ranges of users."""
    spans = _events(spark, sf).groupBy("user_id").agg(((F.max("us") - F.min("us")) / 3_600_000_000.0).alias("d"))
    x = W.index_blocks(spans.withColumn("pieces", S.piece_count(F.col("d"), 24.0)), [], ["user_id"], "pieces")
    x = W.even_pieces(x, "d", 24.0)
    return x.select("user_id", "piece", "pieces", (F.col("idx_base") + F.col("piece") - 1).alias("global_idx"), F.round("offset", 6).alias("offset"))


@book.add(
    "event_latest_state",
    """
SELECT user_id, event_id, event_type, round(value, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def event_latest_state(spark, sf):
    e = _events(spark, sf).select("user_id", "us", "event_id", "event_type", F.round("value", 6).alias("value"))
    return W.latest(e, ["user_id"], ["us", "event_id"]).select("user_id", "event_id", "event_type", "value")


@book.add(
    "event_keep_best",
    """
SELECT user_id, event_type, event_id, round(value, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY (value > 50) DESC, event_id) AS r FROM events) WHERE r = 1""",
)
def event_keep_best(spark, sf):
    """The first success of each key, or its first try."""
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"), (F.col("value") > 50).alias("ok"))
    return W.keep_best(e, ["user_id", "event_type"], "ok", "event_id").select("user_id", "event_type", "event_id", "value")


@book.add(
    "event_trailing_window",
    """
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) AS recent FROM events""",
)
def event_trailing_window(spark, sf):
    """Requests in the day up to each, the far end excluded."""
    return W.trailing_count(_events(spark, sf), ["user_id"], "us", 24 * HOUR).select("event_id", "user_id", "recent")


@book.add(
    "event_pacing",
    f"""
WITH e AS (SELECT user_id, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
SELECT user_id, count(*) AS starts, count(*) FILTER (us - prev < {HOUR}) AS too_close, min(us - prev) AS least_gap FROM e GROUP BY user_id""",
)
def event_pacing(spark, sf):
    from pyspark.sql import Window

    gap = F.col("us") - F.lag("us").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    e = _events(spark, sf).withColumn("gap", gap)
    return e.groupBy("user_id").agg(F.count("*").alias("starts"), F.count_if(F.col("gap") < HOUR).alias("too_close"), F.min("gap").alias("least_gap"))


@book.add(
    "event_trail_last6",
    """
WITH v AS (SELECT event_id, user_id, list(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS t FROM events WHERE event_type <> 'error')
SELECT e.event_id, coalesce(array_to_string(v.t, ','), '') AS trail FROM events e LEFT JOIN v USING (event_id)""",
)
def event_trail_last6(spark, sf):
    e = W.trail(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") != "error", F.col("event_id"), 6)
    return e.select("event_id", F.array_join(F.col("trail").cast("array<string>"), ",").alias("trail"))


@book.add(
    "event_runs_above",
    """
WITH e AS (SELECT user_id, event_id, value > 30 AS f FROM events),
c AS (SELECT *, CASE WHEN f IS DISTINCT FROM lag(f) OVER (PARTITION BY user_id ORDER BY event_id) THEN 1 ELSE 0 END AS ch FROM e),
r AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS length FROM r WHERE f GROUP BY user_id, run""",
)
def event_runs_above(spark, sf):
    return W.runs_above(table(spark, sf, "events"), ["user_id"], "event_id", F.col("value") > 30)


@book.add(
    "event_status_rollup",
    """
SELECT epoch_us(ts) // 86400000000 AS day, count(*) AS total, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
  count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY 1""",
)
def event_status_rollup(spark, sf):
    e = _events(spark, sf).withColumn("day", F.floor(F.col("us") / 86_400_000_000))
    return A.status_counts(e, ["day"], "event_type", ["click", "error", "purchase", "view"])


@book.add(
    "event_props_parse",
    """
SELECT event_type, count(*) AS n, count(k) AS parsed, CAST(sum(k) AS BIGINT) AS total FROM (
  SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type""",
)
def event_props_parse(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.from_json("props", "k long")["k"].alias("k"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count("k").alias("parsed"), F.sum("k").alias("total"))


@book.add(
    "events_overlap_join",
    f"""
WITH s AS (SELECT user_id, event_id, epoch_us(ts) AS a, epoch_us(ts) + 60000000 * (5 + event_id % 300) AS b, event_type FROM events)
SELECT l.event_id AS segment, r.event_id AS line, greatest(l.a, r.a) - l.a AS t_start, least(l.b, r.b) - l.a AS t_end
FROM s l JOIN s r ON l.user_id = r.user_id AND l.event_type = 'view' AND r.event_type = 'click' AND r.a < l.b AND r.b > l.a""",
)
def events_overlap_join(spark, sf):
    """Transcript lines against segments: half-open overlap, clipped to the segment."""
    s = _events(spark, sf).select("user_id", "event_id", "event_type", F.col("us").alias("a"), (F.col("us") + 60_000_000 * (5 + F.col("event_id") % 300)).alias("b"))
    left = s.where("event_type = 'view'").select("user_id", F.col("event_id").alias("segment"), F.col("a").alias("la"), F.col("b").alias("lb"))
    right = s.where("event_type = 'click'").select("user_id", F.col("event_id").alias("line"), F.col("a").alias("ra"), F.col("b").alias("rb"))
    x = J.clipped(J.overlap(left, right, ["user_id"], ("la", "lb"), ("ra", "rb"), 6 * HOUR), "ra", "rb", "la", "lb")
    return x.select("segment", "line", "t_start", "t_end")


@book.add(
    "point_in_interval",
    """
WITH s AS (SELECT user_id, event_id, epoch_us(ts) AS a, epoch_us(ts) + 60000000 * (event_id % 200) AS b FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events WHERE event_type = 'purchase')
SELECT s.event_id AS segment, count(*) AS details, min(p.event_id) AS first_detail FROM p JOIN s ON p.user_id = s.user_id AND p.t >= s.a AND p.t <= s.b GROUP BY s.event_id""",
)
def point_in_interval(spark, sf):
    e = _events(spark, sf)
    s = e.where("event_type = 'view'").select("user_id", F.col("event_id").alias("segment"), F.col("us").alias("a"), (F.col("us") + 60_000_000 * (F.col("event_id") % 200)).alias("b"))
    p = e.where("event_type = 'purchase'").select("user_id", "event_id", F.col("us").alias("t"))
    return J.points_in(p, s, ["user_id"], "t", ("a", "b"), 4 * HOUR).groupBy("segment").agg(F.count("*").alias("details"), F.min("event_id").alias("first_detail"))


@book.add(
    "topk_then_time",
    """
SELECT user_id, event_id, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) AS k FROM events) WHERE k <= 24""",
)
def topk_then_time(spark, sf):
    x = W.top_then_order(table(spark, sf, "events"), ["user_id"], 24, [F.desc("value"), "ts", "event_id"], ["user_id", "ts", "event_id"])
    return x.select("user_id", "event_id", F.round("value", 6).alias("value"))


@book.add(
    "frame_region_limit",
    """
SELECT user_id, epoch_us(ts) // 86400000000 AS frame, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 86400000000 ORDER BY event_id) AS k FROM events) WHERE k <= 2""",
)
def frame_region_limit(spark, sf):
    e = _events(spark, sf).withColumn("frame", F.floor(F.col("us") / 86_400_000_000))
    return W.per_group_limit(e, ["user_id", "frame"], ["event_id"], 2).select("user_id", "frame", "event_id")


@book.add(
    "threshold_median_p95",
    """
SELECT user_id, round(median(value), 6) AS med, round(median(value) + 0.45 * greatest(quantile_cont(value, 0.95) - median(value), 1e-6), 6) AS threshold FROM events GROUP BY user_id""",
)
def threshold_median_p95(spark, sf):
    """A loudness threshold between the median and the linear 95th percentile."""
    e = table(spark, sf, "events").groupBy("user_id").agg(F.percentile("value", 0.5).alias("m"), F.percentile("value", 0.95).alias("p"))
    return e.select("user_id", F.round("m", 6).alias("med"), F.round(F.col("m") + 0.45 * F.greatest(F.col("p") - F.col("m"), F.lit(1e-6)), 6).alias("threshold"))


@book.add(
    "event_markers",
    """
SELECT event_id, row_number() OVER w = 1 AS opens, lead(event_id) OVER w IS NULL AS closes, event_type IS DISTINCT FROM lag(event_type) OVER w AS changed
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def event_markers(spark, sf):
    """First and last rows of a day's recording and changes of state."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf, "events").select(
        "event_id", (F.row_number().over(w) == 1).alias("opens"), F.lead("event_id").over(w).isNull().alias("closes"), (~F.col("event_type").eqNullSafe(F.lag("event_type").over(w))).alias("changed")
    )


@book.add(
    "clip_identity",
    """
SELECT event_id, substr(sha256(CAST(user_id AS VARCHAR) || ':' || CAST(event_id AS VARCHAR)), 1, 24) AS clip_id,
  CASE WHEN second(ts) IN (0, 30) THEN '30s' ELSE 'segment_open' END AS kind, strftime(ts, '%H:%M:%S') AS clock,
  strftime(ts + INTERVAL 3661 SECOND, '%H:%M:%S') AS later FROM events""",
)
def clip_identity(spark, sf):
    """Hashed clip ids, clip kinds and time-of-day arithmetic."""
    e = _events(spark, sf)
    of_day = F.floor(F.pmod(F.col("us"), F.lit(86_400_000_000)) / 1_000_000)
    return e.select(
        "event_id", S.short_hash(F.col("user_id").cast("string"), F.col("event_id").cast("string")).alias("clip_id"), S.clip_kind(F.second("ts")).alias("kind"),
        S.hms(of_day).alias("clock"), S.hms(of_day + 3661).alias("later"),
    )


@book.add(
    "event_active_snapshot",
    """
WITH r AS (SELECT user_id, value::BIGINT % 7 AS request, max_by(event_type, (ts, event_id)) AS state, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, count(*) FILTER (state NOT IN ('error', 'purchase')) AS active, count(*) FILTER (state = 'error') AS failed, count(*) FILTER (state = 'purchase') AS succeeded FROM r GROUP BY user_id"""
    .replace("value::BIGINT % 7", "event_id % 7"),
)
def event_active_snapshot(spark, sf):
    """Requests by their latest state: what is still under way, what ended and how."""
    e = _events(spark, sf).select("user_id", (F.col("event_id") % 7).alias("request"), "us", "event_id", "event_type")
    last = W.latest(e, ["user_id", "request"], ["us", "event_id"])
    return last.groupBy("user_id").agg(
        F.count_if(~F.col("event_type").isin("error", "purchase")).alias("active"), F.count_if(F.col("event_type") == "error").alias("failed"), F.count_if(F.col("event_type") == "purchase").alias("succeeded")
    )


@book.add(
    "event_nested_regroup",
    """
SELECT user_id, count(*) AS kinds, string_agg(event_type || '=' || CAST(last AS VARCHAR), ',' ORDER BY event_type) AS lasts FROM (
  SELECT user_id, event_type, max(event_id) AS last FROM events GROUP BY 1, 2) GROUP BY user_id""",
)
def event_nested_regroup(spark, sf):
    """A map of the last row of each kind, rendered in key order."""
    x = A.regrouped(table(spark, sf, "events"), "user_id", "event_type", "event_id", "event_id")
    entries = F.transform(F.map_entries("values"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return x.select("user_id", F.size("values").cast("long").alias("kinds"), F.array_join(F.array_sort(entries), ",").alias("lasts"))


@book.add("event_watermark", "SELECT count(DISTINCT user_id) AS clips, coalesce(max(event_id), 0) AS watermark, count(DISTINCT event_type) AS kinds FROM events")
def event_watermark(spark, sf):
    return table(spark, sf, "events").agg(F.count_distinct("user_id").alias("clips"), F.coalesce(F.max("event_id"), F.lit(0)).alias("watermark"), F.count_distinct("event_type").alias("kinds"))


@book.add(
    "nearest_window_clamped",
    """
WITH w AS (SELECT user_id, list(event_id ORDER BY event_id) AS l FROM events WHERE event_type = 'view' GROUP BY user_id)
SELECT e.event_id, w.l[least(greatest(e.event_id % 40, 0), len(w.l) - 1) + 1] AS slot FROM events e JOIN w USING (user_id) WHERE e.event_type = 'error'""",
)
def nearest_window_clamped(spark, sf):
    """Utterances against the windows of their clip by index, clamped to the last. Lists hold the windows of one clip."""
    e = table(spark, sf, "events")
    w = e.where("event_type = 'view'").groupBy("user_id").agg(F.sort_array(F.collect_list("event_id")).alias("l"))
    at = F.least(F.greatest(F.col("event_id") % 40, F.lit(0)), F.size("l") - 1) + 1
    return e.where("event_type = 'error'").join(w, "user_id").select("event_id", F.element_at("l", at.cast("int")).alias("slot"))
