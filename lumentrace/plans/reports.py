"""Reports: status of runs, usage, scenes, sampling grids, lenient layers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lumentrace.functions import scalars as S
from lumentrace.operators import windows as W
from lumentrace.operators import contracts as C
from lumentrace.plans.tables import Book, table

book = Book()


@book.add(
    "run_directory_status",
    """
WITH f AS (SELECT l_orderkey AS clip, bool_or(l_returnflag = 'N') AS final, bool_or(l_returnflag = 'R') AS error, bool_or(l_quantity > 49) AS corrupt FROM lineitem GROUP BY 1)
SELECT count(*) FILTER (final AND NOT corrupt) AS completed, count(*) FILTER (final AND corrupt) AS corrupt, count(*) FILTER (error AND NOT final) AS errors_without_final, count(*) AS clips FROM f""",
)
def run_directory_status(spark, sf):
    """Clips with a final result, unreadable ones, and errors that no final result followed."""
    flag = lambda v: F.bool_or(F.col("l_returnflag") == v)
    f = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(flag("N").alias("f"), flag("R").alias("e"), F.bool_or(F.col("l_quantity") > 49).alias("c"))
    return f.agg(F.count_if(F.col("f") & ~F.col("c")).alias("completed"), F.count_if(F.col("f") & F.col("c")).alias("corrupt"), F.count_if(F.col("e") & ~F.col("f")).alias("errors_without_final"), F.count("*").alias("clips"))


@book.add(
    "token_totals",
    """
SELECT l_linestatus AS run, CAST(sum(l_quantity) AS BIGINT) AS tokens, count(*) FILTER (l_returnflag = 'A') AS calls_a, count(*) FILTER (l_returnflag = 'N') AS calls_n, count(*) FILTER (l_returnflag = 'R') AS calls_r FROM lineitem GROUP BY 1""",
)
def token_totals(spark, sf):
    calls = {f"calls_{k.lower()}": F.count_if(F.col("l_returnflag") == k) for k in "ANR"}
    return table(spark, sf, "lineitem").groupBy(F.col("l_linestatus").alias("run")).agg(F.sum("l_quantity").cast("long").alias("tokens"), *(v.alias(k) for k, v in calls.items()))


@book.add(
    "qc_totals",
    """
WITH m AS (SELECT 'tax_free' AS metric, CAST(l_tax = 0 AS INTEGER) AS v FROM lineitem UNION ALL SELECT 'returned', CAST(l_returnflag = 'R' AS INTEGER) FROM lineitem UNION ALL SELECT 'quantity', CAST(l_quantity AS INTEGER) FROM lineitem)
SELECT metric, CAST(sum(v) AS BIGINT) AS total FROM m GROUP BY metric""",
)
def qc_totals(spark, sf):
    """Sums over the entries of metric maps, true counting as one."""
    entries = F.create_map(F.lit("tax_free"), (F.col("l_tax") == 0).cast("int"), F.lit("returned"), (F.col("l_returnflag") == "R").cast("int"), F.lit("quantity"), F.col("l_quantity").cast("int"))
    return table(spark, sf, "lineitem").select(F.explode(entries).alias("metric", "v")).groupBy("metric").agg(F.sum("v").alias("total"))


@book.add(
    "scene_report",
    """
SELECT o_orderpriority AS recording, count(*) FILTER (o_orderstatus = 'F') AS n_single, count(*) FILTER (o_orderstatus = 'O') AS n_cut, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS n_err,
  min(o_orderkey + 5) FILTER (o_orderstatus = 'O') AS first_cut FROM orders GROUP BY 1""",
)
def scene_report(spark, sf):
    s = F.col("o_orderstatus")
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("recording")).agg(
        F.count_if(s == "F").alias("n_single"), F.count_if(s == "O").alias("n_cut"), F.count_if(~s.isin("F", "O")).alias("n_err"), F.min(F.when(s == "O", F.col("o_orderkey") + 5)).alias("first_cut")
    )


@book.add(
    "sampling_grid",
    """
WITH o AS (SELECT o_orderkey, CAST(o_custkey % 40 AS DOUBLE) / 4 AS d FROM orders)
SELECT o_orderkey AS clip, count(*) AS frames, round(max(k / 2.0), 6) AS last_time, round(sum(k / 2.0), 6) AS total FROM (SELECT o_orderkey, unnest(range(0, CAST(ceil(d * 2.0) AS BIGINT))) AS k FROM o WHERE d > 0) GROUP BY 1""",
)
def sampling_grid(spark, sf):
    """Frame times of clips at two a second."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("clip"), ((F.col("o_custkey") % 40).cast("double") / 4).alias("d")).where("d > 0")
    k = o.select("clip", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("d") * 2).cast("long") - 1)).alias("k")).withColumn("t", F.col("k") / 2.0)
    return k.groupBy("clip").agg(F.count("*").alias("frames"), F.round(F.max("t"), 6).alias("last_time"), F.round(F.sum("t"), 6).alias("total"))


@book.add(
    "frame_alignment",
    """
WITH f AS (SELECT event_id AS frame, user_id FROM events WHERE event_type = 'view'), g AS (SELECT event_id - 1 AS frame, max_by(round(value, 4), event_id) AS gaze FROM events WHERE event_type = 'click' GROUP BY 1),
o AS (SELECT event_id - 2 AS frame, props AS text FROM events WHERE event_type = 'purchase')
SELECT f.frame, g.gaze, o.text FROM f LEFT JOIN g USING (frame) LEFT JOIN o USING (frame)""",
)
def frame_alignment(spark, sf):
    """Frames with the gaze and on-screen text of the same index."""
    e = table(spark, sf, "events")
    g = e.where("event_type = 'click'").groupBy((F.col("event_id") - 1).alias("frame")).agg(F.max_by(F.round("value", 4), "event_id").alias("gaze"))
    o = e.where("event_type = 'purchase'").select((F.col("event_id") - 2).alias("frame"), F.col("props").alias("text"))
    return e.where("event_type = 'view'").select(F.col("event_id").alias("frame")).join(g, "frame", "left").join(o, "frame", "left")


@book.add(
    "distinct_in_order",
    """
WITH d AS (SELECT l_orderkey, l_returnflag, min((l_linenumber, l_partkey, l_suppkey)) AS k FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, string_agg(l_returnflag, '>' ORDER BY k) AS flags FROM d GROUP BY 1""",
)
def distinct_in_order(spark, sf):
    """Values of a clip in the order of their first appearance."""
    d = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("k"))
    g = d.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("k", "l_returnflag"))).alias("l"))
    return g.select("l_orderkey", F.array_join(F.transform("l", lambda x: x["l_returnflag"]), ">").alias("flags"))


@book.add(
    "recording_sort",
    """
SELECT name, place FROM (SELECT name, row_number() OVER (ORDER BY coalesce(try_strptime(name, '%Y-%m-%d_%H'), TIMESTAMP '0001-01-01'), name) AS place FROM (
  SELECT DISTINCT CASE WHEN o_orderkey % 9 = 0 THEN 'bad_' || CAST(o_orderkey % 5 AS VARCHAR) ELSE strftime(o_orderdate, '%Y-%m-%d_%H') END AS name FROM orders))""",
)
def recording_sort(spark, sf):
    """Recordings by the time in their name; unreadable names come first. Places come from ranges, not from one task."""
    name = F.when(F.col("o_orderkey") % 9 == 0, F.concat(F.lit("bad_"), (F.col("o_orderkey") % 5).cast("string"))).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd_HH"))
    d = table(spark, sf, "orders").select(name.alias("name")).distinct()
    when = F.coalesce(F.try_to_timestamp("name", F.lit("yyyy-MM-dd_HH")), F.lit("0001-01-01").cast("timestamp"))
    return W.ranked(d.withColumn("at", when), ["at", "name"], "place").select("name", F.col("place").cast("long"))


@book.add(
    "payload_fallback",
    """
SELECT route, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM (SELECT size, CASE WHEN size <= 40000 THEN 'inline' WHEN size <= 160000 THEN 'upload' WHEN size <= 400000 THEN 'shrink_1440' ELSE 'shrink_768' END AS route
  FROM (SELECT CAST(4 * ((o_custkey * 311 % 400000 + 2) // 3) AS BIGINT) AS size FROM orders)) GROUP BY route""",
)
def payload_fallback(spark, sf):
    """How each request would be sent, by its size in base64."""
    size = S.base64_size(F.col("o_custkey") * 311 % 400000)
    x = table(spark, sf, "orders").select(size.alias("size"))
    route = S.classed([(F.col("size") <= 40000, "inline"), (F.col("size") <= 160000, "upload"), (F.col("size") <= 400000, "shrink_1440")], "shrink_768")
    return x.groupBy(route.alias("route")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


@book.add(
    "lenient_layers",
    """
SELECT CASE WHEN lower(trim(coalesce(lang, ''))) IN ('en', 'de') THEN lower(trim(lang)) ELSE 'en' END AS lang, CASE WHEN lower(coalesce(source, '')) IN ('src0', 'src1') THEN source ELSE 'other' END AS cause, count(*) AS n,
  count(*) FILTER (coalesce(text, '') = '') AS empty FROM documents GROUP BY 1, 2""",
)
def lenient_layers(spark, sf):
    """Layers coerced to their enumerations, anything unknown to the default."""
    d = table(spark, sf, "documents")
    return d.groupBy(C.one_of(F.col("lang"), ("en", "de"), "en").alias("lang"), C.one_of(F.col("source"), ("src0", "src1"), "other").alias("cause")).agg(
        F.count("*").alias("n"), F.count_if(C.text_or_empty(F.col("text")) == "").alias("empty")
    )


@book.add(
    "audio_contract",
    """
WITH u AS (SELECT conv_id, turn * 3.0 AS a, turn * 3.0 + length(coalesce(text, '')) % 40 - 2 AS b, role, text FROM conversations)
SELECT error, count(*) AS clips FROM (SELECT CASE WHEN bool_or(b > 60 OR b <= a) THEN 'UTTERANCE_INTERVAL' WHEN bool_or(role = 'user' AND trim(coalesce(text, '')) = '') THEN 'CLEAR_WITHOUT_TEXT' ELSE 'OK' END AS error FROM u GROUP BY conv_id) GROUP BY error""",
)
def audio_contract(spark, sf):
    """Audio documents judged by their rules: intervals within the clip, text for clear speech."""
    a = F.col("turn") * 3.0
    u = F.struct(a.alias("start_sec"), (a + F.length(F.coalesce("text", F.lit(""))) % 40 - 2).alias("end_sec"), F.when(F.col("role") == "user", "clear").otherwise("unclear").alias("intelligibility"), F.col("text").alias("text"))
    d = table(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_list(u).alias("utterances"))
    d = d.withColumn("sound_events", F.expr("array() :: array<struct<start_sec: double, end_sec: double>>"))
    return C.judged(d, C.audio_rules(F.lit(60.0))).groupBy(F.coalesce("error", F.lit("OK")).alias("error")).agg(F.count("*").alias("clips"))


@book.add(
    "day_text",
    """
WITH c AS (SELECT conv_id // 10 AS day, conv_id, turn, role, lag(conv_id) OVER (PARTITION BY conv_id // 10 ORDER BY conv_id, turn, role) AS before FROM conversations)
SELECT day, string_agg(CASE WHEN before IS DISTINCT FROM conv_id THEN '# ' || CAST(conv_id AS VARCHAR) || chr(10) ELSE '' END || CAST(turn AS VARCHAR) || ' ' || role, chr(10) ORDER BY conv_id, turn, role) AS text FROM c GROUP BY day""",
)
def day_text(spark, sf):
    """The text of a day, with a header where the recording changes."""
    w = Window.partitionBy("day").orderBy("conv_id", "turn", "role")
    c = table(spark, sf, "conversations").withColumn("day", F.floor(F.col("conv_id") / 10)).withColumn("new", ~F.col("conv_id").eqNullSafe(F.lag("conv_id").over(w)))
    line = F.concat(F.when(F.col("new"), F.concat(F.lit("# "), F.col("conv_id").cast("string"), F.lit("\n"))).otherwise(""), F.col("turn").cast("string"), F.lit(" "), "role")
    g = c.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "role", line.alias("line")))).alias("l"))
    return g.select("day", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


@book.add(
    "call_estimates",
    """
SELECT count(*) AS clips, 2 * count(*) AS least_calls, 3 * count(*) AS most_calls, CAST(sum(ceil(o_totalprice / 30000)) AS BIGINT) AS pieces, CAST(ceil(3 * count(*) / 90.0) AS BIGINT) AS minutes FROM orders""",
)
def call_estimates(spark, sf):
    """Calls and time of a run, in closed form."""
    n = F.count("*")
    return table(spark, sf, "orders").agg(n.alias("clips"), (2 * n).alias("least_calls"), (3 * n).alias("most_calls"), F.sum(F.ceil(F.col("o_totalprice") / 30000)).cast("long").alias("pieces"), F.ceil(3 * n / 90.0).cast("long").alias("minutes"))


@book.add(
    "overlap_of_runs",
    "SELECT count(*) AS clips FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linestatus = 'O') USING (k)",
)
def overlap_of_runs(spark, sf):
    x = table(spark, sf, "lineitem")
    a, b = (x.where(w).select("l_orderkey").distinct() for w in ("l_returnflag = 'R'", "l_linestatus = 'O'"))
    return a.join(b, "l_orderkey").agg(F.count("*").alias("clips"))


@book.add(
    "unknown_ids",
    "SELECT l_suppkey AS id, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0) GROUP BY 1",
)
def unknown_ids(spark, sf):
    known = table(spark, sf, "supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("id"))
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.count("*").alias("n")).join(known, "id", "left_anti")
