"""Logs, archives, states and streams: tables are written as such and read by the library's readers, so that what comes back can be held against the tables themselves."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from lumentrace.functions import scalars as S
from lumentrace.operators import critics, schemas, speech, wordings
from lumentrace.plans.tables import Book, table
from lumentrace.sources import archives, claims, logs, sinks
from lumentrace.sources.work import kept, scratch
from lumentrace.streaming import live
from lumentrace.streaming import outbox as effects

book = Book()


def _log_lines():
    """JSON of an event as a log may hold it: sound, over two lines, behind noise, cut off, within an array, or two on a line."""
    obj = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    n = F.col("event_id") % 16
    return F.when(n == 3, F.concat(F.lit("noise {"), obj)).when(n == 5, F.regexp_replace(obj, ",", ",\n")).when(n == 7, F.concat(F.lit("["), obj, F.lit("]"))).when(n == 9, F.expr("substring(to_json(struct(event_id, user_id, event_type, value)), 1, 24)")).when(n == 11, F.concat(obj, F.lit(" "), obj)).otherwise(obj)


@book.add(
    "log_objects",
    """
SELECT event_type, count(*) AS events, CAST(sum(CASE event_id % 16 WHEN 9 THEN 0 WHEN 11 THEN 2 ELSE 1 END) AS BIGINT) AS found, CAST(sum(CASE event_id % 16 WHEN 9 THEN 0 WHEN 11 THEN 2 * event_id ELSE event_id END) AS BIGINT) AS ids,
  count(*) FILTER (event_id % 16 = 9) AS lost FROM events GROUP BY event_type""",
)
def log_objects(spark, sf):
    """Every event in a damaged log, and the objects that are found in it: some lines are cut off and lose theirs, some hold two, some objects span lines."""
    e = table(spark, sf, "events")
    path = scratch(spark)
    e.select(_log_lines().alias("value")).write.text(path)
    found = logs.resync_json(spark, path, range_bytes=1 << 20).select(F.from_json("json", "event_id LONG, event_type STRING").alias("r")).select("r.*")
    per_id = found.groupBy("event_id").agg(F.count("*").alias("found"), F.first("event_type").alias("_type"))
    x = e.select("event_id", "event_type").join(per_id, "event_id", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return x.groupBy("event_type").agg(F.count("*").alias("events"), F.sum("found").alias("found"), F.sum(F.col("found") * F.col("event_id")).alias("ids"), F.count_if(F.col("found") == 0).alias("lost"))


@book.add(
    "log_marked_lines",
    """
SELECT event_type, CAST(sum(CASE event_id % 16 WHEN 5 THEN 4 ELSE 1 END) AS BIGINT) AS lines, CAST(sum(CASE WHEN event_id % 16 = 5 THEN 4 WHEN event_id % 16 IN (3, 7, 9, 11) THEN 1 ELSE 0 END) AS BIGINT) AS unparsable,
  CAST(coalesce(sum(event_id) FILTER (event_id % 16 NOT IN (3, 5, 7, 9, 11)), 0) AS BIGINT) AS ids FROM events GROUP BY event_type""",
)
def log_marked_lines(spark, sf):
    """Lines of the same log, by whether they hold an object; those over several lines count as broken ones, those with two objects too."""
    e = table(spark, sf, "events")
    path = scratch(spark)
    e.select("event_type", _log_lines().alias("value")).write.partitionBy("event_type").text(path)
    x = logs.marked_lines(spark, path, "event_id LONG, user_id LONG, event_type STRING, value DOUBLE", range_bytes=1 << 20)
    kind = F.regexp_extract("path", "event_type=([^/]+)/", 1)
    return x.groupBy(kind.alias("event_type")).agg(F.count("*").alias("lines"), F.count_if("unparsable").alias("unparsable"), F.coalesce(F.sum("event_id"), F.lit(0)).alias("ids"))


@book.add(
    "orders_written_once",
    "SELECT o_orderstatus AS status, count(*) AS orders, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY o_orderstatus",
)
def orders_written_once(spark, sf):
    """Orders that come in three overlapping deliveries, written by key and read back: none is lost, none is there twice."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.concat_ws("|", "o_orderstatus", F.col("o_totalprice").cast("string")).alias("content"), "o_orderstatus")
    path = scratch(spark)
    for part in (o.where("key % 3 <> 0"), o.where("key % 3 <> 1"), o):
        sinks.write_once(part, path, "key", "content")
    back = spark.read.parquet(path)
    return back.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("orders"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


@book.add(
    "publish_read_back",
    """
SELECT p_brand AS brand, count(*) AS expected, count(*) FILTER (p_size % 10 = 0) AS missing, count(*) FILTER (p_size % 15 = 0 AND p_size % 10 <> 0) AS differs, count(*) FILTER (p_size % 7 = 0) AS unexpected FROM part GROUP BY p_brand""",
)
def publish_read_back(spark, sf):
    """A published table against what was to be published: what is missing, what has other content, and what nobody has asked for."""
    p = table(spark, sf, "part").select(F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("name"), F.sha2("p_name", 256).alias("sha"), "p_brand", "p_size")
    path = scratch(spark)
    changed = F.when(F.col("p_size") % 15 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("sha"))
    extra = p.where("p_size % 7 = 0").select(F.concat("name", F.lit("/old")).alias("name"), "sha", "p_brand")
    p.where("p_size % 10 <> 0").select("name", changed.alias("sha"), "p_brand").unionAll(extra).write.parquet(path)
    found = sinks.read_back(p.select("name", "sha"), spark.read.parquet(path).select("name", "sha"), "name", "sha")
    brand = p.select("name", "p_brand").unionAll(extra.select("name", "p_brand"))
    kind = lambda k: F.count_if(F.col("kind") == k).alias(k)
    expected = p.groupBy("p_brand").agg(F.count("*").alias("expected"))
    return found.join(brand, "name").groupBy("p_brand").agg(kind("missing"), kind("differs"), kind("unexpected")).join(expected, "p_brand", "right").select(F.col("p_brand").alias("brand"), "expected", *(F.coalesce(k, F.lit(0)).alias(k) for k in ("missing", "differs", "unexpected")))


@book.add(
    "event_submissions",
    "SELECT event_type AS stage, count(*) AS requests, count(*) AS submitted, count(DISTINCT event_id) AS jobs_of_requests FROM events WHERE event_type IN ('error', 'purchase') GROUP BY event_type",
)
def event_submissions(spark, sf):
    """Requests of two stages through an outbox, the second time as a replay; how often each request reached the provider."""
    root = scratch(spark)

    def create(name, rows):
        rows.withColumn("job", F.lit(name)).write.mode("append").parquet(f"{root}/provider/{name}")
        return name

    box = effects.Outbox(spark, f"{root}/outbox", create, lambda name: [name] if claims.exists(spark, f"{root}/provider/{name}") else [])
    e = table(spark, sf, "events").where("event_type IN ('error', 'purchase')").select(F.col("event_id").cast("string").alias("request_id"), F.col("event_type").alias("stage"))
    for stage in ("error", "purchase"):
        mine = e.where(F.col("stage") == stage)
        for _ in range(2):
            dealt = effects.submissions(mine, "run", stage, 200_000)
            for r in dealt.select("submission").distinct().orderBy("submission").toLocalIterator():
                box.submit(r["submission"], dealt.where(F.col("submission") == r["submission"]).drop("submission"))
    got = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/provider")
    return got.groupBy("stage").agg(F.count_distinct("request_id").alias("requests"), F.count("*").alias("submitted"), F.count_distinct("job", "request_id").alias("jobs_of_requests"))


@book.add(
    "event_live_stream",
    """
WITH e AS (
  SELECT user_id, event_id, ts, CASE event_type WHEN 'view' THEN 'q' WHEN 'signup' THEN 'q' WHEN 'click' THEN 's' ELSE 'e' END AS k, 'r' || user_id || '-' || event_id % 3 AS id FROM events),
l AS (SELECT id, max_by(k, (ts, event_id)) AS last, max_by(k, (ts, event_id)) FILTER (k <> 'q') AS run, max_by(ts, (ts, event_id)) AS last_at, max_by(ts, (ts, event_id)) FILTER (k <> 'q') AS since FROM e GROUP BY id)
SELECT id, 'running' AS state, epoch_us(since) AS since_us FROM l WHERE run = 's' UNION ALL SELECT id, 'waiting', epoch_us(last_at) FROM l WHERE last = 'q'""",
)
def event_live_stream(spark, sf):
    """What runs and waits at the end of a stream of all events, by its keyed state."""
    kind = F.when(F.col("event_type") == "view", "request_queued").when(F.col("event_type") == "signup", "retry_scheduled").when(F.col("event_type") == "click", "request_start").when(F.col("event_type") == "error", "request_failed").otherwise("request_success")
    path, root = scratch(spark), scratch(spark)
    e = table(spark, sf, "events")
    e.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), kind.alias("event"), F.concat(F.lit("r"), F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 3).cast("string")).alias("request_id"), F.col("user_id").cast("string").alias("clip_id"), F.lit("audio").alias("phase"), F.lit(1).alias("attempt")).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    q = live.record(live.watch(stream, every=1e9, remember=1e9), f"{root}/rows", f"{root}/checkpoint")
    q.awaitTermination()
    states = F.array(*(F.struct(F.lit(n).alias("state"), S.micros(f"{n}_since").alias("since_us")) for n in ("running", "waiting")))
    return live.current(spark, f"{root}/rows").select("id", F.explode(states).alias("s")).select("id", "s.*").where("since_us IS NOT NULL")


@book.add(
    "doc_wordings",
    r"""
WITH RECURSIVE t AS (SELECT source AS clip, text, list(DISTINCT doc_id % 3) AS calls, count(*) AS items, row_number() OVER (ORDER BY source, text) AS id FROM documents WHERE trim(text) <> '' GROUP BY source, text),
w AS (SELECT *, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}'']+'), lambda x: x <> '')) AS w FROM t),
link AS (SELECT a.id AS a, b.id AS b FROM w a JOIN w b ON a.clip IS NOT DISTINCT FROM b.clip AND a.id <> b.id AND 1000 * least(len(a.w), len(b.w)) >= 600 * greatest(len(a.w), len(b.w))
  WHERE len(a.w) > 0 AND 1600 * len(list_intersect(a.w, b.w)) >= 600 * (len(a.w) + len(b.w))),
reach AS (SELECT id, id AS dest FROM w UNION SELECT reach.id, link.b FROM reach JOIN link ON link.a = reach.dest),
r AS (SELECT id, min(dest) AS root FROM reach GROUP BY id),
k AS (SELECT source AS clip, count(DISTINCT doc_id % 3) AS k FROM documents GROUP BY source),
g AS (SELECT clip, root, max_by(text, (length(text), encode(text))) AS text, len(list_distinct(flatten(list(calls)))) AS n_runs, CAST(sum(items) AS BIGINT) AS n_items FROM w JOIN r USING (id) GROUP BY clip, root)
SELECT clip AS clip_id, sha256(text) AS wording, n_runs, n_items, n_runs || '/' || k AS votes, CASE WHEN n_runs >= k THEN 'high' WHEN n_runs <= 1 THEN 'low' ELSE 'medium' END AS confidence FROM g JOIN k USING (clip)""",
)
def doc_wordings(spark, sf):
    """Documents of a source, as what three runs have said of a clip: near-equal wordings as one, which the longest stands for."""
    items = table(spark, sf, "documents").select(F.col("source").alias("clip_id"), (F.col("doc_id") % 3).alias("call_index"), "text")
    return wordings.merged(items, items.select("clip_id", "call_index")).select("clip_id", F.sha2("text", 256).alias("wording"), "n_runs", "n_items", "votes", "confidence")


_KINDS = ("view", "click", "purchase", "signup", "error")


@book.add(
    "schema_violations_deep",
    """
SELECT CASE WHEN event_id % 23 = 0 THEN 'actors.1.actor_id' WHEN event_id % 19 = 0 THEN 'initial_environment' WHEN event_id % 17 = 0 THEN 'segments.0.speech' WHEN event_id % 11 = 0 THEN 'segments.1.evidence.0' WHEN event_id % 13 = 0 THEN 'segments.1.evidence.2.modality'
    WHEN event_id % 7 = 0 THEN 'segments.1.evidence' WHEN event_id % 5 = 0 THEN 'activity_chain.1' WHEN event_id % 3 = 0 THEN '' END AS path,
  CASE WHEN event_id % 23 = 0 THEN 'type' WHEN event_id % 19 = 0 THEN 'anyOf' WHEN event_id % 17 = 0 THEN 'anyOf' WHEN event_id % 11 = 0 THEN 'required' WHEN event_id % 13 = 0 THEN 'enum' WHEN event_id % 7 = 0 THEN 'minItems'
    WHEN event_id % 5 = 0 THEN 'type' WHEN event_id % 3 = 0 THEN 'additionalProperties' END AS rule, event_type, count(*) AS n FROM events GROUP BY ALL""",
)
def schema_violations_deep(spark, sf):
    """The first violation of an annotation document of every event, wherever in it: actors, evidence, speech, chain, fields too many."""
    # rows are few bytes and much work: they are dealt out, as a file's splits are too few tasks
    e = table(spark, sf, "events").select("event_id", "event_type", "value").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    broken = lambda n: F.col("event_id") % n == 0
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    item = lambda modality: text('{"source_id": "video_0", "modality": "', modality, '", "start_sec": 0, "end_sec": ', F.col("value").cast("string"), ', "support": "direct", "note": ""}')
    short = F.when(broken(11), F.lit('{"source_id": "video_0"}')).otherwise(item(F.lit("visual")))
    evidence = text(short, ", ", item(F.lit("ocr")), ", ", item(F.when(broken(13), "smell").otherwise("audio")))
    evidence = F.when(broken(7) & ~broken(11) & ~broken(13), "").otherwise(evidence)

    def segment(name, spoken, proof):
        return text(
            '{"segment_id": "', name, '", "start_sec": 0, "end_sec": 1.5, "event_type": "', F.col("event_type"), '", "actor_ids": ["wearer"], "activity": null, "action": "a", "action_brief": "b", "objects": [], "environment": {"world_changes": [], "newly_observed": ["x"]}, "text_visible": [], "speech": ',
            spoken, ', "details": null, "evidence": [', proof, '], "boundary": {"start": "observed", "end": "ongoing", "precision": "video_estimate"}, "uncertainties": []}',
        )

    spoken = F.when(broken(17), F.lit('{"speaker_id": "x", "source": "media", "text": null}')).otherwise(F.lit('{"speaker_id": "x", "source": "media", "text": null, "verification": "audio_checked"}'))
    doc = text(
        '{"schema_version": "1", "scene_summary": "s", "actors": [{"actor_id": "a", "description": ""}, {"actor_id": ', F.when(broken(23), "7").otherwise('"b"'), ', "description": ""}], "initial_environment": ',
        F.when(broken(19), '{"time_sec": "0", "description": ""}').otherwise("null"), ', "visual_unavailable_intervals": [], "segments": [', segment("s1", spoken, item(F.lit("visual"))), ", ", segment("s2", F.lit("null"), evidence),
        '], "activity_chain": ["s1", ', F.when(broken(5), "null").otherwise('"s2"'), "]", F.when(broken(3), ', "more": {}').otherwise(""), "}",
    )
    fault = schemas.violation(F.try_parse_json(doc), schemas.annotation(_KINDS, "1"))
    return e.select(fault.alias("f"), "event_type").groupBy("f.path", "f.rule", "event_type").agg(F.count("*").alias("n"))


@book.add(
    "speech_alignment",
    """
WITH f AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, value AS e FROM events),
l AS (SELECT user_id, median(e) + 0.45 * greatest(quantile_cont(e, 0.95) - median(e), 1e-6) AS level FROM f GROUP BY user_id),
x AS (SELECT f.*, e > level AS loud, lag(e > level) OVER (PARTITION BY user_id ORDER BY frame) AS was FROM f JOIN l USING (user_id)),
r AS (SELECT *, sum(CASE WHEN loud IS DISTINCT FROM was THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY frame) AS run FROM x),
s AS (SELECT user_id, min(frame) * 30 / 1000.0::DOUBLE AS a, (max(frame) + 1) * 30 / 1000.0::DOUBLE AS b FROM r WHERE loud GROUP BY user_id, run),
m AS (SELECT *, lag(b) OVER (PARTITION BY user_id ORDER BY a) AS before FROM s),
i AS (SELECT *, sum(CASE WHEN a - before > 0.06 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a) AS island FROM m),
w AS (SELECT user_id, min(a) AS a, max_by(b, a) AS b FROM i GROUP BY user_id, island HAVING max_by(b, a) - min(a) >= 0.03),
d AS (SELECT w.user_id, a, b, avg(e) AS loudness FROM w JOIN f ON f.user_id = w.user_id AND frame >= floor(a * 1000 / 30) AND frame < floor(b * 1000 / 30) GROUP BY w.user_id, a, b),
t AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY loudness DESC, a) <= 12),
n AS (SELECT user_id, a, b, row_number() OVER (PARTITION BY user_id ORDER BY a) - 1 AS slot, count(*) OVER (PARTITION BY user_id) AS slots FROM t),
u AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place, CASE WHEN event_id % 7 <> 0 THEN event_id % 9 - 1 END AS given FROM events WHERE event_type = 'error'),
v AS (SELECT DISTINCT u.*, slots, CASE WHEN given IS NULL OR given >= slots THEN least(place, slots - 1) WHEN given < 0 THEN given + slots ELSE given END AS slot FROM u JOIN n USING (user_id) WHERE event_id % 10 <> 0)
SELECT v.event_id, CAST(v.slot AS INTEGER) AS slot, n.a AS start_sec, n.b AS end_sec FROM v JOIN n ON n.user_id = v.user_id AND n.slot = v.slot""",
)
def speech_alignment(spark, sf):
    """Events of a user as the frames of a clip: the loud windows, and what was said placed in them; refusals go."""
    from pyspark.sql import Window

    e = table(spark, sf, "events")
    frames = e.select("user_id", (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("long").alias("frame"), F.col("value").alias("energy"))
    found = speech.loud_windows(frames, "user_id", least=0.03, gap=0.06).withColumnRenamed("user_id", "clip_id")
    place = (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).alias("place")
    said = e.where("event_type = 'error'").select(F.col("user_id").alias("clip_id"), "event_id", place, F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 9 - 1).alias("window"), F.when(F.col("event_id") % 10 == 0, "Unclear.").otherwise("words").alias("text"))
    return speech.aligned(said, found).select("event_id", F.col("window").alias("slot"), "start_sec", "end_sec")


#: Bytes of texts for which an archive of a source is planned.
_ARCHIVE = 64 << 20


@book.add(
    "archive_sections",
    """
SELECT source, count(*) AS members, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes, count(*) FILTER (n_chars >= 1000) AS long_members, min(sha256(text)) AS first_sha FROM documents WHERE text IS NOT NULL AND source IS NOT NULL GROUP BY source""",
)
def archive_sections(spark, sf):
    """Documents in archives, one of each source or, of large ones, several: members by ranges, and the section of long texts behind the short ones by bisection, in agreement with the texts."""
    d = table(spark, sf, "documents").where("text IS NOT NULL AND source IS NOT NULL").select("source", "doc_id", "text", (F.col("n_chars") >= 1000).alias("long"))
    # an archive is written by one task, so that a large source is dealt out to several
    of_source = kept(d.groupBy("source").agg(F.ceil(F.sum(F.octet_length("text")) / _ARCHIVE).alias("n")))
    d = d.join(of_source, "source").select("source", F.pmod(F.xxhash64("doc_id"), F.greatest("n", F.lit(1))).alias("part"), "doc_id", "text", "long")
    root = scratch(spark)

    def write(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        system.create_dir(base, recursive=True)
        out, now, raw, paths = None, None, None, []
        for b in rows:
            for r in b.itertuples(index=False):
                if (r.source, r.part) != now:
                    if out is not None:
                        out.close()
                        raw.close()
                    of, now = r.source, (r.source, r.part)
                    paths.append(f"{base}/{len(paths)}-{r.part}-{abs(hash(of))}-{of.replace('/', '_')}.tar")
                    raw = system.open_output_stream(paths[-1])
                    out = tarfile.open(fileobj=raw, mode="w|")
                data = r.text.encode()
                info = tarfile.TarInfo(f"{of}/{'long' if r.long else 'short'}/{r.doc_id}.txt")
                info.size = len(data)
                out.addfile(info, io.BytesIO(data))
        if out is not None:
            out.close()
            raw.close()
        if paths:
            yield pd.DataFrame({"path": paths})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{scratch(spark)}/list"
    d.repartition(n, "source", "part").sortWithinPartitions("source", "part", "long", "doc_id").mapInPandas(write, "path string").write.parquet(path)
    files = spark.read.parquet(path)
    members = archives.members(files, partition_bytes=1 << 20)
    source = F.regexp_extract("name", "^(.*)/(?:long|short)/", 1).alias("source")
    all_of = members.groupBy(source).agg(F.count("*").alias("members"), F.sum("size").alias("bytes"), F.min(F.sha2("content", 256)).alias("first_sha"))
    long = archives.members(files, content=False, left="/short/", wanted="/long/", probe_bytes=64 << 10, partition_bytes=1 << 20).groupBy(source).agg(F.count("*").alias("long_members"))
    return all_of.join(long, "source", "left").select("source", "members", "bytes", F.coalesce("long_members", F.lit(0)).alias("long_members"), "first_sha")


_CANDIDATES = """
WITH c AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS i, CAST(l_quantity AS BIGINT) AS q, l_returnflag = 'R' AS fatal FROM lineitem),
b AS (SELECT k, count(*) AS n, min(i) FILTER (q = m) AS largest FROM (SELECT *, max(q) OVER (PARTITION BY k) AS m FROM c) GROUP BY k),
v AS (SELECT k, n, CASE WHEN k % 6 BETWEEN 1 AND n THEN k % 6 - 1 ELSE largest END AS best FROM b WHERE k % 11 <> 0)
"""


def _answers(spark, sf):
    """(clip_id, content): a critic's answer on every order, totals as texts or numbers, the best index often beyond the candidates; some answers have none."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    x = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("clip_id"), F.struct(*order, "l_returnflag").alias("o"))
    q = lambda o: o["l_quantity"].cast("long").cast("string")
    issues = lambda o: F.when(o["l_returnflag"] == "R", '[{"severity": "fatal"}]').otherwise('"none"')
    item = lambda o, i: F.concat(F.lit('{"index": '), i.cast("string"), F.lit(', "scores": {"coverage": "'), q(o), F.lit('"}, "weighted_total": '), F.when(i % 2 == 0, F.concat(F.lit('"'), q(o), F.lit('"'))).otherwise(q(o)), F.lit(', "issues": '), issues(o), F.lit("}"))
    g = x.groupBy("clip_id").agg(F.array_sort(F.collect_list("o")).alias("l"))
    items = F.array_join(F.transform("l", item), ", ")
    full = F.concat(F.lit('{"candidates": ['), F.when(F.col("clip_id") % 11 == 0, "").otherwise(items), F.lit('], "best_index": "'), (F.col("clip_id") % 6 - 1).cast("string"), F.lit('", "needs_regeneration": "'), F.when(F.col("clip_id") % 3 == 0, "Yes").otherwise("no"), F.lit('"}'))
    return g.select("clip_id", full.alias("content"))


@book.add(
    "critic_verdicts",
    _CANDIDATES + "SELECT k AS clip_id, n AS candidates, CAST(best AS INTEGER) AS best_index, CAST(q AS DOUBLE) AS total, fatal, k % 3 = 0 AS again, q AS coverage FROM v JOIN c USING (k) WHERE i = best",
)
def critic_verdicts(spark, sf):
    """What critics have answered: the best candidate, by their word where it can be, else by its total; answers without candidates are none."""
    good, _ = critics.verdicts(_answers(spark, sf))
    c = F.element_at("candidates", F.col("best_index") + 1)
    return good.select("clip_id", F.size("candidates").cast("long").alias("candidates"), "best_index", c["weighted_total"].alias("total"), c["fatal"].alias("fatal"), F.col("needs_regeneration").alias("again"), c["coverage"].alias("coverage"))


@book.add(
    "second_critic_pool",
    _CANDIDATES + "SELECT k AS clip_id, 0 AS place, 'generate' AS source, best AS call_index FROM v WHERE k % 3 = 0 UNION ALL SELECT k, j, 'refine', 99 + j FROM v, (VALUES (1), (2)) AS r(j) WHERE k % 3 = 0",
)
def second_critic_pool(spark, sf):
    """What the critic judges again: the best candidate and two that were made with its guidance, for the clips whose verdict asks for it."""
    answers = _answers(spark, sf)
    good, _ = critics.verdicts(answers)
    good = kept(good.select("clip_id", "best_index", "needs_regeneration", F.size("candidates").alias("n")))  # used four times
    calls = good.select("clip_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("call_index"))
    candidates = calls.select("clip_id", "call_index", F.lit("candidate").alias("content"))
    refined = good.where("needs_regeneration").select("clip_id", F.explode(F.array(F.lit(101), F.lit(100))).alias("call_index"), F.lit("anew").alias("content"))
    pool = critics.second_pool(candidates, good.select("clip_id", "best_index"), refined)
    return pool.select("clip_id", "place", "source", F.col("call_index").cast("long").alias("call_index"))
