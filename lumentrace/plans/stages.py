"""Contracts, responses and stages over documents that are built from the tables' columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentrace.functions import scalars as S
from lumentrace.operators import contracts as C
from lumentrace.operators import flows
from lumentrace.plans.tables import Book, table
from lumentrace.sources import logs

book = Book()

# ---------------------------------------------------------------- names, paths, times


@book.add(
    "clip_id_parts",
    """
WITH c AS (SELECT event_id, 'DAY' || CAST(user_id % 7 AS VARCHAR) || '_A' || CAST(user_id % 3 AS VARCHAR) || '_CAM_' || lpad(CAST(event_id * 7919 % 23000000 AS VARCHAR), CASE WHEN event_id % 11 = 0 THEN 7 ELSE 8 END, '0')
    || CASE WHEN event_id % 3 = 0 THEN '_p' || CAST(event_id % 5 AS VARCHAR) ELSE '' END AS id FROM events),
p AS (SELECT event_id, string_split(id, '_') AS x, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS k FROM c),
q AS (SELECT event_id, x, k, x[len(x) - k] AS t FROM p)
SELECT event_id, CAST(replace(x[1], 'DAY', '') AS INTEGER) AS day, x[2] || '_' || x[3] AS participant, CAST(substr(t, 1, 2) AS INTEGER) * 3600 + CAST(substr(t, 3, 2) AS INTEGER) * 60 + CAST(substr(t, 5, 2) AS INTEGER) AS second,
  CAST(substr(t, 7, 2) AS INTEGER) AS cs, CASE WHEN k = 1 THEN CAST(replace(x[5], 'p', '') AS INTEGER) ELSE 0 END AS piece FROM q WHERE length(t) = 8""",
)
def clip_id_parts(spark, sf):
    """Day, participant, time of day and piece of clip ids; ids of another form are left out."""
    c = table(spark, sf, "events").selectExpr(
        "event_id",
        "concat('DAY', user_id % 7, '_A', user_id % 3, '_CAM_', lpad(cast(event_id * 7919 % 23000000 as string), if(event_id % 11 = 0, 7, 8), '0'), if(event_id % 3 = 0, concat('_p', event_id % 5), '')) AS id",
    )
    x = c.withColumn("p", S.clip_parts(F.col("id"))).where("p IS NOT NULL")
    return x.select("event_id", "p.day", "p.participant", (F.col("p.hh") * 3600 + F.col("p.mm") * 60 + F.col("p.ss")).alias("second"), "p.cs", "p.piece")


@book.add(
    "safe_paths",
    """
WITH p AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'audio/c' WHEN 1 THEN 'review/../c' WHEN 2 THEN 'annotation/x-y_' WHEN 3 THEN 'other/c' WHEN 4 THEN '/audio/c' ELSE 'review/' END || CAST(page_id AS VARCHAR) || CASE WHEN page_id % 7 = 0 THEN '.txt' ELSE '.json' END AS path FROM pages)
SELECT page_id, path FROM p WHERE page_id % 7 <> 0 AND page_id % 6 IN (0, 2, 5)""",
)
def safe_paths(spark, sf):
    """Paths that may be written to."""
    p = table(spark, sf, "pages").selectExpr(
        "page_id",
        "concat(CASE page_id % 6 WHEN 0 THEN 'audio/c' WHEN 1 THEN 'review/../c' WHEN 2 THEN 'annotation/x-y_' WHEN 3 THEN 'other/c' WHEN 4 THEN '/audio/c' ELSE 'review/' END, page_id, if(page_id % 7 = 0, '.txt', '.json')) AS path",
    )
    return p.where(S.safe_path(F.col("path")))


@book.add(
    "utc_and_frame_names",
    """
SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS utc, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS frame_time, CASE WHEN event_id % 5 = 0 THEN -1 ELSE event_id END AS frame FROM events""",
)
def utc_and_frame_names(spark, sf):
    """Times in their one form, and what the names of frames say."""
    e = table(spark, sf, "events").selectExpr(
        "event_id",
        "CASE event_id % 4 WHEN 0 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") WHEN 1 THEN concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '+00:00') WHEN 2 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS\") ELSE date_format(ts, 'dd.MM.yyyy') END AS t",
        "concat('d/', date_format(ts, 'yyyy-MM-dd_HH-mm-ss'), if(event_id % 5 = 0, '_frame_', '_UTC__frame_'), lpad(cast(event_id as string), greatest(6, length(cast(event_id as string))), '0'), '.JPG') AS name",
    )
    f = S.frame_parts(F.col("name"))
    return e.select("event_id", S.utc_text(F.col("t")).alias("utc"), F.when(f.isNotNull(), F.concat_ws(" ", f["day"], f["clock"])).alias("frame_time"), F.coalesce(f["index"], F.lit(-1)).alias("frame"))


@book.add(
    "transcript_lines",
    """
WITH e AS (SELECT event_id, event_id % 6 AS k, date_trunc('second', ts) AS a, date_trunc('second', ts) + to_seconds(event_id % 9) AS b, user_id FROM events)
SELECT event_id, CASE WHEN k IN (0, 1) THEN a ELSE TIMESTAMP '2000-01-01' + to_seconds(CASE k WHEN 2 THEN hour(a) * 3600 + minute(a) * 60 + second(a) ELSE hour(a) * 3600 + minute(a) * 60 END) END AS start_time,
  CASE WHEN k IN (0, 1) THEN b ELSE TIMESTAMP '2000-01-01' + to_seconds(CASE k WHEN 2 THEN hour(a) * 3600 + minute(a) * 60 + second(a) ELSE hour(a) * 3600 + minute(a) * 60 + event_id % 60 END) END AS end_time, 'user ' || CAST(user_id AS VARCHAR) AS body
FROM e WHERE k <= 3""",
)
def transcript_lines(spark, sf):
    """Transcript lines of both dialects; other lines are dropped."""
    e = table(spark, sf, "events").selectExpr(
        "event_id",
        """concat(CASE event_id % 6
            WHEN 0 THEN concat('[', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' UTC -> ', date_format(ts + make_dt_interval(0, 0, 0, event_id % 9), 'yyyy-MM-dd HH:mm:ss'), ' UTC] ')
            WHEN 1 THEN concat('[', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' -> ', date_format(ts + make_dt_interval(0, 0, 0, event_id % 9), 'yyyy-MM-dd HH:mm:ss'), ']')
            WHEN 2 THEN concat('[', date_format(ts, 'H:mm:ss'), ' – ', date_format(ts, 'HH:mm:ss'), '] ')
            WHEN 3 THEN concat('[', date_format(ts, 'HH:mm'), '-', date_format(ts, 'HH:mm'), ':', lpad(cast(event_id % 60 as string), 2, '0'), ']  ')
            WHEN 4 THEN concat('[', date_format(ts, 'yyyy-MM-dd HH:mm'), ' -> x] ') ELSE '' END, 'user ', user_id) AS line""",
    )
    return logs.transcript(e, "line").select("event_id", "start_time", "end_time", "body")


@book.add(
    "ocr_clean",
    r"""
WITH l AS (SELECT doc_id, generate_subscripts(x, 1) AS i, unnest(x) AS line FROM (SELECT doc_id, string_split('capture_time: 1' || chr(10) || coalesce(text, '') || chr(10) || 'frame_index=' || CAST(doc_id AS VARCHAR) || chr(10) || '  ', chr(10)) AS x FROM documents))
SELECT doc_id, sha256(coalesce(regexp_replace(string_agg(line, chr(10) ORDER BY i) FILTER (NOT starts_with(line, 'capture_time') AND NOT starts_with(line, 'capture_epoch') AND NOT starts_with(line, 'frame_index')),
  '^[\s\x0B\x1C-\x1F\x85\p{Z}]+|[\s\x0B\x1C-\x1F\x85\p{Z}]+$', '', 'g'), '')) AS cleaned FROM l GROUP BY doc_id""",
)
def ocr_clean(spark, sf):
    """Screen texts without their capture lines."""
    t = F.concat(F.lit("capture_time: 1\n"), F.coalesce("text", F.lit("")), F.lit("\nframe_index="), F.col("doc_id").cast("string"), F.lit("\n  "))
    return table(spark, sf, "documents").select("doc_id", F.sha2(S.clean_ocr(t), 256).alias("cleaned"))


# ---------------------------------------------------------------- contracts on nested documents

_SEGMENTS = """
WITH e AS (SELECT user_id * 1000 + dayofyear(ts) AS clip, event_id AS k, CAST((epoch_us(ts) // 1000000) % 30 AS DOUBLE) AS a FROM events),
s AS (SELECT clip, k, 's' || CAST(k % 89 AS VARCHAR) AS id, a, a + k % 7 AS b, CASE k % 4 WHEN 0 THEN 'action' WHEN 1 THEN 'action' WHEN 2 THEN 'speech' ELSE 'other' END AS kind,
    CASE k % 23 WHEN 0 THEN 'ghost' WHEN 1 THEN 'unknown' WHEN 2 THEN 'p1' ELSE 'wearer' END AS actor, k % 6 = 0 AS on_a, k % 8 = 0 AS on_b,
    CASE k % 9 WHEN 0 THEN 'audio_0' WHEN 1 THEN 'transcript_0' WHEN 2 THEN 'ocr_1' WHEN 3 THEN 'crop_2' WHEN 4 THEN 'tv_0' ELSE 'video_0' END AS sid, k % 13 = 0 AS odd,
    (k % 4 = 2 AND k % 31 <> 0) OR k % 37 = 0 AS speaks, CASE k % 29 WHEN 0 THEN 'p9' ELSE 'p1' END AS speaker, CASE k % 3 WHEN 0 THEN 'audio_checked' WHEN 1 THEN 'transcript_only' ELSE 'unverified' END AS checked,
    row_number() OVER (PARTITION BY clip ORDER BY k) AS pos FROM e),
d AS (SELECT clip, clip % 2 = 0 AS has_audio, clip % 3 = 0 AS has_transcript, clip % 97 = 0 AS twice, CASE WHEN clip % 4 = 0 THEN NULL ELSE CAST(clip % 31 AS DOUBLE) END AS env, clip % 41 = 0 AS blank, clip % 19 = 0 AS unchained FROM (SELECT DISTINCT clip FROM s))
"""
_EVIDENCE = """,
v AS (SELECT s.*, d.has_audio, d.has_transcript, CASE sid WHEN 'audio_0' THEN 'audio' WHEN 'transcript_0' THEN 'transcript' WHEN 'ocr_1' THEN 'ocr' ELSE 'visual' END AS shows,
    CASE WHEN sid = 'audio_0' THEN has_audio WHEN sid = 'transcript_0' THEN has_transcript ELSE sid <> 'tv_0' END AS known FROM s JOIN d USING (clip)),
c AS (SELECT *, CASE WHEN b > 30 OR b <= a THEN 'SEGMENT_INTERVAL' WHEN actor = 'ghost' THEN 'UNKNOWN_ACTOR' WHEN on_a AND a <> 0 THEN 'ONGOING_START' WHEN on_b AND abs(b - 30) > 0.001 THEN 'ONGOING_END'
    WHEN NOT known THEN 'UNKNOWN_SOURCE' WHEN odd THEN 'MODALITY'
    WHEN kind = 'speech' AND (NOT speaks OR speaker = 'p9') THEN 'SPEAKER' WHEN kind = 'speech' AND checked = 'audio_checked' AND NOT has_audio THEN 'AUDIO_MISSING'
    WHEN kind = 'speech' AND checked = 'audio_checked' AND sid <> 'audio_0' THEN 'AUDIO_UNCITED' WHEN kind = 'speech' AND checked = 'transcript_only' AND NOT has_transcript THEN 'NO_TRANSCRIPT'
    WHEN kind <> 'speech' AND speaks THEN 'SPEECH_OUTSIDE' END AS code FROM v)
"""


def _documents(spark, sf) -> DataFrame:
    """clip, the columns of an annotation, sources and duration_sec: a document for each user and day."""
    e = table(spark, sf, "events").selectExpr("user_id * 1000 + dayofyear(ts) AS clip", "event_id AS k", f"cast({'unix_seconds(cast(ts as timestamp))'} % 30 as double) AS a")
    segment = F.expr("""named_struct('segment_id', concat('s', k % 89), 'start_sec', a, 'end_sec', a + k % 7, 'event_type', CASE k % 4 WHEN 0 THEN 'action' WHEN 1 THEN 'action' WHEN 2 THEN 'speech' ELSE 'other' END,
      'actor_ids', array(CASE k % 23 WHEN 0 THEN 'ghost' WHEN 1 THEN 'unknown' WHEN 2 THEN 'p1' ELSE 'wearer' END),
      'speech', if((k % 4 = 2 AND k % 31 <> 0) OR k % 37 = 0, named_struct('speaker_id', if(k % 29 = 0, 'p9', 'p1'), 'verification', CASE k % 3 WHEN 0 THEN 'audio_checked' WHEN 1 THEN 'transcript_only' ELSE 'unverified' END), null),
      'evidence', array(named_struct('source_id', CASE k % 9 WHEN 0 THEN 'audio_0' WHEN 1 THEN 'transcript_0' WHEN 2 THEN 'ocr_1' WHEN 3 THEN 'crop_2' WHEN 4 THEN 'tv_0' ELSE 'video_0' END,
         'modality', if(k % 13 = 0, 'none', CASE k % 9 WHEN 0 THEN 'audio' WHEN 1 THEN 'transcript' WHEN 2 THEN 'ocr' ELSE 'visual' END), 'start_sec', a, 'end_sec', a)),
      'boundary', named_struct('start', if(k % 6 = 0, 'ongoing', 'observed'), 'end', if(k % 8 = 0, 'ongoing', 'observed')), 'uncertainties', cast(array() as array<string>))""")
    # a few events a clip
    d = e.groupBy("clip").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", segment.alias("s")))), lambda x: x["s"]).alias("segments"))
    d = d.selectExpr(
        "clip", "segments", "30.0D AS duration_sec", "concat(array('video_0', 'ocr_1', 'crop_2'), if(clip % 2 = 0, array('audio_0'), array()), if(clip % 3 = 0, array('transcript_0'), array())) AS sources",
        "transform(concat(array('wearer', 'p1'), if(clip % 97 = 0, array('p1'), array())), x -> named_struct('actor_id', x)) AS actors", "if(clip % 4 = 0, null, named_struct('time_sec', cast(clip % 31 as double))) AS initial_environment",
        "transform(if(clip % 41 = 0, array(3.0D), array()), x -> named_struct('start_sec', x, 'end_sec', x)) AS visual_unavailable_intervals",
    )
    chain = C.expected_chain(C.canonical("segments"))
    return d.withColumn("activity_chain", F.when(F.col("clip") % 19 == 0, F.reverse(chain)).otherwise(chain))


@book.add(
    "annotation_contract",
    _SEGMENTS
    + _EVIDENCE
    + """,
g AS (SELECT clip, count(*) AS n, count(DISTINCT id) AS ids, list(struct_pack(a := a, id := id) ORDER BY pos) = list(struct_pack(a := a, id := id) ORDER BY a, id, pos) AS in_order,
    arg_min(code, pos) FILTER (code IS NOT NULL) AS code, count(code) AS broken, list(id ORDER BY a, id, pos) FILTER (kind = 'action' AND actor = 'wearer') AS chain, list(id ORDER BY pos) FILTER (kind = 'action' AND actor = 'wearer') AS expected FROM c GROUP BY clip),
r AS (SELECT clip, CASE WHEN twice THEN 'DUPLICATE_ACTOR' WHEN ids < n THEN 'DUPLICATE_SEGMENT' WHEN NOT in_order THEN 'UNSORTED_SEGMENTS' WHEN env > 30 THEN 'ENVIRONMENT_TIME' WHEN blank THEN 'UNAVAILABLE_INTERVAL' WHEN code IS NOT NULL THEN code
    WHEN coalesce(CASE WHEN unchained THEN list_reverse(chain) ELSE chain END, []) <> coalesce(expected, []) THEN 'ACTIVITY_CHAIN' END AS error,
    broken + CAST(twice AS INTEGER) + CAST(ids < n AS INTEGER) + CAST(NOT in_order AS INTEGER) + CAST(coalesce(env > 30, false) AS INTEGER) + CAST(blank AS INTEGER)
    + CAST(coalesce(CASE WHEN unchained THEN list_reverse(chain) ELSE chain END, []) <> coalesce(expected, []) AS INTEGER) AS violations FROM g JOIN d USING (clip))
SELECT clip, error, violations FROM r""",
)
def annotation_contract(spark, sf):
    """All rules of the annotation contract: the first that each document breaks, and how many are broken."""
    d = C.annotation_errors(_documents(spark, sf), F.col("duration_sec"), F.col("sources"))
    return d.select("clip", "error", F.size("violations").cast("long").alias("violations"))


@book.add(
    "annotation_errors_count",
    _SEGMENTS + _EVIDENCE + " SELECT coalesce(code, 'SOUND') AS code, count(*) AS segments FROM c GROUP BY 1",
)
def annotation_errors_count(spark, sf):
    """Segments by the first rule that each breaks."""
    d = _documents(spark, sf)
    known = F.concat(F.transform("actors", lambda a: a["actor_id"]), F.array(F.lit("unknown")))
    codes = F.transform("segments", lambda s: F.coalesce(C.segment_error(s, F.col("duration_sec"), known, F.col("sources")), F.lit("SOUND")))
    return d.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count("*").alias("segments"))


@book.add(
    "annotation_normalised",
    _SEGMENTS
    + """,
o AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY a, id, k) AS place FROM s),
x AS (SELECT clip, bool_or(place <> pos) AS moved, list(id ORDER BY place) AS segments, coalesce(list(id ORDER BY place) FILTER (kind = 'action' AND actor = 'wearer'), []) AS chain,
    coalesce(string_agg('NONEDGE_ONGOING_TO_UNCERTAIN ' || id || ' ' || edge || ' ' || CAST(sec AS VARCHAR), '|' ORDER BY place, turn) FILTER (hit), '') AS edges, count(*) FILTER (hit) AS notes
  FROM (SELECT *, 'start' AS edge, 1 AS turn, a AS sec, on_a AND a <> 0 AS hit FROM o UNION ALL SELECT *, 'end', 2, b, on_b AND abs(b - 30) > 0.001 FROM o) GROUP BY clip),
y AS (SELECT clip, moved, notes, edges, list_filter(segments, lambda z: true) AS segments, chain FROM x)
SELECT clip, CASE WHEN moved THEN 'SORT_SEGMENTS|' ELSE '' END || CASE WHEN unchained AND list_reverse(half) <> half THEN 'SORT_ACTIVITY_CHAIN|' ELSE '' END || edges AS changes, notes, array_to_string(half, ',') AS chain
FROM (SELECT clip, moved, edges, notes, [chain[2 * i - 1] FOR i IN range(1, len(chain) // 2 + 1)] AS half FROM y) JOIN d USING (clip)""",
)
def annotation_normalised(spark, sf):
    """Documents in normal form: what was changed, the notes added, and the chain."""
    x = C.normalised(_documents(spark, sf))
    line = F.transform("changes", lambda c: F.when(c["segment_id"].isNull(), c["code"]).otherwise(F.concat_ws(" ", c["code"], c["segment_id"], c["edge"], c["time_sec"].cast("string"))))
    # a mark behind the first two kinds, as the other side has it
    marks = F.transform(line, lambda t: F.when(t.startswith("SORT"), F.concat(t, F.lit("|"))).otherwise(t))
    head, tail = F.filter(marks, lambda t: t.startswith("SORT")), F.filter(marks, lambda t: ~t.startswith("SORT"))
    notes = F.aggregate("segments", F.lit(0), lambda n, s: n + F.size(s["uncertainties"]))
    return x.select("clip", F.concat(F.array_join(head, ""), F.array_join(tail, "|")).alias("changes"), notes.cast("long").alias("notes"), F.array_join("activity_chain", ",").alias("chain"))


@book.add(
    "schema_violations",
    """
SELECT CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 11 = 0 THEN 'scene_summary' WHEN event_id % 7 = 0 THEN 'actors' WHEN event_type = 'error' THEN 'segments.0.event_type' WHEN event_id % 5 = 0 THEN 'segments.1.start_sec' END AS path,
  CASE WHEN event_id % 13 = 0 THEN 'type' WHEN event_id % 11 = 0 THEN 'type' WHEN event_id % 7 = 0 THEN 'required' WHEN event_type = 'error' THEN 'enum' WHEN event_id % 5 = 0 THEN 'type' END AS rule, count(*) AS n FROM events GROUP BY 1, 2""",
)
def schema_violations(spark, sf):
    """Where JSON annotations first leave their schema, and how; no text is shown."""
    e = table(spark, sf, "events").selectExpr("""CASE WHEN event_id % 13 = 0 THEN '[1]' ELSE concat('{"schema_version": "1", "scene_summary": ', if(event_id % 11 = 0, 'null', '"x"'), if(event_id % 7 = 0, '', ', "actors": []'),
      ', "initial_environment": null, "visual_unavailable_intervals": [], "activity_chain": [], "segments": [{"segment_id": "a", "start_sec": 1, "end_sec": 2.5, "event_type": "', event_type,
      '", "actor_ids": [], "evidence": [], "boundary": {}}, {"segment_id": "b", "start_sec": ', if(event_id % 5 = 0, '"3"', '3'), ', "end_sec": 4, "event_type": "view", "actor_ids": [], "evidence": [], "boundary": {}}]}') END AS json""")
    fault = C.schema_violation(F.try_parse_json("json"), {"event_type": ("view", "click", "purchase", "signup", "other")})
    return e.select(fault.alias("f")).groupBy("f.path", "f.rule").agg(F.count("*").alias("n"))


@book.add(
    "layers_lenient",
    """
SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN '' ELSE CAST(turn AS VARCHAR) END AS action_time, coalesce(text, '') AS action_text, CASE WHEN turn % 2 = 0 THEN 'zh' ELSE '' END AS lang, role AS speaker, 'True' AS person,
  CASE WHEN turn % 3 = 0 THEN 'other' ELSE '' END AS cause, CASE WHEN turn % 2 = 0 THEN 'seen' ELSE coalesce(text, '') END AS content, CASE WHEN turn % 4 = 0 THEN 'env->action' ELSE '' END AS causal, CASE turn % 3 WHEN 0 THEN 'strong' WHEN 1 THEN '' ELSE 'weak' END AS strength, 'hum' AS sound FROM conversations""",
)
def layers_lenient(spark, sf):
    """All eight layers of loosely written documents in their one form."""
    c = table(spark, sf, "conversations")
    text = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("t")))
    body = F.substring(text, 6, F.length(text) - 6)  # the text as a JSON string
    cases = lambda n, *x: F.element_at(F.array(*map(F.lit, x)), (F.col("turn") % n + 1).cast("int"))
    parts = [
        F.lit('{"actions": [{"time": '), F.when(F.col("turn") % 5 == 0, "0").otherwise(F.concat(F.lit('"'), F.col("turn").cast("string"), F.lit('"'))), F.lit(', "text": '), body,
        F.lit('}, "plain"], "speech": [{"lang": "'), cases(2, " ZH ", "de"), F.lit('", "speaker": "'), F.col("role"), F.lit('"}], "people": [true, null], "changes": [{"cause": "'), cases(3, "Other", "x", ""),
        F.lit('"}], "screens": [{"content": '), cases(2, '"seen"', "[]"), F.lit(', "text": '), body, F.lit('}], "links": [{"type": "'), cases(4, "env->action", "a", "", "env"), F.lit('", "strength": "'),
        cases(3, "STRONG", "none", "weak"), F.lit('"}], "sounds": ["hum"]}'),
    ]
    x = c.select("conv_id", "turn", F.try_parse_json(F.concat(*parts)).alias("d"))
    layer = lambda name, key, i=0: F.get(C.lenient_layer(C.json_items(F.col("d"), key), name), F.lit(i))
    return x.select(
        "conv_id", "turn", layer("action", "actions")["time"].alias("action_time"), layer("action", "actions")["text"].alias("action_text"), layer("speech", "speech")["lang"].alias("lang"), layer("speech", "speech")["speaker"].alias("speaker"),
        layer("person", "people")["descriptor"].alias("person"), layer("env_change", "changes")["cause"].alias("cause"), layer("interface", "screens")["content"].alias("content"), layer("causal", "links")["type"].alias("causal"),
        layer("causal", "links")["strength"].alias("strength"), layer("sound", "sounds")["text"].alias("sound"),
    )


@book.add(
    "soft_metrics",
    r"""
WITH t AS (SELECT conv_id, turn, coalesce(text, '') || CASE turn % 4 WHEN 0 THEN ' is about to go' WHEN 1 THEN ' looks at the laptop' ELSE '' END AS t FROM conversations)
SELECT conv_id, count(*) FILTER (regexp_matches(t, '准备|打算|想要|试图|about to|going to|trying to')) AS intent_markers, CASE WHEN conv_id % 3 = 0 THEN 0 ELSE count(*) FILTER (turn % 2 = 0) END AS mirror_missing,
  bool_or(regexp_matches(t, '屏幕|显示器|电脑|笔记本|手机|monitor|laptop|screen|phone')) AND conv_id % 2 = 0 AS screen_hint_without_layer, count(*) FILTER (NOT contains(t, 'en') AND NOT contains(t, 'la')) AS unanchored_texts, count(*) FILTER (turn % 3 = 1) AS invalid_edge_types
FROM t GROUP BY conv_id""",
)
def soft_metrics(spark, sf):
    """Five soft figures of each finished document."""
    t = F.concat(F.coalesce("text", F.lit("")), F.when(F.col("turn") % 4 == 0, " is about to go").when(F.col("turn") % 4 == 1, " looks at the laptop").otherwise(""))
    kind = F.when(F.col("turn") % 3 == 1, "nowhere").when(F.col("conv_id") % 3 == 0, "action->env").otherwise("env->env")
    d = table(spark, sf, "conversations").groupBy("conv_id").agg(F.collect_list(t).alias("texts"), F.collect_list(F.when(F.col("turn") % 2 == 0, "self").otherwise("other")).alias("causes"), F.collect_list(kind).alias("kinds"))
    linked = F.when(F.col("conv_id") % 3 == 0, F.array_append("kinds", F.lit("action->env"))).otherwise(F.col("kinds"))
    m = C.soft_metrics(F.col("texts"), F.col("causes"), linked, F.col("conv_id") % 2 != 0, F.array(F.lit("en"), F.lit("la"), F.lit("x")))
    return d.select("conv_id", *(c.alias(n) for n, c in m.items()))


@book.add(
    "setting_faults",
    """
WITH s AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN 'workers' WHEN 1 THEN 'clip_seconds' WHEN 2 THEN 'fps' WHEN 3 THEN 'max_dim' ELSE 'colour' END AS name, l_quantity * CASE WHEN l_linenumber % 5 = 3 THEN 100 WHEN l_linenumber % 5 = 2 THEN 0.1 ELSE 1 END AS value FROM lineitem)
SELECT name, CASE WHEN name = 'colour' THEN 'unknown' ELSE 'bounds' END AS fault, count(*) AS n FROM s
WHERE name = 'colour' OR (name = 'workers' AND (value < 1 OR value > 16 OR value <> floor(value))) OR (name = 'clip_seconds' AND (value <= 0 OR value > 30)) OR (name = 'fps' AND (value <= 0 OR value > 4)) OR (name = 'max_dim' AND (value < 128 OR value > 2880 OR value <> floor(value)))
GROUP BY 1, 2""",
)
def setting_faults(spark, sf):
    """Settings of runs that are unknown or out of bounds."""
    n = F.col("l_linenumber") % 5
    name = F.when(n == 0, "workers").when(n == 1, "clip_seconds").when(n == 2, "fps").when(n == 3, "max_dim").otherwise("colour")
    value = F.col("l_quantity") * F.when(n == 3, 100.0).when(n == 2, 0.1).otherwise(1.0)
    x = table(spark, sf, "lineitem").select(name.alias("name"), value.alias("value"))
    return C.setting_faults(x, "name", "value").groupBy("name", "fault").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- responses and stages


def _rows(spark, sf) -> DataFrame:
    """(conv_id, turn, row): response rows of several kinds."""
    text = F.to_json(F.struct(F.struct(F.col("turn").alias("n")).alias("v")))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.alias("v")).selectExpr(
        "conv_id", "turn",
        r"""concat('{"status": ', CASE conv_id % 7 WHEN 0 THEN '{"code": 3, "message": "x"}' WHEN 1 THEN '{"code": 0}' WHEN 2 THEN '""' WHEN 3 THEN '{}' ELSE 'null' END,
        ', "response": {"candidates": [{"finishReason": "', if(turn % 5 = 4, 'MAX_TOKENS', 'STOP'), '", "content": {"parts": [{"text": "thinking", "thought": true}, {"text": "',
        if(conv_id % 11 = 0, 'x', ''), '{\\"n\\": "}, {"text": "', turn, '}"}]}}], "usageMetadata": {"promptTokenCount": ', conv_id % 100, ', "candidatesTokenCount": ', turn, ', "totalTokenCount": ', conv_id % 100 + turn, '}}}') AS row""",
    )


@book.add(
    "response_parse",
    """
SELECT conv_id, turn, CASE WHEN conv_id % 7 = 0 THEN 'ROW_ERROR' WHEN turn % 5 = 4 OR conv_id % 11 = 0 THEN 'INVALID_OUTPUT' END AS code, CASE WHEN conv_id % 7 <> 0 AND turn % 5 <> 4 AND conv_id % 11 <> 0 THEN turn ELSE -1 END AS n,
  CASE WHEN conv_id % 7 <> 0 AND turn % 5 <> 4 AND conv_id % 11 <> 0 THEN conv_id % 100 ELSE -1 END AS input_tokens, CASE WHEN conv_id % 7 <> 0 AND turn % 5 <> 4 AND conv_id % 11 <> 0 THEN conv_id % 100 + turn ELSE -1 END AS total_tokens, CAST(-1 AS BIGINT) AS cached_tokens FROM conversations""",
)
def response_parse(spark, sf):
    """Response rows read: failures by code, else the object and the usage."""
    x = flows.read_responses(_rows(spark, sf), "row")
    some = lambda c: F.coalesce(c, F.lit(-1).cast("long"))
    return x.select("conv_id", "turn", "code", some(F.get_json_object("data", "$.n").cast("long")).alias("n"), *(some(F.col(f"usage.{c}")).alias(c) for c in ("input_tokens", "total_tokens", "cached_tokens")))


@book.add(
    "usage_renamed",
    """
SELECT conv_id, CAST(sum(conv_id % 100) AS BIGINT) AS input_tokens, CAST(sum(turn) AS BIGINT) AS output_tokens, CAST(0 AS BIGINT) AS thought_tokens, CAST(sum(conv_id % 100 + turn) AS BIGINT) AS total_tokens FROM conversations WHERE conv_id % 7 <> 0 AND turn % 5 <> 4 AND conv_id % 11 <> 0 GROUP BY conv_id""",
)
def usage_renamed(spark, sf):
    """Usage figures under the engine's names, zero where the provider gave none."""
    x = flows.read_responses(_rows(spark, sf), "row").where("code IS NULL")
    return x.groupBy("conv_id").agg(*(F.sum(F.coalesce(f"usage.{c}", F.lit(0))).alias(c) for c in ("input_tokens", "output_tokens", "thought_tokens", "total_tokens")))


_FLOW = """
WITH c AS (SELECT conv_id AS k, count(*) AS turns FROM conversations GROUP BY conv_id),
a AS (SELECT k, turns, CASE WHEN k % 29 = 0 THEN 'UNSCHEDULED_ROW' WHEN k % 23 = 0 THEN 'DUPLICATE_RESPONSE' WHEN k % 19 = 0 THEN 'MISSING_RESPONSE' WHEN k % 17 = 0 THEN 'ROW_ERROR' WHEN k % 13 = 0 THEN 'INVALID_OUTPUT' END AS code FROM c),
b AS (SELECT k, turns, CASE WHEN k % 11 = 0 THEN 'MISSING_RESPONSE' WHEN k % 10 = 0 THEN 'ROW_ERROR' WHEN k % 9 = 0 THEN 'VALIDATION' END AS code FROM a WHERE code IS NULL),
r AS (SELECT k, CASE WHEN k % 8 = 0 THEN 'INVALID_OUTPUT' END AS code FROM b WHERE code IS NULL AND k % 2 = 0)
"""


def _batch(clips: DataFrame, stage: str, faults: list[tuple[str, str]]) -> DataFrame:
    """(clip_id, row): what a provider would return for the clips of a stage; faults: (condition on clip_id, kind)."""
    kind = S.classed([(F.expr(when), name) for when, name in faults], "ok")
    good = F.concat(F.lit('{"response": {"candidates": [{"finishReason": "STOP", "content": {"parts": [{"text": "{\\"stage\\": \\"' + stage + '\\", \\"n\\": '), F.col("clip_id").cast("string"), F.lit('}"}]}}]}}'))
    row = F.when(F.col("kind") == "error", F.lit('{"status": {"code": 13}}')).when(F.col("kind") == "invalid", F.replace(good, F.lit("STOP"), F.lit("SAFETY"))).otherwise(good)
    times = F.when(F.col("kind") == "missing", 0).when(F.col("kind") == "twice", 2).otherwise(1)
    x = clips.select("clip_id", kind.alias("kind")).withColumn("row", row).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(2)))).where(F.col("i") <= times)
    return x.select("clip_id", "row")


def _staged_flow(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(completed, failures) of audio, annotation and, for clips with crops, review."""
    clips = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("clip_id")).agg(F.count("*").alias("turns"))
    nobody = clips.select((-1 - F.col("clip_id")).alias("clip_id")).where("clip_id >= -5")
    sound, bad1, odd1 = flows.collected(clips, clips.where("clip_id % 29 <> 0"), _batch(clips, "audio", [("clip_id % 23 = 0", "twice"), ("clip_id % 19 = 0", "missing"), ("clip_id % 17 = 0", "error"), ("clip_id % 13 = 0", "invalid")]).where("clip_id % 29 <> 0").unionAll(_batch(nobody, "audio", [])), "audio")
    eligible = sound.select("clip_id", "turns")
    sound, bad2, odd2 = flows.collected(eligible, eligible, _batch(eligible, "annotation", [("clip_id % 11 = 0", "missing"), ("clip_id % 10 = 0", "error")]), "annotation")
    # the contract of the stage
    valid = F.get_json_object("data", "$.n").cast("long") % 9 != 0
    bad2 = bad2.unionAll(sound.where(~valid).select("clip_id", F.lit("annotation").alias("stage"), F.lit("VALIDATION").alias("code")))
    sound = sound.where(valid)
    with_crops = sound.where("clip_id % 2 = 0").select("clip_id", "turns")
    reviewed, bad3, odd3 = flows.collected(with_crops, with_crops, _batch(with_crops, "review", [("clip_id % 8 = 0", "invalid")]), "review")
    completed = sound.where("clip_id % 2 <> 0").select("clip_id", F.lit(False).alias("reviewed")).unionAll(reviewed.select("clip_id", F.lit(True)))
    counted = lambda d: d.groupBy("stage", "code").agg(F.count("*").alias("n"))
    failures = counted(bad1.unionAll(bad2).unionAll(bad3)).unionAll(odd1).unionAll(odd2).unionAll(odd3)
    return completed, failures


@book.add(
    "batch_failures",
    _FLOW
    + """
SELECT 'audio' AS stage, code, count(*) AS n FROM a WHERE code IS NOT NULL GROUP BY 2 UNION ALL SELECT 'annotation', code, count(*) FROM b WHERE code IS NOT NULL GROUP BY 2
UNION ALL SELECT 'review', code, count(*) FROM r WHERE code IS NOT NULL GROUP BY 2 UNION ALL SELECT 'audio', 'UNMATCHED_RESPONSE', count(*) FROM c WHERE k <= 4""",
)
def batch_failures(spark, sf):
    """A batch flow of three stages: what failed where, and responses that nobody asked for."""
    return _staged_flow(spark, sf)[1]


@book.add(
    "batch_completed",
    _FLOW + "SELECT k AS clip_id, k % 2 = 0 AS reviewed FROM b LEFT JOIN r USING (k) WHERE b.code IS NULL AND r.code IS NULL",
)
def batch_completed(spark, sf):
    """The clips that a batch flow of three stages completes."""
    return _staged_flow(spark, sf)[0]


@book.add(
    "critic_flow",
    """
WITH c AS (SELECT l_orderkey AS k, list(DISTINCT l_linenumber ORDER BY l_linenumber) AS p FROM lineitem GROUP BY 1),
x AS (SELECT k, p, len(p) AS n, CASE WHEN k % 13 = 0 THEN NULL ELSE greatest(0, least(k % 6 - 1, len(p) - 1)) END AS best, k % 3 = 0 AS again, CASE WHEN k % 3 = 0 AND k % 2 = 0 THEN least(k % 4, 2) END AS second FROM c)
SELECT k AS clip_id, CASE WHEN n > 1 AND best IS NOT NULL AND second > 0 THEN 'refine' ELSE 'generate' END AS source, CASE WHEN n = 1 OR best IS NULL THEN p[1] WHEN second > 0 THEN 100 + second - 1 ELSE p[best + 1] END AS call_index,
  CASE WHEN n = 1 THEN 'single_valid' WHEN best IS NULL THEN 'critic_failed' WHEN second IS NOT NULL THEN 'refined' ELSE 'chosen' END AS critic FROM x""",
)
def critic_flow(spark, sf):
    """The candidate that a flow of several candidates, a critic, guided new ones and a second critic ends with."""
    cand = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("clip_id"), F.col("l_linenumber").cast("long").alias("call_index")).distinct()
    clips = cand.select("clip_id").distinct()
    verdicts = clips.where("clip_id % 13 <> 0").selectExpr("clip_id", "cast(clip_id % 6 - 1 as int) AS best_index", "clip_id % 3 = 0 AS needs_regeneration")
    refined = clips.where("clip_id % 2 = 0").withColumn("call_index", F.explode(F.array(F.lit(100).cast("long"), F.lit(101).cast("long"))))
    second = clips.where("clip_id % 2 = 0").selectExpr("clip_id", "cast(clip_id % 4 as int) AS best_index")
    return flows.critic_choice(cand, verdicts, refined, second)


@book.add(
    "two_pass_merge",
    """
WITH f AS (SELECT l_orderkey AS k, l_linenumber AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS i FROM lineitem)
SELECT k AS clip_id, count(*) AS segments, count(*) FILTER (k % 4 IN (1, 2) AND (i <= 2 OR (k % 5 = 0 AND i = 3))) AS revised, k % 11 <> 0 AND (k % 4 = 0 OR k % 4 IN (1, 2)) AS done FROM f GROUP BY k""",
)
def two_pass_merge(spark, sf):
    """Segments of a first pass with the corrections of a second, by time range and else by place; and whether a clip is done."""
    keys = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("clip_id")).agg(F.size(F.collect_list(F.struct(*keys))).alias("n"))
    seg = lambda i, mark: F.struct(F.concat(F.lit("10:00:0"), i.cast("string"), mark).alias("time_range"), F.concat(F.lit("old "), i.cast("string")).alias("text"), F.lit("kept").alias("detail"))
    first = lines.select("clip_id", (F.col("clip_id") % 11 != 0).alias("ok"), (F.col("clip_id") % 4).alias("n_crops"), F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: seg(i, F.lit(" - x"))).alias("segments"))
    # the first by place, the second by its range, a third by range for some; empty fields change nothing
    fix = lambda at, text: F.struct(F.lit(at).alias("time_range"), F.lit(text).alias("text"), F.lit("").alias("detail"))
    revised = F.when(F.col("clip_id") % 5 == 0, F.array(fix("", "new"), fix("10:00:02-x", "new"), fix("10:00:03 -x", "new"))).otherwise(F.array(fix("", "new"), fix("10:00:02-x", "new")))
    second = lines.where("clip_id % 4 <> 0").select("clip_id", (F.col("clip_id") % 4).isin(1, 2).alias("ok"), revised.alias("revised"))
    x = flows.two_pass(first, second)
    new = F.size(F.filter("segments", lambda s: (s["text"] == "new") & (s["detail"] == "kept")))
    return x.select("clip_id", F.size("segments").cast("long").alias("segments"), new.cast("long").alias("revised"), "done")


@book.add(
    "vote_arbitration",
    "SELECT l_orderkey AS clip_id, bool_or(l_returnflag <> 'N' AND l_suppkey % 2 = 0 AND l_linenumber % 4 <> 3) AS arbitrate FROM lineitem GROUP BY 1",
)
def vote_arbitration(spark, sf):
    """Whether the runs of a clip disagree about an object that is interacted with."""
    v = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("clip_id"), F.when(F.col("l_suppkey") % 2 == 0, "object").otherwise("person").alias("kind"), (F.col("l_returnflag") != "N").alias("interacted"),
        F.concat((F.col("l_linenumber") % 4).cast("string"), F.lit("/3")).alias("votes"),
    )
    return flows.arbitration(v)


@book.add(
    "resume_modes",
    """
WITH r AS (SELECT o_custkey AS clip, arg_max(o_orderkey, o_orderkey) AS k FROM orders GROUP BY 1)
SELECT c_custkey AS clip_id FROM customer LEFT JOIN r ON clip = c_custkey WHERE k IS NULL OR NOT (k % 3 = 1 AND k % 2 = 0 AND k % 5 <> 0 AND k % 7 <> 0)""",
)
def resume_modes(spark, sf):
    """Clips whose last record does not match the run's mode, several candidates with a critic, and its inference."""
    r = table(spark, sf, "orders").selectExpr(
        "o_custkey AS clip_id", "o_orderkey AS seq", "cast(o_orderkey % 3 + 2 as int) AS best_of_n", "if(o_orderkey % 2 = 0, 'high', 'low') AS thinking", "if(o_orderkey % 5 = 0, null, 'c') AS critic", "if(o_orderkey % 7 = 0, 'failed', 'ok') AS inference_status"
    )
    return flows.to_do(table(spark, sf, "customer").select(F.col("c_custkey").alias("clip_id")), r, "seq", 3, "high").select("clip_id")


@book.add(
    "checkpoint_split",
    """
SELECT CASE WHEN o_orderkey % 17 <> 0 AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' AND o_custkey % 2 = 0 AND o_custkey % 5 <> 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 4 < 2 THEN 'completed' ELSE 'pending' END AS state, count(*) AS n, min(o_orderkey) AS first_clip FROM orders GROUP BY 1""",
)
def checkpoint_split(spark, sf):
    """Saved clips that may stand for their clips, by all eight conditions, and those that are still to do."""
    c = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS of_clip", "if(o_orderkey % 17 = 0, o_orderkey + 1, o_orderkey) AS clip_id", "o_orderpriority AS recording", "o_orderstatus AS model", "if(o_custkey % 2 = 0, 'two-pass', 'one-pass') AS pipeline", "if(o_custkey % 5 = 0, null, 'flex') AS service_tier",
        "o_orderkey % 3 <> 0 AS ok", "CASE o_orderkey % 4 WHEN 0 THEN '{}' WHEN 1 THEN '{\"a\": 1}' WHEN 2 THEN '[1]' END AS parsed",
    )
    state = F.when(flows.compatible("1-URGENT", "O", "two-pass", "flex"), "completed").otherwise("pending")
    return c.groupBy(state.alias("state")).agg(F.count("*").alias("n"), F.min("of_clip").alias("first_clip"))


# ---------------------------------------------------------------- requests


@book.add(
    "context_blocks",
    """
WITH d AS (SELECT doc_id, 'clip ' || CAST(doc_id AS VARCHAR) AS head, CASE WHEN doc_id % 3 = 0 THEN 'spoken' END AS speech, CASE WHEN doc_id % 5 = 0 THEN '(no text detected)' WHEN length(coalesce(text, '') || chr(10) || 'end') > 30000 THEN substr(coalesce(text, '') || chr(10) || 'end', 1, 30000) || chr(10) || '... (OCR truncated)' ELSE coalesce(text, '') || chr(10) || 'end' END AS seen FROM documents)
SELECT doc_id, sha256(head || chr(10) || chr(10) || CASE WHEN speech IS NOT NULL THEN '## Speech' || chr(10) || speech ELSE '## Audio transcript' || chr(10) || 'said' END || chr(10) || chr(10) || '## Screen text' || chr(10) || seen) AS with_all,
  sha256(head || chr(10) || chr(10) || CASE WHEN speech IS NOT NULL THEN '## Speech' || chr(10) || speech || chr(10) || chr(10) ELSE '' END || '## Frames only') AS with_none FROM d""",
)
def context_blocks(spark, sf):
    """Context of a request with all of its sections, and with no more than it must have."""
    d = table(spark, sf, "documents")
    head, speech = F.concat(F.lit("clip "), F.col("doc_id").cast("string")), F.when(F.col("doc_id") % 3 == 0, "spoken")
    seen = F.when(F.col("doc_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.coalesce("text", F.lit("")), F.lit("end")))
    block = lambda *use: F.sha2(flows.context_block(head, speech, F.lit("said"), seen, *use), 256)
    return d.select("doc_id", block(True, True).alias("with_all"), block(False, False).alias("with_none"))


@book.add(
    "request_texts",
    """
SELECT o_orderkey, 'BATCH_ID:' || 'audio:' || CAST(o_orderkey AS VARCHAR) || chr(10) || '{"stage":"audio","clip":"' || CAST(o_orderkey AS VARCHAR) || '","duration":' || CAST(o_custkey AS VARCHAR) || ',"note":null}' AS first_part,
  'base note' || CASE WHEN o_custkey % 2 = 0 THEN chr(10) || 'up to ' || CAST(o_custkey % 4 AS VARCHAR) || ' of ' || CAST(o_custkey % 4 AS VARCHAR) ELSE '' END || CASE WHEN o_custkey % 3 = 0 THEN ' fixed' ELSE '' END AS prompt FROM orders""",
)
def request_texts(spark, sf):
    """First parts of requests, with the mark by which their responses are known, and prompts."""
    c = F.col("o_custkey")
    context = F.struct(F.lit("audio").alias("stage"), F.col("o_orderkey").cast("string").alias("clip"), c.alias("duration"), F.lit(None).cast("string").alias("note"))
    prompt = flows.stage_prompt(F.lit("base"), F.lit(" note"), F.lit("up to MAX_REVIEW_REGIONS of MAX_REVIEW_REGIONS"), F.lit(" fixed"), c % 4, c % 2 == 0, c % 3 == 0)
    return table(spark, sf, "orders").select("o_orderkey", flows.request_text("BATCH_ID:", F.concat(F.lit("audio:"), F.col("o_orderkey").cast("string")), context).alias("first_part"), prompt.alias("prompt"))


@book.add(
    "structural_prune",
    "SELECT o_orderkey, '{\"scene_summary\":\"' || o_orderpriority || '\",\"n\":' || CAST(o_custkey AS VARCHAR) || '}' AS doc, o_orderstatus AS review_regions FROM orders",
)
def structural_prune(spark, sf):
    """Fields that ride along on a response are split off before it is judged."""
    d = F.struct(F.col("o_orderpriority").alias("scene_summary"), F.col("o_orderstatus").alias("review_regions"), F.col("o_custkey").alias("n"), F.lit(1).alias("_sort"))
    x = table(spark, sf, "orders").select("o_orderkey", d.alias("d"))
    return x.select("o_orderkey", F.to_json(F.col("d").dropFields("review_regions", "_sort")).alias("doc"), F.col("d.review_regions").alias("review_regions"))


REPORT = tuple("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split())


@book.add("report_projection", f"SELECT {', '.join(REPORT)} FROM lineitem")
def report_projection(spark, sf):
    """The report's columns of a result; only these are read."""
    return table(spark, sf, "lineitem").select(*REPORT)


# ---------------------------------------------------------------- order and limits


@book.add(
    "clip_range",
    """
WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS i FROM conversations) SELECT conv_id, turn, i AS clip_index FROM c WHERE i >= 2 AND i < 5""",
)
def clip_range(spark, sf):
    """Clips of a range of places in each source, as a condition on the place and no offset."""
    from pyspark.sql import Window

    i = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role")) - 1
    return table(spark, sf, "conversations").select("conv_id", "turn", i.cast("long").alias("clip_index")).where("clip_index >= 2 AND clip_index < 5")


@book.add("head_limit", "SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 100")
def head_limit(spark, sf):
    """The first hundred units in order; each task passes on no more than these."""
    return table(spark, sf, "events").orderBy("ts", "event_id").limit(100).select("event_id", "user_id")


@book.add(
    "segment_sort",
    r"""
SELECT conv_id, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY k, turn, role) AS turns FROM (
  SELECT conv_id, turn, role, CASE WHEN regexp_matches(s, '\d{1,2}:\d{2}:\d{2}') THEN regexp_extract(s, '\d{1,2}:\d{2}:\d{2}') ELSE '09:00:00' END AS k FROM (
    SELECT conv_id, turn, role, CASE turn % 4 WHEN 0 THEN 'at 10:0' || CAST(turn % 7 AS VARCHAR) || ':00-10:09:00' WHEN 1 THEN 'none' WHEN 2 THEN '08:1' || CAST(turn % 5 AS VARCHAR) || ':00' ELSE '' END AS s FROM conversations)) GROUP BY conv_id""",
)
def segment_sort(spark, sf):
    """Segments by the first time in their range, by the clip's start where there is none, and else as they came."""
    r = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("at 10:0"), (F.col("turn") % 7).cast("string"), F.lit(":00-10:09:00"))).when(F.col("turn") % 4 == 1, "none").when(F.col("turn") % 4 == 2, F.concat(F.lit("08:1"), (F.col("turn") % 5).cast("string"), F.lit(":00"))).otherwise("")
    found = F.regexp_extract(r, r"\d{1,2}:\d{2}:\d{2}", 0)
    key = F.when(found == "", "09:00:00").otherwise(found)
    g = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), "turn", "role"))).alias("l"))
    return g.select("conv_id", F.array_join(F.transform("l", lambda x: x["turn"].cast("string")), ",").alias("turns"))


@book.add("first_failure", "SELECT l_linestatus AS run, min(l_comment_key) AS name, arg_min(l_quantity, l_comment_key) AS error FROM (SELECT l_linestatus, lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || CAST(l_linenumber AS VARCHAR) || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS l_comment_key, l_quantity FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1")
def first_failure(spark, sf):
    """Of the failures of each run the one whose name comes first, whatever order they come in."""
    pad = lambda c: F.lpad(F.col(c).cast("string"), 9, "0")
    x = table(spark, sf, "lineitem").where("l_returnflag = 'R'").withColumn("name", F.concat(pad("l_orderkey"), F.col("l_linenumber").cast("string"), pad("l_partkey"), pad("l_suppkey")))
    return x.groupBy(F.col("l_linestatus").alias("run")).agg(F.min("name").alias("name"), F.min_by("l_quantity", "name").alias("error"))


# ---------------------------------------------------------------- objects, rollups, logs


@book.add(
    "grouped_objects",
    """
WITH i AS (SELECT l_orderkey AS clip, l_linenumber % 3 AS run, CASE l_partkey % 5 WHEN 0 THEN 'cup' WHEN 1 THEN 'coffee cup' WHEN 2 THEN 'mug' WHEN 3 THEN 'plate' ELSE 'vase' END AS label, CASE WHEN l_partkey % 5 < 3 THEN 'cup' WHEN l_partkey % 5 = 3 THEN 'plate' ELSE 'vase' END AS kind,
    CASE l_partkey % 5 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS specific, l_suppkey % 30 AS a, l_suppkey % 30 + CAST(l_quantity AS BIGINT) % 10 + 1 AS b, l_returnflag = 'R' AS uncertain, l_linestatus AS attribute FROM lineitem),
r AS (SELECT clip, count(DISTINCT run) AS k FROM i GROUP BY clip),
n AS (SELECT *, CASE WHEN a >= max(b) OVER (PARTITION BY clip, kind ORDER BY a, b, run, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS fresh FROM i),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY clip, kind ORDER BY a, b, run, label ROWS UNBOUNDED PRECEDING) AS grp FROM n),
o AS (SELECT clip, kind, grp, arg_max(label, specific) AS label, min(a) AS a, max(b) AS b, count(DISTINCT run) AS n, count(*) FILTER (uncertain) AS u, count(*) AS m, count(DISTINCT label) AS labels, array_to_string(list_sort(list(DISTINCT attribute)), '+') AS attributes FROM g GROUP BY 1, 2, 3)
SELECT clip AS clip_id, label, a AS start, b AS "end", CAST(n AS VARCHAR) || '/' || CAST(k AS VARCHAR) AS votes, CASE WHEN n <= 1 AND k > 1 OR u = m THEN 'low' WHEN n >= k AND u = 0 AND labels = 1 THEN 'high' ELSE 'medium' END AS confidence, attributes FROM o JOIN r USING (clip)""",
)
def grouped_objects(spark, sf):
    """Objects of several runs by synonym and overlapping time, with votes and confidence."""
    p = F.col("l_partkey") % 5
    label = F.when(p == 0, "cup").when(p == 1, "coffee cup").when(p == 2, "mug").when(p == 3, "plate").otherwise("vase")
    start = F.col("l_suppkey") % 30
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("clip_id"), (F.col("l_linenumber") % 3).alias("call_index"), label.alias("label"), start.alias("start"), (start + F.col("l_quantity").cast("long") % 10 + 1).alias("end"), (F.col("l_returnflag") == "R").alias("uncertain"),
        F.col("l_linestatus").alias("attribute"),
    )
    synonyms = spark.createDataFrame([("cup", "cup", 0), ("coffee cup", "cup", 2), ("mug", "cup", 1)], "label string, kind string, specific int")
    return flows.grouped_objects(items, synonyms, items.select("clip_id", "call_index")).withColumn("attributes", F.array_join("attributes", "+"))


@book.add(
    "object_audit",
    """
WITH e AS (SELECT * FROM (VALUES ('URGENT', 1, '3/3'), ('LOW', 2, '1/3'), ('4-NOT SPECIFIED AT ALL', 3, '2/3'), ('MEDIUM', 4, 'new'), ('', 5, '3/3')) AS t(label, pos, votes)),
o AS (SELECT DISTINCT o_orderpriority AS object FROM orders),
m AS (SELECT object, label, votes, row_number() OVER (PARTITION BY object ORDER BY length(label) DESC, pos) AS k FROM o JOIN e ON label <> '' AND (contains(object, label) OR contains(label, object)))
SELECT o.object, coalesce(label, '') AS label, CASE votes WHEN '3/3' THEN 'hit_high' WHEN '1/3' THEN 'hit_low' WHEN '2/3' THEN 'hit_mid' WHEN 'new' THEN 'hit_new' ELSE 'left' END AS bucket FROM o LEFT JOIN m ON o.object = m.object AND k = 1""",
)
def object_audit(spark, sf):
    """Objects against a voted lexicon: what matches, by votes, and what is left for a model."""
    entries = spark.createDataFrame([("URGENT", 1, "3/3"), ("LOW", 2, "1/3"), ("4-NOT SPECIFIED AT ALL", 3, "2/3"), ("MEDIUM", 4, "new"), ("", 5, "3/3")], "label string, pos int, votes string")
    return flows.audited_objects(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("object")), entries).withColumn("label", F.coalesce("label", F.lit("")))


@book.add(
    "final_assembly",
    """
WITH c AS (SELECT o_orderkey AS clip_id, o_custkey * 37 % 86400 AS s FROM orders),
l AS (SELECT l_orderkey AS clip_id, 'p' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS label, CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_suppkey % 40 - 5 AS INTEGER) END AS f FROM lineitem),
t AS (SELECT clip_id, label, CASE WHEN f IS NULL THEN '' ELSE strftime(TIMESTAMP '2000-01-01' + to_seconds(CAST((s + greatest(f, 0)) % 86400 AS BIGINT)), '%H:%M:%S') END AS seen FROM l JOIN c USING (clip_id))
SELECT c.clip_id, coalesce(string_agg(label || '@' || seen, ',' ORDER BY label, seen), '') AS inventory, c.clip_id % 3 = 0 AS has_screen, CASE WHEN c.clip_id % 3 = 0 THEN 'ok' ELSE 'skipped' END AS recovery FROM c LEFT JOIN t ON t.clip_id = c.clip_id GROUP BY c.clip_id""",
)
def final_assembly(spark, sf):
    """Final records: times of day, and what was not asked for."""
    clips = table(spark, sf, "orders").select(F.col("o_orderkey").alias("clip_id"), (F.col("o_custkey") * 37 % 86_400).cast("double").alias("start_sec"))
    at = F.when(F.col("l_linenumber") == 2, "?").otherwise((F.col("l_suppkey") % 40 - 5).cast("string"))
    lexicon = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("clip_id"), F.concat(F.lit("p"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("label"), at.alias("first_s"), at.alias("last_s"))
    screens = clips.where("clip_id % 3 = 0").select("clip_id", F.array(F.lit("screen")).alias("surfaces"), F.lit("ok").alias("recovery"))
    x = flows.assembled(clips, lexicon, screens)
    seen = F.transform("inventory", lambda e: F.concat(e["label"], F.lit("@"), e["first_seen"]))
    return x.select("clip_id", F.array_join(seen, ",").alias("inventory"), (F.size("screen") > 0).alias("has_screen"), "recovery")


@book.add(
    "recording_rollup",
    """
SELECT l_orderkey AS recording, count(*) AS clips, count(*) FILTER (l_returnflag <> 'R') AS ok, min(l_linenumber) AS first_clip, max(l_linenumber) AS last_clip, CAST(sum(l_partkey) + sum(l_suppkey) AS BIGINT) AS tokens,
  round_even((sum(l_partkey) / 1e6 * 0.75 + sum(l_suppkey) / 1e6 * 3.75) * CASE WHEN l_orderkey % 2 = 0 THEN 0.5 ELSE 1.0 END, 3) AS usd FROM lineitem GROUP BY l_orderkey""",
)
def recording_rollup(spark, sf):
    """Recordings with counts, first and last clips, tokens and cost; the cost is shown to a tenth of a cent."""
    c = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("recording"), F.col("l_linenumber").alias("clip_id"), F.col("l_linenumber").alias("start"), (F.col("l_returnflag") != "R").alias("ok"), F.col("l_partkey").alias("input_tokens"), F.col("l_suppkey").alias("output_tokens"),
        (F.col("l_orderkey") % 2 == 0).alias("deferred"),
    )
    return flows.recording_rollup(c, digits=3)


@book.add(
    "log_counters",
    """
SELECT event_type AS stage, count(*) FILTER (event_id % 3 = 0) AS started, count(*) FILTER (event_id % 3 = 1) AS succeeded, count(*) FILTER (event_id % 3 = 2) AS failed, CAST(coalesce(sum(CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 100 END), 0) AS BIGINT) AS input_tokens,
  CAST(coalesce(sum(event_id % 7), 0) AS BIGINT) AS output_tokens, count(*) FILTER (event_id % 3 <> 0 AND event_id % 5 = 0) AS responses_without_usage FROM events GROUP BY 1""",
)
def log_counters(spark, sf):
    """Counters of an event log by stage; missing figures count as none."""
    from lumentrace.streaming.folds import counters

    k = F.col("event_id")
    e = table(spark, sf, "events").select(F.col("event_type").alias("stage"), F.when(k % 3 == 0, "start").when(k % 3 == 1, "success").otherwise("failed").alias("event"), F.when(k % 5 != 0, k % 100).alias("input_tokens"), (k % 7).alias("output_tokens"))
    return counters(e)


@book.add("unmatched_responses", "SELECT 'UNMATCHED_RESPONSE' AS code, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def unmatched_responses(spark, sf):
    """One row for all responses that nobody asked for."""
    from lumentrace.operators.joins import unmatched

    asked = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("rid"))
    return unmatched(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("rid")), asked, "rid")


@book.add(
    "valid_finals",
    """
SELECT o_orderkey AS clip_index, '{"clip":' || CAST(o_orderkey AS VARCHAR) || '}' AS document FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' AND o_orderkey % 7 <> 0""",
)
def valid_finals(spark, sf):
    """Final documents that are exported: sound, of the run's fingerprint, and JSON."""
    from lumentrace.sources.sinks import valid_finals as valid

    document = F.concat(F.lit('{"clip":'), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 7 == 0, "").otherwise("}"))
    f = table(spark, sf, "orders").select(F.col("o_orderkey").alias("clip_index"), F.col("o_orderpriority").alias("fingerprint"), (F.col("o_orderstatus") == "O").alias("ok"), document.alias("document"))
    return valid(f, "2-HIGH").select("clip_index", "document")


@book.add(
    "first_attempts",
    """
WITH a AS (SELECT l_orderkey AS clip_id, l_linenumber AS attempt, l_returnflag = 'N' AS ok, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END, l_linenumber) AS k FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2))
SELECT clip_id, attempt, ok FROM a WHERE k = 1""",
)
def first_attempts(spark, sf):
    """Of the attempts at each clip, with audio and then without, the first sound one, or the first."""
    a = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("clip_id"), F.col("l_linenumber").alias("attempt")).agg(F.min("l_returnflag").alias("f"))
    x = flows.first_success(a.select("clip_id", "attempt", F.when(F.col("f") != "N", "ROW_ERROR").alias("code")))
    return x.select("clip_id", "attempt", F.col("code").isNull().alias("ok"))


@book.add(
    "absolute_cuts",
    "SELECT event_id, event_id * 5 AS start_frame, CASE WHEN event_type = 'error' THEN -1 ELSE event_id * 5 + event_id % 5 END AS cut_frame FROM events",
)
def absolute_cuts(spark, sf):
    """Cuts counted from the recording's start; -1 stands for none."""
    e = table(spark, sf, "events").select("event_id", (F.col("event_id") * 5).alias("start_frame"), F.when(F.col("event_type") != "error", F.col("event_id") % 5).alias("cut_after_frame"))
    return flows.absolute_cuts(e).select("event_id", "start_frame", F.coalesce("cut_frame", F.lit(-1)).alias("cut_frame"))
