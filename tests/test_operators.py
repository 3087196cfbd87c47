"""Operators on small rows."""

import pytest
from pyspark.sql import functions as F

from lumentrace.functions import scalars as S
from lumentrace.operators import aggregates as A
from lumentrace.operators import contracts as C
from lumentrace.operators import flows
from lumentrace.operators import joins as J
from lumentrace.operators import sets as U
from lumentrace.operators import windows as W
from lumentrace.streaming import folds


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(("d", "n"), [(29.0, 1), (30.4, 1), (30.6, 2), (60.3, 2), (61.0, 3), (75.0, 3), (5.0, 1)])
def test_piece_count(spark, d, n):
    assert one(spark, S.piece_count(F.col("d"), 30.0), d=d) == n


def test_time_of_day(spark):
    assert one(spark, S.hms(F.lit(90061))) == "01:01:01" and one(spark, S.hms(F.lit(-1))) == "23:59:59"
    assert one(spark, S.seconds_of(F.lit("01:02:03.50"))) == 3723.5 and one(spark, S.seconds_of(F.lit("bad"))) is None
    assert one(spark, S.compact_seconds(F.lit("0130"))) == 5400 and one(spark, S.compact_seconds(F.lit("130"))) is None


def test_boxes_votes_totals(spark):
    box = one(spark, S.box_pixels(F.lit(100), F.lit(1), F.lit(501), F.lit(999), F.lit(320), F.lit(180)))
    assert (box.x0, box.y0, box.x1, box.y1) == (0, 18, 320, 91)
    assert one(spark, S.box_pixels(F.lit(5), F.lit(1), F.lit(5), F.lit(9), F.lit(10), F.lit(10))) is None
    assert [one(spark, S.vote_bucket(F.lit(v))) for v in ("1/3", "3/3", "2/3", "new")] == ["low", "high", "mid", "mid"]
    assert one(spark, S.weighted_total(F.lit(9.0), F.lit(8.0), F.lit(7.0), F.lit(6.0), F.lit(True))) == 5.3
    assert one(spark, S.backoff(F.lit(20), F.lit(None).cast("int"))) == 256 and one(spark, S.backoff(F.lit(1), F.lit(99999))) == 1800


def _redacted(text, values=(), limit=None):
    """The rules in plain Python."""
    import re

    for v in values:
        text = text.replace(v, "[REDACTED]") if len(v) >= 4 else text
    text = re.sub(r"(?i)(authorization\s*[:=]\s*bearer\s+)[^\s,;\"']+", r"\1[REDACTED]", text)
    text = re.sub(r"(?i)((?:api[_-]?key|key|token)\s*[=:]\s*)[^\s,;\"']+", r"\1[REDACTED]", text)
    text = re.sub(r"hf_[0-9A-Za-z_-]{10,}", "[REDACTED]", re.sub(r"AIza[0-9A-Za-z_-]{10,}", "[REDACTED]", text))
    return " ".join(text.split())[:limit]


@pytest.mark.parametrize("text", [
    "api_key=abcd1234efgh", "key=abc1234", "see hf_abc-defghijklmnop.", "token=abcdefgh.secretpart, on", "API-KEY :  a/b+c== x", "key='quoted'", "Authorization:\tBearer a.b-c; d", "Bearer abc stays",
    "AIzaSy_0123456789 and AIzashort", "monkey: banana", "the value pa55word! and abc", " a\xa0b\u2003c\n\nd ", "", "tokens = many words " * 50,
])
def test_redaction(spark, text):
    values = ("pa55word", "abc")
    assert one(spark, S.redact(F.lit(text), values)) == _redacted(text, values)
    assert one(spark, S.redact(F.lit(text), values, 20)) == _redacted(text, values, 20)


def test_secret_values_and_null_texts(spark):
    assert S.secret_values({"HF_TOKEN": "abcdef", "GOOGLE_API_KEY": "abc", "HOME": "/root"}) == ("abcdef",)
    assert one(spark, S.redact(F.lit(None).cast("string"))) == ""


@pytest.mark.parametrize(
    ("message", "name"),
    [
        ("HTTP 429", "quota"), ("Request Entity Too Large: quota", "quota"), ("413 content size", "payload"), ("404 page", "model"), ("Unknown model x", "model"), ("error 401", "auth"), ("PERMISSION_DENIED", "auth"),
        ("503 Unavailable", "server"), ("Empty stream", "server"), ("read timed out", "network"), ("Connection reset by peer", "network"), ("Deadline exceeded", "other"), ("weird", "other"), (None, "other"),
    ],
)
def test_error_classes(spark, message, name):
    assert one(spark, S.error_class(F.lit(message).cast("string"))) == name


@pytest.mark.parametrize(
    ("code", "kind", "message", "name"),
    [
        (429, "ClientError", "billing is off", "billing"), (403, "", "", "auth"), (None, "RefreshError", "", "auth"), (404, "", "", "model"), (429, "", "", "quota"), (599, "", "", "server"), (408, "", "", "network"),
        (None, "ReadTimeout", "", "network"), (None, "ValueError", "x", "config"), (None, None, None, "config"),
    ],
)
def test_failure_classes(spark, code, kind, message, name):
    assert one(spark, S.failure_class(F.lit(code).cast("int"), F.lit(kind).cast("string"), F.lit(message).cast("string"))) == name


def test_output_classes(spark):
    assert [one(spark, S.output_class(F.lit(t), F.lit(n))) for t, n in ((" ", 1), ("no", 3), ("{}", 3), ("no", 30))] == ["empty", "safety_rejection", "ok", "ok"]


def test_names_and_paths(spark):
    got = one(spark, S.clip_parts(F.lit("DAY4_A1_JAKE_10483000_p2")))
    assert tuple(got) == (4, "A1_JAKE", 10, 48, 30, 0, 2) and one(spark, S.clip_parts(F.lit("DAY1_A1_JAKE_11094208"))).piece == 0
    assert one(spark, S.clip_parts(F.lit("DAY1_A1_JAKE_1109420"))) is None and one(spark, S.clip_parts(F.lit("x"))) is None
    assert [one(spark, S.safe_path(F.lit(p))) for p in ("audio/a-b_1.json", "audio/../x.json", "other/a.json", "review/a.json\n", None)] == [True, False, False, False, False]
    assert [one(spark, S.utc_text(F.lit(t))) for t in ("2024-12-01T10:00:00Z", "2024-12-01 10:00:00.5+00:00", "2024-12-01T10:00:00", "2024-13-01T10:00:00Z", "2024-12-01T10:00:00+08:00")] == ["2024-12-01T10:00:00Z"] * 3 + [None, None]
    assert tuple(one(spark, S.frame_parts(F.lit("dir/2024-12-01_10-11-12_HKT__frame_0042.jpg")))) == ("2024-12-01", "10:11:12", 42)
    assert one(spark, S.clean_ocr(F.lit("capture_time: 1\n Menu \nframe_index 3\nExit\n\n"))) == "Menu \nExit"


def test_privacy_counts(spark):
    t = "a.b@x.org c@example.com 13812345678 1234-5678 Foo College University X; Old School and OLD SCHOOL"
    got = spark.range(1).select(*(c.alias(n) for n, c in S.pii_counts(F.lit(t), ("old school",)).items())).first().asDict()
    assert got == {"school_plain": 2, "school_generic": 1, "email_plain": 1, "phone_plain": 2, "anonymized_placeholders": 1, "total_hits": 6}


def test_gap_is_strict_and_last_end_counts(spark):
    d = spark.createDataFrame([("a", 0, 100), ("a", 10, 20), ("a", 25, 30), ("a", 36, 40)], "k string, s long, e long")
    got = {(r.s, r.e, r.members) for r in W.merge_gaps(d, ["k"], "s", "e", 5).collect()}
    # the second begins before the first ends; what follows it is measured from its own end
    assert got == {(0, 30, 3), (36, 40, 1)}


def test_trail_skips_invalid(spark):
    d = spark.createDataFrame([(i, i != 3) for i in range(6)], "i long, ok boolean")
    got = {r.i: r.trail for r in W.trail(d.withColumn("k", F.lit(1)), ["k"], ["i"], F.col("ok"), F.col("i"), 3).collect()}
    assert got[3] == [] and got[4] == [1, 2, 4] and got[0] == [0]


def test_ranked_is_a_global_order(spark):
    d = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert all(r.r == r.v + 1 for r in W.ranked(d, ["v"], "r").collect())


@pytest.mark.parametrize("bucket", [1, 3, 50])
def test_overlap_joins_like_a_nested_loop(spark, bucket):
    a = [(1, s, s + n) for s in range(0, 40, 3) for n in (0, 1, 9)]
    b = [(1, s, s + n) for s in range(0, 40, 4) for n in (1, 15)]
    got = J.overlap(spark.createDataFrame(a, "k long, s long, e long"), spark.createDataFrame(b, "k long, t long, f long"), ["k"], ("s", "e"), ("t", "f"), bucket).collect()
    want = [(1, s, e, t, f) for _, s, e in a for _, t, f in b if e > s and s < f and t < e]
    assert sorted(map(tuple, got)) == sorted(want)
    pts = spark.createDataFrame([(1, i) for i in range(45)], "k long, p long")
    inside = J.points_in(pts, spark.createDataFrame(b, "k long, t long, f long"), ["k"], "p", ("t", "f"), bucket).count()
    assert inside == sum(t <= p <= f for p in range(45) for _, t, f in b)


def test_correlation_codes(spark):
    x = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "rid string")
    r = spark.createDataFrame([("a", True, False), ("b", False, False), ("b", False, False), ("d", False, True), ("e", False, False), ("z", False, False)], "rid string, bad boolean, inv boolean")
    got = {t.rid: t.code for t in J.correlate(x, r, "rid", F.col("bad"), F.col("inv")).collect()}
    assert got == {"a": "ROW_ERROR", "b": "DUPLICATE_RESPONSE", "c": "MISSING_RESPONSE", "d": "INVALID_OUTPUT", "e": None}
    assert J.unmatched(r, x, "rid").first().n == 1


def test_pool_and_differences(spark):
    f = lambda rows: spark.createDataFrame(rows, "k long, v string")
    got = {r.k: (r.v, r.origin) for r in U.pooled([f([(1, "a")]), f([(1, "b"), (2, "b")]), f([(3, "c")])], ["k"]).collect()}
    assert got == {1: ("a", 0), 2: ("b", 1), 3: ("c", 2)}
    assert {(r.k, r.difference) for r in U.differences(f([(1, "a"), (2, "b"), (4, None)]), f([(2, "x"), (3, "c"), (4, None)]), "k", "v").collect()} == {(1, "missing"), (2, "differs"), (3, "unrecorded")}


def test_index_quantile_takes_an_element(spark):
    d = spark.createDataFrame([("a", v) for v in (5, 1, 1, 9)] + [("b", 3), ("b", None)], "k string, v long")
    assert {(r.k, r.n, r.m) for r in A.index_quantile(d, ["k"], "v", F.floor(F.col("n") / 2), "m").collect()} == {("a", 4, 5), ("b", 1, 3)}


def _document(**change):
    seg = lambda i, a, b, **more: {
        "segment_id": f"s{i:03}", "start_sec": a, "end_sec": b, "event_type": "action", "actor_ids": ["wearer"], "activity": "x", "action": "x", "action_brief": "x", "objects": [],
        "environment": {"world_changes": [], "newly_observed": []}, "text_visible": [], "speech": None, "details": None,
        "evidence": [{"source_id": "video_0", "modality": "visual", "start_sec": a, "end_sec": b, "support": "x", "note": ""}], "boundary": {"start": "seen", "end": "seen", "precision": "x"}, "uncertainties": [],
    } | more
    speech = {"speaker_id": "wearer", "source": "audio", "text": "hi", "verification": "audio_checked"}
    third = seg(3, 6.0, 8.0, event_type="speech", speech=speech, evidence=[{"source_id": "audio_0", "modality": "audio", "start_sec": 6.0, "end_sec": 7.0, "support": "x", "note": ""}])
    doc = {
        "schema_version": "1", "scene_summary": "x", "actors": [{"actor_id": "wearer", "description": "x"}], "initial_environment": {"time_sec": 0.0, "description": "x"}, "visual_unavailable_intervals": [],
        "segments": [seg(1, 2.0, 4.0), seg(2, 4.0, 6.0), third, seg(4, 8.0, 9.0, actor_ids=["unknown"]), seg(5, 9.0, 20.0)], "activity_chain": ["s001", "s002", "s005"],
    }
    return doc | change


def _judge(spark, doc, sources=("video_0", "audio_0")):
    d = spark.createDataFrame([(doc,)], f"d STRUCT<{C.ANNOTATION}>").select("d.*").withColumn("duration_sec", F.lit(20.0))
    return d, C.annotation_errors(d, F.col("duration_sec"), F.array(*map(F.lit, sources))).first().error


def _mutated(change):
    doc = _document()
    change(doc)
    return doc


@pytest.mark.parametrize(
    ("change", "code"),
    [
        (lambda d: None, None),
        (lambda d: d["segments"][0]["evidence"][0].update(end_sec=21.0), "EVIDENCE_INTERVAL"),
        (lambda d: d["segments"][0].update(actor_ids=["person_99"]), "UNKNOWN_ACTOR"),
        (lambda d: d["segments"][0]["evidence"][0].update(source_id="audio_0"), "MODALITY"),
        (lambda d: d["segments"][0]["evidence"][0].update(modality="transcript"), "MODALITY"),
        (lambda d: d["segments"][0]["evidence"][0].update(source_id="tv_0"), "UNKNOWN_SOURCE"),
        (lambda d: d["segments"][0]["evidence"][0].update(source_id=None), "UNKNOWN_SOURCE"),
        (lambda d: d["segments"][2]["speech"].update(verification="transcript_only"), "NO_TRANSCRIPT"),
        (lambda d: d["segments"][2].update(evidence=d["segments"][0]["evidence"]), "AUDIO_UNCITED"),
        (lambda d: d["segments"][2]["speech"].update(speaker_id="person_7"), "SPEAKER"),
        (lambda d: d["segments"][2].update(speech=None), "SPEAKER"),
        (lambda d: d["segments"][0].update(speech=d["segments"][2]["speech"]), "SPEECH_OUTSIDE"),
        (lambda d: d["segments"][0]["boundary"].update(start="ongoing"), "ONGOING_START"),
        (lambda d: d["segments"][0]["boundary"].update(end="ongoing"), "ONGOING_END"),
        (lambda d: d["segments"][1].update(segment_id="s001"), "DUPLICATE_SEGMENT"),
        (lambda d: d["initial_environment"].update(time_sec=21.0), "ENVIRONMENT_TIME"),
        (lambda d: d.update(visual_unavailable_intervals=[{"start_sec": 3.0, "end_sec": 3.0, "reason": "x"}]), "UNAVAILABLE_INTERVAL"),
        # segments are judged one after the other, each by its own rules in order
        (lambda d: (d["segments"][1].update(end_sec=21.0), d["segments"][0].update(actor_ids=["person_99"])), "UNKNOWN_ACTOR"),
        # a point is enough for evidence, and none is allowed
        (lambda d: d["segments"][0]["evidence"][0].update(end_sec=2.0), None),
        (lambda d: d["segments"][0].update(evidence=[]), None),
        (lambda d: d["segments"][0].update(end_sec=21.0), "SEGMENT_INTERVAL"),
        (lambda d: d.update(activity_chain=["s001", "s999"]), "ACTIVITY_CHAIN"),
        (lambda d: d["segments"].reverse(), "UNSORTED_SEGMENTS"),
        (lambda d: d["actors"].append(d["actors"][0]), "DUPLICATE_ACTOR"),
    ],
)
def test_annotation_contract(spark, change, code):
    assert _judge(spark, _mutated(change))[1] == code


@pytest.mark.parametrize(
    ("source", "modality", "code"),
    [("crop_3", "visual", None), ("crop_3", "ocr", "MODALITY"), ("ocr_1", "ocr", None), ("transcript_0", "transcript", None), ("audio_0", "audio", None), ("video_0", "ocr", "MODALITY"), ("other", "visual", "MODALITY")],
)
def test_what_sources_show(spark, source, modality, code):
    doc = _mutated(lambda d: d["segments"][0]["evidence"][0].update(source_id=source, modality=modality))
    assert _judge(spark, doc, ("video_0", "audio_0", "crop_3", "ocr_1", "transcript_0", "other"))[1] == code


def test_audio_checked_speech_needs_audio(spark):
    assert _judge(spark, _mutated(lambda d: d["segments"][2].update(evidence=[])), ("video_0",))[1] == "AUDIO_MISSING"


def test_normal_form_logs_its_changes(spark):
    def change(d):
        d["segments"].reverse()
        d["activity_chain"] = ["s002", "s001", "s005"]
        d["segments"][1]["boundary"]["end"] = "ongoing"

    d, error = _judge(spark, _mutated(change))
    assert error == "UNSORTED_SEGMENTS"
    out = C.normalised(d)
    row = out.first()
    assert [c.code for c in row.changes] == ["SORT_SEGMENTS", "SORT_ACTIVITY_CHAIN", "NONEDGE_ONGOING_TO_UNCERTAIN"] and row.activity_chain == ["s001", "s002", "s005"]
    assert row.changes[0].before == ["s005", "s004", "s003", "s002", "s001"] and row.changes[1].before == ["s002", "s001", "s005"]
    assert (row.changes[2].segment_id, row.changes[2].edge, row.changes[2].time_sec) == ("s004", "end", 9.0)
    fixed = [s for s in row.segments if s.boundary.end == "uncertain"]
    note = "Model marked end as ongoing at 9.0s, away from the clip edge; the boundary is uncertain and its timestamp was not changed."
    assert len(fixed) == 1 and fixed[0].uncertainties == [note] and (fixed[0].start_sec, fixed[0].end_sec) == (8.0, 9.0)
    sources = F.array(F.lit("video_0"), F.lit("audio_0"))
    assert C.annotation_errors(out.drop("changes"), F.col("duration_sec"), sources).first().error is None
    again = C.normalised(out.drop("changes")).first()
    assert again.changes == [] and again.segments == row.segments


def test_calls_resume_and_attrition(spark):
    req = spark.createDataFrame([("c1", 0, '{"a": 1}'), ("c2", 0, "not json"), ("c3", 0, '{"a": 3}')], "clip_id string, call_index int, request string")
    first = flows.call_stage(req, "audio", flows.offline).cache()
    assert {(r.clip_id, r.code, r.attempts) for r in first.collect()} == {("c1", None, 1), ("c2", "ROW_ERROR", 2), ("c3", None, 1)}
    assert [r.clip_id for r in flows.pending(req, first).collect()] == ["c2"]
    second = spark.createDataFrame([("c1", None), ("c3", "INVALID_OUTPUT")], "clip_id string, code string")
    done, failed = flows.attrition([("audio", first), ("annotation", second)])
    assert [r.clip_id for r in done.collect()] == ["c1"] and {tuple(r) for r in failed.collect()} == {("c2", "audio", "ROW_ERROR"), ("c3", "annotation", "INVALID_OUTPUT")}


def test_votes(spark):
    items = spark.createDataFrame([("c", 0, "cup", "cup", False), ("c", 1, "cup", "red cup", False), ("c", 0, "pen", "pen", False), ("c", 0, "key", "key", True), ("c", 1, "key", "a key", True)], "clip_id string, call_index int, label string, text string, uncertain boolean")
    got = {r.label: (r.text, r.votes, r.confidence) for r in flows.merged_votes(items, items.select("clip_id", "call_index")).collect()}
    assert got == {"cup": ("red cup", "2/2", "high"), "pen": ("pen", "1/2", "low"), "key": ("a key", "2/2", "low")}


def test_stage_machine_and_limit():
    m = folds.StageMachine()
    for e in ("submit", "job:RUNNING", "job:SUCCEEDED", "empty", "submit", "job:FAILED", "submit", "resume", "submit", "job:SUCCEEDED"):
        m.step(e)
    assert (m.stage, m.status, m.failures) == (3, "complete_with_errors", 1)
    limit, streak = 4, 0
    for _ in range(4):
        limit, streak = folds.limit_step(limit, streak, True, False, 8)
    assert (limit, streak) == (5, 0) and folds.limit_step(5, 3, False, True, 8) == (2, 0) and folds.limit_step(5, 3, False, False, 8) == (5, 3)


def test_streams(spark, tmp_path):
    rows = [(i, f"k{i % 2}", e) for i, e in enumerate(["submit", "submit", "job:SUCCEEDED", "job:FAILED", "submit", "resume"])]
    spark.createDataFrame(rows, "seq long, k string, event string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("seq long, k string, event string").parquet(str(tmp_path / "in"))
    q = folds.stage_stream(stream, "k", "event").writeStream.outputMode("update").format("memory").queryName("machines").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.k, r.stage, r.status) for r in spark.table("machines").collect()} == {("k0", 1, "submitting"), ("k1", 0, "ready")}
    q = folds.append_once(stream.selectExpr("cast(seq AS string) AS id", "event"), str(tmp_path / "out"), str(tmp_path / "cp"), "id", "event")
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    events = spark.createDataFrame([("a", "start", None, None), ("a", "failed", 10, 2), ("a", "start", None, None), ("a", "success", 20, 5)], "stage string, event string, input_tokens long, output_tokens long")
    assert tuple(folds.counters(events).first()) == ("a", 2, 1, 1, 30, 7, 0)


def test_attempts_responses_and_cuts(spark):
    a = spark.createDataFrame([("c1", 1, "ROW_ERROR", "x"), ("c1", 2, None, "y"), ("c1", 3, None, "z"), ("c2", 1, "ROW_ERROR", "x"), ("c2", 2, "ROW_ERROR", "y")], "clip_id string, attempt int, code string, response string")
    assert {(r.clip_id, r.attempt) for r in flows.first_success(a).collect()} == {("c1", 2), ("c2", 1)}
    d = spark.createDataFrame([('{"summary": "s", "utterances": []}',), (None,)], "response string")
    assert [r.doc and r.doc.summary for r in flows.parsed(d, "audio").collect()] == ["s", None]
    with pytest.raises(ValueError):
        flows.response_schema("none")
    cuts = flows.absolute_cuts(spark.createDataFrame([(40, 3), (50, None)], "start_frame long, cut_after_frame long"))
    assert [r.cut_frame for r in cuts.collect()] == [43, None]


def test_heartbeat_survives_a_failing_sink(spark):
    from lumentrace.streaming.heartbeat import Heartbeat

    seen = []

    def sink(event, fields):
        seen.append(event)
        raise OSError

    beat = Heartbeat(sink)
    spark.streams.addListener(beat)
    try:
        q = spark.readStream.format("rate").load().writeStream.format("noop").trigger(availableNow=True).start()
        q.awaitTermination(60)
        for _ in range(100):
            if "ended" in seen:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(beat)
    assert seen[0] == "started" and "ended" in seen and q.exception() is None


def test_submissions_are_reconciled():
    from lumentrace.streaming.folds import StageMachine

    def after(*events):
        m = StageMachine()
        for e, at in events:
            m.step(e, at)
        return m.status

    assert after(("submit", 10), ("reconcile:0", 3000)) == "submitting"
    assert after(("submit", 10), ("reconcile:0", 3610)) == "needs_attention"
    assert after(("submit", 10), ("reconcile:1", 9000)) == "running"
    assert after(("submit", 10), ("reconcile:2", 20)) == "needs_attention"
    assert after(("submit", 10), ("reconcile:2", 20), ("reconcile:1", 30)) == "running"
    assert after(("submit", 10), ("reconcile:0", 9000), ("reconcile:0", 9001)) == "needs_attention"


def test_calls_fall_back_to_slices(spark, tmp_path):
    def provider(stage, request):
        if "bad" in request:
            raise ValueError(request)
        return flows.offline(stage, request)

    n = [0]

    def keep(df):
        n[0] += 1
        df.write.parquet(str(tmp_path / str(n[0])))
        return spark.read.parquet(str(tmp_path / str(n[0])))

    ask = "clip_id string, call_index int, request string"
    requests = spark.createDataFrame([("a", 0, '{"x": 1}'), ("b", 0, '{"x": "bad"}'), ("c", 0, '{"x": "bad"}')], ask)
    slices = spark.createDataFrame([(c, i, '{"x": "%s"}' % ("bad" if c == "c" or i == 1 else "s")) for c in "abc" for i in (1, 2)], ask)
    captions, inferences, failures = flows.caption_flow(requests, slices, provider, keep)
    assert sorted((r.clip_id, r.call_index, r.sliced) for r in captions.collect()) == [("a", 0, False), ("b", 2, True)]
    assert sorted((r.clip_id, r.code) for r in inferences.collect()) == [("a", None), ("b", None)]
    assert [(r.clip_id, r.code) for r in failures.collect()] == [("c", "ROW_ERROR")]


def test_settings_within_bounds():
    assert C.checked_settings({"workers": 16, "fps": 0.5, "clip_seconds": 30}) == {"workers": 16, "fps": 0.5, "clip_seconds": 30}
    for bad in ({"workers": 0}, {"workers": True}, {"workers": 1.5}, {"fps": 0}, {"fps": float("nan")}, {"max_dim": 3000}, {"colour": 1}):
        with pytest.raises(ValueError):
            C.checked_settings(bad)


def test_lenient_items_that_are_no_objects(spark):
    d = spark.sql("""SELECT parse_json('{"a": ["x", 1, true, null, {"descriptor": 0, "id": [], "name": false, "note": 2.5}], "b": 3}') AS d""")
    got = d.select(C.lenient_layer(C.json_items(F.col("d"), "a"), "person").alias("l"), F.size(C.lenient_layer(C.json_items(F.col("d"), "b"), "person")).alias("n")).first()
    assert [tuple(r) for r in got.l] == [("", "x", "", ""), ("", "1", "", ""), ("", "True", "", ""), ("", "None", "", ""), ("", "", "", "2.5")] and got.n == 0


def test_sums_before_are_running_sums(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), i, rng.randint(0, 9)) for i in range(300)]
    got = {(r.g, r.i): r.s for r in W.sums_before(spark.createDataFrame(rows, "g string, i int, n int").repartition(5), ["g"], ["i"], "n", "s", parts=7).collect()}
    assert got == {(g, i): sum(m for h, j, m in rows if h == g and j < i) for g, i, _ in rows}


def test_ticker_speaks_between_batches(spark):
    import time

    from lumentrace.streaming.heartbeat import Ticker, streams

    seen, calls = [], []

    def sink(event, fields):
        seen.append((event, fields))
        raise OSError

    def status():
        calls.append(1)
        if len(calls) == 1:
            raise KeyError
        return streams(spark)()

    q = spark.readStream.format("rate").load().writeStream.format("noop").queryName("slow").trigger(processingTime="1 hour").start()
    try:
        with Ticker(sink, 0.05, status):
            for _ in range(200):
                if len(seen) > 3 and "slow" in seen[-1][1].get("streams", {}):
                    break
                time.sleep(0.05)
    finally:
        q.stop()
    n = len(seen)
    assert seen[0] == ("progress_unavailable", {"error_type": "KeyError"}) and "slow" in seen[-1][1]["streams"]
    time.sleep(0.2)
    assert len(seen) == n and q.exception() is None
