"""The live snapshot as a stream with restarts against the table of all events and a plain loop."""

import datetime as dt
import random

from lumentrace.streaming import live

SCHEMA = "ts timestamp, seq long, event string, request_id string, clip_id string, phase string, attempt int"
START = dt.datetime(2024, 1, 1)


def log(seed, n=400):
    """Events of requests and stages that begin, wait, fail, are tried again and end, some not at all."""
    rng, out = random.Random(seed), []
    for i in range(n):
        kind = rng.choice([*live.QUEUED, *live.STARTED * 3, *live.ENDED * 2, *live.STAGE_STARTED * 2, *live.STAGE_ENDED, "progress"])
        r, c = f"r{rng.randrange(25)}", f"c{rng.randrange(12)}"
        own = not kind.startswith(("stage", "clip"))
        out.append((START + dt.timedelta(seconds=i // 2), i, kind, r if own and rng.random() < 0.98 else None, c, rng.choice(["audio", "review"]), rng.randrange(1, 4)))
    return out


def loop(events):
    """{(kind, id): (clip_id, phase, attempt, running since, waiting since)}"""
    running, waiting = {}, {}
    for ts, _, e, r, c, phase, attempt in sorted(events, key=lambda x: x[:2]):
        k = ("stage", c) if e.startswith(("stage", "clip")) else ("request", r)
        if k[1] is None:
            continue
        if e in live.QUEUED:
            waiting[k] = (c, phase, attempt, ts)
        elif e in (*live.STARTED, *live.STAGE_STARTED):
            waiting.pop(k, None)
            running[k] = (c, phase, attempt, ts)
        elif e in (*live.ENDED, *live.STAGE_ENDED):
            running.pop(k, None)
            waiting.pop(k, None)
    both = running.keys() | waiting.keys()
    return {k: (*(running.get(k) or waiting[k])[:3], running.get(k, (None,) * 4)[3], waiting.get(k, (None,) * 4)[3]) for k in both}


def rows(df):
    return {(r.kind, r.id): (r.clip_id, r.phase, r.attempt, r.running_since, r.waiting_since) for r in df.collect()}


def test_open_work(spark):
    events = log(1)
    got = rows(live.open_work(spark.createDataFrame(events, SCHEMA).repartition(5)))
    assert got == loop(events) and len(got) > 10
    assert any(v[3] and v[4] for v in got.values()) and live.open_work(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stream_with_restarts(spark, tmp_path):
    events = log(2)
    path, table, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for at, size in ((0, 150), (150, 30), (180, 220)):
        # two files at a time, the last ones shuffled within a micro-batch
        for half in (0, 1):
            part = events[at + half * size // 2 : at + (half + 1) * size // 2]
            random.Random(half).shuffle(part)
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
        q = live.record(live.watch(stream, every=20, remember=1e6), table, checkpoint)
        q.awaitTermination(180)
        assert q.exception() is None
        assert rows(live.current(spark, table)) == loop(events[: at + size])
    told = spark.read.parquet(table).where("report = 'still open'").collect()
    assert told and all((r.running_sec or 0) >= 20 or (r.waiting_sec or 0) >= 20 for r in told)
    # a report says how long its request has run by then
    r = next(r for r in told if r.running_since)
    assert r.running_sec == (r.at - r.running_since).total_seconds()


def test_late_events_do_not_open_what_has_ended(spark, tmp_path):
    at = lambda s: START + dt.timedelta(seconds=s)
    parts = [[(at(5), 5, "request_start", "r", "c", "audio", 1), (at(9), 9, "request_success", "r", "c", "audio", 1)], [(at(7), 7, "request_start", "r", "c", "audio", 2), (at(8), 8, "stage_start", None, "c", "audio", None)]]
    path, table = str(tmp_path / "in"), str(tmp_path / "out")
    for p in parts:
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        q = live.record(live.watch(spark.readStream.schema(SCHEMA).parquet(path)), table, str(tmp_path / "cp"))
        q.awaitTermination(180)
        assert q.exception() is None
    assert rows(live.current(spark, table)) == {("stage", "c"): ("c", "audio", None, at(8), None)}


def test_a_new_key_asks_its_state_once():
    """Plain rows in any order; a key that has no state yet has no timers to look for."""
    calls = []

    class Handle:
        def __getattr__(self, name):
            return lambda *a: calls.append(name) or {"getValueState": self}.get(name)

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0

    p = live._Live(60, 60)
    p.init(Handle())
    rows = [{"us": u, "seq": u, "event": e, "clip_id": "c", "phase": "audio", "attempt": 1} for u, e in ((9, "request_start"), (5, "request_queued"))]
    (r,) = p.handleInputRows(("request", "r"), iter(rows), Times())
    assert (r["running_us"], r["waiting_us"], r["at_us"], r["report"]) == (9, None, 9, "open")
    assert calls == ["getValueState", "get", "update", "registerTimer"]
