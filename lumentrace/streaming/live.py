"""What is under way: requests that run or wait and stages that run, from their events, as a table and as a stream with a state for each key.

Events have ts (timestamp), seq (long, orders events of one time), event, request_id, clip_id, phase and attempt. The stream keeps for each request
and stage when it began and when it was queued, ends them on their last event, and, while they are open, reports at event times `every` seconds apart how long they
have run or waited. State and timers live in the checkpoint: a stream that is stopped goes on where it was."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Events that queue, begin and end requests, and begin and end stages.
QUEUED, STARTED, ENDED = ("request_queued", "retry_scheduled"), ("request_start",), ("request_success", "request_failed")
STAGE_STARTED, STAGE_ENDED = ("stage_start",), ("stage_success", "stage_failed", "stage_reused", "clip_failed", "clip_completed", "clip_reused")

_TOLD = "kind string, id string, clip_id string, phase string, attempt int, running_us long, waiting_us long, at_us long, seq long, report string"
_STATE = "clip_id string, phase string, attempt int, running_us long, waiting_us long, last_us long, last_seq long"


def keyed(events: DataFrame) -> DataFrame:
    """events of requests and stages with kind and id; others, and those without an id, go."""
    request = F.col("event").isin(*QUEUED, *STARTED, *ENDED)
    stage = F.col("event").isin(*STAGE_STARTED, *STAGE_ENDED)
    kind = F.when(request, "request").when(stage, "stage")
    e = events.withColumns({"kind": kind, "id": F.when(request, F.col("request_id")).when(stage, F.col("clip_id"))})
    return e.where("kind IS NOT NULL AND id IS NOT NULL").select("kind", "id", "ts", "seq", "event", "clip_id", "phase", "attempt")


def open_work(events: DataFrame) -> DataFrame:
    """(kind, id, clip_id, phase, attempt, running_since, waiting_since): what the events leave running or waiting; one hash aggregation.

    A request runs if its last event that begins or ends it began it, and waits if nothing came behind its being queued."""
    at = F.struct("ts", "seq")
    began, waits = F.col("event").isin(*STARTED, *STAGE_STARTED), F.col("event").isin(*QUEUED)
    of = F.struct("event", "ts", "clip_id", "phase", "attempt")
    last = keyed(events).groupBy("kind", "id").agg(F.max_by(F.when(~waits, of), F.when(~waits, at)).alias("run"), F.max_by(of, at).alias("any"))
    running, waiting = F.col("run.event").isin(*STARTED, *STAGE_STARTED), F.col("any.event").isin(*QUEUED)
    out = last.where(F.coalesce(running, F.lit(False)) | waiting)
    named = [F.coalesce(F.when(running, F.col(f"run.{c}")), F.col(f"any.{c}")).alias(c) for c in ("clip_id", "phase", "attempt")]
    return out.select("kind", "id", *named, F.when(running, F.col("run.ts")).alias("running_since"), F.when(waiting, F.col("any.ts")).alias("waiting_since"))


class _Live(StatefulProcessor):
    """Plain rows and times in microseconds; a frame for each key would cost many times what its events do."""

    def __init__(self, every: float, remember: float):
        self.every, self.remember = int(every * 1000), int(remember * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", _STATE)

    def _row(self, key: tuple, s: tuple, at_us: int, report: str) -> Row:
        clip_id, phase, attempt, running, waiting, _, seq = s
        return Row(kind=key[0], id=key[1], clip_id=clip_id, phase=phase, attempt=attempt, running_us=running, waiting_us=waiting, at_us=at_us, seq=seq, report=report)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        events = sorted(((e["us"], e["seq"], e["event"], e["clip_id"], e["phase"], e["attempt"]) for e in rows), key=lambda e: e[:2])
        before = self.state.get()
        clip_id, phase, attempt, running, waiting, last, last_seq = before or (None,) * 7
        for us, seq, event, *named in events:
            if last is not None and (us, seq) <= (last, last_seq):
                continue  # late or a repetition: what came behind it has settled the matter
            last, last_seq = us, seq
            if event in QUEUED:
                waiting = us
            else:
                waiting = None
                running = us if event in STARTED or event in STAGE_STARTED else None
            if event in (*QUEUED, *STARTED, *STAGE_STARTED) and (running is None or running == us):
                clip_id, phase, attempt = named
        s = (clip_id, phase, attempt, running, waiting, last, last_seq)
        self.state.update(s)
        is_open = running is not None or waiting is not None
        # a key without a state has no timers
        if before is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
        # open ones report at their times; ended ones are remembered for a while, so that late events do not open them again
        self.handle.registerTimer(max(last // 1000, timerValues.getCurrentWatermarkInMs()) + (self.every if is_open else self.remember))
        yield self._row(key, s, last, "open" if is_open else "ended")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        s = self.state.get()
        if s is None or (s[3] is None and s[4] is None):
            self.state.clear()
            return
        now = expiredTimerInfo.getExpiryTimeInMs()
        # the next report lies behind the watermark, however far it has come
        self.handle.registerTimer(now + self.every * (1 + max(0, timerValues.getCurrentWatermarkInMs() - now) // self.every))
        yield self._row(key, s, now * 1000, "still open")


def watch(events: DataFrame, every: float = 60.0, remember: float = 3600.0, late: str = "10 seconds") -> DataFrame:
    """A stream of events to rows (kind, id, clip_id, phase, attempt, running_since, waiting_since, at, seq, report, running_sec, waiting_sec): for each micro-batch the keys that it touches, open or ended, and at event times `every` seconds apart those still open.

    Events that come late by more than the last event of their key change nothing; ended keys are forgotten after `remember` seconds of event time. The stream's state
    store is RocksDB, which this sets for the session."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    e = keyed(events).where("ts IS NOT NULL AND seq IS NOT NULL").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).withWatermark("ts", late)
    r = e.groupBy("kind", "id").transformWithState(_Live(every, remember), _TOLD, "Update", "EventTime")
    time, since = (lambda c: F.timestamp_micros(c)), (lambda c: (F.col("at_us") - F.col(c)) / 1e6)
    return r.select(
        "kind", "id", "clip_id", "phase", "attempt", time("running_us").alias("running_since"), time("waiting_us").alias("waiting_since"), time("at_us").alias("at"), "seq", "report",
        since("running_us").alias("running_sec"), since("waiting_us").alias("waiting_sec"),
    )


def record(rows: DataFrame, path: str, checkpoint: str):
    """A stream of watch() into a table of its rows, a folder for each micro-batch; a batch that is replayed replaces its own."""
    return rows.writeStream.outputMode("update").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str) -> DataFrame:
    """What is open by the last rows of each key in a recorded table."""
    last = spark.read.parquet(path).groupBy("kind", "id").agg(F.max_by(F.struct("clip_id", "phase", "attempt", "running_since", "waiting_since"), F.struct("batch", "at", "seq")).alias("r"))
    return last.where("r.running_since IS NOT NULL OR r.waiting_since IS NOT NULL").select("kind", "id", "r.*")
