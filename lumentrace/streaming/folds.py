"""Sequential folds over ordered events: the stage machine of a batch, adaptive limits, live snapshots; in batch and as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STAGES = ("audio", "annotation", "review")
# Job states that end a job, and how.
GOOD, BAD = ("SUCCEEDED",), ("FAILED", "EXPIRED", "CANCELLED")
# Fixed value: seconds in which a submission may be unknown to the provider.
GRACE = 3600.0


class StageMachine:
    """ready, submitting, running, then the next stage or an end: complete, complete_with_errors, paused, needs_attention.

    step() takes one event and its time in seconds: submit, job:<STATE>, empty (nothing is eligible), pause, resume, lost (a submission
    without a job), or reconcile:<n>, the number of jobs found under a submission's name. One job is the submission's; none is
    nothing to worry about within GRACE of the submission; anything else needs attention."""

    def __init__(self, stage: int = 0, status: str = "ready", failures: int = 0, submitted: float = 0.0):
        self.stage, self.status, self.failures, self.submitted = stage, status, failures, submitted

    def _advance(self) -> None:
        self.stage += 1
        self.status = "ready" if self.stage < len(STAGES) else "complete_with_errors" if self.failures else "complete"

    @property
    def ended(self) -> bool:
        return self.status.startswith("complete")

    def step(self, event: str, at: float = 0.0) -> None:
        kind, _, state = event.partition(":")
        if self.ended:
            return
        if kind == "pause":
            self.status = "paused"
        elif kind == "resume" and self.status in ("paused", "needs_attention"):
            self.status = "ready"
        elif self.status == "ready" and kind == "submit":
            self.status, self.submitted = "submitting", at
        elif self.status == "ready" and kind == "empty":
            self._advance()
        elif self.status == "submitting" and kind == "job":
            self.status = "running"
            self.step(event, at)
        elif self.status in ("submitting", "needs_attention") and kind == "reconcile":
            if state == "1":
                self.status = "running"
            elif state != "0" or self.status != "submitting" or not 0 <= at - self.submitted < GRACE:
                self.status = "needs_attention"
        elif self.status == "submitting" and kind == "lost":
            self.status = "needs_attention"
        elif self.status == "running" and kind == "job":
            if state in GOOD:
                self._advance()
            elif state in BAD:
                self.failures += 1
                self.status = "needs_attention"


def stage_fold(events: DataFrame, key: str, order: list[str], event: str, seconds: str | None = None) -> DataFrame:
    """(key, stage, status, failures, steps) after all events of each key, in order. seconds: the column of their times, for reconciliation."""
    kept = [key, *order, event, *([seconds] if seconds and seconds not in order else [])]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = StageMachine()
        p = pdf.sort_values(order)
        for e, at in zip(p[event], p[seconds] if seconds else [0.0] * len(p), strict=True):
            m.step(e, float(at))
        return pd.DataFrame({key: [pdf[key].iloc[0]], "stage": [m.stage], "status": [m.status], "failures": [m.failures], "steps": [len(pdf)]})

    kind = events.schema[key].dataType.simpleString()
    return events.select(*kept).groupBy(key).applyInPandas(run, f"{key} {kind}, stage int, status string, failures long, steps long")


def stage_stream(events: DataFrame, key: str, event: str) -> DataFrame:
    """The same as a stream: a row for each key and micro-batch; events of a batch come in the order of the column seq."""

    def run(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        m = StageMachine(*state.get) if state.exists else StageMachine()
        rows = pd.concat(list(batches)).sort_values("seq")
        for e in rows[event]:
            m.step(e)
        state.update((m.stage, m.status, m.failures))
        yield pd.DataFrame({key: [keys[0]], "stage": [m.stage], "status": [m.status], "failures": [m.failures]})

    kind = events.schema[key].dataType.simpleString()
    return events.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, stage int, status string, failures long", "stage int, status string, failures long", "update", GroupStateTimeout.NoTimeout)


def limit_step(limit: int, streak: int, ok: bool, congested: bool, most: int, least: int = 1, patience: int = 4) -> tuple[int, int]:
    """Additive increase after max(patience, limit) successes in a row, halving on congestion; other failures change nothing."""
    if congested:
        return max(least, limit // 2), 0
    if not ok:
        return limit, streak
    if limit >= most:
        return limit, 0
    return (limit + 1, 0) if streak + 1 >= max(patience, limit) else (limit, streak + 1)


def limit_fold(events: DataFrame, key: str, order: list[str], ok: str, congested: str, start: int = 4, most: int = 64) -> DataFrame:
    """(key, limit, highest, backoffs) of the adaptive limit after all events of each key, in order."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        limit, streak, highest, backoffs = start, 0, start, 0
        p = pdf.sort_values(order)
        for good, bad in zip(p[ok], p[congested], strict=True):
            limit, streak = limit_step(limit, streak, bool(good), bool(bad), most)
            highest, backoffs = max(highest, limit), backoffs + bool(bad)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "limit": [limit], "highest": [highest], "backoffs": [backoffs]})

    kind = events.schema[key].dataType.simpleString()
    return events.select(key, *order, ok, congested).groupBy(key).applyInPandas(run, f"{key} {kind}, limit int, highest int, backoffs long")


def counters(events: DataFrame) -> DataFrame:
    """Started, succeeded and failed requests and their tokens by stage, for batch tables and streams (complete mode)."""
    e = F.col("event")
    return events.groupBy("stage").agg(
        F.count_if(e == "start").alias("started"), F.count_if(e == "success").alias("succeeded"), F.count_if(e == "failed").alias("failed"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
        F.count_if((e != "start") & F.col("input_tokens").isNull()).alias("responses_without_usage"),
    )


def append_once(df: DataFrame, path: str, checkpoint: str, key: str, content: str):
    """A stream into a write-once table: each micro-batch may be replayed without effect."""
    from lumentrace.sources.sinks import write_once

    return df.writeStream.foreachBatch(lambda batch, _: write_once(batch, path, key, content) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
