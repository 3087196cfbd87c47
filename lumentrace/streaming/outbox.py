"""Effects outside of Spark, each done once: an intent with a name that follows from what is asked comes first, then the effect, then its outcome.

A batch that is replayed finds its intent. Whether the effect has happened is asked of the provider by the name: one match is the effect, none within
the grace may still appear, none beyond it and more than one need a person. Only the writer whose claim made the intent performs the effect, and it does so once: even
an error may hide an effect that was accepted."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumentrace.sources.claims import claim, names, taken

#: Seconds in which an accepted submission may be unknown to the provider.
GRACE = 3600.0


def submission_name(scope: str, stage: str, request_ids: Iterable[str], prefix: str = "batch") -> str:
    """The same for the same requests of a stage, in any order."""
    identity = json.dumps([scope, stage, sorted(request_ids)], separators=(",", ":"), ensure_ascii=True)
    return f"{prefix}-{stage}-{hashlib.sha256(identity.encode()).hexdigest()[:32]}"


class Outbox:
    """Submissions of a run below a folder: intents, outcomes and those that need attention, each a file that is claimed.

    create(name, rows) performs the effect for the requests of a submission and gives its job; find(name) gives the jobs that the provider knows by a name."""

    def __init__(self, spark: SparkSession, root: str, create: Callable[[str, DataFrame], str], find: Callable[[str], list[str]], clock: Callable[[], float] = time.time):
        self.spark, self.root = spark, root.rstrip("/")
        self.create, self.find, self.clock = create, find, clock

    def _outcome(self, name: str, job: str) -> str:
        claim(self.spark, f"{self.root}/outcomes/{name}", job)
        return "running"

    def submit(self, name: str, rows: DataFrame) -> str:
        """running, submitting (to be asked again), or needs_attention."""
        if claim(self.spark, f"{self.root}/intents/{name}", json.dumps({"name": name, "at": self.clock()})):
            try:
                job = self.create(name, rows)
            except Exception:  # the effect may have happened all the same; only a later look can tell
                return "submitting"
            return self._outcome(name, job)
        return self.reconcile(name)

    def reconcile(self, name: str) -> str:
        """What has become of an intent: a no-op where its outcome is known."""
        if taken(self.spark, f"{self.root}/outcomes/{name}") is not None:
            return "running"
        intent = taken(self.spark, f"{self.root}/intents/{name}")
        if intent is None:
            return "ready"
        jobs = self.find(name)
        if len(jobs) == 1:
            return self._outcome(name, jobs[0])
        if not jobs and 0 <= self.clock() - json.loads(intent)["at"] < GRACE:
            return "submitting"
        return "needs_attention"

    def jobs(self) -> dict[str, str]:
        """Jobs by the name of their submission."""
        return {n: taken(self.spark, f"{self.root}/outcomes/{n}") for n in names(self.spark, f"{self.root}/outcomes") if not n.endswith(".crc")}

    def open(self) -> list[str]:
        """Names of intents without an outcome."""
        return sorted({n for n in names(self.spark, f"{self.root}/intents")} - set(self.jobs()))


def submissions(requests: DataFrame, scope: str, stage: str, most: int) -> DataFrame:
    """requests (request_id, ...) with submission: requests are dealt to submissions of about `most` by their id, the same whenever they come; the name follows from the ids.

    Ids go through one aggregate a submission, whose size `most` bounds."""
    n = F.lit(max(1, -(-requests.count() // most)))
    dealt = requests.withColumn("_part", F.pmod(F.xxhash64("request_id"), n))
    identity = F.concat(F.lit(f'["{scope}","{stage}",["'), F.array_join(F.array_sort(F.collect_set("request_id")), '","'), F.lit('"]]'))
    name = dealt.groupBy("_part").agg(F.concat(F.lit(f"batch-{stage}-"), F.substring(F.sha2(identity, 256), 1, 32)).alias("submission"))
    return dealt.join(name, "_part").drop("_part")


def submit_stream(requests: DataFrame, outbox: Outbox, checkpoint: str, scope: str, stage: str, most: int = 200_000):
    """A stream of requests into an outbox: each micro-batch becomes submissions of at most about `most` requests; a replayed one finds its own.

    An error of a submission does not end the stream; outbox.reconcile() of what is open settles it later."""

    def batch(df: DataFrame, _: int) -> None:
        dealt = submissions(df, scope, stage, most).persist()
        try:
            for r in dealt.select("submission").distinct().orderBy("submission").toLocalIterator():
                outbox.submit(r["submission"], dealt.where(F.col("submission") == r["submission"]).drop("submission"))
        finally:
            dealt.unpersist()

    return requests.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
