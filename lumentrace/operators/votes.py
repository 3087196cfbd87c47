"""Flows of several model runs: votes over objects with an arbitration run, and a second look at objects that no entry holds.

Calls are made through call_stage; keep writes a table of results and reads it back, as calls must not be made again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentrace.functions.scalars import json_object, vote_bucket
from lumentrace.operators import flows
from lumentrace.operators.flows import Provider, arbitration, audited_objects, call_stage

Keep = Callable[[DataFrame], DataFrame]


def entries(results: DataFrame) -> DataFrame:
    """(clip_id, call_index, label, text, kind, interacted, uncertain): the entries that sound results list under "lexicon"; those without a label go."""
    field = "array<struct<label:string,text:string,type:string,interacted_with:boolean,uncertain:boolean>>"
    doc = F.from_json(json_object(F.col("response")), f"lexicon {field}")
    x = results.where("code IS NULL").select("clip_id", "call_index", F.explode(doc["lexicon"]).alias("e"))
    flag = lambda n, to: F.coalesce(F.col(f"e.{n}"), F.lit(False)).alias(to)
    return x.where("trim(e.label) <> ''").select("clip_id", "call_index", "e.label", F.coalesce("e.text", F.lit("")).alias("text"), F.coalesce("e.type", F.lit("object")).alias("kind"), flag("interacted_with", "interacted"), flag("uncertain", "uncertain"))


def _merged(items: DataFrame, runs: DataFrame) -> DataFrame:
    votes = flows.merged_votes(items, runs)
    kinds = items.groupBy("clip_id", "label").agg(F.max_by("kind", F.struct(F.length("kind"), "kind")).alias("kind"), F.bool_or("interacted").alias("interacted"))
    return votes.join(kinds, ["clip_id", "label"])


def vote_flow(clips: DataFrame, k: int, provider: Provider, keep: Keep) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged, recovery, failures) of k runs of each clip (clip_id, request).

    A clip of which a run has no sound result is a failure. Its runs are merged by label; where an object that is interacted with lacks the votes of all, one more run is made, and all k + 1 are merged anew, so that
    its votes count of k + 1. An arbitration that fails leaves the merge as it was. merged: (clip_id, label, text, votes, confidence, kind, interacted); recovery: ok or arbitrated."""
    requests = clips.select("clip_id", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("call_index"), "request")
    results = keep(call_stage(requests, "perception", provider))
    bad = results.where("code IS NOT NULL").groupBy("clip_id").agg(F.min("call_index").alias("call_index"), F.min_by("code", "call_index").alias("code"))
    sound = results.join(bad.select("clip_id"), "clip_id", "left_anti")
    runs = sound.select("clip_id", "call_index")
    items = entries(sound)
    first = keep(_merged(items, runs))
    open_ = arbitration(first).where("arbitrate").select("clip_id")
    again = keep(call_stage(clips.join(open_, "clip_id", "left_semi").select("clip_id", F.lit(k + 1).alias("call_index"), "request"), "arbitration", provider)).where("code IS NULL")
    settled = again.select("clip_id")
    more = runs.join(settled, "clip_id", "left_semi").unionAll(again.select("clip_id", "call_index"))
    second = _merged(items.join(settled, "clip_id", "left_semi").unionAll(entries(again)), more)
    merged = first.join(settled, "clip_id", "left_anti").unionAll(second.select(*first.columns))
    recovery = runs.select("clip_id").distinct().join(settled.withColumn("_s", F.lit(True)), "clip_id", "left").select("clip_id", F.when(F.col("_s"), "arbitrated").otherwise("ok").alias("recovery"))
    return merged, recovery, bad


def audit_flow(objects: DataFrame, labels: DataFrame, provider: Provider, keep: Keep) -> DataFrame:
    """(object, label, bucket) of objects against entries (label, pos, votes): by containment first; what is left is asked of a model, with one request an object.

    An answer {"label": ...} that names an entry, case and white space at its ends aside, puts the object into its bucket as recovered_...; null, no such entry, or no sound answer leave it as missed."""
    first = keep(audited_objects(objects, labels))
    left = first.where("bucket = 'left'").select(F.col("object").alias("clip_id"), F.lit(0).alias("call_index"), F.to_json(F.struct("object")).alias("request"))
    answers = keep(call_stage(left, "audit", provider))
    norm = lambda c: F.lower(F.trim(c))
    said = answers.where("code IS NULL").select(F.col("clip_id").alias("object"), norm(F.from_json(json_object(F.col("response")), "label STRING")["label"]).alias("_l"))
    known = labels.where("label <> ''").groupBy(norm(F.col("label")).alias("_l")).agg(F.min_by(F.struct("label", "votes"), "pos").alias("e"))
    found = said.join(known, "_l").select("object", F.col("e.label").alias("_label"), F.when(F.col("e.votes") == "new", "recovered_new").otherwise(F.concat(F.lit("recovered_"), vote_bucket(F.col("e.votes")))).alias("_bucket"))
    out = first.join(found, "object", "left")
    return out.select("object", F.coalesce("_label", "label").alias("label"), F.coalesce("_bucket", F.when(F.col("bucket") == "left", "missed").otherwise(F.col("bucket"))).alias("bucket"))
