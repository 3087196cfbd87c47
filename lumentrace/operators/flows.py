"""Model stages over clip tables: a replaceable provider, failure codes, attrition, votes, resumption from staged results."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentrace.functions.salvage import strict_object
from lumentrace.operators.contracts import ANNOTATION

#: A provider takes (stage, request text) and gives the response text and its input and output tokens; errors are raised.
Provider = Callable[[str, str], tuple[str, int, int]]
RESULT = "clip_id string, stage string, call_index int, code string, response string, input_tokens long, output_tokens long, attempts int"


# The fields of each stage's response, as DDL.
RESPONSES = {
    "audio": "summary STRING, utterances ARRAY<STRUCT<start_sec DOUBLE, end_sec DOUBLE, speaker_id STRING, source STRING, text STRING, intelligibility STRING>>, sound_events ARRAY<STRUCT<start_sec DOUBLE, end_sec DOUBLE, description STRING, source STRING>>, uncertainties ARRAY<STRING>",
    "annotation": ANNOTATION,
    "review": "findings ARRAY<STRUCT<source_id STRING, time_sec DOUBLE, observation STRING, readable_text ARRAY<STRING>, limitations ARRAY<STRING>>>, scene_summary_replacement STRING, resegmentation_requests ARRAY<STRUCT<segment_ids ARRAY<STRING>, source_id STRING, reason STRING>>",
}


def response_schema(stage: str) -> str:
    if stage not in RESPONSES:
        raise ValueError(f"no stage {stage}")
    return RESPONSES[stage]


def parsed(results: DataFrame, stage: str) -> DataFrame:
    """results with doc, the response in the stage's schema; null where it has none."""
    return results.withColumn("doc", F.from_json("response", response_schema(stage)))


#: A response row as a provider's batch returns it.
RESPONSE_ROW = """status STRING, response STRUCT<candidates ARRAY<STRUCT<finishReason STRING, content STRUCT<parts ARRAY<STRUCT<text STRING, thought BOOLEAN>>>>>,
  usageMetadata STRUCT<promptTokenCount LONG, candidatesTokenCount LONG, thoughtsTokenCount LONG, cachedContentTokenCount LONG, totalTokenCount LONG>>"""
# The names of the usage figures, and those of the provider.
USAGE = {"input_tokens": "promptTokenCount", "output_tokens": "candidatesTokenCount", "thought_tokens": "thoughtsTokenCount", "cached_tokens": "cachedContentTokenCount", "total_tokens": "totalTokenCount"}


def read_responses(rows: DataFrame, row: str) -> DataFrame:
    """rows with code (null, ROW_ERROR or INVALID_OUTPUT), data (the JSON object's text) and usage of a JSON response row.

    A status other than none, empty or code 0 is an error of the row; the first candidate must have stopped by itself, and its parts,
    thoughts left out, must make up one JSON object."""
    r = F.from_json(row, RESPONSE_ROW)
    x = rows.withColumn("_r", r)
    status = F.col("_r.status")
    fine = status.isNull() | status.isin("", "{}") | (F.get_json_object(status, "$.code") == "0")
    first = F.get(F.col("_r.response.candidates"), F.lit(0))
    spoken = F.filter(first["content"]["parts"], lambda p: p["text"].isNotNull() & ~F.coalesce(p["thought"], F.lit(False)))
    x = x.withColumn("_t", F.array_join(F.transform(spoken, lambda p: p["text"]), "")).withColumn("_d", F.when(first["finishReason"] == "STOP", plain_object(F.col("_t"))))
    code = F.when(~F.coalesce(fine, F.lit(False)), "ROW_ERROR").when(F.col("_d").isNull(), "INVALID_OUTPUT")
    usage = F.struct(*(F.col(f"_r.response.usageMetadata.{of}").alias(name) for name, of in USAGE.items()))
    return x.withColumn("code", code).withColumn("data", F.when(F.col("code").isNull(), F.col("_d"))).withColumn("usage", F.when(F.col("code").isNull(), usage)).drop("_r", "_t", "_d")


def plain_object(text):
    """text where it is one JSON object and nothing else, null otherwise."""
    bare = F.trim(text)
    return F.when(bare.startswith("{") & bare.endswith("}") & F.try_parse_json(bare).isNotNull(), bare)


def matches_mode(best_of_n: int, thinking: str, run_infer: bool = True):
    """Whether an earlier final record (best_of_n, thinking, critic, inference_status) stands for a clip in this mode: one candidate takes any record, several need the same mode, a critic, and the inference that the mode asks for."""
    if best_of_n <= 1:
        return F.lit(True)
    same = (F.col("best_of_n") == best_of_n) & (F.col("thinking") == thinking) & F.col("critic").isNotNull()
    return F.coalesce(same & (F.col("inference_status") == ("ok" if run_infer else "skipped")), F.lit(False))


def to_do(clips: DataFrame, records: DataFrame, seq: str, best_of_n: int, thinking: str, run_infer: bool = True) -> DataFrame:
    """Clips whose last record (by seq) is none, or does not match the mode."""
    rest = [c for c in records.columns if c not in ("clip_id", seq)]
    last = records.groupBy("clip_id").agg(F.max_by(F.struct(*rest), seq).alias("r")).select("clip_id", "r.*")
    return clips.join(last.where(matches_mode(best_of_n, thinking, run_infer)), "clip_id", "left_anti")


def compatible(recording: str, model: str, pipeline: str, service_tier: str | None = None):
    """Whether a saved clip (of_clip, clip_id, recording, model, pipeline, service_tier, ok, parsed) may stand for its clip: eight conditions, all of which hold."""
    same = (F.col("clip_id") == F.col("of_clip")) & (F.col("recording") == recording) & (F.col("model") == model) & (F.col("pipeline") == pipeline)
    tier = F.lit(True) if service_tier is None else F.col("service_tier") == service_tier
    return F.coalesce(same & tier & F.col("ok") & F.coalesce(F.schema_of_variant(F.try_parse_json("parsed")).startswith("OBJECT"), F.lit(False)), F.lit(False))


def collected(eligible: DataFrame, scheduled: DataFrame, responses: DataFrame, stage: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sound, failures, unmatched) of a stage's batch: eligible (clip_id, ...), scheduled (clip_id), responses (clip_id, row).

    Responses are matched by clip, in any order. Each eligible clip has one outcome: UNSCHEDULED_ROW, DUPLICATE_RESPONSE, MISSING_RESPONSE,
    ROW_ERROR, INVALID_OUTPUT, or its data and usage. Responses nobody asked for are one failure with their count. Responses are
    reduced to one row a clip before they are joined, so that no clip with very many of them gathers in a task."""
    own = responses.groupBy("clip_id").agg(F.count("*").alias("_n"), F.min("row").alias("_row"))
    x = eligible.join(scheduled.select("clip_id", F.lit(True).alias("_s")), "clip_id", "left").join(own, "clip_id", "left")
    x = read_responses(x, "_row")
    early = F.when(F.col("_s").isNull(), "UNSCHEDULED_ROW").when(F.col("_n") > 1, "DUPLICATE_RESPONSE").when(F.col("_n").isNull(), "MISSING_RESPONSE")
    x = x.withColumn("code", F.coalesce(early, F.col("code"))).drop("_s", "_n", "_row")
    failures = x.where("code IS NOT NULL").select("clip_id", F.lit(stage).alias("stage"), "code")
    unknown = responses.join(scheduled.select("clip_id"), "clip_id", "left_anti").agg(F.count("*").alias("n")).where("n > 0").select(F.lit(stage).alias("stage"), F.lit("UNMATCHED_RESPONSE").alias("code"), "n")
    return x.where("code IS NULL").drop("code"), failures, unknown


def arbitration(votes: DataFrame) -> DataFrame:
    """(clip_id, arbitrate): whether any object that is interacted with lacks the votes of all runs. votes: clip_id, kind, interacted, votes as n/k."""
    short = F.split("votes", "/")
    open_ = F.col("interacted") & (F.col("kind") == "object") & ~F.coalesce(F.get(short, F.lit(0)) == F.get(short, F.lit(1)), F.lit(False))
    return votes.groupBy("clip_id").agg(F.bool_or(F.coalesce(open_, F.lit(False))).alias("arbitrate"))


def critic_choice(candidates: DataFrame, verdicts: DataFrame, refined: DataFrame, second: DataFrame) -> DataFrame:
    """(clip_id, source, call_index, critic) of a flow of several candidates.

    candidates (clip_id, call_index): the sound ones. verdicts (clip_id, best_index, needs_regeneration): the critic's, best_index a
    place among the candidates in the order of their index, brought into range. refined (clip_id, call_index): regenerated ones, used
    where the verdict asks for them. second (clip_id, best_index): of the critic over the best and the refined ones; 0 is the best so far.
    No candidate: no row. One: kept without a critic. No verdict: the first is kept."""
    pool = candidates.groupBy("clip_id").agg(F.sort_array(F.collect_list("call_index")).alias("p"))
    more = refined.groupBy("clip_id").agg(F.sort_array(F.collect_list("call_index")).alias("q"))
    x = pool.join(verdicts, "clip_id", "left").join(more, "clip_id", "left").join(second.select("clip_id", F.col("best_index").alias("again")), "clip_id", "left")
    n = F.size("p")
    place = F.greatest(F.lit(0), F.least(F.col("best_index"), n - 1))
    first = F.when((n == 1) | F.col("best_index").isNull(), F.get("p", F.lit(0))).otherwise(F.get("p", place))
    to = F.when((n > 1) & F.col("needs_regeneration") & F.col("q").isNotNull(), F.greatest(F.lit(0), F.least(F.col("again"), F.size("q"))))
    critic = F.when(n == 1, "single_valid").when(F.col("best_index").isNull(), "critic_failed").when(to.isNotNull(), "refined").otherwise("chosen")
    return x.select("clip_id", F.when(to > 0, "refine").otherwise("generate").alias("source"), F.when(to > 0, F.get("q", to - 1)).otherwise(first).alias("call_index"), critic.alias("critic"))


def two_pass(first: DataFrame, second: DataFrame) -> DataFrame:
    """(clip_id, segments, done) of two passes. first (clip_id, ok, n_crops, segments), second (clip_id, ok, revised): arrays of (time_range, text, detail).

    A clip is done with a sound first pass and, where it has crops, a sound second one. Revised segments replace those of the same
    time_range, white space aside, the last of several; without one the revised segment at the same place. Empty fields change nothing."""
    x = first.alias("a").join(second.select("clip_id", F.col("ok").alias("_ok2"), "revised"), "clip_id", "left")
    key = lambda s: F.regexp_replace(F.coalesce(s["time_range"], F.lit("")), r"\s", "")
    put = lambda new, old: F.coalesce(F.nullif(new, F.lit("")), old)

    def revise(s, i):
        same = F.filter("revised", lambda r: (key(r) == key(s)) & (key(r) != ""))
        r = F.coalesce(F.try_element_at(same, F.lit(-1)), F.get(F.col("revised"), i))
        return F.struct(*(put(r[f], s[f]).alias(f) for f in ("time_range", "text", "detail")))

    use = F.col("_ok2") & (F.size("revised") > 0)
    segments = F.when(F.coalesce(use, F.lit(False)), F.transform("segments", revise)).otherwise(F.col("segments"))
    done = F.col("ok") & ((F.col("n_crops") == 0) | F.coalesce("_ok2", F.lit(False)))
    return x.select("clip_id", segments.alias("segments"), F.coalesce(done, F.lit(False)).alias("done"))


# Fixed value: what ends screen texts that were cut, and where.
OCR_LIMIT, OCR_CUT = 30_000, "\n... (OCR truncated)"


def context_block(head, speech, transcript, screen_texts, use_transcript: bool, use_ocr: bool):
    """Sections of a request's context, an empty line apart: head; speech where there is any, else the transcript if used; screen texts if used, cut at a limit; a note where neither is used. screen_texts: an array of texts."""
    spoken = F.when(F.coalesce(speech, F.lit("")) != "", F.concat(F.lit("## Speech\n"), speech))
    if use_transcript:
        spoken = spoken.otherwise(F.concat(F.lit("## Audio transcript\n"), F.coalesce(transcript, F.lit(""))))
    seen = F.array_join(screen_texts, "\n")
    seen = F.when(F.coalesce(F.size(screen_texts), F.lit(0)) <= 0, "(no text detected)").when(F.length(seen) > OCR_LIMIT, F.concat(F.substring(seen, 1, OCR_LIMIT), F.lit(OCR_CUT))).otherwise(seen)
    parts = [head, spoken]
    if use_ocr:
        parts.append(F.concat(F.lit("## Screen text\n"), seen))
    if not use_transcript and not use_ocr:
        parts.append(F.lit("## Frames only"))
    return F.array_join(F.array_compact(F.array(*parts)), "\n\n")


def request_text(marker: str, request_id, context):
    """The first part of a request: the marker and id by which its response is known, and the context, a struct whose order of fields is kept."""
    return F.concat(F.lit(marker), request_id, F.lit("\n"), F.to_json(context, {"ignoreNullFields": "false"}))


def stage_prompt(base, note, regions, exocentric_note, max_regions, review, exocentric):
    """The prompt of a stage: base and note, then where a review follows the regions' text with its number filled in, then the note for cameras on a stand."""
    filled = F.concat(F.lit("\n"), F.replace(regions, F.lit("MAX_REVIEW_REGIONS"), max_regions.cast("string")))
    return F.concat(base, note, F.when(review, filled).otherwise(""), F.when(exocentric, exocentric_note).otherwise(""))


def first_success(attempts: DataFrame) -> DataFrame:
    """Of the attempts (clip_id, attempt, code, ...) of each clip the first sound one, or its first where none was, as with audio left out after failures."""
    from lumentrace.operators.windows import keep_best

    return keep_best(attempts.withColumn("_ok", F.col("code").isNull()), ["clip_id"], "_ok", "attempt").drop("_ok")


def absolute_cuts(scenes: DataFrame) -> DataFrame:
    """scenes (start_frame, cut_after_frame in the block) with cut_frame in the recording; null without a cut."""
    return scenes.withColumn("cut_frame", F.col("start_frame") + F.col("cut_after_frame"))


def offline(stage: str, request: str) -> tuple[str, int, int]:
    """A provider for tests: echoes the request's fields under "echo"."""
    return json.dumps({"stage": stage, "echo": json.loads(request)}), len(request), 7


def call_stage(requests: DataFrame, stage: str, provider: Provider, tries: int = 2) -> DataFrame:
    """Results of one call for each request (clip_id, call_index, request): code is null, ROW_ERROR, or INVALID_OUTPUT where the response is no JSON object.

    Keep the results in a staged table: a task that runs again calls again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for clip, index, request in zip(b["clip_id"], b["call_index"], b["request"], strict=True):
                code, text, tin, tout, n = "ROW_ERROR", None, 0, 0, 0
                for n in range(1, tries + 1):
                    try:
                        text, tin, tout = provider(stage, request)
                    except Exception:  # a provider may raise anything; the row carries the failure
                        continue
                    code = None if strict_object(text) is not None else "INVALID_OUTPUT"
                    if code is None:
                        break
                rows.append((clip, stage, index, code, text, tin, tout, n))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return requests.select("clip_id", "call_index", "request").mapInPandas(run, RESULT)


def pending(requests: DataFrame, done: DataFrame | None) -> DataFrame:
    """Requests without a sound result in the log of earlier runs; the last result of a clip and call counts."""
    if done is None:
        return requests
    good = done.where("code IS NULL").select("clip_id", "call_index").distinct()
    return requests.join(good, ["clip_id", "call_index"], "left_anti")


def attrition(stages: list[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(completed, failures) of stage results in order: a clip is out with its first failure."""
    failures, left = None, None
    for name, results in stages:
        own = results if left is None else results.join(left, "clip_id", "left_semi")
        bad = own.where("code IS NOT NULL").select("clip_id", F.lit(name).alias("stage"), "code")
        left = own.where("code IS NULL").select("clip_id")
        failures = bad if failures is None else failures.unionAll(bad)
    return left, failures


def chain(turns: list[tuple[str, DataFrame, bool]]) -> DataFrame:
    """(clip_id, one struct column for each turn): turns that are needed end a clip where they failed, others are null."""
    out = None
    for name, results, needed in turns:
        r = results.where("code IS NULL").select("clip_id", F.struct("response", "input_tokens", "output_tokens").alias(name))
        out = r if out is None else out.join(r, "clip_id", "inner" if needed else "left")
    return out


def best(candidates: DataFrame) -> DataFrame:
    """The candidate of each clip with the largest total, of equal ones the first. candidates: clip_id, call_index, total, ..."""
    rest = [c for c in candidates.columns if c != "clip_id"]
    return candidates.groupBy("clip_id").agg(F.max_by(F.struct(*rest), F.struct("total", -F.col("call_index"))).alias("r")).select("clip_id", *(F.col(f"r.{c}").alias(c) for c in rest))


def merged_votes(items: DataFrame, runs: DataFrame) -> DataFrame:
    """(clip_id, label, text, votes, confidence) of items (clip_id, call_index, label, text, uncertain) of several runs: the longest wording, the votes as n/k.

    high: all runs and none uncertain; medium: all runs otherwise, or more than one; low: one run, or all uncertain."""
    k = runs.groupBy("clip_id").agg(F.count_distinct("call_index").alias("k"))
    g = items.groupBy("clip_id", "label").agg(
        F.count_distinct("call_index").alias("n"), F.max_by("text", F.struct(F.length("text"), "text")).alias("text"), F.count_if("uncertain").alias("u"), F.count("*").alias("m")
    )
    conf = F.when((F.col("n") <= 1) & (F.col("k") > 1) | (F.col("u") == F.col("m")), "low").when((F.col("n") >= F.col("k")) & (F.col("u") == 0), "high").otherwise("medium")
    return g.join(k, "clip_id").select("clip_id", "label", "text", F.concat_ws("/", F.col("n").cast("string"), F.col("k").cast("string")).alias("votes"), conf.alias("confidence"))


def recording_rollup(clips: DataFrame, digits: int = 4) -> DataFrame:
    """(recording, clips, ok, first_clip, last_clip, tokens, usd) of clips (recording, clip_id, start, ok, input_tokens, output_tokens, deferred)."""
    from lumentrace.functions.scalars import cost

    usd = cost(F.sum("input_tokens"), F.sum("output_tokens"), F.first("deferred"), digits)
    return clips.groupBy("recording").agg(
        F.count("*").alias("clips"), F.count_if("ok").alias("ok"), F.min_by("clip_id", "start").alias("first_clip"), F.max_by("clip_id", "start").alias("last_clip"),
        (F.sum("input_tokens") + F.sum("output_tokens")).alias("tokens"), usd.alias("usd"),
    )


def grouped_objects(items: DataFrame, synonyms: DataFrame, runs: DataFrame) -> DataFrame:
    """(clip_id, label, start, end, votes, confidence, attributes) of objects that several runs have seen.

    items: clip_id, call_index, label, start, end, uncertain, attribute. synonyms: label, kind (labels of a kind are synonyms or hyponyms), specific (the larger, the more
    specific). Items of a clip are one object if their labels are of a kind and their times overlap, also through others; an object has the most specific label and all
    attributes. high: all runs, none uncertain, one label; low: one run of several, or all uncertain; else medium. runs: (clip_id, call_index)."""
    from pyspark.sql import Window

    k = runs.groupBy("clip_id").agg(F.count_distinct("call_index").alias("k"))
    x = items.join(synonyms, "label", "left").withColumn("kind", F.coalesce("kind", "label")).withColumn("specific", F.coalesce("specific", F.lit(0)))
    order = Window.partitionBy("clip_id", "kind").orderBy("start", "end", "call_index", "label")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("_new", F.coalesce((F.col("start") >= reach).cast("long"), F.lit(1).cast("long"))).withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    g = x.groupBy("clip_id", "kind", "_group").agg(
        F.max_by("label", F.struct("specific", F.length("label"), "label")).alias("label"), F.min("start").alias("start"), F.max("end").alias("end"), F.count_distinct("call_index").alias("n"),
        F.count_if("uncertain").alias("u"), F.count("*").alias("m"), F.count_distinct("label").alias("labels"), F.sort_array(F.collect_set("attribute")).alias("attributes"),
    )
    g = g.join(k, "clip_id")
    low = ((F.col("n") <= 1) & (F.col("k") > 1)) | (F.col("u") == F.col("m"))
    conf = F.when(low, "low").when((F.col("n") >= F.col("k")) & (F.col("u") == 0) & (F.col("labels") == 1), "high").otherwise("medium")
    return g.select("clip_id", "label", "start", "end", F.concat_ws("/", F.col("n").cast("string"), F.col("k").cast("string")).alias("votes"), conf.alias("confidence"), "attributes")


def audited_objects(objects: DataFrame, entries: DataFrame) -> DataFrame:
    """(object, label, bucket): each object with the longest label that it holds or is held by, the first on ties, and the bucket of its votes; "left" without one.

    objects: object. entries: label, pos, votes as n/k, or "new" for what no run has voted for. What is left goes to a model."""
    from lumentrace.functions.scalars import vote_bucket
    from lumentrace.operators.joins import short_contained

    o = objects.select(F.trim("object").alias("object")).distinct()
    first = entries.where("label <> ''").groupBy("label").agg(F.min_by(F.struct("pos", "votes"), "pos").alias("e"))
    pairs = short_contained(o, "object", first.select("label"), "label").join(first, "label")
    best = pairs.groupBy("object").agg(F.max_by(F.struct("label", "e"), F.struct(F.length("label"), -F.col("e.pos"))).alias("b"))
    votes = F.col("b.e.votes")
    bucket = F.when(F.col("b").isNull(), "left").when(votes == "new", "hit_new").otherwise(F.concat(F.lit("hit_"), vote_bucket(votes)))
    return o.join(best, "object", "left").select("object", F.col("b.label").alias("label"), bucket.alias("bucket"))


def caption_flow(requests: DataFrame, slices: DataFrame, provider: Provider, keep: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(captions, inferences, failures) of single calls with inference.

    Each request is tried twice. Clips without a sound response are asked for in slices (clip_id, call_index, request), each tried once, and
    stand if any slice does; others are failures with their code. The sound responses are then the requests of the inference.
    keep writes a result and reads it back, as calls must not be made again."""
    first = keep(call_stage(requests, "caption", provider))
    bad = first.where("code IS NOT NULL")
    second = keep(call_stage(slices.join(bad.select("clip_id").distinct(), "clip_id", "left_semi"), "caption", provider, tries=1))
    names = ["clip_id", "call_index", "response"]
    captions = first.where("code IS NULL").select(*names, F.lit(False).alias("sliced")).unionAll(second.where("code IS NULL").select(*names, F.lit(True)))
    inferences = keep(call_stage(captions.select("clip_id", "call_index", F.col("response").alias("request")), "inference", provider))
    failures = bad.join(second.where("code IS NULL").select("clip_id").distinct(), "clip_id", "left_anti").select("clip_id", "code")
    return captions, inferences, failures


def assembled(clips: DataFrame, lexicon: DataFrame, screens: DataFrame) -> DataFrame:
    """(clip_id, inventory, screen, recovery) of final records: times of day instead of seconds from the clip's start, no screens and "skipped" where that turn was not taken.

    clips: clip_id, start_sec. lexicon: clip_id, label, first_s, last_s (text; what is no number gives an empty time, negative ones the start). screens: clip_id, surfaces, recovery."""
    from lumentrace.functions.scalars import hms

    at = lambda s: F.coalesce(hms(F.col("start_sec") + F.greatest(F.col(s).try_cast("double"), F.lit(0.0))), F.lit(""))
    at_text = lambda s: F.when(F.col(s).try_cast("double").isNull(), "").otherwise(at(s))
    x = lexicon.join(clips, "clip_id").select("clip_id", F.struct("label", at_text("first_s").alias("first_seen"), at_text("last_s").alias("last_seen")).alias("e"))
    inventory = x.groupBy("clip_id").agg(F.array_sort(F.collect_list("e")).alias("inventory"))
    out = clips.join(inventory, "clip_id", "left").join(screens, "clip_id", "left")
    empty = F.array().cast(screens.schema["surfaces"].dataType)
    return out.select("clip_id", F.coalesce("inventory", F.array().cast(inventory.schema["inventory"].dataType)).alias("inventory"), F.coalesce("surfaces", empty).alias("screen"), F.coalesce("recovery", F.lit("skipped")).alias("recovery"))
