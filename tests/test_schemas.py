"""Violations at every depth against a plain validator."""

import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from lumentrace.operators import schemas as S

SEGMENT = {
    "segment_id": "s001", "start_sec": 0, "end_sec": 2.5, "event_type": "action", "actor_ids": ["wearer"], "activity": None, "action": "a", "action_brief": "b", "objects": ["cup"],
    "environment": {"world_changes": [], "newly_observed": ["x"]}, "text_visible": [], "speech": None, "details": "d",
    "evidence": [{"source_id": "video_0", "modality": "visual", "start_sec": 0, "end_sec": 1, "support": "direct", "note": ""}],
    "boundary": {"start": "observed", "end": "ongoing", "precision": "sampled_frames"}, "uncertainties": [],
}
SPOKEN = SEGMENT | {"segment_id": "s002", "event_type": "speech", "speech": {"speaker_id": "unknown", "source": "media", "text": None, "verification": "transcript_only"}}
ANNOTATION = {
    "schema_version": S.VERSION, "scene_summary": "s", "actors": [{"actor_id": "wearer", "description": "d"}], "initial_environment": {"time_sec": 1, "description": "x"},
    "visual_unavailable_intervals": [{"start_sec": 1, "end_sec": 2, "reason": "r"}], "segments": [SEGMENT, SPOKEN], "activity_chain": ["s001"],
}
AUDIO = {
    "summary": "", "utterances": [{"start_sec": 1, "end_sec": 2, "speaker_id": "x", "source": "media", "text": None, "intelligibility": "unintelligible"}],
    "sound_events": [{"start_sec": 1e-3, "end_sec": 2, "description": "d", "source": "s"}], "uncertainties": [],
}
REVIEW = {
    "findings": [{"source_id": "v", "time_sec": 3, "observation": "o", "readable_text": ["t"], "limitations": []}], "segment_replacements": [{"segment_id": "s001", "reason": "r", "replacement": SEGMENT}],
    "initial_environment_replacement": None, "scene_summary_replacement": None, "resegmentation_requests": [{"segment_ids": ["s001"], "source_id": "v", "reason": "r"}],
}


def kind(x):
    return "null" if x is None else "boolean" if isinstance(x, bool) else "number" if isinstance(x, int | float) else "string" if isinstance(x, str) else "array" if isinstance(x, list) else "object"


def first(schema, x, path=()):
    """The first violation, by a walk in the order of the schema's words."""
    for word, v in schema.items():
        if word == "type" and kind(x) not in ([v] if isinstance(v, str) else v):
            return path, "type"
        if word == "enum" and x not in v:
            return path, "enum"
        if word == "anyOf" and all(first(s, x, path) for s in v):
            return path, "anyOf"
        if word == "properties" and isinstance(x, dict):
            for name, s in v.items():
                if name in x and (found := first(s, x[name], (*path, name))):
                    return found
        if word == "required" and isinstance(x, dict) and not set(v) <= x.keys():
            return path, "required"
        if word == "additionalProperties" and isinstance(x, dict) and x.keys() - schema["properties"].keys():
            return path, "additionalProperties"
        if word == "items" and isinstance(x, list):
            for i, y in enumerate(x):
                if found := first(v, y, (*path, i)):
                    return found
        if word == "minItems" and isinstance(x, list) and len(x) < v:
            return path, "minItems"
    return None


def places(x, path=()):
    yield path
    for k, y in x.items() if isinstance(x, dict) else enumerate(x) if isinstance(x, list) else ():
        yield from places(y, (*path, k))


def mutations(doc):
    """The document with each of its places replaced by values of other types, taken out, or given something more."""
    for path in places(doc):
        for value in (None, True, 7, "text", [], {}, [None], {"more": 1}):
            d = copy.deepcopy(doc)
            at = d
            for k in path[:-1]:
                at = at[k]
            if path:
                at[path[-1]] = value
                yield d
            else:
                yield value
        if path:
            d = copy.deepcopy(doc)
            at = d
            for k in path[:-1]:
                at = at[k]
            if isinstance(at, dict):
                extra = "x" * (1 + max(map(len, at)))
                at[extra] = 1
                yield copy.deepcopy(d)
                del at[extra]
            del at[path[-1]]
            yield d


def judged(spark, docs, schema):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string").repartition(4)
    got = {r.i: r.v and (r.v.path, r.v.rule) for r in df.select("i", S.violation(F.try_parse_json("d"), schema).alias("v")).collect()}
    return [got[i] for i in range(len(docs))]


@pytest.mark.parametrize(("name", "doc"), [("annotation", ANNOTATION), ("audio", AUDIO), ("review", REVIEW)])
def test_one_mutation_at_every_place(spark, name, doc):
    schema = getattr(S, name)()
    docs = [doc, *mutations(doc)]
    want = [None if (v := first(schema, d)) is None else (".".join(map(str, v[0])), v[1]) for d in docs]
    assert judged(spark, [json.dumps(d) for d in docs], schema) == want
    assert want[0] is None and {r for v in want if v for r in v[1:]} >= {"type", "enum", "required", "additionalProperties"} and max(v[0].count(".") for v in want if v) >= 2


def test_several_mutations_and_what_is_no_json(spark):
    rng = random.Random(1)
    docs = []
    for _ in range(150):
        d = ANNOTATION
        for _ in range(3):
            d = rng.choice(list(mutations(d))) if isinstance(d, dict) else d
        docs.append(d)
    schema = S.annotation()
    want = [None if (v := first(schema, d)) is None else (".".join(map(str, v[0])), v[1]) for d in docs]
    assert judged(spark, [json.dumps(d) for d in docs], schema) == want
    assert judged(spark, ["{", None, "[1, 2]", "3"], schema) == [("", "type")] * 4
    with pytest.raises(ValueError, match="pattern"):
        S.violation(F.lit(None), {"pattern": "x"})
