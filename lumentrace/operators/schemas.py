"""Schemas of nested JSON as column expressions over VARIANT: the first violation of a document, at whatever depth.

A schema is a dict of these words: type (a name or several), properties with required and additionalProperties=False, items with minItems, enum and
anyOf. A schema's words are judged in the order in which they stand, properties in theirs and before what is missing or too many; the first to fail is the violation, with its path and
its word. Texts are never shown. Whole schemas become one expression, so that a document is judged where it is, in one pass over the table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VIOLATION = "struct<path:array<string>,rule:string>"


def an_object(properties: dict) -> dict:
    """All fields are there and no others."""
    return {"type": "object", "properties": properties, "required": list(properties), "additionalProperties": False}


def an_array(items: dict, least: int = 0) -> dict:
    return {"type": "array", "items": items} | ({"minItems": least} if least else {})


def one_of(*values: str) -> dict:
    return {"enum": list(values)}


def or_null(schema: dict) -> dict:
    return {"anyOf": [schema, {"type": "null"}]}


TEXT, NUMBER, NULL_TEXT = {"type": "string"}, {"type": "number"}, {"type": ["string", "null"]}
TEXTS = an_array(TEXT)

# The values that fields of annotations, audio notes and reviews may have.
EVENT_TYPES = ("action", "speech", "observation", "environment")
SPEECH_SOURCES = ("in_person", "media", "unknown")
VERIFICATION = ("audio_checked", "transcript_only")
MODALITIES = ("visual", "audio", "transcript", "ocr")
SUPPORT = ("direct", "indirect")
EDGES = ("observed", "ongoing", "uncertain")
PRECISION = ("video_estimate", "sampled_frames", "audio_estimate", "transcript_only")
INTELLIGIBILITY = ("clear", "partial", "unintelligible")
VERSION = "castle-caption-v1"


def _fields(of: dict[str, dict], **groups: str) -> dict:
    """Fields by groups of one schema: the names with blanks between."""
    return {name: of[kind] for kind, names in groups.items() for name in names.split()}


_SPAN = {"start_sec": NUMBER, "end_sec": NUMBER}
_SPEECH = an_object({"speaker_id": TEXT, "source": one_of(*SPEECH_SOURCES), "text": NULL_TEXT, "verification": one_of(*VERIFICATION)})
_EVIDENCE = an_object({"source_id": TEXT, "modality": one_of(*MODALITIES), **_SPAN, "support": one_of(*SUPPORT), "note": TEXT})
_BOUNDARY = an_object({"start": one_of(*EDGES), "end": one_of(*EDGES), "precision": one_of(*PRECISION)})
_ENVIRONMENT = an_object({"world_changes": TEXTS, "newly_observed": TEXTS})
_INITIAL = or_null(an_object({"time_sec": NUMBER, "description": TEXT}))


def segment(event_types: tuple[str, ...] = EVENT_TYPES) -> dict:
    head = {"segment_id": TEXT, **_SPAN, "event_type": one_of(*event_types), "actor_ids": TEXTS, "activity": NULL_TEXT, "action": TEXT, "action_brief": TEXT, "objects": TEXTS}
    return an_object(head | {"environment": _ENVIRONMENT, "text_visible": TEXTS, "speech": or_null(_SPEECH), "details": NULL_TEXT, "evidence": an_array(_EVIDENCE, 1), "boundary": _BOUNDARY, "uncertainties": TEXTS})


def annotation(event_types: tuple[str, ...] = EVENT_TYPES, version: str = VERSION) -> dict:
    gaps = an_array(an_object(_SPAN | {"reason": TEXT}))
    actors = an_array(an_object({"actor_id": TEXT, "description": TEXT}))
    return an_object({"schema_version": one_of(version), "scene_summary": TEXT, "actors": actors, "initial_environment": _INITIAL, "visual_unavailable_intervals": gaps, "segments": an_array(segment(event_types)), "activity_chain": TEXTS})


def audio() -> dict:
    said = an_object(_SPAN | {"speaker_id": TEXT, "source": one_of(*SPEECH_SOURCES), "text": NULL_TEXT, "intelligibility": one_of(*INTELLIGIBILITY)})
    return an_object({"summary": TEXT, "utterances": an_array(said), "sound_events": an_array(an_object(_SPAN | {"description": TEXT, "source": TEXT})), "uncertainties": TEXTS})


def review() -> dict:
    found = an_object({"source_id": TEXT, "time_sec": NUMBER, "observation": TEXT, "readable_text": TEXTS, "limitations": TEXTS})
    replaced = an_object({"segment_id": TEXT, "reason": TEXT, "replacement": segment()})
    again = an_object({"segment_ids": TEXTS, "source_id": TEXT, "reason": TEXT})
    return an_object({"findings": an_array(found), "segment_replacements": an_array(replaced), "initial_environment_replacement": _INITIAL, "scene_summary_replacement": NULL_TEXT, "resegmentation_requests": an_array(again)})


def bound(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


# Names of leaf types, as Spark gives them.
_LEAVES = {"string": ("STRING",), "boolean": ("BOOLEAN",), "null": ("VOID",), "number": ("BIGINT", "DOUBLE", "FLOAT")}


def _is_leaf(v: Column, kinds: list[str]) -> Column:
    known = [n for k in kinds for n in _LEAVES[k]]
    right = lambda s: s.isin(*known) | s.startswith("DECIMAL") if "number" in kinds else s.isin(*known)
    return F.coalesce(bound(F.schema_of_variant(v), right) if "number" in kinds else right(F.schema_of_variant(v)), F.lit(False))


def _violation(schema: dict, v: Column, path: list[Column]) -> Column:
    """Of a value that is there (a variant); null for none. Containers are told by what they can become, as naming the type of one walks all of it."""
    place = F.array(*path) if path else F.array().cast("array<string>")
    broken = lambda rule: F.struct(place.alias("path"), F.lit(rule).alias("rule")).cast(VIOLATION)
    if unknown := schema.keys() - {"type", "properties", "required", "additionalProperties", "items", "minItems", "enum", "anyOf"}:
        raise ValueError(f"{', '.join(sorted(unknown))} is not known")

    def judged(inner: Column | None) -> Column:
        """inner: the keys of an object or the items of an array, null for other values."""
        cases: list[Column] = []
        for word, value in schema.items():
            if word == "type":
                wrong = inner.isNull() if inner is not None else ~_is_leaf(v, [value] if isinstance(value, str) else value)
                cases.append(F.when(wrong, broken("type")))
            elif word == "enum":
                text = F.when(_is_leaf(v, ["string"]), F.try_variant_get(v, "$", "string"))
                cases.append(F.when(~F.coalesce(text.isin(*value), F.lit(False)), broken("enum")))
            elif word == "anyOf":
                none = F.lit(True)
                for s in value:
                    none = none & _violation(s, v, path).isNotNull()
                cases.append(F.when(none, broken("anyOf")))
            elif word == "properties":
                for name, s in value.items():
                    cases.append(bound(F.try_variant_get(v, f"$.{name}", "variant"), lambda x: F.when(x.isNotNull(), _violation(s, x, [*path, F.lit(name)]))))  # noqa: B023  called at once
            elif word == "required":
                cases.append(F.when(F.size(F.array_except(F.array(*map(F.lit, value)).cast("array<string>"), inner)) > 0, broken("required")))
            elif word == "additionalProperties" and value is False:
                known = F.array(*map(F.lit, schema.get("properties", {}))).cast("array<string>")
                cases.append(F.when(F.size(F.array_except(inner, known)) > 0, broken("additionalProperties")))
            elif word == "items":
                found = F.transform(inner, lambda x, i: _violation(value, x, [*path, i.cast("string")]))  # noqa: B023  called at once
                cases.append(F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0)))
            elif word == "minItems":
                cases.append(F.when(F.size(inner) < value, broken("minItems")))
        return F.coalesce(*cases) if cases else F.lit(None).cast(VIOLATION)

    if schema.get("type") == "object":
        return bound(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), judged)
    if schema.get("type") == "array":
        return bound(F.try_variant_get(v, "$", "array<variant>"), judged)
    return judged(None)


def violation(document: Column, schema: dict) -> Column:
    """(path, rule) of the first violation of a document (variant), with dots between the parts of the path; null for a sound one. What is no JSON, a null variant, breaks the type of the whole."""

    def judged(d):
        first = F.when(d.isNull(), F.struct(F.array().cast("array<string>").alias("path"), F.lit("type").alias("rule"))).otherwise(_violation(schema, d, []))
        return bound(first, lambda v: F.when(v.isNotNull(), F.struct(F.array_join(v["path"], ".").alias("path"), v["rule"].alias("rule"))))

    # the text is parsed once, and the document judged once
    return bound(document, judged)
