"""Contracts on nested annotation documents: rules, normal form, references, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentrace.functions.scalars import micros

#: Nested schema of an annotation document.
ANNOTATION = """
schema_version STRING, scene_summary STRING, actors ARRAY<STRUCT<actor_id STRING, description STRING>>,
initial_environment STRUCT<time_sec DOUBLE, description STRING>,
visual_unavailable_intervals ARRAY<STRUCT<start_sec DOUBLE, end_sec DOUBLE, reason STRING>>,
segments ARRAY<STRUCT<segment_id STRING, start_sec DOUBLE, end_sec DOUBLE, event_type STRING, actor_ids ARRAY<STRING>, activity STRING,
  action STRING, action_brief STRING, objects ARRAY<STRING>, environment STRUCT<world_changes ARRAY<STRING>, newly_observed ARRAY<STRING>>,
  text_visible ARRAY<STRING>, speech STRUCT<speaker_id STRING, source STRING, text STRING, verification STRING>, details STRING,
  evidence ARRAY<STRUCT<source_id STRING, modality STRING, start_sec DOUBLE, end_sec DOUBLE, support STRING, note STRING>>,
  boundary STRUCT<start STRING, end STRING, precision STRING>, uncertainties ARRAY<STRING>>>,
activity_chain ARRAY<STRING>
"""
# What the evidence of each source shows; sources by name, or by the beginning of their name.
SOURCE_MODALITY = {"video_0": "visual", "audio_0": "audio"}
PREFIX_MODALITY = {"crop_": "visual", "transcript_": "transcript", "ocr_": "ocr"}
WEARER = "wearer"
#: A change of normalised().
CHANGE = "code STRING, before ARRAY<STRING>, after ARRAY<STRING>, segment_id STRING, edge STRING, time_sec DOUBLE"


def annotations(events: DataFrame) -> DataFrame:
    """(clip, segments): one nested document for each user of an event table, segments in order of arrival."""
    tenth = F.floor(micros("ts") / 1_000_000) % 100_000 / 10.0
    seg = F.struct(F.col("event_id").alias("segment_id"), tenth.alias("start_sec"), (tenth + F.col("event_id") % 50).alias("end_sec"), F.col("event_type").alias("kind"), (F.col("event_id") % 9).alias("actor"))
    return events.groupBy(F.col("user_id").alias("clip")).agg(F.array_sort(F.collect_list(seg)).alias("segments"))


def canonical(segments: Column | str) -> Column:
    """Segments by start and id; those that agree in both stay as they came."""
    keyed = F.transform(segments, lambda s, i: F.struct(s["start_sec"].alias("a"), s["segment_id"].alias("b"), i.alias("i"), s.alias("s")))
    return F.transform(F.sort_array(keyed), lambda x: x["s"])


def sorted_segments(docs: DataFrame) -> DataFrame:
    """Segments in canonical order, and changes: the codes of what was put right."""
    ids = lambda c: F.transform(c, lambda s: s["segment_id"])
    x = docs.withColumn("_s", canonical("segments"))
    moved = ids("_s") != ids("segments")
    return x.withColumn("changes", F.when(moved, F.array(F.lit("SORT_SEGMENTS"))).otherwise(F.array().cast("array<string>"))).withColumn("segments", F.col("_s")).drop("_s")


def expected_chain(segments: Column) -> Column:
    """Ids of the wearer's actions in order."""
    return F.transform(F.filter(segments, lambda s: F.array_contains(s["actor_ids"], WEARER) & (s["event_type"] == "action")), lambda s: s["segment_id"])


def _change(code: str, **fields: Column) -> Column:
    kinds = {n: t for n, t in (f.split(" ", 1) for f in CHANGE.split(", "))}
    return F.struct(*((F.lit(code) if n == "code" else fields.get(n, F.lit(None))).cast(t).alias(n) for n, t in kinds.items()))


def normalised(docs: DataFrame) -> DataFrame:
    """Annotation documents in normal form, with changes (an array of CHANGE): segments sorted; a chain with the right members reordered; "ongoing" away from the clip's edges made "uncertain", with a note that is added once.

    Nothing else is moved or invented. docs needs duration_sec beside the columns of ANNOTATION; judge the result by annotation_errors."""
    ids = lambda c: F.transform(c, lambda s: s["segment_id"])
    duration = F.col("duration_sec")
    x = docs.withColumn("_s", canonical("segments"))
    moved = F.when(F.col("_s") != F.col("segments"), _change("SORT_SEGMENTS", before=ids("segments"), after=ids("_s")))
    right = expected_chain(F.col("_s"))
    members = lambda c: F.sort_array(F.array_distinct(c))
    swap = (F.col("activity_chain") != right) & (F.size("activity_chain") == F.size(right)) & (members(F.col("activity_chain")) == members(right))
    chained = F.when(swap, _change("SORT_ACTIVITY_CHAIN", before=F.col("activity_chain"), after=right))
    inner = {"start": lambda s: (s["boundary"]["start"] == "ongoing") & (s["start_sec"] != 0), "end": lambda s: (s["boundary"]["end"] == "ongoing") & (F.abs(s["end_sec"] - duration) > 0.001)}
    # Fixed value: the note's wording.
    note = lambda s, e: F.concat(F.lit(f"Model marked {e} as ongoing at "), s[f"{e}_sec"].cast("string"), F.lit("s, away from the clip edge; the boundary is uncertain and its timestamp was not changed."))
    edges = F.flatten(F.transform("_s", lambda s: F.array(*(F.when(hit(s), _change("NONEDGE_ONGOING_TO_UNCERTAIN", before=F.array(F.lit("ongoing")), after=F.array(F.lit("uncertain")), segment_id=s["segment_id"], edge=F.lit(e), time_sec=s[f"{e}_sec"])) for e, hit in inner.items()))))

    def put(s):
        edge, notes = s["boundary"], s["uncertainties"]
        for e, hit in inner.items():
            edge = edge.withField(e, F.when(hit(s), "uncertain").otherwise(s["boundary"][e]))
            notes = F.when(hit(s) & ~F.array_contains(s["uncertainties"], note(s, e)), F.concat(notes, F.array(note(s, e)))).otherwise(notes)
        return s.withField("boundary", edge).withField("uncertainties", notes)

    changes = F.array_compact(F.concat(F.array(moved, chained), edges))
    return x.withColumn("changes", changes).withColumn("activity_chain", F.when(swap, right).otherwise(F.col("activity_chain"))).withColumn("segments", F.transform("_s", put)).drop("_s")


def _bad_span(a: Column, b: Column, duration: Column, point: bool = False) -> Column:
    out = lambda v: v.isNull() | F.isnan(v) | (v < 0) | (v > duration)
    return out(a) | out(b) | ((b < a) if point else (b <= a))


def _first(cases: list[tuple[Column, str]]) -> Column:
    """The code of the first case that holds; null for none."""
    return F.coalesce(*(F.when(F.coalesce(broken, F.lit(False)), code) for broken, code in cases))


def segment_error(s: Column, duration: Column, known: Column, sources: Column) -> Column:
    """The first rule that a segment breaks; null for none. known: actor ids; sources: source ids."""
    has = lambda name: F.array_contains(sources, name)
    sid = lambda e: e["source_id"]

    def shows(e):
        out = None
        for name, m in SOURCE_MODALITY.items():
            out = F.when(sid(e) == name, m) if out is None else out.when(sid(e) == name, m)
        for prefix, m in PREFIX_MODALITY.items():
            out = out.when(sid(e).startswith(prefix), m)
        return out

    def evidence(e):
        return _first(
            [
                (_bad_span(e["start_sec"], e["end_sec"], duration, point=True), "EVIDENCE_INTERVAL"),
                (sid(e).isNull() | ~F.array_contains(sources, sid(e)), "UNKNOWN_SOURCE"),
                (~shows(e).eqNullSafe(e["modality"]), "MODALITY"),
                ((e["modality"] == "audio") & ~has("audio_0"), "NO_AUDIO"),
            ]
        )

    speech, checked = s["speech"], s["speech"]["verification"]
    said = s["event_type"] == "speech"
    return F.coalesce(
        _first(
            [
                (_bad_span(s["start_sec"], s["end_sec"], duration), "SEGMENT_INTERVAL"),
                (F.size(F.array_except(s["actor_ids"], known)) > 0, "UNKNOWN_ACTOR"),
                ((s["boundary"]["start"] == "ongoing") & (s["start_sec"] != 0), "ONGOING_START"),
                ((s["boundary"]["end"] == "ongoing") & (F.abs(s["end_sec"] - duration) > 0.001), "ONGOING_END"),
            ]
        ),
        F.get(F.filter(F.transform(s["evidence"], evidence), lambda c: c.isNotNull()), F.lit(0)),
        _first(
            [
                (said & (speech.isNull() | speech["speaker_id"].isNull() | ~F.array_contains(known, speech["speaker_id"])), "SPEAKER"),
                (said & (checked == "audio_checked") & ~has("audio_0"), "AUDIO_MISSING"),
                (said & (checked == "audio_checked") & ~F.exists(s["evidence"], lambda e: (sid(e) == "audio_0") & (e["modality"] == "audio")), "AUDIO_UNCITED"),
                (said & (checked == "transcript_only") & ~F.exists(sources, lambda x: x.startswith("transcript_")), "NO_TRANSCRIPT"),
                (~said & speech.isNotNull(), "SPEECH_OUTSIDE"),
            ]
        ),
    )


def annotation_errors(docs: DataFrame, duration: Column, sources: Column) -> DataFrame:
    """docs with violations, the codes of what is broken in the order in which a document is judged, and error, the first of them; null for a sound document.

    The document's actors, ids, order, environment and unavailable intervals come first, then its segments one after the other (of each
    the first broken rule), last the activity chain. duration in seconds; sources: the source ids that were supplied."""
    seg = F.col("segments")
    ids = F.transform(seg, lambda s: s["segment_id"])
    actors = F.transform("actors", lambda a: a["actor_id"])
    known = F.concat(actors, F.array(F.lit("unknown")))
    starts = F.transform(seg, lambda s: F.struct(s["start_sec"], s["segment_id"]))
    time = F.col("initial_environment.time_sec")
    outside = F.col("initial_environment").isNotNull() & (time.isNull() | F.isnan(time) | (time < 0) | (time > duration))
    case = lambda broken, code: F.when(F.coalesce(broken, F.lit(False)), code)
    whole = F.array(
        case(F.size(F.array_distinct(actors)) < F.size(actors), "DUPLICATE_ACTOR"),
        case(F.size(F.array_distinct(ids)) < F.size(ids), "DUPLICATE_SEGMENT"),
        case(starts != F.sort_array(starts), "UNSORTED_SEGMENTS"),
        case(outside, "ENVIRONMENT_TIME"),
        case(F.exists("visual_unavailable_intervals", lambda v: _bad_span(v["start_sec"], v["end_sec"], duration)), "UNAVAILABLE_INTERVAL"),
    )
    chain = F.array(case(F.col("activity_chain") != expected_chain(seg), "ACTIVITY_CHAIN"))
    codes = F.array_compact(F.concat(whole, F.transform(seg, lambda s: segment_error(s, duration, known, sources)), chain))
    return docs.withColumn("violations", codes).withColumn("error", F.get("violations", F.lit(0)))


def judged(docs: DataFrame, rules: list[tuple[Column, str]]) -> DataFrame:
    """violations: codes of all broken rules in order; error: the first, null for a sound document."""
    codes = F.array_compact(F.array(*(F.when(F.coalesce(broken, F.lit(False)), code) for broken, code in rules)))
    return docs.withColumn("violations", codes).withColumn("error", F.get("violations", F.lit(0)))


def audio_rules(duration: Column) -> list[tuple[Column, str]]:
    """Rules of an audio document: sound intervals within the clip, and a text for clear speech."""
    bad = lambda u: u["start_sec"].isNull() | u["end_sec"].isNull() | (u["start_sec"] < 0) | (u["end_sec"] > duration) | (u["end_sec"] <= u["start_sec"])
    return [
        (F.exists("utterances", bad), "UTTERANCE_INTERVAL"),
        (F.exists("sound_events", bad), "SOUND_INTERVAL"),
        (F.exists("utterances", lambda u: (u["intelligibility"] == "clear") & (F.trim(F.coalesce(u["text"], F.lit(""))) == "")), "CLEAR_WITHOUT_TEXT"),
    ]


def longest_label(df: DataFrame, text: str, labels: list[tuple[int, str]]) -> DataFrame:
    """label: the longest of a bounded list that equals, holds or is held by the text; of equally long ones the first."""
    ordered = [label for _, label in sorted(labels, key=lambda x: (-len(x[1]), x[0])) if label]
    arr = F.array(*map(F.lit, ordered))
    return df.withColumn("label", F.get(F.filter(arr, lambda x: F.col(text).contains(x) | x.contains(F.col(text))), F.lit(0)))


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def one_of(value: Column, allowed: tuple[str, ...], default: str) -> Column:
    """Lenient enumerations: anything else is the default."""
    v = F.lower(F.trim(text_or_empty(value)))
    return F.when(v.isin(*allowed), v).otherwise(default)


# The fields of each lenient layer, the first of which takes an item that is no object unless "text" is among them, and the values that some fields may have.
LAYERS = {
    "action": ("time", "time_end", "text"),
    "speech": ("lang", "speaker", "text"),
    "person": ("id", "descriptor", "name", "note"),
    "other": ("time", "time_end", "person", "text"),
    "sound": ("time", "text", "source"),
    "interface": ("time", "where", "app_or_site", "content", "note"),
    "env_change": ("time", "time_end", "text", "cause"),
    "causal": ("type", "cause", "effect", "strength"),
}
PLAIN_FIELD = {"person": "descriptor", "interface": "content", "causal": "cause"}
LAYER_VALUES = {
    ("speech", "lang"): ("zh", "en"),
    ("env_change", "cause"): ("self", "other", "external"),
    ("causal", "type"): ("env->action", "env->emotion", "emotion->action", "action->env", "other->action", "other->env", "other->emotion", "env->env"),
    ("causal", "strength"): ("strong", "moderate", "weak"),
}
#: Fields that take another field's text where they have none.
LAYER_FALLBACK = {("interface", "content"): "text"}
CAUSAL_TYPES = LAYER_VALUES["causal", "type"]


def loose_text(value: Column) -> Column:
    """The text of a JSON value (variant): empty for null, false, zero, and empty arrays and objects; lists and objects as JSON."""
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    zero = F.coalesce(F.try_variant_get(value, "$", "double") == 0, F.lit(False))
    return (
        F.when(value.isNull() | F.is_variant_null(value), "")
        .when(kind == "STRING", text)
        .when(kind == "BOOLEAN", F.when(text == "true", "True").otherwise(""))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.when(F.to_json(value).isin("{}", "[]"), "").otherwise(F.to_json(value)))
        .otherwise(F.when(zero, "").otherwise(text))
    )


def lenient_layer(items: Column, layer: str) -> Column:
    """The items of a layer, an array of JSON values (variants), as structs of its fields, all of them text; values that a field may not have are empty."""
    plain = PLAIN_FIELD.get(layer, "text")

    def item(v):
        is_object = F.schema_of_variant(v).startswith("OBJECT")
        of = lambda f: loose_text(F.try_variant_get(v, f"$.{f}", "variant"))
        whole = F.when(F.is_variant_null(v), "None").when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(F.try_variant_get(v, "$", "string"))).otherwise(F.try_variant_get(v, "$", "string"))
        fields = []
        for f in LAYERS[layer]:
            x = of(f)
            if (layer, f) in LAYER_FALLBACK:
                x = F.when(x == "", of(LAYER_FALLBACK[layer, f])).otherwise(x)
            if (layer, f) in LAYER_VALUES:
                low = F.lower(F.trim(x))
                x = F.when(low.isin(*LAYER_VALUES[layer, f]), low).otherwise("")
            fields.append(F.when(is_object, x).otherwise(whole if f == plain else F.lit("")).alias(f))
        return F.struct(*fields)

    return F.transform(F.coalesce(items, F.array().cast("array<variant>")), item)


def json_items(doc: Column, name: str) -> Column:
    """The items of an array of a JSON object (variant); none where it has no such array."""
    return F.try_variant_get(doc, f"$.{name}", "array<variant>")


# Words of intent, and words that hint at a screen.
INTENT = r"准备|打算|想要|试图|about to|going to|trying to"
SCREEN = r"屏幕|显示器|电脑|笔记本|手机|monitor|laptop|screen|phone"


def soft_metrics(texts: Column, env_causes: Column, causal_types: Column, has_screen: Column, labels: Column) -> dict[str, Column]:
    """Five counts that warn and never reject. texts: of actions; env_causes: causes of changes; causal_types: of links; labels: of the inventory."""
    n = lambda test, of: F.size(F.filter(of, test)).cast("long")
    long_labels = F.filter(labels, lambda x: F.length(x) >= 2)
    return {
        "intent_markers": n(lambda t: t.rlike(INTENT), texts),
        "mirror_missing": F.when(F.array_contains(causal_types, "action->env"), F.lit(0)).otherwise(n(lambda c: c == "self", env_causes)).cast("long"),
        "screen_hint_without_layer": F.exists(texts, lambda t: t.rlike(SCREEN)) & ~has_screen,
        "unanchored_texts": n(lambda t: ~F.exists(long_labels, lambda x: t.contains(x)), texts),
        "invalid_edge_types": n(lambda c: ~c.isin(*CAUSAL_TYPES), causal_types),
    }


#: Required fields of a nested annotation: path, and whether it may be null.
REQUIRED = (
    ("schema_version", False), ("scene_summary", False), ("actors", False), ("initial_environment", True), ("visual_unavailable_intervals", False), ("segments", False), ("activity_chain", False),
)
SEGMENT_REQUIRED = ("segment_id", "start_sec", "end_sec", "event_type", "actor_ids", "evidence", "boundary")


def schema_violation(doc: Column, values: dict[str, tuple[str, ...]] | None = None) -> Column:
    """(path, rule) of the first field of a JSON annotation (variant) that is missing, null or of another type, or holds a value that it may not; null for a sound one. Texts are never shown.

    values: the values that fields of segments may have."""
    kind = lambda v: F.coalesce(F.schema_of_variant(v), F.lit("MISSING"))
    wanted = {"actors": "ARRAY", "visual_unavailable_intervals": "ARRAY", "segments": "ARRAY", "activity_chain": "ARRAY", "schema_version": "STRING", "scene_summary": "STRING", "initial_environment": "OBJECT"}
    wanted |= {"segment_id": "STRING", "event_type": "STRING", "actor_ids": "ARRAY", "evidence": "ARRAY", "boundary": "OBJECT"}
    numbers = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")

    def fault(v, field: str, path: Column, nullable: bool = False) -> Column:
        k = kind(v)
        ok = F.greatest(F.lit(False), *(k.startswith(n) for n in numbers)) if field.endswith("_sec") else k.startswith(wanted[field])
        allowed = (values or {}).get(field)
        out = F.when(k == "MISSING", F.struct(path.alias("path"), F.lit("required").alias("rule")))
        out = out.when(~(ok | ((k == "VOID") & F.lit(nullable))), F.struct(path.alias("path"), F.lit("type").alias("rule")))
        return out.when(~F.try_variant_get(v, "$", "string").isin(*allowed), F.struct(path.alias("path"), F.lit("enum").alias("rule"))) if allowed else out

    def segment(s, i):
        at = lambda f: F.concat(F.lit("segments."), i.cast("string"), F.lit(f".{f}"))
        return F.coalesce(*(fault(F.try_variant_get(s, f"$.{f}", "variant"), f, at(f)) for f in SEGMENT_REQUIRED))

    top = [fault(F.try_variant_get(doc, f"$.{f}", "variant"), f, F.lit(f), nullable) for f, nullable in REQUIRED]
    inner = F.get(F.filter(F.transform(json_items(doc, "segments"), segment), lambda x: x.isNotNull()), F.lit(0))
    broken = F.struct(F.lit("").alias("path"), F.lit("type").alias("rule"))
    return F.when(doc.isNull() | ~F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False)), broken).otherwise(F.coalesce(*top, inner))


# The bounds of a run's settings: least, most, whole numbers only, and whether least itself is too little.
BOUNDS = {
    "workers": (1, 16, True, False),
    "clip_seconds": (0, 30, False, True),
    "fps": (0, 4, False, True),
    "max_dim": (128, 2880, True, False),
    "max_review_regions": (0, 8, True, False),
    "max_output_tokens": (1024, 65536, True, False),
    "start_clip": (0, float("inf"), True, False),
    "max_clips": (1, float("inf"), True, False),
    "media_threads": (1, 32, True, False),
    "decode_slots": (1, 16, True, False),
    "footer_workers": (1, 16, True, False),
    "timeout_sec": (0, 1800, False, True),
}


def checked_settings(settings: dict) -> dict:
    """settings, all of them known and within their bounds, else ValueError; true and false are no numbers, and nan is within no bounds."""
    for k, v in settings.items():
        if k not in BOUNDS:
            raise ValueError(f"no setting {k}")
        least, most, whole, above = BOUNDS[k]
        if isinstance(v, bool) or not isinstance(v, int if whole else (int, float)) or not least <= v <= most or (above and v == least):
            raise ValueError(f"{k} must be {'a whole number' if whole else 'a number'} {'above' if above else 'from'} {least} to {most}")
    return settings


def setting_faults(rows: DataFrame, name: str, value: str) -> DataFrame:
    """rows of settings (name, value double) that are unknown or out of bounds, with fault."""
    n, v = F.col(name), F.col(value)
    fault = F.when(~n.isin(*BOUNDS), "unknown")
    for k, (least, most, whole, above) in BOUNDS.items():
        low = (v <= least) if above else (v < least)
        bad = v.isNull() | F.isnan(v) | low | (v > most) | ((v != F.floor(v)) if whole else F.lit(False))
        fault = fault.when((n == k) & bad, "bounds")
    return rows.withColumn("fault", fault).where("fault IS NOT NULL")
