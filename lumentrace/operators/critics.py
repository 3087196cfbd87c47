"""Answers of critics and of the baselines they judge by, from loosely written JSON to typed columns.

Numbers, truth values and texts are taken as Python's int(), float() and str() take them; what cannot be read becomes 0, false or empty. An answer without a single candidate, or that is no JSON object, is
an error; a best index beyond the candidates gives way to the candidate with the largest total, of equal ones the first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentrace.functions.scalars import json_object
from lumentrace.operators.contracts import loose_text
from lumentrace.operators.schemas import bound

SCORES = ("faithfulness", "coverage", "timestamp_accuracy", "rule_compliance")
# What a text has to be to mean yes, and how far a fatal issue lets the faithfulness go.
YES = ("true", "1", "yes")
NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _is_number(kind: Column) -> Column:
    return kind.isin(*NUMBERS) | kind.startswith("DECIMAL")


def _by_kind(v: Column, use) -> Column:
    """use(value, name of its type), each computed once; null for an absent value."""
    return bound(v, lambda x: F.when(x.isNotNull(), bound(F.schema_of_variant(x), lambda kind: use(x, kind))))


def _bare(v: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.try_variant_get(v, "$", "string"), r"(?U)^\s+|\s+$", ""), r"(?<=\d)_(?=\d)", "")


def whole_number(v: Column, default: int = 0) -> Column:
    """int() of a variant: numbers are cut towards zero, texts must be whole numbers."""

    def of(x, kind):
        cut = bound(F.try_variant_get(x, "$", "double"), lambda number: F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)))
        text = bound(_bare(x), lambda bare: F.when(bare.rlike(r"^[+-]?\d+\z"), bare.try_cast("long")))
        out = F.when(kind == "BIGINT", F.try_variant_get(x, "$", "long")).when(_is_number(kind), cut)
        return out.when(kind == "BOOLEAN", F.try_variant_get(x, "$", "boolean").cast("long")).when(kind == "STRING", text)

    return F.coalesce(_by_kind(v, of), F.lit(default).cast("long"))


def real_number(v: Column, default: float = 0.0) -> Column:
    """float() of a variant."""

    def of(x, kind):
        text = bound(_bare(x), lambda bare: F.when(bare.rlike(r"(?i)^[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?\z"), bare.try_cast("double")))
        out = F.when(_is_number(kind), F.try_variant_get(x, "$", "double")).when(kind == "BOOLEAN", F.try_variant_get(x, "$", "boolean").cast("double"))
        return out.when(kind == "STRING", text)

    return F.coalesce(_by_kind(v, of), F.lit(default))


def truth(v: Column) -> Column:
    """Whether a variant means yes: true, a number that is not 0, or one of the words for it."""

    def of(x, kind):
        text = F.lower(F.regexp_replace(F.try_variant_get(x, "$", "string"), r"(?U)^\s+|\s+$", "")).isin(*YES)
        return F.when(kind == "BOOLEAN", F.try_variant_get(x, "$", "boolean")).when(_is_number(kind), F.try_variant_get(x, "$", "double") != 0).when(kind == "STRING", text)

    return F.coalesce(_by_kind(v, of), F.lit(False))


def said(v: Column) -> Column:
    """str() of a variant, empty where Python takes the value for false: an absent one, null, 0, false, an empty text or container."""
    return loose_text(v)


def _texts(v: Column) -> Column:
    """str() of the items of an array: null, true and false by Python's names; none for what is no array."""

    def text(x):
        kind = F.schema_of_variant(x)
        plain = F.try_variant_get(x, "$", "string")
        return F.when(kind == "VOID", "None").when(kind == "BOOLEAN", F.initcap(plain)).when(kind == "STRING", plain).otherwise(F.coalesce(F.nullif(loose_text(x), F.lit("")), plain))

    return F.coalesce(F.transform(F.try_variant_get(v, "$", "array<variant>"), text), F.array().cast("array<string>"))


def baseline(content: Column) -> Column:
    """(scene, near_field, key_events, audio_gist, screens) of a baseline, wrapped or bare; null for an answer that has none."""
    doc = F.try_parse_json(json_object(content))
    wrapped = _field(doc, "verification_baseline")
    is_object = lambda v: F.try_variant_get(v, "$", "map<string,variant>").isNotNull()
    bare = F.lit(False)
    for name in ("scene", "key_events", "near_field", "audio_gist", "screens"):
        bare = bare | _field(doc, name).isNotNull()
    b = F.when(is_object(wrapped), wrapped).when(bare, doc)
    lists = [_texts(_field(b, n)).alias(n) for n in ("near_field", "key_events", "audio_gist", "screens")]
    return F.when(b.isNotNull(), F.struct(F.coalesce(said(_field(b, "scene")), F.lit("")).alias("scene"), *lists))


def verdict(content: Column) -> Column:
    """(candidates, best_index, needs_regeneration, regeneration_guidance, baseline_corrections) of a critic's answer; null for one without candidates. candidates: (index, the scores, weighted_total, fatal, summary)."""
    texts = lambda doc, name: F.coalesce(said(_field(doc, name)), F.lit("")).alias(name)

    def candidate(c):
        def of(scores):
            issues = F.try_variant_get(c, "$.issues", "array<variant>")
            fatal = F.coalesce(F.exists(issues, lambda i: F.lower(F.try_variant_get(i, "$.severity", "string")) == "fatal"), F.lit(False))
            return F.struct(whole_number(_field(c, "index")).alias("index"), *(whole_number(_field(scores, s)).alias(s) for s in SCORES), real_number(_field(c, "weighted_total")).alias("weighted_total"), fatal.alias("fatal"), texts(c, "summary"))

        return bound(_field(c, "scores"), of)

    def judged(doc):
        items = F.filter(F.try_variant_get(doc, "$.candidates", "array<variant>"), lambda c: F.try_variant_get(c, "$", "map<string,variant>").isNotNull())

        def chosen(found):
            totals = F.transform(found, lambda c: c["weighted_total"])
            given = whole_number(_field(doc, "best_index"), -1)
            best = F.when((given >= 0) & (given < F.size(found)), given).otherwise(F.array_position(totals, F.array_max(totals)) - 1)
            out = F.struct(found.alias("candidates"), best.cast("int").alias("best_index"), truth(_field(doc, "needs_regeneration")).alias("needs_regeneration"), texts(doc, "regeneration_guidance"), _texts(_field(doc, "baseline_corrections")).alias("baseline_corrections"))
            return F.when(F.size(found) > 0, out)

        return bound(F.transform(items, candidate), chosen)

    # each answer is parsed once, each candidate read once
    return bound(F.try_parse_json(json_object(content)), judged)


def verdicts(answers: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """answers with the fields of their verdict, and those whose answer is none."""
    x = answers.withColumn("_v", verdict(F.col(content)))
    # the fields are a generator's, as a condition on a column's would be drawn below it and each answer judged for it once more
    good = answers.select(*answers.columns, F.inline_outer(F.array(verdict(F.col(content))))).where("best_index IS NOT NULL")
    return good, x.where("_v IS NULL").drop("_v")


def second_pool(candidates: DataFrame, chosen: DataFrame, refined: DataFrame) -> DataFrame:
    """(clip_id, place, source, call_index, content): what a critic judges a second time, the best candidate first, then what was made anew, in order of calls.

    candidates and refined: (clip_id, call_index, content). chosen: (clip_id, best_index), a place among the clip's candidates in the order of calls; only clips that were refined have a second pool."""
    from pyspark.sql import Window

    order = Window.partitionBy("clip_id").orderBy("call_index")
    place = (F.row_number().over(order) - 1).alias("place")
    best = candidates.select("clip_id", "call_index", "content", place).join(chosen, "clip_id").where("place = best_index").select("clip_id", F.lit(0).alias("place"), F.lit("generate").alias("source"), "call_index", "content")
    again = refined.select("clip_id", F.row_number().over(order).alias("place"), F.lit("refine").alias("source"), "call_index", "content")
    return best.join(refined.select("clip_id").distinct(), "clip_id", "left_semi").unionAll(again)
