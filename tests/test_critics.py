"""Critics' answers against Python's own readings."""

import json

import pytest
from pyspark.sql import functions as F

from lumentrace.operators import critics as C

VALUES = [None, True, False, 0, 7, -3, 2.9, -2.9, 1e3, "7", " -12 ", "+4", "1_000", "7.5", "x", "", "yes", " TRUE ", "1", "no", [], [1], {}, {"a": 1}, "٣"]


def number(f, v, default):
    try:
        return f(v)
    except (TypeError, ValueError):
        return default


def test_readings(spark):
    d = spark.createDataFrame([(i, json.dumps({"v": v})) for i, v in enumerate(VALUES)] + [(len(VALUES), "{}")], "i int, j string").coalesce(1)
    v = F.try_variant_get(F.parse_json("j"), "$.v", "variant")
    got = d.orderBy("i").select(C.whole_number(v, -1).alias("w"), C.real_number(v).alias("r"), C.truth(v).alias("t")).collect()
    for r, x in zip(got, [*VALUES, None]):
        if x == "٣":
            continue  # digits of other scripts are no numbers here
        assert (r.w, r.r) == (number(int, x, -1), number(float, x, 0.0)), x
        yes = x if isinstance(x, bool) else x != 0 if isinstance(x, int | float) else isinstance(x, str) and x.strip().lower() in ("true", "1", "yes")
        assert r.t == yes, x


def loop(answer):
    try:
        data = json.loads(answer)
    except (TypeError, ValueError):
        return None
    cands = [c for c in data.get("candidates", []) if isinstance(c, dict)] if isinstance(data, dict) and isinstance(data.get("candidates"), list) else []
    if not cands:
        return None
    totals = [number(float, c.get("weighted_total"), 0.0) for c in cands]
    best = number(int, data.get("best_index"), -1)
    return (best if 0 <= best < len(cands) else totals.index(max(totals))), totals, [number(int, (c.get("scores") if isinstance(c.get("scores"), dict) else {}).get("coverage"), 0) for c in cands]


def test_verdicts(spark):
    one = {"index": 0, "scores": {"faithfulness": 8, "coverage": "7"}, "weighted_total": "7.25", "issues": [{"severity": "Fatal"}], "summary": "s"}
    two = {"scores": [1], "weighted_total": 9, "issues": "none", "summary": None}
    answers = [
        json.dumps({"candidates": [one, two], "best_index": 0, "needs_regeneration": "yes", "regeneration_guidance": "more", "baseline_corrections": ["a", None, True, 3]}),
        json.dumps({"candidates": [one, "text", two, two], "best_index": 7}), "```json\n" + json.dumps({"candidates": [one], "best_index": "0"}) + "\n```", json.dumps({"candidates": []}), json.dumps({"candidates": ["x"]}), json.dumps([one]), "no json", None, json.dumps({"candidates": {"a": 1}}),
    ]
    d = spark.createDataFrame(list(enumerate(answers)), "i int, content string")
    good, bad = C.verdicts(d)
    got = {r.i: r for r in good.collect()}
    assert set(got) == {0, 1, 2} and {r.i for r in bad.collect()} == {3, 4, 5, 6, 7, 8}
    for i in (0, 1):
        best, totals, coverage = loop(answers[i])
        r = got[i]
        assert (r.best_index, [c.weighted_total for c in r.candidates], [c.coverage for c in r.candidates]) == (best, totals, coverage)
    r = got[0]
    assert (r.needs_regeneration, r.regeneration_guidance, r.baseline_corrections) == (True, "more", ["a", "None", "True", "3"])
    assert [c.fatal for c in r.candidates] == [True, False] and [c.summary for c in r.candidates] == ["s", ""]
    assert got[1].best_index == 1 and got[1].needs_regeneration is False


@pytest.mark.parametrize(
    ("answer", "want"),
    [
        ({"verification_baseline": {"scene": "s", "near_field": ["a", 1], "screens": None}}, ("s", ["a", "1"], [])),
        ({"scene": None, "near_field": ["x"]}, ("", ["x"], [])),
        ({"verification_baseline": [1], "key_events": []}, ("", [], [])),
        ({"other": 1}, None),
    ],
)
def test_baselines(spark, answer, want):
    b = spark.createDataFrame([(json.dumps(answer),)], "c string").select(C.baseline(F.col("c")).alias("b")).first().b
    assert (b and (b.scene, b.near_field, b.screens)) == want


def test_second_pool(spark):
    cand = spark.createDataFrame([("c", 4, "x"), ("c", 2, "y"), ("d", 1, "z")], "clip_id string, call_index int, content string")
    chosen = spark.createDataFrame([("c", 1), ("d", 0)], "clip_id string, best_index int")
    refined = spark.createDataFrame([("c", 9, "r2"), ("c", 8, "r1")], "clip_id string, call_index int, content string")
    got = C.second_pool(cand, chosen, refined).orderBy("place").collect()
    assert [(r.clip_id, r.place, r.source, r.content) for r in got] == [("c", 0, "generate", "x"), ("c", 1, "refine", "r1"), ("c", 2, "refine", "r2")]
