"""Flows of several runs with a provider whose answers are known."""

import json

import pytest

from lumentrace.operators import votes as V


@pytest.fixture
def keep(spark, tmp_path):
    n = [0]

    def put(df):
        n[0] += 1
        df.write.parquet(str(tmp_path / f"kept{n[0]}"))
        return spark.read.parquet(str(tmp_path / f"kept{n[0]}"))

    return put


def test_votes_and_arbitration(spark, keep):
    calls = spark.sparkContext.accumulator(0)
    cup = {"label": "cup", "text": "a cup", "type": "object", "interacted_with": True}
    sky = {"label": "sky", "text": "blue", "type": "scene"}

    def provider(stage, request):
        calls.add(1)
        r = json.loads(request)
        if r["clip"] == "bad":
            raise OSError
        if stage == "arbitration":
            if r["clip"] == "deaf":
                raise OSError
            return json.dumps({"lexicon": [cup | {"text": "a cup of tea"}]}), 1, 1
        # which run this is cannot be seen from the request: the first clip has all agree, the others never all
        both = {"same": [cup, sky, {"label": " "}], "split": [sky], "deaf": [cup | {"uncertain": True}], "none": []}[r["clip"]]
        return json.dumps({"lexicon": both}), 1, 1

    clips = spark.createDataFrame([(c, json.dumps({"clip": c})) for c in ("same", "split", "deaf", "none", "bad")], "clip_id string, request string")
    merged, recovery, failures = V.vote_flow(clips, 2, provider, keep)
    got = {(r.clip_id, r.label): (r.text, r.votes, r.confidence, r.interacted) for r in merged.collect()}
    assert got == {("same", "cup"): ("a cup", "2/2", "high", True), ("same", "sky"): ("blue", "2/2", "high", False), ("split", "sky"): ("blue", "2/2", "high", False), ("deaf", "cup"): ("a cup", "2/2", "low", True)}
    assert {r.clip_id: r.recovery for r in recovery.collect()} == dict.fromkeys(("same", "split", "deaf", "none"), "ok")
    assert [(r.clip_id, r.code) for r in failures.collect()] == [("bad", "ROW_ERROR")]


def test_disagreement_asks_once_more(spark, keep, tmp_path):
    """Runs that differ, told apart by marks on the disk."""
    cup = {"label": "cup", "text": "a cup", "type": "object", "interacted_with": True}

    def provider(stage, request):
        clip = json.loads(request)["clip"]
        if stage == "arbitration":
            if clip == "deaf":
                raise OSError
            return json.dumps({"lexicon": [cup | {"text": "a cup of tea"}]}), 1, 1
        try:
            (tmp_path / f"seen-{clip}").touch(exist_ok=False)
        except FileExistsError:
            return json.dumps({"lexicon": []}), 1, 1
        return json.dumps({"lexicon": [cup]}), 1, 1

    clips = spark.createDataFrame([(c, json.dumps({"clip": c})) for c in ("split", "deaf")], "clip_id string, request string")
    merged, recovery, failures = V.vote_flow(clips, 2, provider, keep)
    assert {r.clip_id: (r.text, r.votes, r.confidence) for r in merged.collect()} == {"split": ("a cup of tea", "2/3", "medium"), "deaf": ("a cup", "1/2", "low")}
    assert {r.clip_id: r.recovery for r in recovery.collect()} == {"split": "arbitrated", "deaf": "ok"} and failures.count() == 0


def test_audit_with_a_second_look(spark, keep):
    def provider(stage, request):
        o = json.loads(request)["object"]
        if o == "broken":
            raise OSError
        return json.dumps({"label": {"mug": " CUP ", "kettle": "pot", "thing": None, "gadget": "new one"}.get(o, "none")}), 1, 1

    objects = spark.createDataFrame([(o,) for o in ("red cup", "mug", "kettle", "thing", "broken", "gadget", None, "")], "object string")
    labels = spark.createDataFrame([("cup", 1, "3/3"), ("lamp", 2, "1/3"), ("new one", 3, "new"), ("", 4, "1/3")], "label string, pos int, votes string")
    got = {r.object: (r.label, r.bucket) for r in V.audit_flow(objects, labels, provider, keep).collect() if r.object}
    full = got["red cup"][1].removeprefix("hit_")
    assert got["red cup"][0] == "cup" and got["mug"] == ("cup", f"recovered_{full}") and got["gadget"] == ("new one", "recovered_new")
    assert all(got[o] == (None, "missed") for o in ("kettle", "thing", "broken"))
