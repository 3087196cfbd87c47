"""Texts in texts against all pairs."""

import random

import numpy as np
import pytest

from lumentrace.operators import containment as C
from lumentrace.operators import joins as J


@pytest.mark.parametrize("part", [40, 1 << 22])
def test_anchors_of_parts_are_entries(monkeypatch, part):
    monkeypatch.setattr(C, "PART", part)
    rng = random.Random(1)
    for _ in range(300):
        t = bytes(rng.choice(b"abcdefgh \n") for _ in range(rng.choice([1, 2, 15, 16, 17, 100, 700])))
        a = rng.randrange(len(t))
        x = t[a : a + rng.choice([1, 2, 3, 8, 15, 16, 31, 32, 200])]
        assert C.anchor(x) in C.entries(t, len(x).bit_length() - 1).tolist()


def test_entries_are_few():
    t = np.random.default_rng(2).integers(97, 122, 100_000).astype(np.uint8).tobytes()
    assert len(C.entries(t, 8)) < 5 * len(t) / 256


def test_pairs(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcé中") for _ in range(rng.randint(1, 6)))
    docs = [(i, rng.choice([" ", ""]).join(word() for _ in range(rng.choice([1, 3, 8, 60, 200])))) for i in range(80)]
    items = []
    for i in range(60):
        t = rng.choice(docs)[1]
        a = rng.randrange(len(t))
        x = t[a : a + rng.choice([1, 2, 5, 20, 90, 300])]
        items.append((i, rng.choice([x, x, x + "z", f"before {x}"])))
    docs += [(100, None), (101, ""), (102, "x" * 70_000 + items[0][1]), (102, "y")]
    items += [(100, None), (101, ""), (102, "x" * 33)]
    got = J.contained(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), "doc_id", spark.createDataFrame(items, "item_id int, text string"), "item_id", "text")
    rows = [tuple(r) for r in got.collect()]
    want = {(d, i) for d, t in docs for i, x in items if t and x and (t in x or x in t)}
    assert set(rows) == want and len(rows) == len(want) > 60
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nothing(spark):
    e = spark.createDataFrame([], "id long, t string")
    assert J.contained(e, "id", e.withColumnRenamed("id", "other"), "other", "t").count() == 0


@pytest.mark.parametrize("most", [0, 1 << 18])
def test_entries_that_meet_nothing_stay_where_they_are(spark, monkeypatch, most):
    """Only entries of anchors that the other side has go on, but where these are too many for a filter; the pairs are the same."""
    monkeypatch.setattr(C, "MOST_ANCHORS", most)
    rng, made, entries = np.random.default_rng(4), [], C._entries
    texts = [rng.integers(97, 122, 4000).astype(np.uint8).tobytes().decode() for _ in range(20)]
    monkeypatch.setattr(C, "_entries", lambda classes, places: made.append((classes, places)) or entries(classes, places))
    inner, outer = spark.createDataFrame([(1, texts[3][100:228])], "i int, t string"), spark.createDataFrame(list(enumerate(texts)), "o int, t string")
    assert [tuple(r) for r in C.held_by(inner, outer).collect()] == [(1, 3)]
    (classes, places), = made
    assert classes == [7]
    rows = outer.mapInArrow(entries(classes, places), "id int, class int, anchor long").count()
    assert rows == 1 if most else rows > 100
