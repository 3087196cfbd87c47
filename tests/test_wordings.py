"""Near-equal wordings against all pairs."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lumentrace.operators import wordings as W


def plain(items, runs, share):
    k = {}
    for clip, call in runs:
        k.setdefault(clip, set()).add(call)
    by = {}
    for clip, call, text in items:
        if text and text.strip(" "):
            by.setdefault(clip, {}).setdefault(text, []).append(call)
    out = []
    for clip, texts in by.items():
        ws = {t: {w for w in re.split(r"[^\w']+|_", t.lower()) if w} for t in texts}
        parent = {t: t for t in texts}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a in texts:
            for b in texts:
                if ws[a] and ws[b] and 1000 * len(ws[a] & ws[b]) >= round(share * 1000) * len(ws[a] | ws[b]):
                    parent[find(a)] = find(b)
        groups = {}
        for t in texts:
            groups.setdefault(find(t), []).append(t)
        for g in groups.values():
            calls = {c for t in g for c in texts[t]}
            n, of = len(calls), len(k[clip])
            out.append((clip, max(g, key=lambda t: (len(t), t)), n, sum(len(texts[t]) for t in g), f"{n}/{of}", "high" if n >= of else "low" if n <= 1 else "medium"))
    return sorted(out)


@pytest.mark.parametrize("share", [0.4, 0.6, 0.8, 1.0])
def test_merged(spark, share):
    rng = random.Random(int(share * 10))
    vocabulary = [f"w{i}" for i in range(30)] + ["the", "The", "a", "it's", "né", "中文"]
    items = []
    for clip in ("c1", "c2", "c3"):
        bases = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 9))] for _ in range(8)]
        for call in range(4):
            for b in bases:
                w = [x for x in b if rng.random() < 0.9] + [rng.choice(vocabulary) for _ in range(rng.randint(0, 1))]
                rng.shuffle(w)
                items.append((clip, call, rng.choice([" ", ", ", "  "]).join(w) + rng.choice(["", ".", "!"])))
    items += [("c1", 0, None), ("c1", 1, "  "), ("c2", 0, "..."), ("c2", 1, "..."), ("c2", 3, "?!")]
    runs = [(c, r) for c in ("c1", "c2", "c3", "c4") for r in range(4)]
    got = W.merged(spark.createDataFrame(items, "clip_id string, call_index int, text string").repartition(3), spark.createDataFrame(runs, "clip_id string, call_index int"), share)
    assert sorted(map(tuple, got.collect())) == plain(items, runs, share)


def test_groups_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(300)] + [(i * 7 + 1000, i * 5 + 1003) for i in range(50)] + [(5000, 5000)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.root for r in W.groups(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert W.groups(spark.createDataFrame([], "a long, b long")).count() == 0


def _stars(sets, left, share):
    """Which texts a pair of blocks joins; left: how many are in the left one, all if it is paired with itself."""
    hashes = [np.array([zlib.crc32(str(w).encode()) for w in s], np.int64) for s in sets]
    rows = pa.RecordBatch.from_pydict({"clip_id": ["c"] * len(sets), "id": list(range(len(sets))), "h": pa.array([h.tolist() for h in hashes], pa.list_(pa.int64()))})
    (made,) = W._sketches(W._width(round(share * 1000), 1000))(iter([rows]))
    table = pa.Table.from_batches([made]).append_column("side", pa.array([int(i >= left) for i in range(len(sets))], pa.int32()))
    got = W._near(round(share * 1000), 1000)(table.take(pa.array(np.random.default_rng(1).permutation(len(sets))))).to_pydict()
    to = dict(zip(got["b"], got["a"], strict=True))
    return [to.get(i, i) for i in range(len(sets))]


@pytest.mark.parametrize("share", [0.4, 0.6, 0.8, 1.0])
def test_sketches_lose_no_link(monkeypatch, share):
    monkeypatch.setattr(W, "MATRIX", 1)
    rng = random.Random(int(share * 10))
    sets = [rng.sample(range(60), rng.randint(1, 30)) for _ in range(300)]
    sets += [s + [100 + i] for i, s in enumerate(sets[:100])] + [list(range(20_000)), list(range(300, 20_300)), list(range(30_000, 30_400)), list(range(40_000, 40_400))]
    rng.shuffle(sets)
    for left in (len(sets), 150):
        root = _stars(sets, left, share)
        for i, a in enumerate(sets):
            for j in range(i):
                if (left == len(sets) or j < left <= i) and 1000 * len(set(a) & set(sets[j])) >= round(share * 1000) * len(set(a) | set(sets[j])):
                    assert root[i] == root[j]
    far = [rng.sample(range(1 << 40), k + 200) for k in range(40)]
    assert _stars(far, len(far), 0.6) == list(range(40))


def _refused(*a):
    def run(rows):
        raise AssertionError("whole sets are dealt")

    return run


def test_texts_that_nothing_is_near_to_are_not_dealt(spark, monkeypatch):
    """What is stored of them are sketches; whole sets went to every block that theirs meets."""
    texts = [("c", i, [f"w{k}" if k < 5 else f"w{i}x{k}" for k in range(30)]) for i in range(50)]
    d = spark.createDataFrame(texts, "clip_id string, id long, w array<string>")
    assert len(W.near_links(d.unionAll(d.selectExpr("clip_id", "id + 100", "w")), 0.6, 7).collect()) >= 50
    monkeypatch.setattr(W, "_joined", _refused)
    assert W.near_links(d, 0.6, 7).collect() == []
