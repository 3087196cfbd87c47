"""The n-gram join against a comparison of all pairs."""

import random

import brute
import numpy as np
import pytest

from lumentrace.llm import ngram_join
from lumentrace.llm.ngram_join import INDEX, LACKING, Scheme, join_groups


def copies(seed, groups=12, size=9):
    """Groups of texts that differ in some words, at all distances around the limit."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    out = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([2, 3, 9, 14, 30, 60, 120, 260]))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 30)):
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
            out.append(" ".join(w))
    rng.shuffle(out)
    return list(enumerate(out))


def groups(df):
    return sorted(((str(r[0]), r[1], r[2]) for r in df.collect()), key=str)


def want(docs, **how):
    return sorted(((str(i), n, c) for (i, _), (n, c) in zip(docs, brute.jaccard_groups(docs, **how))), key=str)


@pytest.mark.parametrize(("part", "whole"), [(9, 10), (1, 2), (4, 5), (1, 1)])
@pytest.mark.parametrize("spare", [0, 1, 3])
def test_no_pair_is_lost_by_any_allocation(part, whole, spare):
    """Every pair of similar sets has a signature in common, one of them in the index and not both lacking a token, also where long lists are left out."""
    rng = random.Random(part * 10 + spare)
    plain = Scheme(part, whole)
    pairs = []
    for _ in range(150):
        n = rng.choice([1, 2, 5, 9, 10, 11, 20, 41, 90, 300])
        a = {rng.getrandbits(64) for _ in range(n)}
        most = int(plain.differing(2 * n))
        b = set(a)
        for x in rng.sample(sorted(a), min(n - 1, rng.randint(0, most // 2))):
            b.discard(x)
        b |= {rng.getrandbits(64) for _ in range(rng.randint(0, most // 2))}
        if whole * len(a & b) >= part * len(a | b) and a != b:
            pairs.append([np.array(sorted(s), np.uint64) for s in (a, b)])
    # all lists of all sets are taken for long ones: whatever the spare segments allow is left out
    long = {}
    for p in pairs:
        for s in p:
            sigs = plain.signatures(s)
            long |= {x: 1.0 for x in (sigs[sigs & 3 == INDEX].view(np.uint64) & ~np.uint64(3)).tolist()}
    scheme = Scheme(part, whole, {b: spare for b in range(40)}, long)
    for a, b in pairs:
        x, y = ({int(s) >> 2: set() for s in scheme.signatures(t)} for t in (a, b))
        for of, t in ((x, a), (y, b)):
            for s in scheme.signatures(t).tolist():
                of[s >> 2].add(s & 3)
        assert any((i | j) & INDEX and not i & j & LACKING for k in x.keys() & y.keys() for i in x[k] for j in y[k]), (len(a), len(b))
    assert len(pairs) > (30 if part < whole else -1)


def test_sketches_bound_differences():
    rng = np.random.default_rng(3)
    s = Scheme(9, 10)
    for n, m in ((40, 3), (500, 30), (1000, 60), (30_000, 900)):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[m:], rng.integers(0, 2**64, 3 * m, dtype=np.uint64)]))
        x, y = s.sketch(a), s.sketch(b)
        size = min(len(x), len(y))
        bits = (int.from_bytes(ngram_join._folded(x, size), "little") ^ int.from_bytes(ngram_join._folded(y, size), "little")).bit_count()
        assert 2 * m < bits <= 4 * m or n > ngram_join.MOST_SKETCH


@pytest.mark.parametrize("share", [(9, 10), (1, 2)])
def test_groups(spark, share):
    d = copies(share[0])
    found = groups(join_groups(spark.createDataFrame(d, "doc_id long, text string").repartition(3), share=share))
    assert found == want(d, part=share[0], whole=share[1])
    assert 12 < len({c for _, _, c in found}) < len(d)


def test_spare_segments_blocks_and_small_batches(spark, monkeypatch):
    d = copies(77, 6, 20)
    df = spark.createDataFrame(d, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(ngram_join, "PAIR_COST", 1e3)
    scheme = ngram_join.allocated(df.select("text"), 3, 9, 10)
    assert any(scheme.spare.values()) and scheme.long
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        assert groups(join_groups(df, scheme=scheme)) == want(d)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lists_across_batches():
    import pyarrow as pa

    rng = random.Random(4)
    rows = sorted({(rng.randrange(9) * 4 + rng.randrange(4), rng.randrange(3)) for _ in range(60)}, key=lambda r: (r[0] >> 2, -(r[0] & 1), r[1], r[0]))
    for size in (1, 2, 5, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows[i : i + size]], pa.int64()), pa.array([k for _, k in rows[i : i + size]], pa.int64())], ["sig", "key"]) for i in range(0, len(rows), size)]
        got = {(r["list"] * 4 + r["kind"], r["key"]) for b in ngram_join._shared(iter(batches)) for r in b.to_pylist()}
        good = {s >> 2 for s, k in rows if s & INDEX and any(t >> 2 == s >> 2 and o != k for t, o in rows)}
        assert got == {(s, k) for s, k in rows if s >> 2 in good}


def test_edges(spark, docs, rows, empty):
    assert join_groups(empty).count() == 0
    assert groups(join_groups(docs)) == want(rows)
    d = [(None, "a b c d"), (7, "A b  c d"), (7, "other words here now"), (3, None), (9, ""), (None, "alone"), (8, "one two"), (2, "one\ttwo")]
    assert groups(join_groups(spark.createDataFrame(d, "doc_id long, text string"))) == want(d)
    with pytest.raises(ValueError):
        join_groups(docs, share=(3, 2))
