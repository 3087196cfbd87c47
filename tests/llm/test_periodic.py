"""Periodic runs against a search that tries every period."""

import random
from fractions import Fraction

import brute
import pytest

from lumentrace.llm import periodic, queries


def strings(seed, how_many):
    rng = random.Random(seed)
    for _ in range(how_many):
        w = [rng.randrange(rng.choice([1, 2, 3, 60])) for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3) if w else 0):
            a, p = rng.randrange(len(w)), rng.randint(1, 12)
            w = w[:a] + w[a : a + p] * rng.randint(1, 9) + w[a + rng.randint(0, p + 4) :]
        yield w


@pytest.mark.parametrize(("least", "times"), [(24, 3), (2, 2), (5, 2), (9, 3), (12, 5)])
def test_runs_are_those_of_every_period(least, times):
    some = 0
    for w in strings(least, 500):
        want = brute.runs(w, least, times)
        assert periodic.runs_of(w, least, times) == want, w
        some += len(want)
    assert some > 100


def test_runs_beside_and_within_each_other():
    inner = ["a"] * 30 + ["b"]
    w = ["x", *inner * 4, "y", *["c", "d"] * 20]
    assert periodic.runs_of(w) == brute.runs(w) == [(1, 30, 1), (1, 124, 31), (32, 30, 1), (63, 30, 1), (94, 30, 1), (126, 40, 2)]
    assert periodic.runs_of(["w"] * 24) == [(0, 24, 1)] and periodic.runs_of(["w"] * 23) == []


def test_mistaken_hashes_are_found_out():
    w = [1, 2, 3, 4, 5, 6, 7, 8, 9] * 5
    s = periodic._Stretch(w[:30] + [99] + w[31:], 1)
    s._same = lambda i, j, size: True
    assert s.runs(24, 3) is None


def test_strongest_ties():
    assert periodic.strongest([(5, 30, 3), (7, 20, 2), (9, 100, 11)]) == (5, 30, 3) and periodic.strongest([]) is None


def test_find_runs(spark, docs, rows):
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), r.collapsed) for r in periodic.find_runs(docs).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w = (t or "").encode().split()
        if i in (106, 107):  # one word over and over
            assert got[i] == ([(0, len(w), 1)], (0, len(w), 1), "ab")
            continue
        want = brute.runs(w)
        assert got[i][0] == want and got[i][2].encode() == brute.collapsed(w, want), i
    assert got[100] == got[101] == got[102] == ([], None, "")
    assert any(x[0] for i, x in got.items() if i < 60)


def test_edges(spark, empty):
    assert periodic.find_runs(empty).count() == 0
    long = "lorem ipsum dolor " * 200_000
    d = spark.createDataFrame([(None, "a b " * 20, 1), (7, "a b " * 20, 2), (7, long, 3), (8, None, 4)], "doc_id long, text string, runs int")
    got = sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find_runs(d).collect())
    assert got == [("7", [(0, 40, 2)], "a b"), ("7", [(0, 600_000, 3)], "lorem ipsum dolor"), ("8", [], ""), ("None", [(0, 40, 2)], "a b")]
    with pytest.raises(ValueError):
        periodic.find_runs(d, times=1)


def test_query(spark, rows, tmp_path):
    more = [(i, " ".join(f"w{i * j * j % 97}" for j in range(i % 130)) if i % 9 else None) for i in range(200, 420)]
    many = [(i, t) for i, t in rows if i < 106] + more
    spark.createDataFrame(many, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    some = 0
    for i, t in many:
        w = brute.planted(i, t)
        want = brute.runs(w)
        top = min(want, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        r = got[i]
        assert r.n_runs == len(want) and (r.start, r.length, r.period) == (top or (None, None, None))
        assert r.exponent_milli == (1000 * top[1] // top[2] if top else None)
        assert r.runs_sha256 == brute.sha("".join("%d,%d,%d\n" % x for x in want).encode())
        assert r.collapsed_sha256 == brute.sha(brute.collapsed(w, want))
        some += top is not None
    assert some > 15
