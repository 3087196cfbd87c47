"""Collocations against counts of all phrases."""

import random

import brute
import pytest

from lumentrace.llm import collocations
from lumentrace.llm.collocations import mine

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def corpus(seed, docs=300):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "é", "x\x01y", "x", "b" * 300, "t20", *(f"w{i}" for i in range(12))]
    out = []
    for i in range(docs):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"]) for _ in range(rng.randint(0, 120)))
        out.append((rng.choice(["en", "en", "en", "de", None, "und", "a b%20", ""]), t + ("New York times " * rng.randint(0, 3))))
    return [*out, ("en", None), ("en", ""), ("fr", "one two"), ("de", " \t\n.,")]


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("how", [{}, {"max_n": 2}, {"least": 3, "max_n": 4, "top": 50}, {"min_n": 3, "least": 2}])
def test_mine(spark, how):
    d = corpus(1)
    got = found(mine(spark.createDataFrame(d, "lang string, text string").repartition(3), **how))
    assert got == sorted(brute.collocations(d, **how)) and len(got) > 20


def test_small_tasks_and_hot_words(spark, monkeypatch):
    """Words and pairs that are dealt to several tasks, suffixes sent in several lots, sorted rows in small batches."""
    d = corpus(2)
    df = spark.createDataFrame(d, "lang string, text string").repartition(3)
    hot = collocations.hot_prefixes(df, 3, 40, "x")
    assert {len(p) for p in hot} == {2, 3} and all(p[:2] in hot for p in hot)
    monkeypatch.setattr(collocations, "hot_prefixes", lambda *_: hot)
    want = sorted(brute.collocations(d))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(mine(df)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lots_of_a_task():
    import pyarrow as pa

    held = collocations._Held(3, {("en", b"a"): 3, ("en", b"a", b"b"): 2})
    held.add("en", [b"a", b"b", b"c", b"a", b"b", b"a"], [3, 2, 1])
    rows = {r["suffix"]: (r["n"] % collocations.OPEN, r["n"] // collocations.OPEN) for b in held.sent() for r in pa.Table.from_batches([b]).to_pylist()}
    assert rows == {b"a en b c ": (2, 1), b"b en c  ": (0, 1), b"c en   ": (0, 1), b"a en b  ": (2, 1), b"b en   ": (0, 1), b"a en   ": (1, 1)}
    assert not held.size and not held.ids


def test_exact_products(spark):
    """Products beyond 64 bits: counts as they would be of a corpus of many terabytes."""
    a, l, r = 3_000_000_007, 5_000_000_029, 4_000_000_007
    counted = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, l), ("en", "y", 1, r), ("en", "", 0, 10**11)], "lang string, phrase string, words int, f long")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(collocations, "phrase_counts", lambda *_, **__: counted)
        got = found(mine(counted.select("lang", "phrase"), text_col="phrase", max_n=2))
    assert got == [("en", 1, "x y", a, l, r, 10**11, 1000000 * a * a // (l * r))]


def test_edges(spark, docs, rows, empty):
    assert mine(empty).count() == 0
    with pytest.raises(ValueError):
        mine(docs, min_n=1)
    few = [(i, t) for i, t in rows if i < 106]
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = found(mine(docs.where("doc_id < 106"), least=4))
    assert got == sorted(brute.collocations([(langs[i], t) for i, t in few], least=4)) and got
    # one word over and over
    assert found(mine(docs.where("doc_id = 106")))[0][3:7] == (29998, 30000, 29999, 30000)
