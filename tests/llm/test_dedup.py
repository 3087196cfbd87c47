"""Line, near and substring deduplication against plain versions."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lumentrace.llm import line_dedup, simhash, suffix_dedup
from lumentrace.llm.components import components


@pytest.mark.parametrize("bits", [{}, {"once_bits": 6, "twice_bits": 6, "segments": 2}, {"most_filter_bytes": 0}, {"most_filter_bytes": 0, "once_bits": 6, "twice_bits": 6, "segments": 2}])
def test_lines(docs, rows, bits):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text.encode()) for r in line_dedup.dedup_lines(docs, **bits).collect()}
    want = {i: x for (i, _), x in zip(rows, brute.dedup_lines(rows))}
    assert got == want and any(x[1] for x in want.values())


def test_segments_grow_with_the_texts(spark):
    d = spark.createDataFrame([("x" * 2100,)], "text string")
    assert line_dedup.segments_for(d, F.col("text"), 20) == 64
    # 21 bytes a key at least: a thousand million bytes need 91 segments
    many = spark.range(1000, numPartitions=4).select(F.lit("x").alias("text"))
    assert line_dedup.segments_for(many, F.repeat("text", F.lit(1_000_000)), 20) == 128


def test_lines_keep_columns_and_stand_empty_tables(docs, empty):
    out = line_dedup.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept", "KEY", "id", "doc", "n_lines", "n_dropped"]
    assert line_dedup.dedup_lines(empty).count() == 0


def test_lines_of_repeated_and_missing_ids(spark):
    line = "a line that is long enough"
    d = [(1, line), (1, line), (2, line + "\nown"), (None, line), (None, "x")]
    out = line_dedup.dedup_lines(spark.createDataFrame(d, "doc_id long, text string"))
    got = sorted((str(r.doc_id), r.text) for r in out.collect())
    assert got == sorted((str(i), k.decode()) for (i, _), (_, _, k) in zip(d, brute.dedup_lines(d)))


def test_bloom_filters_hold_what_was_added():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    b = line_dedup.Bits(20)
    b.add(h)
    assert b.holds(h).all() and b.folded().holds(h).all() and b.folded().bits < 20
    assert b.holds(rng.integers(0, 2**63, 5000, dtype=np.uint64)).mean() < 0.05


def test_near_copies(docs, rows):
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: x for (i, _), x in zip(rows, brute.simhash_groups(rows))}


def test_near_copies_edges(spark, empty):
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    d = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "other words here now"), (3, None), (9, "")], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(d).collect())
    assert got == [("3", "3"), ("7", "7"), ("7", "7"), ("9", "3"), ("None", "7")]
    assert sorted(str(r.doc_id) for r in simhash.keep_one(d).collect()) == ["3", "7", "7"]


@pytest.mark.parametrize(("spread", "most"), [(1, None), (40, None), (40, 20)])
def test_links_reach_all_pairs(spark, spread, most, monkeypatch):
    """Fingerprints in clusters: the index must find every group that all pairs give, also where long lists are cut."""
    if most:
        monkeypatch.setattr(simhash, "MOST_IN_LIST", most)
    rng = random.Random(spread)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        for _ in range(spread):
            fps.add(f)
            for _ in range(rng.randint(1, 4)):
                f ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    found = {(r.node, r.root) for r in components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")), "test").collect()}
    parent = dict.fromkeys(fps)
    groups = {f: {f} for f in fps}
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3 and groups[a] is not groups[b]:
                groups[a] |= groups[b]
                for x in groups[b]:
                    groups[x] = groups[a]
    to = dict(zip(fps, signed))
    want = {(to[f], min(to[x] for x in groups[f])) for f in parent if len(groups[f]) > 1}
    assert found == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(2000, 2300)] + [(5, 5), (None, 3)]  # the hub is one
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert len(got) == 602 and all(r == (0 if n <= 300 else 1000) for n, r in got.items())
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(25):
        t = np.array([rng.randint(0, rng.choice([0, 1, 3, 255])) for _ in range(rng.randint(1, 1500))], np.uint8)
        b, sa = t.tobytes(), suffix_dedup.suffix_array(t, 100)
        assert sorted(sa.tolist()) == list(range(len(b)))
        shared = suffix_dedup.common_prefixes(t, sa, 100, lanes=rng.choice([1, 7, 64]))
        for i in range(1, len(b)):
            x, y = b[sa[i - 1] :][:100], b[sa[i] :][:100]
            assert x <= y
            n = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert shared[i] == n


@pytest.mark.parametrize(("shard", "most", "whole", "confirm"), [(1 << 20, 1024, False, False), (2000, 1024, True, True), (2000, 2, False, True), (1 << 20, 1, True, False)])
def test_substrings(docs, rows, shard, most, whole, confirm):
    out = suffix_dedup.dedup_substrings(docs, whole_chars=whole, shard_bytes=shard, most_fragments=most, confirm=confirm).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept.encode() if whole else bytes(r.kept)) for r in out}
    want = brute.dedup_substrings(rows, whole_chars=whole)
    assert got == want and sum(x[1] > 0 for x in want.values()) > 5


def test_substrings_across_shards(spark):
    """One anchor in very many surroundings, cut into shards of a few fragments."""
    rng = random.Random(9)
    core = "".join(rng.choice("abcdefgh") for _ in range(90))
    noise = lambda: "".join(rng.choice("ABCDEFGH") for _ in range(60))
    rows = [(i, noise() + "xy"[i % 2] * 8 + core + "pq"[i % 3 % 2] * 8 + noise()) for i in range(80)]
    out = suffix_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), shard_bytes=500, most_fragments=7)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()} == brute.dedup_substrings(rows)


def test_rows_of_anchors_in_many_surroundings(spark, monkeypatch):
    """A phrase that is everywhere: what is staged stays within a few rows for each text, and is no row for each window."""
    rng = random.Random(12)
    noise = lambda: "".join(rng.choice("ABCDEFGHIJKL") for _ in range(110))
    made, stage = [], suffix_dedup.staged
    monkeypatch.setattr(suffix_dedup, "staged", lambda df, scope="": (lambda t: made.append(t.count()) or t)(stage(df, scope)))
    for phrase in ("".join(rng.choice("abcdefgh") for _ in range(n)) for n in (70, 95)):
        rows = [(i, noise() + phrase + noise()) for i in range(100)]
        made.clear()
        out = suffix_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), most_fragments=10)
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()} == brute.dedup_substrings(rows)
        assert 100 <= max(made) <= 600


def test_substrings_edges(spark, empty):
    assert suffix_dedup.dedup_substrings(empty).count() == 0
    rng = random.Random(6)
    t = "".join(rng.choice("abcdefghijkl") for _ in range(150))
    d = spark.createDataFrame([(1, t), (1, t), (None, "q" + t), (4, "q" + t)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_removed) for r in suffix_dedup.dedup_substrings(d).collect())
    assert got == [("1", 150), ("1", 150), ("4", 151), ("None", 0)]
    alone = spark.createDataFrame([(1, t), (1, t)], "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup.dedup_substrings(alone).collect()] == [0, 0]
    assert suffix_dedup.dedup_substrings(docs_with(spark)).columns == ["doc_id", "lang", "kept", "n_bytes", "n_removed", "n_spans"]


def docs_with(spark):
    return spark.createDataFrame([(1, "a", "b", 1)], "doc_id long, text string, lang string, N_BYTES int").withColumn("kept", F.lit(1))
