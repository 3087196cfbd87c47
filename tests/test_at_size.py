"""Faults that only larger tables have shown, on small ones."""

import random

from pyspark.sql import functions as F

from lumentrace.operators import contracts as C
from lumentrace.operators import critics
from lumentrace.operators import schemas
from lumentrace.operators import windows as W
from lumentrace.operators import wordings
from lumentrace.plans import catalog, inputs


def test_equal_starts_and_ids_stay_as_they_came(spark):
    s = [(2.0, "b", 1), (1.0, "a", 9), (1.0, "a", 3), (1.0, "a", 5)]
    d = spark.createDataFrame([(s,)], "segments array<struct<start_sec double, segment_id string, end_sec int>>")
    assert [tuple(x) for x in d.select(C.canonical("segments").alias("s")).first().s] == [s[1], s[2], s[3], s[0]]


def test_sums_before_over_rows_in_no_order(spark):
    """Rows come in another order each time, and so do the samples that ranges are drawn from."""
    n = 200_000

    def shuffled(batches):
        for b in batches:
            yield b.sample(frac=1)

    d = spark.range(0, n, 1, 8).select("id", (F.col("id") % 7).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("more")).mapInPandas(shuffled, "id long, n long, more string")
    want = F.lit(21) * F.floor(F.col("id") / 7) + (F.col("id") % 7) * (F.col("id") % 7 - 1) / 2
    assert W.sums_before(d, [], ["id"], "n", "before", 16).where((F.col("before") == want) & (F.length("more") == 64)).count() == n
    assert W.ranked(d, ["id"], "place", 16).where((F.col("place") == F.col("id") + 1) & (F.length("more") == 64)).count() == n


def test_frames_of_seven_digits(spark, tmp_path):
    spark.sql("SELECT id AS event_id, TIMESTAMP '2024-01-01 00:00:00' AS ts FROM VALUES (7L), (999999L), (1000001L), (12345678L) AS t(id)").write.parquet(str(tmp_path / "events.parquet"))
    assert {r.event_id: r.frame for r in catalog.queries()["utc_and_frame_names"](spark, str(tmp_path)).collect()} == {i: i for i in (7, 999_999, 1_000_001, 12_345_678)}


def test_documents_are_parsed_and_judged_once(spark):
    d = spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',), ("[]",), ("no",)], "t string")
    f = d.select(schemas.violation(F.try_parse_json("t"), schemas.an_object({"a": schemas.TEXT, "b": schemas.or_null(schemas.TEXT)})).alias("f"))
    assert [tuple(r.f) for r in f.collect()] == [("a", "type"), ("", "required"), ("", "type"), ("", "type")]
    assert f._jdf.queryExecution().analyzed().toString().count("parse_json(t") == 1


def test_answers_are_judged_once(spark):
    d = spark.createDataFrame([(1, '{"candidates": [{"weighted_total": "2.5"}], "best_index": 0}'), (2, '{"candidates": []}'), (3, None)], "clip_id long, content string")
    good, bad = critics.verdicts(d)
    assert [(r.clip_id, r.best_index, r.candidates[0].weighted_total) for r in good.collect()] == [(1, 0, 2.5)] and {r.clip_id for r in bad.collect()} == {2, 3}
    assert good._jdf.queryExecution().optimizedPlan().toString().count("$.candidates") == 1


def test_links_in_blocks(spark):
    """Pairs of blocks of few texts reach what all pairs do, and store no candidates: at most one link less than a pair of blocks has texts."""
    rng = random.Random(5)
    sets = [(f"c{i % 2}", i, rng.sample([f"w{k}" for k in range(14)], rng.randint(1, 9))) for i in range(160)] + [("c0", 500 + i, ["x", "y", "z"]) for i in range(60)] + [("c1", 900, [])]
    d = spark.createDataFrame(sets, "clip_id string, id long, w array<string>")

    def reached(links):
        to = {i: i for _, i, _ in sets}

        def find(i):
            while to[i] != i:
                i = to[i]
            return i

        for a, b in links:
            a, b = sorted((find(a), find(b)))
            to[b] = a
        return {i: find(i) for i in to}

    want = {(a, b) for c, a, v in sets for e, b, w in sets if c == e and a < b and v and w and 5 * len(set(v) & set(w)) >= 3 * len(set(v) | set(w))}
    for block in (7, 1000):
        got = [tuple(r) for r in wordings.near_links(d, 0.6, block).collect()]
        assert set(got) <= want and reached(got) == reached(want)
    assert len(got) < 2 * len(sets) < len(want)


def test_large_sources_are_written_as_several_archives(spark, tmp_path, monkeypatch):
    """One archive is one task's work; a source of many bytes has several, and the same members."""
    spark.range(600).selectExpr("id AS doc_id", "concat('s/', id % 2) AS source", "repeat(concat('w', id, ' '), cast(id AS int)) AS text").withColumn("n_chars", F.length("text")).write.parquet(str(tmp_path / "documents.parquet"))
    want = spark.sql("SELECT concat('s/', id % 2) AS source, count(*) AS members, sum(length(repeat(concat('w', id, ' '), cast(id AS int)))) AS bytes, min(sha2(repeat(concat('w', id, ' '), cast(id AS int)), 256)) AS sha FROM range(600) GROUP BY 1").collect()
    monkeypatch.setattr(inputs, "_ARCHIVE", 64 << 10)
    seen, members = [], inputs.archives.members
    monkeypatch.setattr(inputs.archives, "members", lambda files, **how: seen.append(files.select("path").distinct().count()) or members(files, **how))
    got = catalog.queries()["archive_sections"](spark, str(tmp_path)).collect()
    assert {(r.source, r.members, r.bytes, r.first_sha) for r in got} == {tuple(r) for r in want} and min(seen) > 8
    assert sum(r.long_members for r in got) == spark.read.parquet(str(tmp_path / "documents.parquet")).where("n_chars >= 1000").count()
