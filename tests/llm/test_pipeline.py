"""The pipeline against plain versions of its stages, and the queries against their SQL."""

import os

import brute
import pytest
from pyspark.sql import functions as F
from test_text import _check_packing

import corpus_pipeline
from lumentrace.llm import queries

P = pytest.importorskip("public_tokenizers")


def test_pipeline(spark, docs, rows, tmp_path):
    from tokenizers import Tokenizer

    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    host = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    clean = brute.without_boilerplate([(i, t, host[i]) for i, t in rows])
    left = []
    for i, t in rows:
        n, _, _, _, repeated = brute.base_metrics(t)
        if n >= 20 and 100 * repeated <= 30 * n and clean[i][0] <= 0.7:
            left.append((i, clean[i][1]))
    assert any(t != clean[i][1] for i, t in rows if t)
    left = [(i, k.decode()) for (i, _), (_, _, k) in zip(left, brute.dedup_lines(left))]
    groups = brute.near_groups(left)
    left = [d for d in left if groups[d[0]] == d[0]]
    left = [(i, x[3].decode()) for i, x in brute.dedup_substrings(left, whole_chars=True).items()]
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == {i for i, _ in left} and len(left) > 10
    _check_packing(out, {i: t.encode(x, add_special_tokens=False).ids + [1] for i, x in left}, 2048)


def test_results_outlive_other_runs(spark, docs, tmp_path):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    a = corpus_pipeline.run(spark, str(tmp_path))
    n = a.count()
    b = corpus_pipeline.run(spark, str(tmp_path))
    assert a.count() == n == b.count()


def test_no_folder_of_one_machine_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from lumentrace.llm import common

    monkeypatch.setattr(common, "ready", lambda s: s)
    conf = SimpleNamespace(get=lambda *a: None)
    away = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://x:7077"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_root(away)


def test_stages_keep_the_columns(spark, docs, empty, tmp_path):
    d = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, d, str(tmp_path))
        assert out.dtypes == d.dtypes
        out.write.parquet(str(tmp_path / str(i)))
        d = spark.read.parquet(str(tmp_path / str(i)))
        assert d.where(F.col("n_chars") != F.length("text")).count() == 0
    none = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_give_the_rows_of_their_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries.queries()[name](spark, SF).toPandas(), c.execute(queries.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    key = lambda f: sorted(repr(tuple(x.item() if hasattr(x, "item") else x for x in r)) for r in f[columns].astype(object).itertuples(index=False, name=None))
    assert key(got) == key(want)
