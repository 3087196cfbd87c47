"""Queries over whole tables and texts, where those beside them are bound by their SQL to less."""

from lumentrace.operators import joins as J
from lumentrace.plans import catalog


def test_passages_inside_longer_lines(spark):
    p = "alpha beta gamma delta epsilon zeta eta theta"
    docs = [(1, f"before it {p} and after"), (2, p), (3, f"xx{p}yy\nmore"), (4, p.replace("zeta", "Zeta")), (5, "beta gamma"), (6, None), (7, ""), (8, "a gamma delta epsilon b"), (9, "eta\ntheta"), (10, "gamma delta epsilon zeta eta the")]
    items = [(1, p), (2, "gamma"), (3, ""), (4, None), (5, "a delta\nepsilon")]
    got = J.contained(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    want = {(d, i) for d, t in docs for i, x in items if t and x and (t in x or x in t)}
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want) and (1, 1) in want and (3, 1) in want


def test_labels_of_all_orders(spark, tmp_path):
    types = [(i, f"TYPE {i}") for i in range(1, 60)] + [(60, "RARE 1-URGENT KIND")]
    spark.createDataFrame(types, "p_partkey long, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1, "1-URGENT"), (2, "TYPE 55"), (3, "none"), (50, "2-HIGH"), (51, None)], "o_orderkey long, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    got = {r.o_orderkey: r.label for r in catalog.queries()["label_containment_all"](spark, str(tmp_path)).collect()}
    assert got == {1: "RARE 1-URGENT KIND", 2: "TYPE 55", 50: "2-HIGH LEVEL"}


def test_short_texts_in_each_other(spark):
    left, right = ["ab", "b", "xyz", "", None, "éa"], ["xabx", "b", "zz", "a", "xyz", "é"]
    a, b = (spark.createDataFrame([(x,) for x in v], f"{n} string") for v, n in ((left, "o"), (right, "l")))
    got = {tuple(r) for r in J.short_contained(a, "o", b, "l").collect()}
    assert got == {(x, y) for x in left for y in right if x and y and (x in y or y in x)}
    assert J.short_contained(a.where("o = 'none'"), "o", b, "l").count() == 0


def test_cut_at_the_limit_of_the_reference(spark, tmp_path):
    spark.createDataFrame([(1, "x" * 5000), (2, "x" * 30_001), (3, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    counted = {r.doc_id: (r.n, r.cut) for r in catalog.queries()["doc_truncate_context"](spark, str(tmp_path)).collect()}
    assert counted == {1: (5000, False), 2: (30_020, True), 3: (None, False)}
    got = {r.doc_id: (r.n, r.cut) for r in catalog.queries()["doc_truncate_context_30k"](spark, str(tmp_path)).collect()}
    assert got == {1: (5000, False), 2: (30_006, True), 3: (None, False)}
