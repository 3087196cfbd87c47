"""Every query with SQL gives the rows of DuckDB; the others give rows."""

import os

import duckdb
import pytest

from lumentrace.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr(tuple(None if x is None or x != x else x.item() if hasattr(x, "item") else x for x in r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, duck, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_order_of_input_does_not_matter(spark, tmp_path):
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    spark.read.parquet(f"{SF}/events.parquet").repartition(7, "value").write.parquet(str(tmp_path / "events.parquet"))
    for name in ("event_gap_segments", "event_merge_gaps", "event_latest_state", "event_trail_last6"):
        q = catalog.queries()[name]
        assert rows(q(spark, SF).toPandas()) == rows(q(spark, str(tmp_path)).toPandas())
