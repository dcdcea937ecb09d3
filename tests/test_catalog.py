"""Every query with SQL gives the SQL's rows on the smallest tables."""

import glob
import os

import pytest

from terrafold.plans import catalog, maps, registry  # noqa: F401

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    return round(float(v), 6) + 0.0 if isinstance(v, float) or type(v).__name__ in ("int", "Decimal", "float64") else str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DIR)
    got = df.collect()
    if name not in registry.ORACLES:
        assert got
        return
    rel = duck.sql(registry.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [df.columns.index(c) for c in sorted(df.columns)]
    theirs = [rel.columns.index(c) for c in sorted(rel.columns)]
    ours = sorted(([plain(r[i]) for i in order] for r in got), key=repr)
    assert ours == sorted(([plain(r[i]) for i in theirs] for r in rel.fetchall()), key=repr)


def test_plans_stay_in_the_jvm(spark):
    """Label queries: filters reach the files, and no Python runs on their rows (`biome_left_join` cuts its polygons with numpy before they meet points)."""
    plan = registry.QUERIES["labels_filter_full"](spark, DIR)._jdf.queryExecution().toString()
    assert "PushedFilters: [In(event_type" in plan or "PushedFilters: [IsNotNull(event_type)" in plan or "In(event_type" in plan
    for name in ("labels_filter_full", "thin_20m", "biome_left_join", "scl_masked_median", "month_subset", "maha_ood"):
        assert "Python" not in registry.QUERIES[name](spark, DIR)._jdf.queryExecution().toString()
