"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from tessella import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def _cell(x):
    if pd.isna(x):
        return "null"
    if isinstance(x, bool):
        return str(x)
    try:
        return f"{float(x):.6f}"
    except (TypeError, ValueError):
        return str(x)


def _rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(_cell(x) for x in row) for row in frame[names].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    got = _rows(catalogue.queries()[name](spark, DATA).toPandas())
    if name in catalogue.oracle_sql():
        assert got == _rows(duck.sql(catalogue.oracle_sql()[name]).df())
    else:
        assert got[1]


def test_no_cartesian_plans(spark):
    """Joins of two growing tables are never products; one-row and sized sides are broadcast."""
    for name in ("asof_interpolate", "asof_band_keyframes", "neighbour_edges", "knn_join", "block_ata", "pair_correlation", "depth_consistency", "schur_diag"):
        plan = catalogue.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name


def test_scans_read_few_columns(spark):
    plan = catalogue.queries()["topk_per_group"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan
    plan = catalogue.queries()["scatter_sum"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in plan and "l_shipdate" not in plan


def test_entry_imports_without_corpus_operators():
    import importlib.util

    import __spark_entry__

    assert set(catalogue.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    if importlib.util.find_spec("tessella.llm") is None:
        assert set(catalogue.queries()) == set(__spark_entry__.queries())
