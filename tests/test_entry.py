"""The registered queries against their DuckDB oracle, on the smallest tables."""

import importlib.util
import os

import pytest

from conftest import SF_SMALL
from lading.plans import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


entry = load("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
check = load("oracle_check", os.path.join(ROOT, "tools", "oracle_check.py"))
check.EXACT = True      # floats compared bit for bit


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["o_orderpriority", "n"] and len(rows) == 5


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = check.canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    want = check.canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert check.type_mismatches(df.schema, res.description) == {}
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
