"""The corpus queries against their DuckDB twins, on the smallest tables."""

import os

import pytest
from conftest import SF_SMALL
from test_entry import check, duck  # noqa: F401

from lading.llm import queries


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert os.path.exists(os.path.join(os.path.dirname(queries.__file__), "..", "..", "corpus_pipeline.py"))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, duck, name):  # noqa: F811
    df = queries.QUERIES[name](spark, SF_SMALL)
    got = check.canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(queries.ORACLE[name])
    want = check.canon([d[0] for d in res.description], res.fetchall())
    assert got == want
    assert check.type_mismatches(df.schema, res.description) == {}
