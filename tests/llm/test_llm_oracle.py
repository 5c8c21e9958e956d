"""Queries against DuckDB where SQL can express them."""

import pytest

from spendwatch.llm.oracle import oracle_sql
from spendwatch.llm.queries import queries
from tests.conftest import SF_SMALL
from tools.oracle_check import canon, duck


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    df = queries()[name](spark, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck(SF_SMALL).execute(oracle_sql()[name])
    assert got == canon([c[0] for c in res.description], res.fetchall())
