"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import canon, duck
from tests.conftest import SF_SMALL

from spendwatch.plans.oracle import oracle_sql
from spendwatch.plans.registry import queries

QUERIES = queries()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    scols, srows = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLES[name])
    dcols, drows = canon([c[0] for c in res.description], res.fetchall())
    assert scols == dcols
    assert srows == drows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["workspace_id", "snapshot_ts", "snapshot_date"]
    assert df.count() > 0
