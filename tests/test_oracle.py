"""Every registered query equals its DuckDB SQL twin (sf0.001), and the
driver contract (entry / queries / oracle_sql) is consistent."""

import pytest

import __spark_entry__ as entry_mod
from eventide.plans import ORACLE, QUERIES
from eventide.plans.compare import compare, duck, type_diffs

from .conftest import SF001


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_contract(spark):
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    df = entry_mod.entry(spark)
    assert df.count() >= 0 and "burn_rate" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF001)
    assert type_diffs(df, con, ORACLE[name]) == {}
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, msg
