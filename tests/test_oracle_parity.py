"""Every registered query against its DuckDB oracle on the sf0.001 tables.

Same gate as the driver: row count, column names and an order-insensitive
hash of all values.
"""

import pytest

from kpistar.oracle.check import compare
from kpistar.oracle.queries import ORACLE
from kpistar.registry import QUERIES

from conftest import SF_SMALL


def test_every_query_has_an_oracle():
    assert sorted(set(QUERIES) - set(ORACLE)) == []


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, key):
    df = QUERIES[key](spark, SF_SMALL)
    r = compare(df, duck_small, ORACLE[key], show_diff=3)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_entry_contract(spark):
    import __spark_entry__ as entry_mod
    df = entry_mod.entry(spark)
    assert df.count() > 0
    # the training-data queries, where installed, come on top; not all of them have SQL
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
