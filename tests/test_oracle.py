"""Tier 1: every key with an oracle equals its DuckDB SQL on the smallest test folder."""

from __future__ import annotations

import pytest

from helpers import duck_table, spark_table
from helpers import SF_SMALL


def _oracle_keys():
    from tessera.plans.registry import load_all

    return sorted(k for k, p in load_all().items() if p.oracle)


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", _oracle_keys())
def test_key_matches_oracle(spark, con, registry, key):
    p = registry[key]
    s_cols, s_rows = spark_table(p.build(spark, SF_SMALL))
    d_cols, d_rows = duck_table(con, p.oracle)
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) == {"category_name", "total_orders", "units_sold", "total_revenue",
                               "avg_selling_price", "profit"}
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
