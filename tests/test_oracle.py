"""Every catalog query against its independent DuckDB oracle (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from ledgerlake.plans import catalog  # noqa: E402
from oracle_check import compare  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    from ledgerlake.oracle import oracle_queries
    assert set(catalog.queries()) == set(oracle_queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, name):
    r = compare(spark, SF, [name], verbose=False)[name]
    assert "error" not in r, r.get("error")
    assert r["cols_match"], r
    assert not r["type_mismatches"], r["type_mismatches"]
    assert r["values_match"], r.get("diff")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "name", "region", "risk_profile", "num_portfolios",
                          "total_pnl_usd", "total_volume_usd", "unique_symbols_traded"]
