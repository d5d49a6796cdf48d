"""Cross-fact invariants on the sf0.01 fixture."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import gold
from ledgerlake.plans.catalog import PNL_MEASURES, Lake

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, SF)


def test_trade_counts_agree(lake):
    v = lake.valid()
    n_valid = v.filter(F.col("side").isin("BUY", "SELL")).count()
    assert 8000 < n_valid < 10000
    sums = [f.agg(F.sum("num_trades")).first()[0]
            for f in (lake.pnl, lake.liquidity, lake.activity)]
    assert sums == [n_valid] * 3


def test_notional_agrees_across_facts(lake):
    tot = [f.agg(F.sum(c)).first()[0] for f, c in (
        (lake.pnl, "notional_traded_usd"), (lake.liquidity, "total_turnover_usd"),
        (lake.activity, "total_notional_usd"))]
    assert max(tot) - min(tot) < 1e-6 * max(tot)


def test_outer_join_plan_equals_single_aggregation(lake):
    from ledgerlake.functions.exprs import stabilize
    a = stabilize(lake.pnl, PNL_MEASURES)
    b = stabilize(gold.pnl_outer_join(lake.valid()), PNL_MEASURES)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_most_traded_window_equals_fold(lake):
    w = gold.most_traded_symbol(lake.valid()).select("ds", "portfolio_id", "most_traded_symbol")
    f = lake.activity.select("ds", "portfolio_id", "most_traded_symbol")
    assert w.exceptAll(f).count() == 0 and f.exceptAll(w).count() == 0


def test_unique_symbols_equals_pnl_cells(lake):
    cells = lake.pnl.groupBy("ds", "portfolio_id").agg(F.count(F.lit(1)).alias("n"))
    j = lake.activity.join(cells, on=["ds", "portfolio_id"], how="full_outer")
    assert j.filter(F.col("n").isNull() | F.col("unique_symbols").isNull()
                    | (F.col("n") != F.col("unique_symbols"))).count() == 0


def test_concentration_shares_sum_to_one(lake):
    ps = lake.pnl.groupBy("portfolio_id", "symbol").agg(F.sum("notional_traded_usd").alias("x"))
    share = ps.withColumn("s", F.col("x") / F.sum("x").over(Window.partitionBy("portfolio_id")))
    bad = share.groupBy("portfolio_id").agg(F.sum("s").alias("t")).filter(F.abs(F.col("t") - 1) > 1e-9)
    assert bad.count() == 0
