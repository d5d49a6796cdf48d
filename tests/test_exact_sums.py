"""Money is summed exactly: the same bytes whatever the order, the partitioning
and the number of shuffle partitions; averages against Python's Decimal."""

import datetime as dt
import struct
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.exprs import exact_sum, quotient, round_half_up
from ledgerlake.operators import gold, silver
from ledgerlake.plans import documented, regional, risk, users
from ledgerlake.sources import fixtures

SF = "/root/testdata/sf0.01"


def bits(rows):
    """Rows with their doubles as bytes."""
    def of(v):
        return struct.pack("<d", v) if isinstance(v, float) else str(v)
    return sorted(tuple(of(v) for v in r) for r in rows)


def all_results(spark, trades, t):
    valid = silver.valid_trades(silver.scored_trades(trades, t.symbols), columns=(
        "portfolio_id", "symbol", "side", "price_usd", "qty", "notional_usd", "exchange", "sector"))
    pnl, activity = gold.fact_pnl_daily(valid), gold.fact_user_activity(valid)
    u, p, day = t.users, t.portfolios, "2024-01-31"
    return {
        "pnl": pnl, "activity": activity, "liquidity": gold.fact_liquidity(valid).drop("price_volatility"),
        "profiles": users.risk_profile_performance(u, p, pnl, day),
        "regions": regional.regional_profitability(u, p, pnl, day),
        "losses": risk.loss_making_users(u, p, pnl, day),
        "means": documented.pnl_by_risk_profile(u, p, pnl)}


def test_results_do_not_depend_on_order_or_partitions(spark):
    t = fixtures.load(spark, SF)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = {}
    try:
        for n, salt in ((1, "a"), (8, "b"), (200, "c")):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            shuffled = t.trades.repartition(n, F.hash("trade_id", F.lit(salt))).sortWithinPartitions(
                F.hash(F.lit(salt), "trade_id"))
            for name, df in all_results(spark, shuffled, t).items():
                got = bits(df.collect())
                assert seen.setdefault(name, got) == got, (name, n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(seen.values())


def test_ties_of_half_cents(spark):
    """Doubles whose sum in any order misses the tie; exactly it is one."""
    rows = [(0.1,), (0.2,), (0.705,)] * 7 + [(1e9,), (-1e9,), (None,), (float("nan"),), (float("inf"),)]
    exact = sum(Decimal(repr(x)) for (x,) in rows if x is not None and abs(x) < 1e300)
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "x double").repartition(parts)
        got = df.agg(round_half_up(exact_sum("x"), 2), exact_sum("x").alias("s")).first()
        assert got.s == exact and got[0] == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP)) == 7.04


@pytest.mark.parametrize("values", [[10.0, 10.0, 10.01], [0.005, 0.005], [-1.0, -1.0, -1.01], [1e12, 0.01, 0.02]])
def test_averages_against_decimal(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(quotient(exact_sum("x"), F.count("x"), 10).alias("m"), gold.mean(F.col("x")).alias("n")).first()
    want = sum(Decimal(repr(v)) for v in values) / len(values)
    assert got.m == got.n == want.quantize(Decimal("1e-10"), ROUND_HALF_UP)
    none = df.where("x > 1e300").agg(gold.mean(F.col("x")).alias("m")).first()
    assert none.m is None


def test_prices_that_are_no_numbers_are_left_out(spark):
    rows = [(dt.date(2024, 1, 1), "P", "A", "BUY", x, 1, x) for x in (1.0, float("nan"), 2.0)]
    v = spark.createDataFrame(rows, "ds date, portfolio_id string, symbol string, side string, price_usd double, "
                                    "qty bigint, notional_usd double")
    r = gold.fact_pnl_daily(v).first()
    assert (r.avg_buy_price, r.notional_traded_usd, r.buy_qty, r.num_trades) == (1.5, 3.0, 3, 3)
