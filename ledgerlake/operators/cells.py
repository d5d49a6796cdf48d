"""Mergeable partial aggregates of valid trades, and the gold facts from them.

A cell holds what all three daily facts need of one day's trades of a portfolio
in a symbol: counts, quantities, and exact decimal sums of prices, squared prices
and amounts.  Cells of two batches add up to the cell of both, so a late trade
costs its own cells and a merge of the touched days' cells; the day's trades are
not read again.  Every sum is exact, so facts from merged cells equal those from
all trades at once, whatever the batches.

Cells keep the portfolio in their key, so distinct portfolios are counted exactly
and a hot portfolio or symbol is many small rows at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import exact, quotient
from ..schemas import FACT_LIQUIDITY_COLUMNS
from . import gold

CELL_KEYS = ["ds", "portfolio_id", "symbol", "exchange", "sector"]
#: measures of a cell; all of them add up
PARTS = ["n", "buys", "sells", "qty", "buy_qty", "sell_qty", "prices", "buy_prices", "sell_prices",
         "n_price", "n_buy_price", "n_sell_price", "squares", "amount", "buy_amount", "sell_amount"]
#: A square keeps all 16 decimals of prices below 10^10.
SQUARED = "decimal(18,8)"


def cells(valid: DataFrame) -> DataFrame:
    """The cells of valid trades (with exchange and sector)."""
    price, amount = exact("price_usd"), exact("notional_usd")
    small = price.try_cast(SQUARED)

    def of(side: str | None, value: Column) -> Column:
        return value if side is None else F.when(F.col("side") == side, value)

    aggs = [F.count(F.lit(1)).alias("n")]
    for side, name in ((None, ""), ("BUY", "buy_"), ("SELL", "sell_")):
        aggs += [F.coalesce(F.sum(of(side, F.col("qty"))), F.lit(0)).cast("bigint").alias(f"{name}qty"),
                 F.coalesce(F.sum(of(side, price)), F.lit(0)).cast("decimal(36,8)").alias(f"{name}prices"),
                 F.count(of(side, price)).alias(f"n_{name}price"),
                 F.coalesce(F.sum(of(side, amount)), F.lit(0)).cast("decimal(36,8)").alias(f"{name}amount")]
        if side:
            aggs.append(F.count(of(side, F.lit(1))).alias(f"{side.lower()}s"))
    aggs.append(F.coalesce(F.sum(small * small), F.lit(0)).cast("decimal(38,16)").alias("squares"))
    return valid.groupBy(*CELL_KEYS).agg(*aggs).select(*CELL_KEYS, *PARTS)


def merged(some: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Cells added up to one per key (default: per cell)."""
    kinds = dict(some.dtypes)
    keys = keys or CELL_KEYS
    return some.groupBy(*keys).agg(*[F.sum(p).cast(kinds[p]).alias(p) for p in PARTS])


def pnl(some: DataFrame) -> DataFrame:
    """``gold.fact_pnl_daily`` from cells."""
    whole = merged(some, gold.PNL_KEYS).where((F.col("buys") + F.col("sells")) > 0)

    def side(name: str) -> Column:
        price = quotient(F.col(f"{name}_prices"), F.col(f"n_{name}_price"), gold.AVERAGE_SCALE)
        return F.struct(F.col(f"{name}_qty").alias("qty"),
                        F.coalesce(price.cast(gold.PRICE), F.lit(0).cast(gold.PRICE)).alias("price"),
                        F.col(f"{name}_amount").cast(gold.VALUE).alias("value"), F.col(f"{name}s").alias("n"))

    return gold._day_result(whole.select(*gold.PNL_KEYS, side("buy").alias("b"), side("sell").alias("s")))


def deviation(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from exact sums; 0 for one value.

    The squares are first freed of the mean in decimal, so nothing cancels in
    double: with S = n m + r, the sum of squared deviations is
    (SS - n m^2) - 2 m r - r^2 / n."""
    m = F.round(total.cast("decimal(28,8)") / n, 4).cast("decimal(13,4)")
    count = n.cast("decimal(10,0)")
    r = (total.cast("decimal(28,8)") - (count * m)).cast("double")
    apart = squares - (count * (m * m).cast("decimal(26,8)")).cast("decimal(38,16)")
    whole = apart.cast("double") - 2 * m.cast("double") * r - r * r / n
    return F.when(n > 1, F.sqrt(F.greatest(whole, F.lit(0.0)) / (n - 1))).otherwise(F.lit(0.0))


def liquidity(some: DataFrame) -> DataFrame:
    """``gold.fact_liquidity`` from cells: after merging, a portfolio is one cell."""
    kinds = dict(some.dtypes)
    add = lambda p: F.sum(p).cast(kinds[p]).alias(p)
    whole = merged(some).groupBy("ds", "symbol", "exchange", "sector").agg(
        *map(add, ("n", "qty", "n_price", "prices", "squares", "amount")),
        F.count("portfolio_id").cast("int").alias("unique_portfolios"))
    return whole.select(
        "*", F.col("qty").alias("total_volume"), F.col("amount").cast("double").alias("total_turnover_usd"),
        F.col("n").cast("int").alias("num_trades"),
        quotient(F.col("amount"), F.col("n"), gold.AVERAGE_SCALE).cast("double").alias("avg_trade_size"),
        deviation(F.col("n_price"), F.col("prices"), F.col("squares")).alias("price_volatility"),
    ).select(*FACT_LIQUIDITY_COLUMNS)


def activity(some: DataFrame) -> DataFrame:
    """``gold.fact_user_activity`` from cells."""
    per_symbol = merged(some, gold.PNL_KEYS).select(
        *gold.PNL_KEYS, "n", F.col("amount").alias("notional"), "buys", "sells")
    return gold.activity_of(per_symbol)


FACTS = {"pnl": pnl, "liquidity": liquidity, "activity": activity}
