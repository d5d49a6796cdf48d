"""Risk reports: concentration, large aggressive traders, losses, mismatch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import round_half_up, safe_ratio
from .common import avg_from, money, per_grain, since, user_portfolios, verified

CONCENTRATION_MIN_SHARE = 0.30
CONCENTRATION_CRITICAL_SHARE = 0.50
AGGRESSIVE_PROFILES = ["very_aggressive", "aggressive"]
# (min distinct symbols, min volume USD, label), first match wins.
BEHAVIOUR_STEPS = [(15, 50000, "Very Aggressive"), (10, 30000, "Aggressive"),
                   (5, 10000, "Moderate")]
BEHAVIOUR_FLOOR = "Conservative"
# Declared profile → volume above which trading contradicts it.
MISMATCH_VOLUME = {"conservative": 30000, "moderate": 50000}


def portfolio_concentration(users: DataFrame, portfolios: DataFrame,
                            pnl: DataFrame, as_of: str, days: int = 30,
                            min_share: float = CONCENTRATION_MIN_SHARE,
                            critical_share: float = CONCENTRATION_CRITICAL_SHARE,
                            top_n: int = 50) -> DataFrame:
    """(portfolio, symbol) pairs holding more than ``min_share`` of the
    portfolio's traded notional in the window, for verified users.

    Per-(portfolio, symbol) sums first (partial aggregation), then the
    portfolio total as a window sum over that small result.
    """
    ps = per_grain(since(pnl, as_of, days), ["portfolio_id", "symbol"],
                   {"symbol_notional": F.col("notional_traded_usd")})
    ps = ps.withColumn("total_notional", F.sum("symbol_notional").over(
        Window.partitionBy("portfolio_id")))
    share = safe_ratio(F.col("symbol_notional").cast("double"), F.col("total_notional").cast("double"))
    hot = ps.withColumn("share", share).filter(F.col("share") > min_share)
    keys = ["user_id", "name", "region", "risk_profile"]
    up = user_portfolios(verified(users), portfolios, keys)
    out = hot.join(up, on="portfolio_id", how="inner").select(
        *keys, "portfolio_id", "symbol",
        round_half_up("symbol_notional", 2).alias("symbol_volume_usd"),
        round_half_up("total_notional", 2).alias("portfolio_total_usd"),
        round_half_up(F.col("share") * 100, 2).alias("concentration_pct"),
        F.when(F.col("share") > critical_share, "CRITICAL")
        .when(F.col("share") > min_share, "HIGH")
        .otherwise("MODERATE").alias("risk_level"),
    )
    return (out.orderBy(F.desc("concentration_pct"), "portfolio_id", "symbol")
            .limit(top_n))


def high_risk_users(users: DataFrame, portfolios: DataFrame, pnl: DataFrame,
                    as_of: str, days: int = 30, min_volume: float = 100000,
                    profiles: list[str] = AGGRESSIVE_PROFILES,
                    top_n: int = 30) -> DataFrame:
    """Aggressive-profile verified users trading more than ``min_volume``."""
    f = per_grain(since(pnl, as_of, days), ["portfolio_id", "symbol"],
                  {"notional": F.col("notional_traded_usd"),
                   "abs_pnl": F.abs("realized_pnl_usd")})
    u = verified(users).filter(F.col("risk_profile").isin(*profiles))
    keys = ["user_id", "name", "risk_profile"]
    j = user_portfolios(u, portfolios, keys).join(f, on="portfolio_id", how="left")
    out = (j.groupBy(*keys)
           .agg(F.countDistinct("portfolio_id").alias("num_portfolios"),
                money("notional").alias("total_volume_30d"),
                F.countDistinct("symbol").alias("unique_symbols"),
                round_half_up(avg_from("abs_pnl"), 2).alias("avg_absolute_pnl"))
           .filter(F.col("total_volume_30d") > min_volume))
    return (out.orderBy(F.desc("total_volume_30d"), "user_id").limit(top_n))


def loss_making_users(users: DataFrame, portfolios: DataFrame, pnl: DataFrame,
                      as_of: str, days: int = 30, max_pnl: float = -1000,
                      min_trades: int = 10, top_n: int = 30) -> DataFrame:
    """Verified users with Σ PnL < ``max_pnl`` over > ``min_trades`` trades."""
    f = per_grain(since(pnl, as_of, days), ["portfolio_id", "ds"],
                  {"pnl": F.col("realized_pnl_usd"),
                   "trades": F.col("num_trades")})
    keys = ["user_id", "name", "region", "risk_profile"]
    up = user_portfolios(verified(users), portfolios, keys)
    out = (f.join(up, on="portfolio_id", how="inner")
           .groupBy(*keys)
           .agg(F.countDistinct("ds").alias("trading_days"),
                F.sum("trades").cast("bigint").alias("total_trades"),
                F.sum("pnl").alias("_pnl"),
                avg_from("pnl").alias("_avg"))
           .filter((F.col("_pnl") < max_pnl) & (F.col("total_trades") > min_trades))
           .select(*keys, "trading_days", "total_trades",
                   round_half_up("_pnl", 2).alias("total_pnl_usd"),
                   round_half_up("_avg", 2).alias("avg_pnl_per_day")))
    return (out.orderBy(F.asc_nulls_last("total_pnl_usd"), "user_id").limit(top_n))


def behaviour_label(symbols: str = "symbols_traded", volume: str = "total_volume"):
    s, v = F.col(symbols), F.col(volume)
    expr = None
    for min_sym, min_vol, label in BEHAVIOUR_STEPS:
        cond = (s > min_sym) & (v > min_vol)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(BEHAVIOUR_FLOOR)


def risk_mismatch(users: DataFrame, portfolios: DataFrame, pnl: DataFrame,
                  as_of: str, days: int = 30,
                  thresholds: dict[str, float] = MISMATCH_VOLUME) -> DataFrame:
    """Portfolios whose traded volume contradicts the declared risk profile."""
    per_sym = per_grain(since(pnl, as_of, days), ["portfolio_id", "symbol"],
                        {"notional": F.col("notional_traded_usd"),
                         "abs_pnl": F.abs("realized_pnl_usd"),
                         "trades": F.col("num_trades")})
    tb = (per_sym.join(portfolios.select("portfolio_id", "user_id"),
                       on="portfolio_id", how="inner")
          .groupBy("portfolio_id", "user_id")
          .agg(F.count("symbol").alias("symbols_traded"),      # one row per symbol
               F.sum("notional").alias("total_volume"),
               avg_from("abs_pnl").alias("avg_absolute_pnl"),
               F.sum("trades").cast("bigint").alias("total_trades")))
    u = verified(users).select("user_id", "name", "risk_profile")
    mismatch = None
    for profile, vol in thresholds.items():
        cond = (F.col("risk_profile") == profile) & (F.col("total_volume") > vol)
        mismatch = cond if mismatch is None else (mismatch | cond)
    out = (u.join(tb, on="user_id", how="inner").filter(mismatch)
           .select("user_id", "name",
                   F.col("risk_profile").alias("declared_profile"),
                   behaviour_label().alias("actual_behavior"),
                   "symbols_traded",
                   round_half_up("total_volume", 2).alias("total_volume_usd"),
                   "total_trades", F.col("total_volume").alias("_v"),
                   "portfolio_id"))
    return out.orderBy(F.desc("_v"), "portfolio_id").drop("_v", "portfolio_id")
