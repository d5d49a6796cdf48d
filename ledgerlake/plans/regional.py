"""Regional reports over the PnL and activity facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import rank_of, round_half_up, safe_ratio
from .common import (RISK_ORDER, avg_from, left_window, money, per_grain, since,
                     user_portfolios, verified)


def regional_volume(users: DataFrame, portfolios: DataFrame,
                    activity: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    j = left_window(users, portfolios, activity, as_of, days, ["region"],
                    {"trades": F.col("num_trades"),
                     "notional": F.col("total_notional_usd"),
                     "score": F.col("activity_score")})
    out = j.groupBy("region").agg(
        F.countDistinct("user_id").alias("num_users"),
        F.count("portfolio_id").alias("num_portfolios"),    # one row per portfolio
        F.sum("trades").cast("bigint").alias("total_trades"),
        round_half_up(F.sum("notional"), 2).alias("total_volume_usd"),
        round_half_up(avg_from("score"), 2).alias("avg_activity_score"),
    )
    return out.orderBy(F.desc_nulls_last("total_volume_usd"), "region")


def regional_profitability(users: DataFrame, portfolios: DataFrame,
                           pnl: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    j = left_window(users, portfolios, pnl, as_of, days, ["region"],
                    {"pnl": F.col("realized_pnl_usd"),
                     "notional": F.col("notional_traded_usd")})
    out = j.groupBy("region").agg(
        F.countDistinct("user_id").alias("num_users"),
        round_half_up(F.sum("pnl"), 2).alias("total_pnl_usd"),
        round_half_up(avg_from("pnl"), 2).alias("avg_pnl_per_position"),
        round_half_up(safe_ratio(money("pnl"), money("notional")) * 100, 4)
        .alias("roi_percentage"),
    )
    return out.orderBy(F.desc_nulls_last("total_pnl_usd"), "region")


def regional_risk_distribution(users: DataFrame, portfolios: DataFrame,
                               activity: DataFrame, as_of: str,
                               days: int = 7) -> DataFrame:
    j = left_window(users, portfolios, activity, as_of, days,
                    ["region", "risk_profile"], {"trades": F.col("num_trades")})
    out = j.groupBy("region", "risk_profile").agg(
        F.countDistinct("user_id").alias("num_users"),
        F.sum("trades").cast("bigint").alias("total_trades"),
    )
    return out.orderBy("region", rank_of("risk_profile", RISK_ORDER).asc_nulls_last())


def regional_symbol_preferences(users: DataFrame, portfolios: DataFrame,
                                pnl: DataFrame, as_of: str, days: int = 30,
                                min_trades: int = 10) -> DataFrame:
    """Region × symbol activity, kept where Σ trades > ``min_trades``."""
    f = per_grain(since(pnl, as_of, days), ["portfolio_id", "symbol"],
                  {"trades": F.col("num_trades"),
                   "notional": F.col("notional_traded_usd")})
    up = user_portfolios(verified(users), portfolios, ["region"])
    out = (f.join(up, on="portfolio_id", how="inner")
           .groupBy("region", "symbol")
           .agg(F.count("portfolio_id").alias("num_portfolios_traded"),   # unique per symbol
                F.sum("trades").cast("bigint").alias("total_trades"),
                F.sum("notional").alias("_volume"))
           .filter(F.col("total_trades") > min_trades)
           .select("region", "symbol", "num_portfolios_traded", "total_trades",
                   round_half_up("_volume", 2).alias("total_volume_usd")))
    return out.orderBy("region", F.desc("total_volume_usd"), "symbol")
