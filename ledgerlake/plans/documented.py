"""The documented report variants: all-time (or 7-day) joins without the
KYC filter, as written in the project's prose examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import band
from .common import avg_from, money, per_grain, user_portfolios, window_start

YOUNG_MIDDLE_SENIOR = [(30, "Young (18-29)"), (50, "Middle (30-49)")]
SENIOR = "Senior (50+)"
YOUNG_SPLIT = [(30, "Young")]
SENIOR_SPLIT = "Senior"


def pnl_by_region(users: DataFrame, portfolios: DataFrame, pnl: DataFrame,
                  as_of: str, recent_days: int = 7) -> DataFrame:
    """Σ realised PnL per region up to ``as_of``, and over the last
    ``recent_days`` (NULL when the region has no facts in that window)."""
    recent = F.col("ds") >= window_start(as_of, recent_days)
    until = pnl.filter(F.col("ds") <= F.lit(as_of).cast("date"))
    f = per_grain(until, ["portfolio_id"],
                  {"pnl": F.col("realized_pnl_usd"),
                   "pnl_recent": F.when(recent, F.col("realized_pnl_usd"))})
    out = (f.join(user_portfolios(users, portfolios, ["region"]),
                  on="portfolio_id", how="inner")
           .groupBy("region")
           .agg(money("pnl").alias("total_pnl_usd"),
                money("pnl_recent").alias("pnl_last_7d_usd")))
    return out.orderBy(F.desc_nulls_last("total_pnl_usd"), "region")


def pnl_by_risk_profile(users: DataFrame, portfolios: DataFrame,
                        pnl: DataFrame) -> DataFrame:
    """Mean realised PnL per fact row, by declared risk profile."""
    f = per_grain(pnl, ["portfolio_id"], {"pnl": F.col("realized_pnl_usd")})
    out = (f.join(user_portfolios(users, portfolios, ["risk_profile"]),
                  on="portfolio_id", how="inner")
           .groupBy("risk_profile").agg(avg_from("pnl").cast("double").alias("avg_pnl")))
    return out.orderBy(F.desc_nulls_last("avg_pnl"), "risk_profile")


def activity_by_age_band(users: DataFrame, portfolios: DataFrame,
                         activity: DataFrame) -> DataFrame:
    u = users.withColumn("age_group",
                         band("metadata.age", YOUNG_MIDDLE_SENIOR, SENIOR))
    f = per_grain(activity, ["portfolio_id"],
                  {"trades": F.col("num_trades"), "score": F.col("activity_score")})
    return (f.join(user_portfolios(u, portfolios, ["age_group"]),
                   on="portfolio_id", how="inner")
            .groupBy("age_group")
            .agg(avg_from("trades").cast("double").alias("avg_trades"),
                 avg_from("score").cast("double").alias("avg_activity")))


def activity_by_age_split(users: DataFrame, portfolios: DataFrame,
                          activity: DataFrame) -> DataFrame:
    u = users.withColumn("age_group", band("metadata.age", YOUNG_SPLIT, SENIOR_SPLIT))
    f = per_grain(activity, ["portfolio_id"], {"score": F.col("activity_score")})
    return (f.join(user_portfolios(u, portfolios, ["age_group"]),
                   on="portfolio_id", how="inner")
            .groupBy("age_group")
            .agg(avg_from("score").cast("double").alias("avg_activity_score")))
