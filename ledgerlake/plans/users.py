"""User-demographics reports over the PnL and activity facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import band, rank_of, round_half_up, safe_ratio
from .common import (RISK_ORDER, avg_from, left_window, money, per_grain, since,
                     user_portfolios, verified)

AGE_BANDS = [(30, "18-29"), (40, "30-39"), (50, "40-49"), (60, "50-59")]
AGE_BAND_TOP = "60+"
INCOME_BANDS = [(50000, "< $50K"), (100000, "$50K-$100K"), (200000, "$100K-$200K")]
INCOME_BAND_TOP = "$200K+"


def top_profitable_users(users: DataFrame, portfolios: DataFrame,
                         pnl: DataFrame, as_of: str, days: int = 7,
                         top_n: int = 20) -> DataFrame:
    """Verified users ranked by realised PnL over the window (inner joins)."""
    f = per_grain(since(pnl, as_of, days), ["portfolio_id", "symbol"],
                  {"pnl": F.col("realized_pnl_usd"),
                   "notional": F.col("notional_traded_usd")})
    keys = ["user_id", "name", "region", "risk_profile"]
    up = user_portfolios(verified(users), portfolios, keys)
    out = (f.join(up, on="portfolio_id", how="inner")
           .groupBy(*keys)
           .agg(F.countDistinct("portfolio_id").alias("num_portfolios"),
                money("pnl").alias("total_pnl_usd"),
                money("notional").alias("total_volume_usd"),
                F.countDistinct("symbol").alias("unique_symbols_traded")))
    return out.orderBy(F.desc_nulls_last("total_pnl_usd"), "user_id").limit(top_n)


def risk_profile_performance(users: DataFrame, portfolios: DataFrame,
                             pnl: DataFrame, as_of: str,
                             days: int = 30) -> DataFrame:
    j = left_window(users, portfolios, pnl, as_of, days, ["risk_profile"],
                    {"trades": F.col("num_trades"),
                     "pnl": F.col("realized_pnl_usd")})
    out = j.groupBy("risk_profile").agg(
        F.countDistinct("user_id").alias("num_users"),
        F.sum("trades").cast("bigint").alias("total_trades"),
        round_half_up(avg_from("trades"), 2).alias("avg_trades_per_portfolio"),
        round_half_up(F.sum("pnl"), 2).alias("total_pnl_usd"),
        round_half_up(avg_from("pnl"), 2).alias("avg_pnl_per_position"),
    )
    return out.orderBy(rank_of("risk_profile", RISK_ORDER).asc_nulls_last(),
                       "risk_profile")


def age_group_activity(users: DataFrame, portfolios: DataFrame,
                       activity: DataFrame, as_of: str,
                       days: int = 30) -> DataFrame:
    u = users.withColumn("age_group", band("metadata.age", AGE_BANDS, AGE_BAND_TOP))
    j = left_window(u, portfolios, activity, as_of, days, ["age_group"],
                    {"trades": F.col("num_trades"),
                     "score": F.col("activity_score"),
                     "notional": F.col("total_notional_usd")})
    out = j.groupBy("age_group").agg(
        F.countDistinct("user_id").alias("num_users"),
        F.sum("trades").cast("bigint").alias("total_trades"),
        round_half_up(avg_from("score"), 2).alias("avg_activity_score"),
        round_half_up(F.sum("notional"), 2).alias("total_traded_usd"),
    )
    return out.orderBy("age_group")


def income_bracket_activity(users: DataFrame, portfolios: DataFrame,
                            activity: DataFrame, as_of: str,
                            days: int = 30) -> DataFrame:
    u = users.withColumn("income_bracket", band("metadata.annual_income_usd",
                                                INCOME_BANDS, INCOME_BAND_TOP))
    j = left_window(u, portfolios, activity, as_of, days, ["income_bracket"],
                    {"trades": F.col("num_trades"),
                     "notional": F.col("total_notional_usd")})
    out = j.groupBy("income_bracket").agg(
        F.countDistinct("user_id").alias("num_users"),
        F.sum("trades").cast("bigint").alias("total_trades"),
        round_half_up(avg_from("notional"), 2).alias("avg_traded_per_user"),
    )
    labels = [label for _, label in INCOME_BANDS] + [INCOME_BAND_TOP]
    return out.orderBy(rank_of("income_bracket", labels, len(labels) + 1))


def activation_rate(users: DataFrame, portfolios: DataFrame,
                    activity: DataFrame, as_of: str,
                    months: int = 12) -> DataFrame:
    """Share of each monthly sign-up cohort that traded since signing up.

    Cohort: verified users created within ``months`` of ``as_of``.  A user
    is active when one of their portfolios has a trading day on or after the
    first day of the sign-up month.  The fact is reduced to its last active
    day per portfolio, then joined with the residual ``last_day >=
    signup_month`` (hash join on portfolio_id + residual condition).
    """
    start = F.add_months(F.lit(as_of).cast("date"), -months)
    cohorts = (verified(users)
               .filter((F.col("created_at") >= start.cast("timestamp_ntz"))
                       & (F.col("created_at") < F.date_add(F.lit(as_of).cast("date"), 1).cast("timestamp_ntz")))
               .select("user_id",
                       F.trunc(F.to_date("created_at"), "MM").alias("signup_month")))
    # No cohort starts before the month of ``start``: earlier days are pruned.
    in_reach = activity.filter(F.col("ds").between(F.trunc(start, "MM"), F.lit(as_of).cast("date")))
    last_active = (in_reach.filter(F.col("num_trades") > 0)
                   .groupBy("portfolio_id").agg(F.max("ds").alias("last_active_ds")))
    cp = cohorts.join(portfolios.select("portfolio_id", "user_id"),
                      on="user_id", how="left")
    j = cp.join(last_active,
                (cp.portfolio_id == last_active.portfolio_id)
                & (last_active.last_active_ds >= cp.signup_month),
                how="left")
    active = F.when(last_active.last_active_ds.isNotNull(), cp.user_id)
    out = j.groupBy(cp.signup_month).agg(
        F.countDistinct(cp.user_id).alias("new_users"),
        F.countDistinct(active).alias("active_users"),
    )
    rate = safe_ratio(F.col("active_users").cast("double") * 100.0,
                      F.col("new_users").cast("double"))
    return (out.withColumn("activation_rate_pct", round_half_up(rate, 2))
            .orderBy(F.desc("signup_month")))
