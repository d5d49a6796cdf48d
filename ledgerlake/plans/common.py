"""Building blocks shared by the business reports.

Reports join daily facts (large, grow with time × portfolios) to the
customer tables (users, portfolios; grow with customers).  Each report first
filters the fact to its date window (partition pruning on ``ds`` when the
fact is a written table), then **pre-aggregates it to the grain the report
needs** (portfolio, or portfolio × symbol, or portfolio × day) before the
join, so the join and the final shuffle carry one row per portfolio instead
of one per fact row.  Averages over fact rows are re-assembled exactly as
Σ value / Σ row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import FACT_SCALE, exact, quotient

VERIFIED = "verified"
# Custom display order of risk profiles (most aggressive first).
RISK_ORDER = ["very_aggressive", "aggressive", "moderate", "conservative"]


def window_start(as_of: str, days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), days)


def since(fact: DataFrame, as_of: str | None, days: int | None) -> DataFrame:
    """Rows with ``as_of − days <= ds <= as_of`` (no filter when days is None)."""
    if days is None or as_of is None:
        return fact
    return fact.filter(F.col("ds").between(window_start(as_of, days), F.lit(as_of).cast("date")))


def verified(users: DataFrame) -> DataFrame:
    return users.filter(F.col("kyc_status") == VERIFIED)


def owners(portfolios: DataFrame) -> DataFrame:
    return portfolios.select("portfolio_id", "user_id")


def user_portfolios(users: DataFrame, portfolios: DataFrame,
                    user_cols: list[str]) -> DataFrame:
    """users ⋈ portfolios (inner), keeping ``user_cols`` + portfolio_id."""
    u = users.select(*dict.fromkeys(["user_id", *user_cols]))
    return u.join(owners(portfolios), on="user_id", how="inner")


def per_grain(fact: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Pre-aggregate a fact to ``keys``: each of ``sums`` (name → measure)
    becomes its sum and, as ``n_<name>``, the number of its non-null values.
    Sums of DOUBLE measures are exact DECIMALs."""
    kinds = dict(fact.select(*[m.alias(n) for n, m in sums.items()]).dtypes)
    aggs = []
    for name, measure in sums.items():
        m = exact(measure, FACT_SCALE) if kinds[name] == "double" else measure
        aggs += [F.sum(m).alias(name), F.count(m).alias(f"n_{name}")]
    return fact.groupBy(*keys).agg(*aggs)


def left_window(users: DataFrame, portfolios: DataFrame, fact: DataFrame,
                as_of: str | None, days: int | None, user_cols: list[str],
                sums: dict[str, Column]) -> DataFrame:
    """verified users ⋈ portfolios ⟕ (fact in window, pre-aggregated per
    portfolio).

    The window predicate is applied to the fact *before* the outer join —
    ON-clause semantics: portfolios without facts survive with NULLs.
    """
    f = per_grain(since(fact, as_of, days), ["portfolio_id"], sums)
    up = user_portfolios(verified(users), portfolios, user_cols)
    return up.join(f, on="portfolio_id", how="left")


def avg_from(name: str) -> Column:
    """AVG of a measure of ``per_grain``: Σ sums / Σ counts of its values, exact
    to 16 decimals (DECIMAL)."""
    return quotient(F.sum(name), F.sum(f"n_{name}"), 16)


def money(name: str) -> Column:
    """Σ of a measure of ``per_grain`` as DOUBLE."""
    return F.sum(name).cast("double")
