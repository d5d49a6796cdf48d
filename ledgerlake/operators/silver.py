"""Silver layer: trades enriched with symbol metadata, validity and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TRADES_ENRICHED_COLUMNS
from .asof import asof_join


def scored_trades(trades: DataFrame, symbols: DataFrame,
                  with_processed_ts: bool = True) -> DataFrame:
    """Left-join trades to the symbol master and score each row.

    * ``price_usd`` = ``price`` (all prices are USD), ``notional_usd`` =
      ``price_usd * qty``.
    * ``is_valid`` = price > 0 AND qty > 0 AND symbol and exchange present;
      three-valued: a NULL price on a listed symbol gives NULL.
    * ``quality_score``: 100; 50 when ``is_valid`` is false (NULL does not
      count as false); then −10 when sector is missing.  An unlisted symbol
      therefore scores 40, a listed one without sector 90.
    """
    sym = symbols.select("symbol", "exchange", "sector")
    return score(trades.join(sym, on="symbol", how="left"), with_processed_ts)


def score(j: DataFrame, with_processed_ts: bool = True) -> DataFrame:
    """Validity and quality of trades that have their exchange and sector."""
    is_valid = ((F.col("price") > 0) & (F.col("qty") > 0)
                & F.col("symbol").isNotNull() & F.col("exchange").isNotNull())
    base = F.when(~is_valid, F.lit(50)).otherwise(F.lit(100))
    score = F.when(F.col("sector").isNull(), base - 10).otherwise(base)
    out = (
        j.withColumn("price_usd", F.col("price"))
        .withColumn("notional_usd", F.col("price") * F.col("qty"))
        .withColumn("is_valid", is_valid)
        .withColumn("quality_score", score.cast("int"))
    )
    if with_processed_ts:
        out = out.withColumn("processed_ts", F.current_timestamp())
        return out.select(*TRADES_ENRICHED_COLUMNS)
    return out.select(*[c for c in TRADES_ENRICHED_COLUMNS if c != "processed_ts"])


def valid_trades(enriched: DataFrame, start: str | None = None,
                 end: str | None = None,
                 columns: tuple[str, ...] = ("portfolio_id", "symbol", "side",
                                             "price_usd", "qty",
                                             "notional_usd")) -> DataFrame:
    """Gold-layer read of silver: ``event_date AS ds``, inclusive date range,
    ``is_valid = true`` (NULL validity is dropped)."""
    df = enriched
    if start is not None:
        df = df.filter(F.col("event_date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("event_date") <= F.lit(end).cast("date"))
    df = df.filter(F.col("is_valid"))
    return df.select(F.col("event_date").alias("ds"), *columns)


# The trades of a hot portfolio meet their owner in this many join keys.
OWNER_SALTS = 16
# A portfolio is hot if it holds more than one in so many trades; so there are
# fewer hot ones than this, whatever the size of the tables.
HOT_ONE_IN = 1000


def hot_portfolios(valid: DataFrame, one_in: int = HOT_ONE_IN) -> DataFrame:
    """portfolio_id of the fewer than ``one_in`` portfolios that each hold more
    than one in ``one_in`` trades."""
    held = valid.groupBy("portfolio_id").agg(F.count(F.lit(1)).alias("num_trades"))
    return held.where(F.col("num_trades") * one_in > held.agg(F.sum("num_trades")).scalar()).select("portfolio_id")


def join_owner_ccy(valid: DataFrame, portfolios: DataFrame,
                   salts: int = OWNER_SALTS) -> DataFrame:
    """valid trades ⋈ portfolios (base_ccy) on portfolio_id.

    The join is per trade, so nothing can be combined first, and one portfolio
    may hold a third of all trades.  The trades of a hot portfolio take the salt
    of their id and its row is repeated once per salt, so they are spread over
    ``salts`` keys; all other portfolios stay one row.  The portfolios grow with
    the customers and Spark's estimate leaves out rows that ``explode`` makes,
    so they are merged and never sent whole to the driver.
    """
    hot = F.broadcast(hot_portfolios(valid).withColumn("_hot", F.lit(True)))
    copies = F.when(F.col("_hot"), F.lit(salts)).otherwise(F.lit(1))
    owners = (portfolios.select("portfolio_id", "base_ccy").join(hot, "portfolio_id", "left")
              .select("portfolio_id", "base_ccy", F.explode(F.sequence(F.lit(0), copies - 1)).alias("_salt")))
    salt = F.when(F.col("_hot"), F.pmod(F.hash("trade_id"), F.lit(salts))).otherwise(F.lit(0))
    salted = valid.join(hot, "portfolio_id", "left").withColumn("_salt", salt).drop("_hot")
    return salted.join(owners.hint("merge"), on=["portfolio_id", "_salt"], how="inner").drop("_salt")


def to_base_currency(valid: DataFrame, portfolios: DataFrame, fx: DataFrame,
                     home_ccy: str = "USD") -> DataFrame:
    """Trade notionals converted to the portfolio's base currency at the
    day's rate (``fx``: base_ccy, quote_ccy, rate, ds; rate = quote units per
    one base unit).  Days without a rate give NULL, never a dropped trade.
    """
    j = (join_owner_ccy(valid, portfolios)
         .join(_home_rates(fx, home_ccy), on=["ds", "base_ccy"], how="left"))
    return _converted(j)


def to_base_currency_as_of(valid: DataFrame, portfolios: DataFrame, fx: DataFrame, home_ccy: str = "USD",
                           chunk_days: int = 32, salts: int = 4) -> DataFrame:
    """The same at the last rate on or before the day.

    Trades of a day and currency share their rate, so the as-of join looks up
    each (currency, day) once, and the trades meet it by equality."""
    owned = join_owner_ccy(valid, portfolios)
    asked = owned.select("base_ccy", "ds").distinct()
    rates = asof_join(asked, _home_rates(fx, home_ccy), ["base_ccy"], "ds", ["fx_rate"], chunk_days,
                      salts, salt_by="ds")
    return _converted(owned.join(rates, on=["ds", "base_ccy"], how="left"))


def _home_rates(fx: DataFrame, home_ccy: str) -> DataFrame:
    return fx.filter(F.col("base_ccy") == home_ccy).select(
        "ds", F.col("quote_ccy").alias("base_ccy"), F.col("rate").alias("fx_rate"))


def _converted(j: DataFrame) -> DataFrame:
    return j.select("trade_id", "portfolio_id", "ds", "base_ccy", "notional_usd",
                    "fx_rate", (F.col("notional_usd") * F.col("fx_rate"))
                    .alias("notional_base_ccy"))


def quality_score_histogram(enriched: DataFrame) -> DataFrame:
    """Rows per (quality_score, is_valid) — the data-quality report."""
    return (enriched.groupBy("quality_score", "is_valid")
            .agg(F.count(F.lit(1)).alias("num_trades")))
