"""Driver tables → domain tables (users, portfolios, trades, symbols, FX).

The mapping is all integer arithmetic on the driver's keys so the same rows
come out of any engine (the DuckDB oracle re-types it independently).  Every
domain table is a lazy projection of a driver table: it grows with the data
and Catalyst prunes the columns a query does not use.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import padded_id

# --- fixed values (must stay as they are for results to match) -------------
VENUES = ["NYSE", "NASDAQ", "BATS", "IEX", "ARCA"]
PORTFOLIO_CCYS = ["USD", "EUR", "GBP", "JPY", "AUD"]
BUY_EVENT_TYPES = ["click", "purchase"]
CONSERVATIVE_SEGMENTS = ["HOUSEHOLD", "FURNITURE"]
# Sign-up and opening dates count back from here, whatever a report's date is.
SIGN_UP_EPOCH = "2024-01-31"
DELIVERY_DAYS = ["2024-01-03", "2024-01-12", "2024-01-21"]
# ---------------------------------------------------------------------------


class Tables:
    """The domain tables of one scale-factor directory, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._scans: dict[str, DataFrame] = {}

    def _t(self, name: str) -> DataFrame:
        if name not in self._scans:
            self._scans[name] = read_table(self.spark, self.sf_dir, name)
        return self._scans[name]

    @cached_property
    def users(self) -> DataFrame:
        return users(self._t("customer"), self._t("nation"), self._t("region"))

    @cached_property
    def portfolios(self) -> DataFrame:
        return portfolios(self._t("customer"), self._t("part"))

    @cached_property
    def trades(self) -> DataFrame:
        return trades(self._t("events"), self._t("part"))

    @cached_property
    def symbols(self) -> DataFrame:
        return symbols_master(self._t("part"))

    @cached_property
    def symbol_feed(self) -> DataFrame:
        return symbol_feed(self._t("part"), self._t("lineitem"))

    @cached_property
    def symbol_deliveries(self) -> DataFrame:
        return symbol_deliveries(self._t("part"))

    @cached_property
    def rate_lines(self) -> DataFrame:
        return rate_lines(self._t("events"))

    @cached_property
    def rate_feed(self) -> DataFrame:
        return rate_feed(self._t("events"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One user per customer."""
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", "r_name"))
    c = customer
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    kyc = k % 20
    created = F.date_sub(F.lit(SIGN_UP_EPOCH).cast("date"), ((k * 13) % 730).cast("int"))
    return (
        c.join(geo, c.c_nationkey == geo.n_nationkey)
        .select(
            padded_id("USER_", k + 1).alias("user_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("user"), (k + 1).cast("string"),
                     F.lit("@example.com")).alias("email"),
            F.format_string("+1-555-%04d", k % 10000).alias("phone"),
            F.col("r_name").alias("region"),
            F.when(seg.isin(*CONSERVATIVE_SEGMENTS), "conservative")
            .when(seg == "BUILDING", "moderate")
            .when(seg == "MACHINERY", "aggressive")
            .otherwise("very_aggressive").alias("risk_profile"),
            F.when(kyc <= 16, "verified").when(kyc == 17, "pending")
            .when(kyc == 18, "rejected").otherwise("under_review")
            .alias("kyc_status"),
            created.cast("timestamp_ntz").alias("created_at"),
            F.date_add(created, (k % 30).cast("int")).cast("timestamp_ntz")
            .alias("last_login"),
            F.struct(
                (21 + (k * 7) % 55).cast("int").alias("age"),
                F.lower(seg).alias("occupation"),
                (30000 + F.floor(F.abs(F.col("c_acctbal")) * 47)).cast("int")
                .alias("annual_income_usd"),
                (k % 31).cast("int").alias("investment_experience_years"),
            ).alias("metadata"),
        )
    )


def listed(part: DataFrame) -> Column:
    """Number of symbol keys in the master: one past the largest part key."""
    return part.agg((F.coalesce(F.max("p_partkey"), F.lit(-1)) + 1).alias("n")).scalar()


def portfolios(customer: DataFrame, part: DataFrame) -> DataFrame:
    """One portfolio per customer, and a second one for every third."""
    k, second = F.col("c_custkey"), F.col("second")
    opened = F.date_sub(F.lit(SIGN_UP_EPOCH).cast("date"), ((k * 11) % 700).cast("int"))
    number = 2 * k + 1 + second
    both = F.explode(F.when(k % 3 == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return customer.select("c_custkey", "c_acctbal", both.alias("second")).select(
        padded_id("PORT_", number).alias("portfolio_id"),
        padded_id("USER_", k + 1).alias("user_id"),
        F.format_string("Portfolio %d", number).alias("portfolio_name"),
        F.element_at(F.array(*[F.lit(c) for c in PORTFOLIO_CCYS]),
                     (number % 5 + 1).cast("int")).alias("base_ccy"),
        F.array(F.struct(
            padded_id("SYM_", number % F.greatest(listed(part), F.lit(1)), 2).alias("symbol"),
            (k % 100 + 1).cast("int").alias("qty"))).alias("holdings"),
        F.abs(F.col("c_acctbal")).alias("cash_balance_usd"),
        opened.cast("timestamp_ntz").alias("created_at"),
        F.lit(SIGN_UP_EPOCH).cast("date").cast("timestamp_ntz").alias("updated_at"),
        (number % 20 != 0).alias("is_active"),
        (F.abs(F.col("c_acctbal")) * 2).alias("total_deposits_usd"),
        F.abs(F.col("c_acctbal")).alias("total_withdrawals_usd"),
    )


def trades(events: DataFrame, part: DataFrame) -> DataFrame:
    """Trade events from the ``events`` stream table.

    Symbols range over the whole master and a tenth beyond it (unlisted);
    some users keep to the popular first hundredth of the list."""
    e, u = F.col("event_id"), F.col("user_id")
    h, n = e * 7 + u, F.col("n_listed")
    wide, popular = n + F.floor(n / 10) + 1, F.floor(n / 100) + 1
    sym = (F.when(u % 5 == 0, F.when(e % 2 == 0, u % popular).otherwise(h % wide))
           .when(u % 5 == 1, h % (F.floor(popular / 4) + 1))
           .when(u % 5 == 2, h % (F.floor(popular / 2) + 1))
           .when(u % 5 == 3, h % popular).otherwise(h % wide))
    is_error = F.col("event_type") == "error"
    price = (F.when(is_error & (e % 10 == 0), -F.col("value"))
             .when(is_error & (e % 10 == 1), F.lit(None).cast("double"))
             .otherwise(F.col("value")))
    number = 2 * u + 1 + F.when((u % 3 == 2) & (e % 2 == 1), 1).otherwise(0)
    return events.withColumn("n_listed", listed(part)).select(
        e.cast("string").alias("trade_id"),
        padded_id("PORT_", number).alias("portfolio_id"),
        padded_id("SYM_", sym, 2).alias("symbol"),
        F.when(F.col("event_type").isin(*BUY_EVENT_TYPES), "BUY")
        .otherwise("SELL").alias("side"),
        price.alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("qty"),
        F.col("ts"),
        F.element_at(F.array(*[F.lit(v) for v in VENUES]),
                     (e % 5 + 1).cast("int")).alias("venue"),
        F.to_date("ts").alias("event_date"),
    )


def symbols_master(part: DataFrame) -> DataFrame:
    """Symbol master: one symbol per part; every eleventh has no sector."""
    p = F.col("p_partkey")
    return part.select(
        padded_id("SYM_", p, 2).alias("symbol"),
        F.when(p % 2 == 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
        F.when(p % 11 == 10, F.lit(None).cast("string"))
        .otherwise(F.col("p_type")).alias("sector"),
        F.lit(0.01).alias("tick_size"),
    )


def symbol_feed(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The symbol master as delivered: the list, and again the symbols of
    every shipped line (natural duplicates)."""
    shipped = lineitem.select(F.col("l_partkey").alias("p_partkey")).join(part, "p_partkey")
    return symbols_master(part).unionByName(symbols_master(shipped))


def rate_feed(events: DataFrame) -> DataFrame:
    """A feed of exchange rates observed at events, several for most days and
    currencies: units of ``quote_ccy`` per USD."""
    e = F.col("event_id")
    return events.select(
        F.lit("USD").alias("base_ccy"),
        F.element_at(F.array(*[F.lit(c) for c in PORTFOLIO_CCYS]),
                     (e % 5 + 1).cast("int")).alias("quote_ccy"),
        F.when(e % 5 == 0, F.lit(1.0)).otherwise(1 + F.col("value") / 100).alias("rate"),
        F.to_date("ts").alias("ds"))


def symbol_deliveries(part: DataFrame) -> DataFrame:
    """Three deliveries of the symbol master: in the second some symbols have
    another sector and some are gone; in the third half of either are back."""
    p = F.col("p_partkey")
    whole = part.select(
        "p_partkey", padded_id("SYM_", p, 2).alias("symbol"),
        F.when(p % 2 == 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
        F.when(p % 11 != 10, F.col("p_type")).alias("sector"), F.lit(0.01).alias("tick_size"))
    rows = whole.withColumn("ds", F.explode(F.array(*[F.lit(d).cast("date") for d in DELIVERY_DAYS])))
    second, third = (F.col("ds") == F.lit(d).cast("date") for d in DELIVERY_DAYS[1:])
    away = second | (third & (p % 2 == 1))
    moved = F.when((p % 7 == 3) & away, "RECLASSIFIED").otherwise(F.col("sector"))
    return (rows.where(~((p % 13 == 5) & away)).withColumn("sector", moved)
            .select("symbol", "exchange", "sector", "tick_size", "ds"))


def rate_lines(events: DataFrame) -> DataFrame:
    """The rate feed as lines of text by day, (ds, value); one line of ten is
    broken: no number, a field too few, one too many, no currency."""
    e = F.col("event_id")
    ccy = F.element_at(F.array(*[F.lit(c) for c in PORTFOLIO_CCYS]), (e % 5 + 1).cast("int"))
    rate = F.when(e % 5 == 0, F.lit(1.0)).otherwise(1 + F.col("value") / 100).cast("decimal(12,4)")
    whole = F.concat(F.lit("USD,"), ccy, F.lit(","), rate.cast("string"))
    kind = e % 40
    line = (F.when(kind == 3, F.concat(F.lit("USD,"), ccy, F.lit(",n/a")))
            .when(kind == 13, F.concat(F.lit("USD,"), ccy))
            .when(kind == 23, F.concat(whole, F.lit(",9")))
            .when(kind == 33, F.lit("USD,,1.5")).otherwise(whole))
    return events.select(F.to_date("ts").alias("ds"), line.alias("value"))


def load(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger trade feed for benchmarks: lineitem ⋈ orders ⋈ part.

    portfolio = customer, symbol = brand, side from line status, unit price
    = extended price / quantity, day = ship date.
    """
    li = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(part, li.l_partkey == part.p_partkey))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string")).alias("trade_id"),
        padded_id("PORT_", 2 * F.col("o_custkey") + 1).alias("portfolio_id"),
        F.col("p_brand").alias("symbol"),
        F.when(F.col("l_linestatus") == "O", "BUY").otherwise("SELL").alias("side"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_shipdate").alias("ts"),
        F.element_at(F.array(*[F.lit(v) for v in VENUES]),
                     (F.col("l_orderkey") % 5 + 1).cast("int")).alias("venue"),
        F.to_date("l_shipdate").alias("event_date"),
    )


def brand_master(part: DataFrame) -> DataFrame:
    """Symbol master for the lineitem feed: one row per brand (exchange by
    brand number parity, sector = smallest part type of the brand)."""
    n = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    return (part.groupBy("p_brand").agg(F.min("p_type").alias("sector"))
            .select(F.col("p_brand").alias("symbol"),
                    F.when(n % 2 == 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
                    "sector", F.lit(0.01).alias("tick_size")))
