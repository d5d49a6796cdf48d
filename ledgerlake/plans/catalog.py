"""The query catalog: every operator and report as ``(spark, sf_dir) → DataFrame``.

Each entry reads the driver's tables under ``sf_dir`` and builds the whole
lineage lazily (fixtures → silver → gold → report): no job runs before the
result is asked for.  Only the queries about sinks and file scans (``LANDING``)
write files first, because that is what they show.  Aggregated floating columns
are rounded HALF_UP to 6 decimals unless the report rounds itself; columns that
are passed on keep all digits.  Timestamps stamped at run time
(``ingestion_ts``, ``processed_ts``) are left out of compared outputs.

Scheduled runs build the gold facts as written layers (``pipeline.build_gold``)
and report on those; here a report's plan contains its fact.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import AS_OF_DEFAULT
from .. import pipeline, sinks
from ..published import Published
from ..functions.exprs import exact_sum, stabilize
from ..operators import bronze, cells, gold, history, silver, sketches
from ..schemas import FACT_PNL_COLUMNS, PORTFOLIOS, TRADES_ENRICHED_COLUMNS, USERS
from ..session import scratch_path
from ..sources import document_store, files, fixtures, quarantine
from . import documented, regional, risk, users

AS_OF = AS_OF_DEFAULT
WINDOW_DAYS = 30
# First day of the 30-day window ending at AS_OF (ds >= as_of - 30 days).
WINDOW_START = (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=WINDOW_DAYS)).isoformat()

#: Windows of the published run: days with trades, and days without.
RUN_WINDOW, EMPTY_WINDOW = ("2024-01-05", "2024-01-20"), ("2030-01-01", "2030-01-02")

# Aggregated floating columns of the facts.
PNL_MEASURES = ["avg_buy_price", "avg_sell_price", "realized_pnl_usd", "notional_traded_usd"]
LIQUIDITY_MEASURES = ["total_turnover_usd", "avg_trade_size", "price_volatility"]
ACTIVITY_MEASURES = ["total_notional_usd", "buy_sell_ratio"]


class Lake:
    """The layers over one scale-factor directory, as lazy plans."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self.t = fixtures.load(spark, sf_dir)

    @property
    def users(self) -> DataFrame:
        return self.t.users

    @property
    def portfolios(self) -> DataFrame:
        return self.t.portfolios

    @cached_property
    def enriched(self) -> DataFrame:
        return silver.scored_trades(self.t.trades, self.t.symbols, with_processed_ts=False)

    def valid(self, *extra: str) -> DataFrame:
        cols = ("portfolio_id", "symbol", "side", "price_usd", "qty",
                "notional_usd", *extra)
        return silver.valid_trades(self.enriched, columns=tuple(dict.fromkeys(cols)))

    @cached_property
    def pnl(self) -> DataFrame:
        return gold.fact_pnl_daily(self.valid())

    @cached_property
    def liquidity(self) -> DataFrame:
        return gold.fact_liquidity(self.valid("exchange", "sector"))

    @cached_property
    def activity(self) -> DataFrame:
        return gold.fact_user_activity(self.valid())

    @cached_property
    def rates(self) -> DataFrame:
        return bronze.clean_rates(self.t.rate_feed, with_ingestion_ts=False)

    def landed_rates(self) -> DataFrame:
        """The rate feed landed as daily CSV files, and read again."""
        path = scratch_path(self.spark, "landed-rates")
        files.write_fx_csv(self.t.rate_feed, path)
        return files.read_fx_csv(self.spark, path)


Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
#: queries that write files when they are built
LANDING = {"fx_bronze", "fx_missing_days", "fx_latest_day", "symbols_bronze",
           "roundtrip_silver", "roundtrip_fact_pnl", "fx_quarantine", "fx_rejects",
           "regional_profitability_from_store", "published_fact_pnl", "published_run", "layer_stamps",
           "incremental_fact_pnl", "incremental_fact_liquidity", "incremental_fact_user_activity",
           "active_owners_30d", "portfolio_trades"}


def query(*rounded: str):
    """Registers a query; ``rounded`` names its aggregated floating columns."""
    def register(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return stabilize(fn(Lake(spark, sf_dir)), rounded)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        _QUERIES[fn.__name__] = run
        return fn
    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def last_day(L: Lake) -> dt.date:
    """The last day that carries trades (a re-run needs a day to re-run)."""
    return L.t.trades.agg(F.max("event_date")).first()[0]


def corrected(trades: DataFrame) -> DataFrame:
    """A day's trades as delivered again: those with an even id are withdrawn,
    the others re-booked to the first symbol."""
    return (trades.filter(F.col("trade_id").cast("bigint") % 2 == 1)
            .withColumn("symbol", F.lit("SYM_00")))


# --- bronze -----------------------------------------------------------------

@query()
def fx_bronze(L: Lake) -> DataFrame:
    """Daily rate CSVs → typed, one rate per (base, quote, day), written by day."""
    rates = bronze.clean_rates(L.landed_rates(), with_ingestion_ts=False)
    path = scratch_path(L.spark, "bronze-rates")
    sinks.write_partitioned(rates, path, ["ds"])
    return sinks.read_layer(L.spark, path, ["base_ccy", "quote_ccy", "rate", "ds"])


@query()
def fx_missing_days(L: Lake) -> DataFrame:
    """Days of the 30-day window ending at as_of with no FX file."""
    return bronze.missing_days(L.landed_rates(), WINDOW_START, L.as_of)


@query()
def fx_latest_day(L: Lake) -> DataFrame:
    """The latest day's FX rows."""
    raw = L.landed_rates()
    return bronze.clean_rates(bronze.latest_day(raw), with_ingestion_ts=False)


#: The rate feed with one broken line in ten, which it may have.
BROKEN_FEED = dataclasses.replace(pipeline.FX_FEED, header=False, max_share=0.2)


def _quarantined(L: Lake) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of the feed with broken lines, landed as text
    files by day and read with the declared schema."""
    landed, rejects = scratch_path(L.spark, "landed-lines"), scratch_path(L.spark, "rejects")
    L.t.rate_lines.repartition("ds").write.partitionBy("ds").text(landed)
    rows = quarantine.scan(L.spark, landed, BROKEN_FEED)
    good = quarantine.set_aside(rows, BROKEN_FEED, rejects, "all")
    return good, quarantine.read_rejects(L.spark, rejects)


@query()
def fx_rejects(L: Lake) -> DataFrame:
    """The malformed lines of the rate feed, with the reason."""
    return _quarantined(L)[1].select("ds", "line", "reason")


@query()
def fx_quarantine(L: Lake) -> DataFrame:
    """Per day, the good rows and the rejected ones (together all lines of the
    feed), and the rates that bronze keeps of the good ones."""
    good, bad = _quarantined(L)
    rates = bronze.clean_rates(good, with_ingestion_ts=False)
    n = lambda df, name: df.groupBy("ds").agg(F.count(F.lit(1)).alias(name))
    days = n(good, "good_rows").join(n(bad, "rejected_rows"), "ds", "full_outer").join(
        n(rates, "rates"), "ds", "left").na.fill(0)
    return days.select("ds", "good_rows", "rejected_rows", "rates")


@query()
def symbols_bronze(L: Lake) -> DataFrame:
    """Symbol CSV with duplicates → typed, one row per symbol, full refresh."""
    landed, path = scratch_path(L.spark, "landed-symbols"), scratch_path(L.spark, "bronze-symbols")
    files.write_symbols_csv(L.t.symbol_feed, landed)
    raw = files.read_symbols_csv(L.spark, landed)
    sinks.write_table(bronze.clean_symbols(raw, with_ingestion_ts=False), path)
    return sinks.read_layer(L.spark, path, ["symbol", "exchange", "sector", "tick_size"])


# --- silver -----------------------------------------------------------------

@query()
def trades_scan(L: Lake) -> DataFrame:
    """Trades in an inclusive date range (pushed into the scan)."""
    return files.trades_scan(L.t.trades, WINDOW_START, L.as_of)


@query()
def trades_enriched(L: Lake) -> DataFrame:
    return L.enriched


@query()
def silver_valid_trades(L: Lake) -> DataFrame:
    return silver.valid_trades(L.enriched, WINDOW_START, L.as_of,
                               columns=("portfolio_id", "symbol", "side",
                                        "price_usd", "qty", "notional_usd",
                                        "is_valid"))


@query()
def quality_score_histogram(L: Lake) -> DataFrame:
    return silver.quality_score_histogram(L.enriched)


@query()
def roundtrip_silver(L: Lake) -> DataFrame:
    """Silver written by day, then its last two days run again on corrected
    trades (the day before the last withdrawn altogether), and read back."""
    path, last = scratch_path(L.spark, "trades_enriched"), last_day(L)
    days = L.t.trades.agg(F.min("event_date")).first()[0]
    sinks.replace_days(L.enriched, path, "event_date", str(days), str(last), "batch")
    again = corrected(L.t.trades.filter(F.col("event_date") == F.lit(last)))
    scored = silver.scored_trades(again, L.t.symbols, with_processed_ts=False)
    sinks.replace_days(scored, path, "event_date", str(last - dt.timedelta(days=1)), str(last), "batch")
    cols = [c for c in TRADES_ENRICHED_COLUMNS if c != "processed_ts"]
    return sinks.read_layer(L.spark, path, cols)


# --- gold -------------------------------------------------------------------

@query(*PNL_MEASURES)
def fact_pnl_daily(L: Lake) -> DataFrame:
    return L.pnl


@query(*PNL_MEASURES)
def pnl_outer_join(L: Lake) -> DataFrame:
    return gold.pnl_outer_join(L.valid())


@query(*LIQUIDITY_MEASURES)
def fact_liquidity(L: Lake) -> DataFrame:
    return L.liquidity


@query(*ACTIVITY_MEASURES)
def fact_user_activity(L: Lake) -> DataFrame:
    return L.activity


@query()
def most_traded_symbol(L: Lake) -> DataFrame:
    return gold.most_traded_symbol(L.valid())


@query(*PNL_MEASURES)
def top_pnl_rows(L: Lake) -> DataFrame:
    return L.pnl.orderBy(F.desc("realized_pnl_usd"), "ds", "portfolio_id",
                         "symbol").limit(10)


@query(*LIQUIDITY_MEASURES)
def top_turnover_rows(L: Lake) -> DataFrame:
    return L.liquidity.orderBy(F.desc("total_turnover_usd"), "ds",
                               "symbol").limit(10)


@query(*ACTIVITY_MEASURES)
def top_activity_rows(L: Lake) -> DataFrame:
    return L.activity.orderBy(F.desc("activity_score"), "ds",
                              "portfolio_id").limit(10)


@query(*PNL_MEASURES)
def roundtrip_fact_pnl(L: Lake) -> DataFrame:
    """The PnL fact written by day, then its last two days run again on
    corrected trades, and read back: other days stay."""
    path, last = scratch_path(L.spark, "fact_pnl_daily"), last_day(L)
    sinks.write_partitioned(L.pnl, path, ["ds"])
    again = corrected(L.t.trades.filter(F.col("event_date") == F.lit(last)))
    fact = gold.fact_pnl_daily(silver.valid_trades(silver.scored_trades(again, L.t.symbols)))
    sinks.replace_days(fact, path, "ds", str(last - dt.timedelta(days=1)), str(last))
    return sinks.read_layer(L.spark, path, FACT_PNL_COLUMNS)


def _published(L: Lake) -> Published:
    name = f"run_{uuid.uuid4().hex[:12]}"
    return Published(L.spark, name, scratch_path(L.spark, "published"))


def _published_run(L: Lake) -> tuple[Published, list[tuple]]:
    """The layered run over the tables of the catalog for the report's window,
    and again for a window without any trade; with the rows it says it wrote."""
    fx, listed = scratch_path(L.spark, "landed-rates"), scratch_path(L.spark, "landed-symbols")
    files.write_fx_csv(L.t.rate_feed, fx)
    files.write_symbols_csv(L.t.symbol_feed, listed)
    tables, said = _published(L), []
    for start, end in (RUN_WINDOW, EMPTY_WINDOW):
        counts = pipeline.run_published(L.spark, tables, L.t.trades, fx, listed, start, end)
        said += [(start, end, table, n) for table, n in counts.items()]
    return tables, said


@query()
def published_run(L: Lake) -> DataFrame:
    """Per window and table, the rows the run says it wrote and those a reader
    then finds in the table by its name."""
    tables, said = _published_run(L)
    runs = L.spark.createDataFrame(said, "start string, end string, table_name string, written long")
    days = {pipeline.FX_TABLE: "ds", pipeline.SILVER_TABLE: "event_date", **dict.fromkeys(
        pipeline.FACT_TABLES.values(), "ds"), pipeline.SYMBOL_TABLE: None}
    found = None
    for table, day in days.items():
        inside = F.lit(True) if day is None else F.col(day).between(*(F.lit(d).cast("date") for d in RUN_WINDOW))
        one = tables.read(table).where(inside).agg(F.count(F.lit(1)).alias("found")).select(
            F.lit(table).alias("table_name"), "found")
        found = one if found is None else found.unionByName(one)
    return runs.join(found, "table_name").select("start", "end", "table_name", "written", "found")


@query()
def layer_stamps(L: Lake) -> DataFrame:
    """Ingest and processing stamps of the layers: rows per table, how many
    carry a stamp, and of how many moments (each table is written at once)."""
    tables, _ = _published_run(L)
    stamps = {pipeline.FX_TABLE: "ingestion_ts", pipeline.SYMBOL_TABLE: "ingestion_ts",
              pipeline.SILVER_TABLE: "processed_ts"}
    out = None
    for table, stamp in stamps.items():
        one = tables.read(table).agg(
            F.count(F.lit(1)).alias("num_rows"), F.count(stamp).alias("stamped"),
            F.countDistinct(stamp).alias("moments")).select(F.lit(table).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(*PNL_MEASURES)
def published_fact_pnl(L: Lake) -> DataFrame:
    """The PnL fact published by day, its last two days published again from
    corrected trades (the day before the last is gone), and read by name."""
    tables, last = _published(L), last_day(L)
    first = L.t.trades.agg(F.min("event_date")).first()[0]
    tables.replace_days(L.pnl, "fact_pnl_daily", "ds", str(first), str(last))
    again = corrected(L.t.trades.filter(F.col("event_date") == F.lit(last)))
    fact = gold.fact_pnl_daily(silver.valid_trades(silver.scored_trades(again, L.t.symbols)))
    tables.replace_days(fact, "fact_pnl_daily", "ds", str(last - dt.timedelta(days=1)), str(last))
    return tables.read("fact_pnl_daily").select(*FACT_PNL_COLUMNS)


def _cells_in_batches(L: Lake, batches: int = 3) -> DataFrame:
    """The trades' cells as they come in with several late batches (every day's
    trades are dealt to all of them), written one after the other."""
    path = scratch_path(L.spark, "trade-cells")
    for k in range(batches):
        late = L.t.trades.filter(F.col("trade_id").cast("bigint") % batches == k)
        scored = silver.scored_trades(late, L.t.symbols, with_processed_ts=False)
        own = cells.cells(pipeline.cell_trades(scored)).withColumn("feed", F.lit(f"late-{k}"))
        sinks.write_partitioned(own, path, ["ds", "feed"], shuffle_by=["ds"])
    return L.spark.read.parquet(path)


@query(*PNL_MEASURES)
def incremental_fact_pnl(L: Lake) -> DataFrame:
    """The PnL fact merged from the partial aggregates of three late batches."""
    return cells.pnl(_cells_in_batches(L))


@query(*LIQUIDITY_MEASURES)
def incremental_fact_liquidity(L: Lake) -> DataFrame:
    return cells.liquidity(_cells_in_batches(L))


@query(*ACTIVITY_MEASURES)
def incremental_fact_user_activity(L: Lake) -> DataFrame:
    return cells.activity(_cells_in_batches(L))


@query()
def active_owners_30d(L: Lake) -> DataFrame:
    """Distinct portfolios and users that traded in 30 days, by region: from
    stored daily sketches, beside the exact counts; whether the estimates are
    within four standard errors."""
    owners = L.portfolios.select("portfolio_id", "user_id").join(L.users.select("user_id", "region"), "user_id")
    active = L.valid().select("ds", "portfolio_id").distinct().join(owners, "portfolio_id")
    path, what = scratch_path(L.spark, "daily-sketches"), ["portfolio_id", "user_id"]
    sinks.write_partitioned(sketches.daily(active, ["region"], what), path, ["ds"])
    stored = L.spark.read.parquet(path)
    met = sketches.window(stored, ["region"], what, L.as_of, WINDOW_DAYS).join(
        sketches.exact_window(active, ["region"], what, L.as_of, WINDOW_DAYS), "region")
    close = F.lit(True)
    for c in what:
        close = close & sketches.within(F.col(f"approx_{c}"), F.col(f"exact_{c}"))
    return met.select("region", "num_days", F.col("exact_portfolio_id").alias("num_portfolios"),
                      F.col("exact_user_id").alias("num_users"), close.alias("estimates_close"))


@query()
def daily_bars(L: Lake) -> DataFrame:
    return gold.daily_bars(L.valid("ts", "trade_id"))


@query("turnover_usd")
def sector_turnover(L: Lake) -> DataFrame:
    return gold.sector_turnover(L.liquidity)


@query()
def trades_in_base_ccy(L: Lake) -> DataFrame:
    """Valid trades converted to the portfolio's base currency (bronze FX)."""
    return silver.to_base_currency(L.valid("trade_id"), L.portfolios, L.rates)


@query()
def portfolio_trades(L: Lake) -> DataFrame:
    """All trades of the portfolio with the greatest id, read from a silver copy
    that is clustered by symbol and has Bloom filters on the portfolio."""
    path = scratch_path(L.spark, "clustered-silver")
    sinks.write_clustered(L.enriched, path, "event_date", ["symbol", "portfolio_id"], bloom=["portfolio_id"])
    last = L.t.trades.agg(F.max("portfolio_id")).first()[0]
    cols = [c for c in TRADES_ENRICHED_COLUMNS if c != "processed_ts"]
    return sinks.read_layer(L.spark, path, cols).where(F.col("portfolio_id") == last)


@query()
def trades_in_base_ccy_as_of(L: Lake) -> DataFrame:
    """Valid trades converted at the last rate on or before their day, where
    rates are quoted on every fourth day only."""
    quoted = L.rates.where(F.dayofmonth("ds") % 4 == 3)
    return silver.to_base_currency_as_of(L.valid("trade_id"), L.portfolios, quoted)


@query()
def symbol_history(L: Lake) -> DataFrame:
    """Three deliveries of the symbol master, one after the other, as a history."""
    days = fixtures.DELIVERY_DAYS
    told = [L.t.symbol_deliveries.where(F.col("ds") == F.lit(d).cast("date")) for d in days]
    out = history.from_deliveries(told[0])
    for d, delivery in zip(days[1:], told[1:]):
        out = history.deliver(out, delivery, d)
    return out


@query()
def trades_enriched_history(L: Lake) -> DataFrame:
    """Trades scored by the listing that was valid on their day."""
    listed = history.from_deliveries(L.t.symbol_deliveries)
    scored = silver.score(history.listed_on_day(L.t.trades, listed), with_processed_ts=False)
    return scored.select("trade_id", "symbol", "event_date", "exchange", "sector", "is_valid", "quality_score")


@query("holdings_value_usd")
def holdings_value(L: Lake) -> DataFrame:
    """Portfolio holdings marked to the latest price."""
    return gold.holdings_value(L.portfolios, L.valid("ts", "trade_id"), L.as_of)


@query()
def engagement_bands(L: Lake) -> DataFrame:
    return gold.engagement_bands(L.activity)


@query("total_turnover_usd")
def regional_symbol_activity(L: Lake) -> DataFrame:
    return gold.regional_symbol_activity(L.valid(), L.portfolios, L.users)


# --- a larger feed: lineitem ⋈ orders ⋈ part -----------------------------------

def _line_trades(L: Lake, *extra: str) -> DataFrame:
    scored = silver.scored_trades(
        fixtures.lineitem_trades(L.spark, L.sf_dir),
        fixtures.brand_master(fixtures.read_table(L.spark, L.sf_dir, "part")), with_processed_ts=False)
    cols = ("portfolio_id", "symbol", "side", "price_usd", "qty", "notional_usd", *extra)
    return silver.valid_trades(scored, columns=cols)


@query(*PNL_MEASURES)
def lineitem_fact_pnl_daily(L: Lake) -> DataFrame:
    return gold.fact_pnl_daily(_line_trades(L))


@query(*LIQUIDITY_MEASURES)
def lineitem_fact_liquidity(L: Lake) -> DataFrame:
    return gold.fact_liquidity(_line_trades(L, "exchange", "sector"))


@query(*ACTIVITY_MEASURES)
def lineitem_fact_user_activity(L: Lake) -> DataFrame:
    return gold.fact_user_activity(_line_trades(L))


# --- reports: users ---------------------------------------------------------

@query("total_pnl_usd", "total_volume_usd")
def top_profitable_users(L: Lake) -> DataFrame:
    return users.top_profitable_users(L.users, L.portfolios, L.pnl, L.as_of)


@query()
def risk_profile_performance(L: Lake) -> DataFrame:
    return users.risk_profile_performance(L.users, L.portfolios, L.pnl, L.as_of)


@query()
def age_group_activity(L: Lake) -> DataFrame:
    return users.age_group_activity(L.users, L.portfolios, L.activity, L.as_of)


@query()
def income_bracket_activity(L: Lake) -> DataFrame:
    return users.income_bracket_activity(L.users, L.portfolios, L.activity, L.as_of)


@query()
def activation_rate(L: Lake) -> DataFrame:
    return users.activation_rate(L.users, L.portfolios, L.activity, L.as_of)


@query("avg_pnl")
def pnl_by_risk_profile(L: Lake) -> DataFrame:
    return documented.pnl_by_risk_profile(L.users, L.portfolios, L.pnl)


@query("avg_trades", "avg_activity")
def activity_by_age_band(L: Lake) -> DataFrame:
    return documented.activity_by_age_band(L.users, L.portfolios, L.activity)


@query("avg_activity_score")
def activity_by_age_split(L: Lake) -> DataFrame:
    return documented.activity_by_age_split(L.users, L.portfolios, L.activity)


# --- reports: regional ------------------------------------------------------

@query()
def regional_volume(L: Lake) -> DataFrame:
    return regional.regional_volume(L.users, L.portfolios, L.activity, L.as_of)


@query()
def regional_profitability(L: Lake) -> DataFrame:
    return regional.regional_profitability(L.users, L.portfolios, L.pnl, L.as_of)


@query()
def regional_profitability_from_store(L: Lake) -> DataFrame:
    """The same report with users and portfolios from the document store, beside
    the lake's fact in one plan; the store filters ``kyc_status``."""
    landed = scratch_path(L.spark, "customer-documents")
    L.users.write.json(f"{landed}/users")
    L.portfolios.write.json(f"{landed}/portfolios")
    u = document_store.read(L.spark, f"{landed}/users", USERS)
    p = document_store.read(L.spark, f"{landed}/portfolios", PORTFOLIOS)
    return regional.regional_profitability(u, p, L.pnl, L.as_of)


@query()
def regional_risk_distribution(L: Lake) -> DataFrame:
    return regional.regional_risk_distribution(L.users, L.portfolios,
                                               L.activity, L.as_of)


@query()
def regional_symbol_preferences(L: Lake) -> DataFrame:
    return regional.regional_symbol_preferences(L.users, L.portfolios, L.pnl,
                                                L.as_of)


@query("total_pnl_usd", "pnl_last_7d_usd")
def pnl_by_region(L: Lake) -> DataFrame:
    return documented.pnl_by_region(L.users, L.portfolios, L.pnl, L.as_of)


# --- reports: risk ----------------------------------------------------------

@query()
def portfolio_concentration(L: Lake) -> DataFrame:
    return risk.portfolio_concentration(L.users, L.portfolios, L.pnl, L.as_of)


@query("total_volume_30d")
def high_risk_users(L: Lake) -> DataFrame:
    return risk.high_risk_users(L.users, L.portfolios, L.pnl, L.as_of)


@query()
def loss_making_users(L: Lake) -> DataFrame:
    return risk.loss_making_users(L.users, L.portfolios, L.pnl, L.as_of)


@query()
def risk_mismatch(L: Lake) -> DataFrame:
    return risk.risk_mismatch(L.users, L.portfolios, L.pnl, L.as_of)


# --- reports on the data ----------------------------------------------------

@query()
def users_by_region(L: Lake) -> DataFrame:
    return L.users.groupBy("region").agg(F.count(F.lit(1)).alias("num_users"))


@query()
def users_by_risk_profile(L: Lake) -> DataFrame:
    return L.users.groupBy("risk_profile").agg(F.count(F.lit(1)).alias("num_users"))


@query()
def active_portfolios(L: Lake) -> DataFrame:
    return L.portfolios.agg(
        F.count(F.lit(1)).alias("total_portfolios"),
        F.count_if(F.col("is_active")).alias("active_portfolios"))


@query()
def table_counts(L: Lake) -> DataFrame:
    def n(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
    return (n(L.users, "users").unionByName(n(L.portfolios, "portfolios"))
            .unionByName(n(L.t.trades, "trades_stream"))
            .unionByName(n(L.t.symbols, "symbols")))


@query()
def portfolio_ids(L: Lake) -> DataFrame:
    """Zero-padded portfolio and owner ids with currency and status."""
    return L.portfolios.select("portfolio_id", "user_id", "base_ccy", "is_active")


@query("notional_usd")
def weekday_trades(L: Lake) -> DataFrame:
    """Valid trades on weekdays (Mon–Fri) per day."""
    v = L.valid().filter(F.weekday("ds") < 5)
    return v.groupBy("ds", F.weekday("ds").alias("weekday")).agg(
        F.count(F.lit(1)).alias("num_trades"),
        exact_sum("notional_usd").cast("double").alias("notional_usd"))


__all__ = ["queries", "Lake", "LANDING", "AS_OF"]
