"""The layered batch run: bronze → silver → gold, written as Parquet layers.

``run`` is the scheduled job of the reference re-expressed as one Spark
application: each layer is written to the shared lake path with dynamic
partition overwrite (re-running a date range replaces only those days) and
the next layer reads it back, so lineage is cut at every layer and a lost
executor recomputes at most one layer's tasks.  Nothing is collected; empty
inputs write nothing.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks
from .published import Published, Staged
from .operators import bronze, cells, gold, silver
from .schemas import (BR_FX_RATES, BR_SYMBOLS, FACT_ACTIVITY_COLUMNS,
                      FACT_LIQUIDITY_COLUMNS, FACT_PNL_COLUMNS, FX_CSV, SYMBOLS_CSV,
                      TRADES_ENRICHED_COLUMNS)
from .sources import files, quarantine


@dataclass
class LakePaths:
    root: str
    fx: str = field(init=False)
    symbols: str = field(init=False)
    silver: str = field(init=False)
    pnl: str = field(init=False)
    liquidity: str = field(init=False)
    activity: str = field(init=False)
    rejects: str = field(init=False)
    cells: str = field(init=False)

    def __post_init__(self):
        r = self.root.rstrip("/")
        self.fx = f"{r}/bronze/fx_rates"
        self.symbols = f"{r}/bronze/symbols"
        self.silver = f"{r}/silver/trades_enriched"
        self.pnl = f"{r}/gold/fact_pnl_daily"
        self.liquidity = f"{r}/gold/fact_liquidity"
        self.activity = f"{r}/gold/fact_user_activity"
        self.rejects = f"{r}/rejects"
        self.cells = f"{r}/silver/trade_cells"


def ingest_bronze(spark: SparkSession, paths: LakePaths, fx_csv_dir: str,
                  symbols_csv: str, start: str, end: str) -> dict[str, int]:
    return {"bronze.fx_rates": ingest_fx(spark, paths, fx_csv_dir, start, end),
            "bronze.symbols": ingest_symbols(spark, paths, symbols_csv)}


FX_FEED = quarantine.Feed("fx_rates", FX_CSV, required=("base_ccy", "quote_ccy", "rate"), partitions=("ds",))
SYMBOL_FEED = quarantine.Feed("symbols", SYMBOLS_CSV, required=("symbol",))


def ingest_fx(spark: SparkSession, paths: LakePaths, fx_csv_dir: str,
              start: str, end: str, feed: quarantine.Feed = FX_FEED) -> int:
    """Bronze rates of the days [start, end]; malformed rows go to the lake's
    rejects, and too many of them fail the run before a rate is written."""
    raw = files.trades_scan(quarantine.scan(spark, fx_csv_dir, feed), start, end, "ds")
    if not sinks.has_rows(raw):
        return 0
    good = quarantine.set_aside(raw, feed, paths.rejects, f"{start}_{end}")
    return sinks.replace_days(bronze.clean_rates(good), paths.fx, "ds", start, end)


def ingest_symbols(spark: SparkSession, paths: LakePaths, symbols_csv: str,
                   feed: quarantine.Feed = SYMBOL_FEED) -> int:
    raw = quarantine.scan(spark, symbols_csv, feed)
    if not sinks.has_rows(raw):          # never replace the master with nothing
        return 0
    good = quarantine.set_aside(raw, feed, paths.rejects, "latest")
    return sinks.write_table(bronze.clean_symbols(good), paths.symbols)


#: Trades loaded by the batch run; streams write feeds of their own.
BATCH_FEED = "batch"


def build_silver(spark: SparkSession, paths: LakePaths, trades: DataFrame,
                 start: str, end: str) -> int:
    """Silver for the days [start, end], replaced as a whole: a trade that
    was re-booked or withdrawn is gone.  Partitioned by day and feed; inside a
    day's files trades are sorted by symbol, so row groups are pruned by it."""
    t = files.trades_scan(trades, start, end)
    if not sinks.has_rows(t):
        return 0
    sym = sinks.read_layer(spark, paths.symbols, [f.name for f in BR_SYMBOLS.fields])
    enriched = silver.scored_trades(t, sym)
    n = sinks.replace_days(enriched, paths.silver, "event_date", start, end, BATCH_FEED)
    # the feed's cells, from the days as written (see ``build_facts_from_cells``)
    written = files.trades_scan(spark.read.parquet(paths.silver).where(F.col("feed") == BATCH_FEED), start, end)
    sinks.replace_days(cells.cells(cell_trades(written)), paths.cells, "ds", start, end, BATCH_FEED)
    return n


def cell_trades(trades: DataFrame) -> DataFrame:
    """Valid trades with the columns that cells need."""
    return silver.valid_trades(trades, columns=("portfolio_id", "symbol", "side", "price_usd", "qty",
                                                "notional_usd", "exchange", "sector"))


def read_cells(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The partial aggregates of all feeds, by day."""
    return spark.read.parquet(paths.cells)


def build_facts_from_cells(spark: SparkSession, paths: LakePaths, days: DataFrame) -> dict[str, int]:
    """The gold facts of some days (a column ``ds``), anew from the cells of all
    feeds: no trade is read.  These days are overwritten, other days stay."""
    some = read_cells(spark, paths).join(days.select("ds").distinct(), "ds", "left_semi")
    return {f"gold.{kind}": sinks.write_partitioned(cells.FACTS[kind](some), getattr(paths, kind), ["ds"])
            for kind in FACT_KINDS}


def read_silver(spark: SparkSession, paths: LakePaths, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """All feeds of the silver layer."""
    s = sinks.read_layer(spark, paths.silver, TRADES_ENRICHED_COLUMNS)
    return files.trades_scan(s, start, end)


FACT_KINDS = ("pnl", "liquidity", "activity")


FACT_COLUMNS = {"pnl": FACT_PNL_COLUMNS, "liquidity": FACT_LIQUIDITY_COLUMNS,
                "activity": FACT_ACTIVITY_COLUMNS}


def fact(kind: str, trades: DataFrame) -> DataFrame:
    """One gold fact from silver trades."""
    base = ("portfolio_id", "symbol", "side", "price_usd", "qty", "notional_usd")
    if kind == "pnl":
        return gold.fact_pnl_daily(silver.valid_trades(trades, columns=base))
    if kind == "liquidity":
        return gold.fact_liquidity(silver.valid_trades(trades, columns=base + ("exchange", "sector")))
    if kind == "activity":
        return gold.fact_user_activity(silver.valid_trades(trades, columns=base))
    raise ValueError(f"unknown fact {kind!r}")


def build_fact(spark: SparkSession, paths: LakePaths, kind: str, start: str,
               end: str) -> int:
    """One gold fact for [start, end] from the written silver layer (the date
    range prunes silver's partitions).  The days are replaced as a whole: one
    whose trades have all become invalid loses its old facts."""
    s = read_silver(spark, paths, start, end)
    if not sinks.has_rows(s):
        return 0
    return sinks.replace_days(fact(kind, s), getattr(paths, kind), "ds", start, end)


def build_gold(spark: SparkSession, paths: LakePaths, start: str,
               end: str) -> dict[str, int]:
    """The gold facts of the window, submitted side by side: they are
    independent, and one's tail leaves room for the next."""
    if not sinks.has_rows(read_silver(spark, paths, start, end)):
        return {f"gold.{k}": 0 for k in FACT_KINDS}
    build = inheritable_thread_target(spark)(
        lambda k: build_fact(spark, paths, k, start, end))
    with ThreadPoolExecutor(len(FACT_KINDS)) as pool:
        counts = list(pool.map(build, FACT_KINDS))
    return {f"gold.{k}": n for k, n in zip(FACT_KINDS, counts)}


def run(spark: SparkSession, trades: DataFrame, fx_csv_dir: str,
        symbols_csv: str, lake_root: str, start: str, end: str) -> dict[str, int]:
    """One scheduled run over the inclusive window [start, end].

    Returns the rows written per table (observed on the write jobs).
    """
    paths = LakePaths(lake_root)
    counts = ingest_bronze(spark, paths, fx_csv_dir, symbols_csv, start, end)
    counts["silver.trades_enriched"] = build_silver(spark, paths, trades, start, end)
    if counts["silver.trades_enriched"] == 0:       # no trades in the window
        counts.update({f"gold.{k}": 0 for k in FACT_KINDS})
    else:
        counts.update(build_gold(spark, paths, start, end))
    return counts


def read_fact(spark: SparkSession, paths: LakePaths, kind: str) -> DataFrame:
    return sinks.read_layer(spark, getattr(paths, kind), FACT_COLUMNS[kind])


def read_bronze_fx(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return sinks.read_layer(spark, paths.fx, [f.name for f in BR_FX_RATES.fields])


#: Published tables by layer (see ``published``).
FX_TABLE, SYMBOL_TABLE, SILVER_TABLE = "br_fx_rates", "br_symbols", "trades_enriched"
FACT_TABLES = {"pnl": "fact_pnl_daily", "liquidity": "fact_liquidity", "activity": "fact_user_activity"}


def run_published(spark: SparkSession, tables: Published, trades: DataFrame, fx_csv_dir: str, symbols_csv: str,
                  start: str, end: str) -> dict[str, int]:
    """``run`` over published tables: each layer is read by name from the last
    published state, and its days change atomically for whoever reads them.
    An input without rows in the window publishes nothing."""
    rejects = f"{tables.root}/rejects"
    counts = dict.fromkeys([FX_TABLE, SYMBOL_TABLE, SILVER_TABLE, *FACT_TABLES.values()], 0)
    fx = files.trades_scan(quarantine.scan(spark, fx_csv_dir, FX_FEED), start, end, "ds")
    if sinks.has_rows(fx):
        rates = bronze.clean_rates(quarantine.set_aside(fx, FX_FEED, rejects, f"{start}_{end}"))
        counts[FX_TABLE] = tables.replace_days(rates, FX_TABLE, "ds", start, end)
    listed = quarantine.scan(spark, symbols_csv, SYMBOL_FEED)
    if sinks.has_rows(listed):
        symbols = bronze.clean_symbols(quarantine.set_aside(listed, SYMBOL_FEED, rejects, "latest"))
        counts[SYMBOL_TABLE] = tables.replace_table(symbols, SYMBOL_TABLE)
    t = files.trades_scan(trades, start, end)
    if not sinks.has_rows(t):
        return counts
    enriched = silver.scored_trades(t, tables.read(SYMBOL_TABLE))
    counts[SILVER_TABLE] = tables.replace_days(enriched, SILVER_TABLE, "event_date", start, end,
                                               {"feed": BATCH_FEED})
    days = files.trades_scan(tables.read(SILVER_TABLE), start, end)

    def build(kind: str) -> Staged:
        return tables.stage(fact(kind, days), FACT_TABLES[kind], "ds", start, end)

    with ThreadPoolExecutor(len(FACT_KINDS)) as pool:      # written side by side, then published
        for staged in pool.map(inheritable_thread_target(spark)(build), FACT_KINDS):
            counts[staged.table] = tables.publish(staged)
    return counts


LAYER_TABLES = {
    "bronze_v1.br_fx_rates": "fx", "bronze_v1.br_symbols": "symbols",
    "silver_v1.trades_enriched": "silver", "gold_v1.fact_pnl_daily": "pnl",
    "gold_v1.fact_liquidity": "liquidity", "gold_v1.fact_user_activity": "activity",
}


#: layers whose files lie in one folder per day
LAYER_PARTITIONS = {"fx": "ds", "silver": "event_date", "pnl": "ds", "liquidity": "ds", "activity": "ds"}


def register_tables(spark: SparkSession, paths: LakePaths) -> list[str]:
    """Names the written layers as tables of the session's catalog, one
    database per layer, so that reports can be written in SQL by name.  Call it
    again after new days were written: that refreshes the file listing."""
    for table, layer in LAYER_TABLES.items():
        path = getattr(paths, layer)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.partition('.')[0]}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
        if LAYER_PARTITIONS.get(layer):
            spark.sql(f"MSCK REPAIR TABLE {table}")
        spark.catalog.refreshTable(table)
    return sorted(LAYER_TABLES)


__all__ = ["run", "LakePaths", "ingest_bronze", "build_silver", "build_fact",
           "build_gold", "fact", "read_silver", "read_fact", "read_bronze_fx",
           "register_tables"]
