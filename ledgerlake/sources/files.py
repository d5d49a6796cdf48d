"""File and table scans with explicit schemas and pushed-down predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FX_CSV, SYMBOLS_CSV, TRADES


def _between(df: DataFrame, column: str, start: str | None,
             end: str | None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end).cast("date"))
    return df


def read_fx_csv(spark: SparkSession, base: str, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """Daily FX CSVs laid out as ``base/ds=YYYY-MM-DD/*.csv``.

    Reads the base directory once with a declared schema and filters ``ds``
    (partition pruning) instead of listing one path per day, so a missing day
    is an absent partition, not a read error.  The directory value of ``ds``
    wins over a ``ds`` column inside the file.
    """
    df = (spark.read.schema(FX_CSV).option("header", "true")
          .option("mode", "PERMISSIVE").csv(base))
    return _between(df, "ds", start, end)


def write_fx_csv(fx: DataFrame, base: str) -> None:
    """Write an FX frame in the daily-CSV layout (one folder per day)."""
    (fx.select("base_ccy", "quote_ccy", "rate", "ds")
     .repartition("ds")
     .write.mode("overwrite").option("header", "true")
     .partitionBy("ds").csv(base))


def read_symbols_csv(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(SYMBOLS_CSV).option("header", "true").csv(path))


def write_symbols_csv(symbols: DataFrame, path: str) -> None:
    (symbols.select("symbol", "exchange", "sector", "tick_size")
     .write.mode("overwrite").option("header", "true").csv(path))


def read_trades(spark: SparkSession, path: str, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """Trade events with the date range pushed into the Parquet scan."""
    df = spark.read.schema(TRADES).parquet(path)
    return _between(df, "event_date", start, end)


def trades_scan(trades: DataFrame, start: str | None, end: str | None,
                day: str = "event_date") -> DataFrame:
    """Date-range scan of an already-declared frame (of trades, by default)."""
    return _between(trades, day, start, end)
