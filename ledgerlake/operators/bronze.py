"""Bronze layer: typed, de-duplicated reference data (FX rates, symbols)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FX_KEYS = ["base_ccy", "quote_ccy", "ds"]


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` (ascending, NULLs
    last).

    Written as an aggregation (``min_by`` of the row over the order), so
    duplicates collapse map-side before the shuffle; a hot key never sends
    its raw rows to one task.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.struct(F.col(c).isNull(), F.col(c)) for c in order])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def clean_rates(raw: DataFrame, with_ingestion_ts: bool = True) -> DataFrame:
    """Cast to the declared types and keep one rate per (base, quote, ds).

    Survivor of duplicates: the lowest rate (deterministic, unlike an
    arbitrary ``dropDuplicates``).
    """
    typed = raw.select(
        F.col("base_ccy").cast("string").alias("base_ccy"),
        F.col("quote_ccy").cast("string").alias("quote_ccy"),
        F.col("rate").cast("double").alias("rate"),
        F.to_date(F.col("ds")).alias("ds"),
    )
    out = dedupe(typed, FX_KEYS, ["rate"])
    if with_ingestion_ts:
        out = out.withColumn("ingestion_ts", F.current_timestamp())
    return out


def clean_symbols(raw: DataFrame, with_ingestion_ts: bool = True) -> DataFrame:
    """Cast the symbol master and keep one row per symbol (first by
    exchange, sector, tick size)."""
    typed = raw.select(
        F.col("symbol").cast("string").alias("symbol"),
        F.col("exchange").cast("string").alias("exchange"),
        F.col("sector").cast("string").alias("sector"),
        F.col("tick_size").cast("double").alias("tick_size"),
    )
    out = dedupe(typed, ["symbol"], ["exchange", "sector", "tick_size"])
    if with_ingestion_ts:
        out = out.withColumn("ingestion_ts", F.current_timestamp())
    return out


def expected_days(start: str | Column, end: str | Column) -> Column:
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    return F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY")))


def missing_days(fx: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar days in [start, end] with no FX rows (the input-exists gate
    as a report).  The day range is generated, the present days are a
    distinct projection of that range only, and the two meet in an anti join."""
    expected = fx.sparkSession.range(1).select(expected_days(start, end).alias("ds"))
    present = fx.filter(F.col("ds").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return expected.join(present.select("ds").distinct(), on="ds", how="left_anti")


def latest_day(fx: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Rows of the most recent ``ds``.  ``days`` (default: ``fx`` itself) is
    where the maximum is looked up; the raw feed's ``ds`` partition column
    answers it without reading or de-duplicating a rate."""
    newest = (fx if days is None else days).select(F.max("ds")).scalar()
    return fx.filter(F.col("ds") == newest)
