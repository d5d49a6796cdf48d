"""The symbol master with history: what was listed, and how, on every day.

A delivery is the whole master as of a day.  The history keeps one row per symbol
and state, with the days it was valid: a later delivery closes what changed or
is gone and opens what is new, and leaves earlier days as they were, so silver
days that are built again get the sector they had.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATE = ["exchange", "sector", "tick_size"]
COLUMNS = ["symbol", *STATE, "valid_from", "valid_to"]


def _same(a: Sequence[Column], b: Sequence[Column]) -> Column:
    out = F.lit(True)
    for x, y in zip(a, b):
        out = out & x.eqNullSafe(y)
    return out


def from_deliveries(deliveries: DataFrame, day: str = "ds") -> DataFrame:
    """The history of whole deliveries (``day`` names each one's day): states
    that stay the same are one row; a symbol that a delivery lacks ends there."""
    days = deliveries.select(day).distinct()
    # the delivery after each one (one row per delivery)
    after = days.select(F.col(day), F.lead(day).over(Window.orderBy(day)).alias("_next"))
    by_symbol = Window.partitionBy("symbol").orderBy(day)
    rows = deliveries.join(after, day).withColumns({
        "_before": F.lag(F.struct(*STATE, "_next")).over(by_symbol)})
    # a row starts a state if the delivery before lacked the symbol or told another
    goes_on = F.col("_before").isNotNull() & F.col("_before._next").eqNullSafe(F.col(day)) & _same(
        [F.col(c) for c in STATE], [F.col(f"_before.{c}") for c in STATE])
    numbered = rows.withColumn("_state", F.sum((~goes_on).cast("int")).over(by_symbol))
    ends = F.when(F.max(F.col("_next").isNull().cast("int")) == 0, F.date_sub(F.max("_next"), 1))
    return numbered.groupBy("symbol", *STATE, "_state").agg(
        F.min(day).alias("valid_from"), ends.alias("valid_to")).select(*COLUMNS)


def deliver(history: DataFrame, delivery: DataFrame, day: str) -> DataFrame:
    """``history`` after a delivery as of ``day``, not earlier than those it
    already holds.  The same delivery again changes nothing."""
    today = F.lit(day).cast("date")
    is_open = F.col("valid_to").isNull()
    closed, now = history.where(~is_open), history.where(is_open)
    new = delivery.select("symbol", *STATE).withColumn("_told", F.lit(True))
    met = now.alias("h").join(new.alias("d"), "symbol", "full_outer")
    known, told = F.col("valid_from").isNotNull(), F.coalesce("_told", F.lit(False))
    same = known & told & _same([F.col(f"h.{c}") for c in STATE], [F.col(f"d.{c}") for c in STATE])
    old = F.struct("symbol", *[F.col(f"h.{c}").alias(c) for c in STATE], "valid_from",
                   F.when(~same, F.date_sub(today, 1)).alias("valid_to"))
    opened = F.struct("symbol", *[F.col(f"d.{c}").alias(c) for c in STATE], today.alias("valid_from"),
                      F.lit(None).cast("date").alias("valid_to"))
    # what was opened and closed on one day was never valid
    lasting = F.when(known & (same | (F.col("valid_from") < today)), old)
    both = met.select(F.explode(F.array_compact(F.array(lasting, F.when(told & ~same, opened)))).alias("r"))
    return closed.unionByName(both.select("r.*")).select(*COLUMNS)


def as_of(history: DataFrame, day: str) -> DataFrame:
    """The master as it was on a day."""
    d = F.lit(day).cast("date")
    return history.where((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") >= d))).select(
        "symbol", *STATE)


def listed_on_day(trades: DataFrame, history: DataFrame, day: str = "event_date") -> DataFrame:
    """``trades`` with exchange and sector of the state that was valid on their
    day; NULL where the symbol was not listed.  An equi-join on the symbol with the
    interval as residual: states of a symbol are few and do not overlap."""
    h = history.select(F.col("symbol").alias("_symbol"), "exchange", "sector", "valid_from", "valid_to")
    valid = (F.col(day) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(day) <= F.col("valid_to")))
    met = trades.join(h, (F.col("symbol") == F.col("_symbol")) & valid, "left")
    return met.drop("_symbol", "valid_from", "valid_to")
