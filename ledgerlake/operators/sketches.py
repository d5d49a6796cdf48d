"""Distinct counts over long windows from daily sketches.

An exact distinct count cannot be added up over days, so a 30-day count reads 30
days of trades.  A HyperLogLog sketch per day and key can: it is a few kilobytes
at most, is built once when the day is written, and sketches of any days unite to
the sketch of them all.  ``window`` estimates from at most ``days`` small rows per
key; ``exact_window`` is the exact query beside it.

The relative standard error is 1.04 / sqrt(2 ** lg_k); while few values are
seen a sketch holds them as they are and its estimate is nearly exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / math.sqrt(1 << lg_k)


def daily(df: DataFrame, keys: Sequence[str], what: Sequence[str], day: str = "ds", lg_k: int = LG_K) -> DataFrame:
    """One row per day and key: the sketch of each column of ``what``.  Values
    are gathered in sketches on the map side, so a hot key is one row a task."""
    return df.groupBy(day, *keys).agg(*[F.hll_sketch_agg(c, lg_k).alias(f"{c}_sketch") for c in what])


def _inside(day: str, as_of: str, days: int) -> Column:
    return F.col(day).between(F.date_sub(F.lit(as_of).cast("date"), days), F.lit(as_of).cast("date"))


def window(sketches: DataFrame, keys: Sequence[str], what: Sequence[str], as_of: str, days: int,
           day: str = "ds") -> DataFrame:
    """Per key, the estimated number of distinct values from ``as_of - days`` to
    ``as_of``, and the number of daily rows it was made from."""
    return sketches.where(_inside(day, as_of, days)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_days"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"approx_{c}") for c in what])


def exact_window(df: DataFrame, keys: Sequence[str], what: Sequence[str], as_of: str, days: int,
                 day: str = "ds") -> DataFrame:
    return df.where(_inside(day, as_of, days)).groupBy(*keys).agg(
        *[F.countDistinct(c).alias(f"exact_{c}") for c in what])


def within(approx: Column, true: Column, lg_k: int = LG_K, errors: float = 4.0) -> Column:
    """Whether an estimate is no more than so many standard errors (or one) off."""
    return F.abs(approx - true) <= F.greatest(F.lit(1.0), errors * standard_error(lg_k) * true)
