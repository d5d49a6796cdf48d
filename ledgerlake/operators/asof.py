"""As-of join: for each row the last earlier row of another table.

Both tables are cut into chunks of time.  Inside a chunk the last value is found
by one sorted pass over the union of both sides (``last`` that ignores nulls);
what a chunk starts with is the last value of the chunks before it, found over one
row per key and chunk.  So no task holds the whole history of a key: a hot key is
spread over its chunks and, if one chunk alone is hot, over ``salts`` parts of its
left rows, each with its own copy of the chunk's (few) right rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _number(at: Column, kind: str) -> Column:
    """A time as a number: days of a date, microseconds of a timestamp."""
    return F.unix_date(at).cast("bigint") if kind == "date" else F.unix_micros(at.cast("timestamp"))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, take: Sequence[str],
              width: int, salts: int = 1, salt_by: str | None = None) -> DataFrame:
    """``left`` with the columns ``take`` of the last row of ``right`` that has
    the same ``keys`` and is not later than ``at``; NULL where there is none.

    ``width`` is the length of a chunk (days for dates, microseconds for
    timestamps).  Null keys or times match nothing; of several right rows at one
    time the greatest by ``take`` counts; every left row comes back once."""
    kind = dict(right.dtypes)[at]
    chunk = F.floor(_number(F.col(at), kind) / width).cast("bigint")
    value = F.struct(*take)
    known = (right.dropna(subset=[*keys, at]).groupBy(*keys, at).agg(F.max(value).alias("_v"))
             .withColumn("_chunk", chunk))
    # the last value of each chunk, and with it what the next chunks start with
    lasts = known.groupBy(*keys, "_chunk").agg(F.max_by("_v", at).alias("_last"))
    part = F.pmod(F.xxhash64(salt_by), F.lit(salts)) if salt_by else F.lit(0).cast("bigint")
    rows = left.withColumns({"_chunk": chunk, "_salt": part, "_row": F.struct(*left.columns)})
    # carried in: over chunks that hold a value or are asked for, one row each
    asked = rows.select(*keys, "_chunk").distinct()
    chunks = lasts.join(asked, [*keys, "_chunk"], "full_outer")
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(*keys, "_chunk", F.last("_last", ignorenulls=True).over(before).alias("_in"))
    copies = known.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    both = rows.select(*keys, at, "_chunk", "_salt", "_row").unionByName(
        copies.select(*keys, at, "_chunk", "_salt", "_v"), allowMissingColumns=True)
    # a right row comes before the left rows of its time
    inside = (Window.partitionBy(*keys, "_chunk", "_salt").orderBy(at, F.col("_row").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn("_now", F.last("_v", ignorenulls=True).over(inside)).where(F.col("_row").isNotNull())
    met = found.join(carried, [*keys, "_chunk"], "left")
    got = F.coalesce("_now", "_in")
    return met.select("_row.*", *[got[c].alias(c) for c in take])
