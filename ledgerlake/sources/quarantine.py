"""Delimited feeds whose malformed rows are set aside, not lost.

A row is rejected if the parser cannot read its line into the declared schema
(too few or too many fields, text where a number or a date is declared), or if a
required value is missing.  Rejected rows go to a sink of their own with the
file, the line and the reason; all others go on.  More rejects than the feed
allows fail the job before anything is written but the rejects.

The feed is scanned once for the rejects and the two counts (an ``Observation``
on the write) and once for the good rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Name of the column that takes a line the parser cannot read.
BAD_LINE = "_bad_line"


class TooManyRejects(RuntimeError):
    """A feed has more malformed rows than it may have."""


@dataclass(frozen=True)
class Feed:
    """A delimited feed: its columns in the order of the file, those that must
    have a value, and how many rows may be rejected."""
    name: str
    schema: StructType                 # columns of the file, then partition columns
    required: Sequence[str] = ()
    partitions: Sequence[str] = ()     # columns that come from folder names
    repeated: Sequence[str] = ()       # of these, those that the files carry too, last
    header: bool = True
    max_rejects: int = 100             # always allowed
    max_share: float = 0.01            # allowed of a large feed

    @property
    def in_file(self) -> list[StructField]:
        own = [f for f in self.schema.fields if f.name not in self.partitions]
        return own + [StructField(f"_file_{c}", StringType(), True) for c in self.repeated]

    def allows(self, rejected: int, rows: int) -> bool:
        return rejected <= max(self.max_rejects, self.max_share * rows)


def scan(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """All rows of the feed, with ``BAD_LINE`` and ``_file``.

    Column pruning is off: whether a line is malformed must not depend on the
    columns that are asked for."""
    folders = [f for f in feed.schema.fields if f.name in feed.partitions]
    schema = StructType([*feed.in_file, *folders, StructField(BAD_LINE, StringType(), True)])
    return (spark.read.schema(schema).option("header", str(feed.header).lower())
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
            .option("columnPruning", "false").csv(path)
            .withColumn("_file", F.col("_metadata.file_path")))


def _lacking(feed: Feed) -> Column:
    """Whether a required value is missing."""
    out = F.lit(False)
    for c in feed.required:
        out = out | F.col(c).isNull()
    return out


def good_rows(rows: DataFrame, feed: Feed) -> DataFrame:
    return rows.where(F.col(BAD_LINE).isNull() & ~_lacking(feed)).select(*feed.schema.fieldNames())


def reason(feed: Feed) -> Column:
    """Why a row is rejected: ``fields`` (too few or too many), ``type:<column>``
    or ``missing:<column>``; of several, the first by column."""
    fields = feed.in_file
    # the line read again as so many texts and one more
    names = [f"c{i}" for i in range(len(fields) + 1)]
    texts = F.from_csv(F.col(BAD_LINE), ", ".join(f"{n} string" for n in names), {"mode": "PERMISSIVE"})
    found = F.when(F.col(BAD_LINE).isNotNull() & texts[names[-1]].isNotNull(), "fields")
    for f, n in zip(fields, names):
        text = F.when(F.col(BAD_LINE).isNotNull(), texts[n])
        unread = text.isNotNull() & text.try_cast(f.dataType).isNull()
        found = found.when(unread, f"type:{f.name}")
    for c in feed.required:
        missing = F.when(F.col(BAD_LINE).isNull(), F.col(c).isNull())
        found = found.when(missing, f"missing:{c}")
    return found.otherwise("fields")


def rejected_rows(rows: DataFrame, feed: Feed) -> DataFrame:
    """(feed, file, line, reason, and the partition columns) of the rejected rows;
    of a row that was read but lacks a value, the line is written anew."""
    line = F.coalesce(F.col(BAD_LINE), F.to_csv(F.struct(*[f.name for f in feed.in_file])))
    return (rows.where(F.col(BAD_LINE).isNotNull() | _lacking(feed))
            .select(F.lit(feed.name).alias("feed"), F.col("_file").alias("file"), line.alias("line"),
                    reason(feed).alias("reason"), *feed.partitions))


def set_aside(rows: DataFrame, feed: Feed, rejects: str, run: str) -> DataFrame:
    """Writes the rejected rows under ``rejects/feed=…/run=…`` (a repeated run
    replaces its own) and returns the good rows.  Raises ``TooManyRejects`` if
    there are more than the feed allows; the rejects stay, to be looked at."""
    seen, bad = Observation("rows"), Observation("rejects")
    every = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    (rejected_rows(every, feed).drop("feed").observe(bad, F.count(F.lit(1)).alias("n"))
     .write.mode("overwrite").parquet(f"{rejects.rstrip('/')}/feed={feed.name}/run={run}"))
    n, n_bad = int(seen.get["n"]), int(bad.get["n"])
    if not feed.allows(n_bad, n):
        raise TooManyRejects(f"{feed.name}: {n_bad} of {n} rows are malformed; see {rejects}")
    return good_rows(rows, feed)


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """All rejected rows: file, line, reason, partition columns, feed, run."""
    return spark.read.option("mergeSchema", "true").parquet(rejects)
