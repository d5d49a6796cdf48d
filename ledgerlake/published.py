"""Layer tables whose days are published atomically, through the catalog.

A run writes its days to folders of its own and then points the table's
partitions at them, one catalog statement a day: a reader sees a day as it was
or as it is now, never half of it, whenever it starts and whatever step the run
is at.  A run that dies before it publishes changes nothing; one that dies among
its days leaves whole old and whole new days, and is repaired by running again.
A day that became empty is dropped in the same way.  Readers that have planned
keep the old files, until ``retire`` deletes the folders that no partition names
any more, after a time of grace.

The tables are plain Parquet tables of the session's catalog; there is no format
and no log beside it.  Tables without days are replaced by moving their location.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Staged:
    """Days that are written but not yet seen by readers."""
    table: str
    folder: str
    day: str
    every: tuple[str, ...]                 # days the run stands for
    filled: frozenset[str]                 # of these, days with rows
    rows: int
    fixed: Mapping[str, str] = field(default_factory=dict)   # further partition columns

    def partition(self, d: str) -> str:
        return ", ".join(f"{c} = '{v}'" for c, v in {self.day: d, **self.fixed}.items())

    def place(self, d: str) -> str:
        return "/".join([self.folder, f"{self.day}={d}", *(f"{c}={v}" for c, v in self.fixed.items())])


class Published:
    """The published tables of one database, under one folder."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark, self.database, self.root = spark, database, root.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def named(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.named(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.named(table))

    def _run_folder(self, table: str) -> str:
        return f"{self.root}/{table}/run={dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"

    def _create(self, df: DataFrame, table: str, partitions: list[str]) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        # an external table: dropping a partition leaves its files
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.named(table)} ({columns}) USING parquet {by} "
                       f"LOCATION '{self.root}/{table}/empty'")

    def stage(self, df: DataFrame, table: str, day: str, start: str, end: str,
              fixed: Mapping[str, str] | None = None) -> Staged:
        """Writes the rows of the days [start, end] where no reader looks."""
        fixed = dict(fixed or {})
        df = df.withColumns({c: F.lit(v) for c, v in fixed.items()}) if fixed else df
        keys = [day, *fixed]
        df = df.select(*[c for c in df.columns if c not in keys], *keys)
        self._create(df, table, keys)
        folder, seen = self._run_folder(table), Observation("staged")
        inside = df.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        (inside.hint("rebalance", day)
         .observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set(F.col(day).cast("string")).alias("days"))
         .write.partitionBy(*keys).parquet(folder))
        first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
        every = tuple(str(first + dt.timedelta(days=i)) for i in range((last - first).days + 1))
        return Staged(table, folder, day, every, frozenset(seen.get["days"]), int(seen.get["n"]), fixed)

    def publish(self, staged: Staged) -> int:
        """Moves the table's partitions to the staged folders, day by day."""
        name = self.named(staged.table)
        present = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        for d in staged.every:
            part = staged.partition(d)
            known = "/".join(f"{c}={v}" for c, v in {staged.day: d, **staged.fixed}.items()) in present
            if d in staged.filled and known:
                self._say(f"ALTER TABLE {name} PARTITION ({part}) SET LOCATION '{staged.place(d)}'")
            elif d in staged.filled:
                self._say(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({part}) LOCATION '{staged.place(d)}'")
            elif known:
                self._say(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({part})")
        self.spark.catalog.refreshTable(name)
        return staged.rows

    def _say(self, statement: str) -> None:
        self.spark.sql(statement)

    def replace_days(self, df: DataFrame, table: str, day: str, start: str, end: str,
                     fixed: Mapping[str, str] | None = None) -> int:
        """Makes ``df`` the whole content of the days [start, end]; returns rows."""
        return self.publish(self.stage(df, table, day, start, end, fixed))

    def replace_table(self, df: DataFrame, table: str) -> int:
        """Makes ``df`` the whole content of a table without days."""
        self._create(df, table, [])
        folder, seen = self._run_folder(table), Observation("staged")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(folder)
        self._say(f"ALTER TABLE {self.named(table)} SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(self.named(table))
        return int(seen.get["n"])

    def _locations(self, table: str) -> set[str]:
        """The folders that the table or its partitions name."""
        name = self.named(table)
        wanted = [f"DESCRIBE EXTENDED {name}"]
        if self.spark.table(name).schema and self._partitioned(table):
            wanted = ["DESCRIBE EXTENDED {} PARTITION ({})".format(
                name, ", ".join("{} = '{}'".format(*kv.split("=", 1)) for kv in r[0].split("/")))
                for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()]
        rows = [r for w in wanted for r in self.spark.sql(w).collect() if r.col_name == "Location"]
        return {r.data_type.split(":", 1)[-1].replace("//", "/") for r in rows}

    def _partitioned(self, table: str) -> bool:
        return any(c.isPartition for c in self.spark.catalog.listColumns(self.named(table)))

    def retire(self, table: str, grace_seconds: float = 86_400) -> list[str]:
        """Deletes folders of earlier or dead runs that no partition names and
        that were written more than the time of grace ago; returns them."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        levels = "/*" * sum(c.isPartition for c in self.spark.catalog.listColumns(self.named(table)))
        pattern = path(f"{self.root}/{table}/run=*{levels}")
        fs = pattern.getFileSystem(conf)
        used, before = self._locations(table), (time.time() - grace_seconds) * 1000
        gone = []
        for status in fs.globStatus(pattern) or []:
            plain = status.getPath().toUri().getPath()
            if status.isDirectory() and plain not in used and status.getModificationTime() <= before:
                fs.delete(status.getPath(), True)
                gone.append(plain)
        return gone
