"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space, the separator of words everywhere in this subpackage.
WORD_GAP = r"[\x20\x09-\x0D]+"


def text_or_empty(col: str | Column) -> Column:
    """A null text is the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """The maximal runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(df: DataFrame) -> Column:
    """A content hash of the whole row: equal rows share it, and it survives
    recomputation of a lost partition (unlike a running row number)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(nulls, *cols)


def written(df: DataFrame, name: str, dictionary: bool = True) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: later passes read the files, and a lost executor costs
    nothing but the tasks it was running.  Columns of hashes gain nothing from
    Parquet's ``dictionary``."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    (df.write.option("compression", "zstd").option("parquet.enable.dictionary", str(dictionary).lower())
     .parquet(path))
    schema, spark = df.schema, df.sparkSession
    del df
    release(spark)
    out = spark.read.schema(schema).parquet(path)
    out.written_to = path
    return out


def discard(*done: DataFrame) -> None:
    """Deletes tables of ``written`` that no later phase reads."""
    for df in done:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished phases now: it does so
    when the driver's collector finds that no plan refers to them any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settle(spark: SparkSession) -> None:
    """``release`` once more: listeners hold the plan of a query, and with it its
    shuffle files, until they have seen its end, which may come a little later."""
    time.sleep(0.5)
    release(spark)
