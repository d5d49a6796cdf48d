"""The corpus pipeline: documents in, packed training sequences out.

Every stage is one operator of ``ledgerlake.llm`` applied to all rows that the
stage before it kept; its result is written as Parquet and read again, so a
stage can be repeated on its own and no plan spans two stages.  All stages but
the last return the columns of ``documents``.

Not expressible in SQL as a whole (SimHash components, tokenizer), so
``ORACLE_SQL`` is None; tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from ledgerlake.llm.common import written
from ledgerlake.llm.queries import packing_defaults, table

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines are cut from the others."""
    return quality_rules.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line of the corpus are cut."""
    return line_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.with_digest(packing.pack(docs, packing_defaults()))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
