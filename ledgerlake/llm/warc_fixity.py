"""Merkle fixity audit of WARC replicas.

A replica is a table of records: ``file``, ``offset`` (of the record in its
file), and its ``payload``, or the ``digest`` that ``hashed`` made of it where the
payload was read.  Each record is hashed with its place; the
records of an offset range of ``range_bytes`` form a leaf, ordered by offset;
``fanout`` neighbouring nodes form the next level, up to one root per file, and
the file roots one root per replica.  An audit compares the roots and descends
only into nodes that differ, down to the records.

Scale: payloads are hashed where they are read and never shuffled; a leaf
holds the records of a bounded byte range and an inner node ``fanout``
digests, so no group grows with the data, not even for one huge file.  The
trees are written once per replica, level by level, and a level shrinks by the
fan-out; the descent joins mismatching nodes only.

Defined results: a null payload is an empty record; a record that only one
replica has is ``missing`` or ``extra``; several records at one place are
compared as a whole; rows without a file or an offset are left
out (they have no place); empty tables give an empty result; further columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written


@dataclass(frozen=True)
class Tree:
    range_bytes: int = 1 << 18
    fanout: int = 16


def record(url: Column, body: Column) -> Column:
    """The bytes of a WARC response record, as text."""
    body, url = F.coalesce(body, F.lit("")), F.coalesce(url, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
        body, F.lit("\r\n\r\n"))


def lay_out(records: DataFrame, record_id: str, order: list[str],
            records_per_file: int = 1024) -> DataFrame:
    """Adds ``file`` and ``offset`` to records with an integer id and a
    ``length``: ids are dealt to files in turn and follow each other there, ties
    by ``order``.  A file holds a bounded number of ids.  Records without an id go to
    as many files of their own, by a hash of ``order``."""
    files = max(1, -(-records.count() // records_per_file))
    placed = records.withColumn("file", F.coalesce(
        F.pmod(F.col(record_id), F.lit(files)), F.lit(files) + F.pmod(F.xxhash64(*order), F.lit(files))))
    before = Window.partitionBy("file").orderBy(record_id, *order).rowsBetween(
        Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))


def hashed(payload: Column) -> Column:
    """The digest of a record; a null payload is an empty record."""
    return F.sha2(F.coalesce(payload.cast("binary"), F.lit("").cast("binary")), 256)


def record_digests(replica: DataFrame, how: Tree) -> DataFrame:
    """(file, leaf, offset, digest): one row per place."""
    digest = F.col("digest") if "digest" in replica.columns else hashed(F.col("payload"))
    one = replica.where(F.col("file").isNotNull() & F.col("offset").isNotNull()).select(
        "file", "offset", digest.alias("d"))
    # several records at one place: sums of their digests' quarters, so that
    # even a place with very many rows is combined before the shuffle
    quarters = [F.sum(F.conv(F.substring("d", 16 * i + 1, 15), 16, 10).cast("decimal(38,0)"))
                .cast("string").alias(f"q{i}") for i in range(4)]
    whole = one.groupBy("file", "offset").agg(
        F.count(F.lit(1)).alias("n"), F.min("d").alias("least"), F.max("d").alias("most"), *quarters)
    return whole.select(
        "file", F.expr(f"offset div {how.range_bytes}").alias("leaf"), "offset",
        F.sha2(F.concat_ws(":", F.col("offset").cast("string"), F.col("n").cast("string"),
                           "least", "most", "q0", "q1", "q2", "q3"), 256).alias("digest"))


def _joined(order: str) -> Column:
    parts = F.sort_array(F.collect_list(F.struct(order, "digest")))
    return F.sha2(F.array_join(F.transform(
        parts, lambda x: F.concat(x[order].cast("string"), F.lit(":"), x["digest"])), ","), 256)


def build(replica: DataFrame, how: Tree = Tree()) -> list[DataFrame]:
    """Levels from the records up: records, leaves (level 1), ..., file roots."""
    records = written(record_digests(replica, how), "fixity-records")
    level = written(records.groupBy("file", F.col("leaf").alias("node"))
                    .agg(_joined("offset").alias("digest")), "fixity-leaves")
    levels = [records, level]
    while (level.agg(F.max("node")).first()[0] or 0) > 0:
        level = written(level.withColumn("up", F.expr(f"node div {how.fanout}"))
                        .groupBy("file", F.col("up").alias("node2")).agg(_joined("node").alias("digest"))
                        .withColumnRenamed("node2", "node"), "fixity-level")
        levels.append(level)
    return levels


def root(levels: list[DataFrame]) -> DataFrame:
    """One row: the digest of all file roots, combined without gathering them."""
    return levels[-1].agg(F.count(F.lit(1)).alias("files"), F.bit_xor(F.xxhash64("file", "digest")).alias("x"),
                          F.sum(F.xxhash64("digest", "file").cast("decimal(38,0)")).alias("s"))


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of nodes that differ or that one side lacks."""
    both = a.withColumnRenamed("digest", "da").join(b.withColumnRenamed("digest", "db"), keys, "full")
    return both.where(~F.col("da").eqNullSafe(F.col("db")))


def audit(first: DataFrame, second: DataFrame, how: Tree = Tree()) -> DataFrame:
    """(file, offset, status) of the records of ``second`` that are not those
    of ``first``: changed, missing or extra."""
    trees = [build(first, how), build(second, how)]
    records = [t[0] for t in trees]
    if root(trees[0]).first() == root(trees[1]).first():
        return records[0].select("file", "offset", F.lit("").alias("status")).limit(0)
    height = max(len(t) for t in trees)
    suspects = None
    for k in range(height - 1, 0, -1):
        sides = [t[k] if k < len(t) else None for t in trees]
        if None in sides:     # one tree is lower: nothing to compare here yet
            continue
        if suspects is not None:
            parent = F.expr(f"node div {how.fanout}")
            sides = [s.join(suspects.withColumnRenamed("node", "up"),
                            (s["file"] == F.col("f")) & (parent == F.col("up")), "left_semi")
                     for s in sides]
        suspects = written(_differing(*sides, ["file", "node"]).select(F.col("file").alias("f"), "node"),
                           f"fixity-suspects-{k}")
    sides = [r.join(suspects, (r["file"] == F.col("f")) & (r["leaf"] == F.col("node")), "left_semi")
             for r in records]
    return _differing(*sides, ["file", "leaf", "offset"]).select(
        "file", "offset", F.when(F.col("db").isNull(), "missing").when(F.col("da").isNull(), "extra")
        .otherwise("changed").alias("status"))
