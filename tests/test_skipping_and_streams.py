"""Row groups that a scan skips, and trades that a stream delivers twice or late."""

import datetime as dt
import time

from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.schemas import TRADES
from ledgerlake.streaming import start_incremental
from ledgerlake.streaming.incremental import IncrementalLake, late_rows

DAY = dt.date(2024, 1, 5)


def rows_read(df):
    """Rows the scan of a collected frame handed on, and rows of the result."""
    n = len(df.collect())
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value(), n


def test_scans_skip_row_groups(spark, tmp_path):
    n = 40_000
    df = spark.range(n).select(
        F.lit(DAY).alias("event_date"), F.format_string("SYM_%03d", F.pmod(F.xxhash64("id"), F.lit(200))).alias("symbol"),
        F.concat(F.lit("PORT_"), F.sha2((F.col("id") / 20).cast("int").cast("string"), 256)).alias("portfolio_id"),
        F.rand(3).alias("x")).repartition(4)
    one = df.orderBy("portfolio_id").first().portfolio_id
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    df.coalesce(1).write.partitionBy("event_date").parquet(plain)
    assert sinks.write_clustered(df, clustered, "event_date", ["symbol", "portfolio_id"], ["portfolio_id"],
                                 values=2000, row_group_bytes=64 << 10) == n
    reads = {}
    for name, path in (("plain", plain), ("clustered", clustered)):
        t = spark.read.parquet(path)
        assert t.count() == n
        reads[name] = (rows_read(t.where(F.col("portfolio_id") == one)), rows_read(t.where("symbol = 'SYM_007'")))
    (p_read, p_n), (s_read, s_n) = reads["clustered"]
    assert (p_n, s_n) == (reads["plain"][0][1], reads["plain"][1][1]) and p_n == 20
    assert reads["plain"][0][0] == reads["plain"][1][0] == n        # one row group: all of it
    assert p_read < n / 2 and s_read < n / 10, reads


def test_hot_symbol_spans_files(spark, tmp_path):
    df = spark.range(30_000).select(F.lit(DAY).alias("event_date"), F.lit("HOT").alias("symbol"),
                                    F.format_string("P%05d", "id").alias("portfolio_id"))
    sinks.write_clustered(df, str(tmp_path / "t"), "event_date", ["symbol", "portfolio_id"])
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 1 and sum(r["count"] for r in files) == 30_000
    # days without rows stay, days with rows are replaced
    other = df.limit(3).withColumn("event_date", F.lit(dt.date(2024, 1, 6)))
    sinks.write_clustered(other, str(tmp_path / "t"), "event_date", ["symbol"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 30_003


def test_redelivered_and_late_trades(spark, tmp_path):
    symbols = spark.createDataFrame([("A", "NYSE", "Tech", 0.01)],
                                    "symbol string, exchange string, sector string, tick_size double")
    src, lake, ckpt = str(tmp_path / "src"), str(tmp_path / "lake"), str(tmp_path / "ckpt")

    def land(*rows):
        at = lambda h: dt.datetime.combine(DAY, dt.time()) + dt.timedelta(hours=h)
        spark.createDataFrame([(i, "P1", "A", "BUY", 10.0, 1, at(h), "NYSE", at(h).date()) for i, h in rows],
                              TRADES).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)        # the source takes files by their time

    land(("1", 1), ("2", 1))
    land(("1", 1), ("3", 2), ("3", 2))            # again in another file, and twice in one
    land(("4", 40))
    land(("8", 40))                               # a batch goes by the watermark of the one before
    land(("5", 3), ("6", 39))                     # 5 comes later than the watermark
    q = start_incremental(spark, src, lake, ckpt, symbols, max_files_per_trigger=1, once_within="4 hours")
    q.awaitTermination(300)
    assert late_rows(q) == 1
    land(("6", 39), ("7", 41))                    # after a restart the state is still there
    q = start_incremental(spark, src, lake, ckpt, symbols, once_within="4 hours")
    q.awaitTermination(300)
    ids = sorted(r.trade_id for r in IncrementalLake(lake, symbols).read(spark, "silver").collect())
    assert ids == ["1", "2", "3", "4", "6", "7", "8"]
    pnl = IncrementalLake(lake, symbols).read(spark, "pnl").agg(F.sum("num_trades")).first()[0]
    assert pnl == 7
