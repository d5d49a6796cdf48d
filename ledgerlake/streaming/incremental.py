"""Incremental silver/gold maintenance as a Structured Streaming job.

The scheduled batch job re-runs a date window every hour; the streaming
form processes each new trade file once and keeps the layers current:

* ``readStream`` of the trade files (declared schema, file source; the
  checkpoint records which files were consumed).
* ``foreachBatch``: the micro-batch is enriched and written to the lake's one
  silver layer under ``event_date=…/feed=<name>-<batch>`` with dynamic
  partition overwrite, so a replayed batch (after a failure) replaces exactly
  its own rows — effectively once.  The batch run writes feed ``batch`` of the
  same layer, so both see each other's trades.
* The batch's partial aggregates (``operators.cells``) are written beside it
  under the same feed.  The gold facts of the days the batch touched are merged
  from the cells of all feeds of these days (left-semi join on ``ds`` → dynamic
  partition pruning) and overwrite those ``ds`` partitions: a late trade does not
  read its day's trades again.

Nothing is collected to the driver; every step is a Spark job over files
in the shared lake folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import pipeline, sinks
from ..operators import cells, silver
from ..schemas import TRADES

def trade_stream(spark: SparkSession, source_dir: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(TRADES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(source_dir)


def once(stream: DataFrame, within: str, key: str = "trade_id", at: str = "ts") -> DataFrame:
    """Each trade once, also if it is delivered again in a later file.

    The state holds the ids of the last ``within`` of event time (say
    ``"2 days"``) and no older ones.  A trade that comes later than that cannot be
    told from a repetition: it is left out and counted (``late_rows``)."""
    timed = stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", within)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_at")


def late_rows(query: StreamingQuery) -> int:
    """Rows of the recent batches that were left out as later than the watermark
    (repeated ones among them)."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


class IncrementalLake:
    """The per-batch step over the layers of a lake."""

    def __init__(self, lake_root: str, symbols: DataFrame, name: str = "stream"):
        self.paths = pipeline.LakePaths(lake_root)
        self.symbols, self.name = symbols, name

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()           # the trades are used three times
        try:
            if not sinks.has_rows(batch):
                return
            scored = (silver.scored_trades(batch, self.symbols)
                      .withColumn("feed", F.lit(f"{self.name}-{batch_id}")))
            sinks.write_partitioned(scored, self.paths.silver, ["event_date", "feed"],
                                    shuffle_by=["event_date"])
            own = cells.cells(pipeline.cell_trades(scored)).withColumn("feed", F.lit(f"{self.name}-{batch_id}"))
            sinks.write_partitioned(own, self.paths.cells, ["ds", "feed"], shuffle_by=["ds"])
            pipeline.build_facts_from_cells(spark, self.paths, batch.select(F.col("event_date").alias("ds")))
        finally:
            batch.unpersist()

    def read(self, spark: SparkSession, kind: str) -> DataFrame:
        if kind == "silver":
            return pipeline.read_silver(spark, self.paths)
        return pipeline.read_fact(spark, self.paths, kind)


def start_incremental(spark: SparkSession, source_dir: str, lake_root: str,
                      checkpoint: str, symbols: DataFrame,
                      available_now: bool = True,
                      processing_time: str | None = None,
                      max_files_per_trigger: int | None = None,
                      once_within: str | None = None) -> StreamingQuery:
    """Start the incremental job.

    ``available_now=True`` drains all pending files and stops (the hourly
    run); otherwise it runs continuously with ``processing_time`` triggers.
    The checkpoint must live in the shared lake folder.  With ``once_within``
    (a time, such as "2 days") re-delivered trades count once, see ``once``.
    """
    lake = IncrementalLake(lake_root, symbols)
    trades = trade_stream(spark, source_dir, max_files_per_trigger)
    w = ((once(trades, once_within) if once_within else trades).writeStream
         .foreachBatch(lake.process_batch)
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
