"""Sources, sinks and the layered run: CSV layout, dynamic overwrite, schemas."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake import pipeline, sinks
from ledgerlake.operators import bronze, gold, silver
from ledgerlake.schemas import FACT_PNL_COLUMNS, TRADES_ENRICHED_COLUMNS
from ledgerlake.sources import files, fixtures

SF = "/root/testdata/sf0.001"


def land_inputs(spark, root):
    t = fixtures.load(spark, SF)
    fx_dir, sym_path = f"{root}/landing/fx_rates", f"{root}/landing/symbols"
    files.write_fx_csv(t.rate_feed.filter(F.col("ds") != F.lit("2024-01-15").cast("date")), fx_dir)
    files.write_symbols_csv(t.symbol_feed, sym_path)
    return t, fx_dir, sym_path


def test_fx_csv_missing_day_is_absent_not_error(spark, tmp_path):
    root = str(tmp_path)
    _, fx_dir, _ = land_inputs(spark, root)
    fx = files.read_fx_csv(spark, fx_dir, "2024-01-14", "2024-01-16")
    assert sorted(r.ds for r in fx.select("ds").distinct().collect()) == [
        dt.date(2024, 1, 14), dt.date(2024, 1, 16)]
    plan = fx._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    miss = bronze.missing_days(fx, "2024-01-14", "2024-01-16").collect()
    assert [r.ds for r in miss] == [dt.date(2024, 1, 15)]


def test_directory_ds_wins_over_file_column(spark, tmp_path):
    p = str(tmp_path / "fx")
    spark.createDataFrame([("USD", "EUR", 0.9, "2024-01-02")],
                          "base_ccy string, quote_ccy string, rate double, ds string") \
        .coalesce(1).write.option("header", "true").csv(f"{p}/ds=2024-01-01")
    got = files.read_fx_csv(spark, p).collect()
    assert [r.ds for r in got] == [dt.date(2024, 1, 1)]


def test_dedupe_is_deterministic(spark):
    raw = spark.createDataFrame(
        [("USD", "EUR", 0.93, dt.date(2024, 1, 1)), ("USD", "EUR", 0.92, dt.date(2024, 1, 1)),
         ("USD", "EUR", None, dt.date(2024, 1, 1)), ("USD", "GBP", 0.79, dt.date(2024, 1, 1))],
        "base_ccy string, quote_ccy string, rate double, ds date")
    out = {(r.base_ccy, r.quote_ccy): r.rate
           for r in bronze.clean_rates(raw).collect()}
    assert out == {("USD", "EUR"): 0.92, ("USD", "GBP"): 0.79}


def test_pipeline_rerun_is_idempotent_and_keeps_other_days(spark, tmp_path):
    root = str(tmp_path)
    t, fx_dir, sym = land_inputs(spark, root)
    lake = f"{root}/lake"
    c1 = pipeline.run(spark, t.trades, fx_dir, sym, lake, "2024-01-01", "2024-01-30")
    assert c1["bronze.symbols"] == 200
    assert c1["silver.trades_enriched"] == 1000
    paths = pipeline.LakePaths(lake)
    before = sorted(pipeline.read_fact(spark, paths, "pnl").collect())
    # re-run one day: only that day's partitions are replaced
    c2 = pipeline.run(spark, t.trades, fx_dir, sym, lake, "2024-01-10", "2024-01-10")
    assert 0 < c2["silver.trades_enriched"] < 1000
    after = sorted(pipeline.read_fact(spark, paths, "pnl").collect())
    assert before == after
    s = pipeline.read_silver(spark, paths)
    assert s.columns == TRADES_ENRICHED_COLUMNS and s.count() == 1000
    fx = pipeline.read_bronze_fx(spark, paths)
    assert fx.select("ds").distinct().count() == 29            # one day never landed
    assert fx.count() == fx.select("base_ccy", "quote_ccy", "ds").distinct().count()
    assert fx.count() == 29 * 5                                 # duplicates removed


def test_gold_from_written_silver_equals_in_memory(spark, tmp_path):
    root = str(tmp_path)
    t, fx_dir, sym = land_inputs(spark, root)
    lake = f"{root}/lake"
    pipeline.run(spark, t.trades, fx_dir, sym, lake, "2024-01-01", "2024-01-31")
    written = pipeline.read_fact(spark, pipeline.LakePaths(lake), "pnl")
    assert written.columns == FACT_PNL_COLUMNS
    mem = gold.fact_pnl_daily(silver.valid_trades(silver.scored_trades(t.trades, t.symbols)))
    key = ["ds", "portfolio_id", "symbol"]
    assert written.count() == mem.count()
    assert written.select(*key, "num_trades").exceptAll(mem.select(*key, "num_trades")).count() == 0


def test_empty_write_keeps_partitions(spark, tmp_path):
    p = str(tmp_path / "e")
    full = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)],
                                 "ds date, x int")
    assert sinks.write_partitioned(full, p, ["ds"]) == 2
    empty = spark.createDataFrame([], "ds date, x int")
    assert sinks.write_partitioned(empty, p, ["ds"]) == 0
    assert spark.read.parquet(p).count() == 2
    assert not sinks.has_rows(empty) and sinks.has_rows(full)


def test_empty_window_writes_nothing(spark, tmp_path):
    root = str(tmp_path)
    t, fx_dir, sym = land_inputs(spark, root)
    lake = f"{root}/lake"
    c = pipeline.run(spark, t.trades, fx_dir, sym, lake, "2030-01-01", "2030-01-02")
    assert c["bronze.fx_rates"] == 0 and c["silver.trades_enriched"] == 0
    assert c["gold.pnl"] == 0 and c["bronze.symbols"] == 200


def test_rerun_replaces_whole_days(spark, tmp_path):
    from ledgerlake.schemas import TRADES
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    spark.createDataFrame([("A", "NYSE", "Tech", 0.01), ("B", "NYSE", "Tech", 0.01)],
                          "symbol string, exchange string, sector string, tick_size double") \
        .withColumn("ingestion_ts", F.current_timestamp()).write.parquet(paths.symbols)

    def load(rows, start, end):
        ts = lambda d: dt.datetime(2024, 1, d, 9, 0)
        t = spark.createDataFrame([(i, "P1", s, "BUY", p, 1, ts(d), "NYSE", ts(d).date())
                                   for i, s, p, d in rows], TRADES)
        pipeline.build_silver(spark, paths, t, start, end)
        pipeline.build_gold(spark, paths, start, end)
        return (sorted((r.trade_id, r.symbol, r.event_date.day)
                       for r in pipeline.read_silver(spark, paths).collect()),
                sorted((r.ds.day, r.symbol, r.num_trades)
                       for r in pipeline.read_fact(spark, paths, "pnl").collect()))

    window = ("2024-01-01", "2024-01-03")
    load([("1", "A", 1.0, 1), ("2", "A", 1.0, 1), ("3", "A", 1.0, 2), ("4", "A", 1.0, 3)], *window)
    # trade 1 re-booked to B, day 2 invalid, day 3 withdrawn
    silver_rows, facts = load([("1", "B", 1.0, 1), ("2", "A", 1.0, 1), ("3", "A", -1.0, 2)], *window)
    assert silver_rows == [("1", "B", 1), ("2", "A", 1), ("3", "A", 2)]
    assert facts == [(1, "A", 1), (1, "B", 1)]


def test_layer_tables_by_name(spark, tmp_path):
    t, fx_dir, sym = land_inputs(spark, str(tmp_path))
    paths = pipeline.LakePaths(str(tmp_path / "lake"))
    pipeline.run(spark, t.trades, fx_dir, sym, paths.root, "2024-01-01", "2024-01-31")
    try:
        assert "gold_v1.fact_pnl_daily" in pipeline.register_tables(spark, paths)
        by_name = spark.sql("SELECT SUM(num_trades) AS n FROM gold_v1.fact_pnl_daily").first().n
        assert by_name == pipeline.read_fact(spark, paths, "pnl").agg(F.sum("num_trades")).first()[0]
    finally:
        for table in pipeline.LAYER_TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
