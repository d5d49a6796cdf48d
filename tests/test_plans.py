"""Physical-plan shape checks: shuffles, pruning, broadcast decisions."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import gold, silver
from ledgerlake.plans import regional
from ledgerlake.plans import catalog, users
from ledgerlake.plans.catalog import Lake
from ledgerlake.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, SF)


def test_pnl_is_one_shuffle(lake):
    p = plan(lake.pnl)
    assert hash_exchanges(lake.pnl) == 1
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p   # symbols broadcast
    assert "partial_sum" in p                                       # map-side combine


def test_outer_join_form_needs_more_shuffles(lake):
    assert hash_exchanges(gold.pnl_outer_join(lake.valid())) > 1


def test_activity_has_no_window_or_self_join(lake):
    p = plan(lake.activity)
    assert "Window" not in p and "SortMergeJoin" not in p
    assert hash_exchanges(lake.activity) == 2


def test_scan_reads_only_needed_columns(lake):
    p = plan(lake.pnl)
    scans = [{c.split(":")[0] for c in schema.split(",")}
             for schema in re.findall(r"ReadSchema: struct<([^>]*)>", p)]
    assert {"p_partkey"} in scans                              # the number of symbols
    events = next(s for s in scans if "event_id" in s)
    assert events <= {"event_id", "ts", "user_id", "event_type", "value", "props"}


@pytest.fixture()
def written_activity(spark, lake, tmp_path):
    lake.activity.write.partitionBy("ds").parquet(str(tmp_path / "act"))
    return spark.read.parquet(str(tmp_path / "act"))


def test_reports_prune_gold_partitions(lake, written_activity):
    df = regional.regional_volume(lake.users, lake.portfolios, written_activity, lake.as_of)
    p = plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*ds#\d+ >= 2024-01-01", p), p
    assert re.search(r"PartitionFilters: \[[^\]]*ds#\d+ <= 2024-01-31", p), p
    p = plan(users.activation_rate(lake.users, lake.portfolios, written_activity, lake.as_of))
    assert re.search(r"PartitionFilters: \[[^\]]*ds#\d+ >= 2023-01-01", p), p


def test_bars_use_a_hash_aggregation(lake):
    p = plan(gold.daily_bars(lake.valid("ts", "trade_id")))
    assert "HashAggregate" in p and "SortAggregate" not in p
    p = plan(gold.latest_closes(lake.valid("ts", "trade_id"), lake.as_of))
    assert "SortAggregate" not in p


def test_no_needless_distinct(lake):
    df = gold.regional_symbol_activity(lake.valid(), lake.portfolios, lake.users)
    assert "Expand" not in plan(df) and "distinct" not in plan(df)


def test_building_a_query_starts_no_job(spark):
    """But for those about sinks and file scans, queries are lazy."""
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    for name, build in catalog.queries().items():
        if name in catalog.LANDING:
            continue
        sc.setJobGroup(f"build-{name}", name)
        try:
            build(spark, SF)
            # reading a Parquet footer for the schema may start a job of one task
            jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"build-{name}")]
            stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
            assert all(s is None or s.numTasks == 1 for s in stages), name
            assert len(jobs) <= 10, (name, len(jobs))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)


def test_hot_portfolio_is_combined_map_side(spark):
    """A portfolio with a third of all trades still reaches the shuffle as
    partial rows; results equal the plain per-row computation."""
    t = fixtures.load(spark, SF)
    hot = t.trades.withColumn(
        "portfolio_id", F.when(F.col("trade_id").cast("int") % 3 == 0, F.lit("PORT_HOT"))
        .otherwise(F.col("portfolio_id")))
    v = silver.valid_trades(silver.scored_trades(hot, t.symbols))
    act = gold.fact_user_activity(v)
    assert "partial_count" in plan(act)
    h = act.filter(F.col("portfolio_id") == "PORT_HOT").agg(F.sum("num_trades")).first()[0]
    assert h == v.filter(F.col("portfolio_id") == "PORT_HOT").count()


def test_hot_portfolio_join_is_spread(spark):
    """A portfolio holding a third of all trades meets its owner in several
    keys, and no trade is lost or doubled."""
    t = fixtures.load(spark, SF)
    hot = t.trades.withColumn(
        "portfolio_id", F.when(F.col("trade_id").cast("int") % 3 == 0, F.lit("PORT_000001"))
        .otherwise(F.col("portfolio_id")))
    v = silver.valid_trades(silver.scored_trades(hot, t.symbols),
                            columns=("trade_id", "portfolio_id", "notional_usd"))
    joined = silver.join_owner_ccy(v, t.portfolios)
    plain = v.join(t.portfolios.select("portfolio_id", "base_ccy"), "portfolio_id")
    cols = ["trade_id", "portfolio_id", "base_ccy"]
    assert joined.select(cols).exceptAll(plain.select(cols)).count() == 0
    assert joined.count() == plain.count()
    salts = v.filter("portfolio_id = 'PORT_000001'").select(
        F.pmod(F.hash("trade_id"), F.lit(silver.OWNER_SALTS))).distinct().count()
    assert salts == silver.OWNER_SALTS


def test_owners_are_merged_and_only_hot_ones_repeated(spark):
    """the portfolios grow with the customers, so they are not sent whole
    to the driver, and only a hot one is repeated once per salt."""
    n = 3000
    v = spark.range(n).select(
        F.col("id").cast("string").alias("trade_id"),
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 100 != 1, F.concat(F.lit("P"), F.col("id") % 1000))
        .alias("portfolio_id"))
    owners = spark.range(1000).select(F.concat(F.lit("P"), "id").alias("portfolio_id"), F.lit("EUR").alias("base_ccy"))
    owners = owners.unionByName(spark.createDataFrame(
        [("HOT", "USD"), ("P1", "JPY"), (None, "GBP")], "portfolio_id string, base_ccy string"))
    joined = silver.join_owner_ccy(v, owners)
    met = next(line for line in plan(joined).splitlines() if "Join" in line and "_salt" in line)
    assert "SortMergeJoin" in met
    plain = v.join(owners, "portfolio_id").select(joined.columns)
    assert joined.exceptAll(plain).count() == plain.exceptAll(joined).count() == 0
    assert [r.portfolio_id for r in silver.hot_portfolios(v.where("portfolio_id is not null")).collect()] == ["HOT"]


def test_symbol_master_grows_with_the_data(spark):
    small, large = (fixtures.load(spark, f"/root/testdata/{d}").symbols.count() for d in ("sf0.001", "sf0.01"))
    assert (small, large) == (200, 2000)
    assert fixtures.load(spark, SF).users.count() == 150          # every customer
