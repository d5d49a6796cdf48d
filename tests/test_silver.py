"""Silver enrichment: validity (three-valued) and quality scores."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.operators import silver
from ledgerlake.schemas import TRADES, TRADES_ENRICHED_COLUMNS

TS = dt.datetime(2024, 1, 10, 12, 0)
D = dt.date(2024, 1, 10)


def trades(spark, rows):
    return spark.createDataFrame(
        [(f"T{i}", "PORT_000001", sym, "BUY", price, qty, TS, "NYSE", D)
         for i, (sym, price, qty) in enumerate(rows)], TRADES)


def symbols(spark):
    return spark.createDataFrame(
        [("AAA", "NYSE", "Technology", 0.01), ("NOSEC", "NASDAQ", None, 0.01)],
        "symbol string, exchange string, sector string, tick_size double")


def test_five_quality_cases(spark):
    t = trades(spark, [
        ("AAA", 175.5, 50),     # perfect → 100
        ("NOSEC", 10.0, 5),     # listed, no sector → 90
        ("AAA", -1.0, 5),       # invalid price → 50
        ("ZZZ", 10.0, 5),       # unlisted: invalid and no sector → 40
        ("AAA", None, 5),       # NULL price: validity NULL → stays 100
    ])
    out = {r.trade_id: r for r in silver.scored_trades(t, symbols(spark)).collect()}
    assert [out[f"T{i}"].quality_score for i in range(5)] == [100, 90, 50, 40, 100]
    assert [out[f"T{i}"].is_valid for i in range(5)] == [True, True, False, False, None]
    assert out["T0"].notional_usd == 8775.0          # 175.50 × 50
    assert out["T0"].price_usd == 175.5
    assert out["T3"].exchange is None                 # left join keeps the trade


def test_contract_columns(spark):
    t = trades(spark, [("AAA", 1.0, 1)])
    df = silver.scored_trades(t, symbols(spark))
    assert df.columns == TRADES_ENRICHED_COLUMNS
    assert "processed_ts" not in silver.scored_trades(
        t, symbols(spark), with_processed_ts=False).columns


def test_valid_trades_drops_null_validity_and_bounds_inclusive(spark):
    rows = [("AAA", 1.0, 1), ("AAA", None, 1), ("AAA", 2.0, 0)]
    t = trades(spark, rows).unionByName(
        trades(spark, [("AAA", 3.0, 1)]).withColumn(
            "event_date", F.lit(dt.date(2024, 1, 11))).withColumn("trade_id", F.lit("L")))
    e = silver.scored_trades(t, symbols(spark))
    v = silver.valid_trades(e, "2024-01-10", "2024-01-10", columns=("portfolio_id",))
    assert v.count() == 1
    v2 = silver.valid_trades(e, "2024-01-10", "2024-01-11", columns=("portfolio_id",))
    assert v2.count() == 2
    assert v.columns == ["ds", "portfolio_id"]


def test_quality_histogram(spark):
    t = trades(spark, [("AAA", 1.0, 1), ("AAA", 2.0, 1), ("ZZZ", 1.0, 1)])
    h = {(r.quality_score, r.is_valid): r.num_trades
         for r in silver.quality_score_histogram(silver.scored_trades(t, symbols(spark))).collect()}
    assert h == {(100, True): 2, (40, False): 1}
