"""Partial aggregates: facts from merged cells equal the facts from all trades,
whatever the batches; deviations from exact sums; replays; daily sketches."""

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake import pipeline
from ledgerlake.operators import cells, gold, silver, sketches
from ledgerlake.schemas import TRADES
from ledgerlake.sources import fixtures
from ledgerlake.streaming import IncrementalLake

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def valid(spark):
    t = fixtures.load(spark, SF)
    odd = spark.createDataFrame([(dt.date(2024, 1, 2), "P9", "SYM_00", "HOLD", 3.5, 2, 7.0, "NYSE", None)] * 3,
                                "ds date, portfolio_id string, symbol string, side string, price_usd double, "
                                "qty bigint, notional_usd double, exchange string, sector string")
    return pipeline.cell_trades(silver.scored_trades(t.trades, t.symbols)).unionByName(odd)


def test_any_batches_give_the_same_facts(spark, valid):
    facts = {"pnl": gold.fact_pnl_daily(valid), "activity": gold.fact_user_activity(valid),
             "liquidity": gold.fact_liquidity(valid)}
    for parts in (1, 4):
        some = None
        for k in range(parts):
            own = cells.cells(valid.where(F.pmod(F.hash("portfolio_id", "price_usd", "qty"), F.lit(parts)) == k))
            some = own if some is None else some.unionByName(own)
        some = some.unionByName(some.limit(0))
        for kind, want in facts.items():
            got = cells.FACTS[kind](some)
            assert got.columns == want.columns and got.dtypes == want.dtypes
            if kind == "liquidity":
                keys = ["ds", "symbol", "exchange", "sector"]
                a = {tuple(r[k] for k in keys): r.price_volatility for r in got.collect()}
                b = {tuple(r[k] for k in keys): r.price_volatility for r in want.collect()}
                assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
                got, want = got.drop("price_volatility"), want.drop("price_volatility")
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("values", [
    [1e6 + 0.01 * k for k in range(9)], [5.0] * 7, [0.1, 0.2, 0.3], [99999999.99, 100000000.0, 99999999.98],
    [random.Random(1).uniform(1, 2000) for _ in range(500)]])
def test_deviation_does_not_cancel(spark, values):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), f"P{i % 3}", "A", "BUY", round(v, 6), 1, 1.0, "X", "Y")
                                for i, v in enumerate(values)],
                               "ds date, portfolio_id string, symbol string, side string, price_usd double, "
                               "qty bigint, notional_usd double, exchange string, sector string")
    got = cells.liquidity(cells.cells(df)).first().price_volatility
    want = statistics.stdev([Decimal(repr(round(v, 6))) for v in values])
    assert got == pytest.approx(float(want), rel=1e-9, abs=1e-9)


def test_late_and_replayed_batches(spark, tmp_path):
    """A batch for an old day merges with that day's cells; a replay replaces
    its own; the day's trades are not needed any more."""
    lake = IncrementalLake(str(tmp_path / "lake"), spark.createDataFrame(
        [("A", "NYSE", "Tech", 0.01)], "symbol string, exchange string, sector string, tick_size double"))
    at = dt.datetime(2024, 1, 5, 10, 0)

    def batch(*rows):
        return spark.createDataFrame([(str(i), p, "A", side, price, 2, at, "NYSE", at.date())
                                      for i, p, side, price in rows], TRADES)

    lake.process_batch(batch((1, "P1", "BUY", 10.0), (2, "P2", "BUY", 10.0)), 0)
    # nothing but cells of the old batch: its silver files are out of reach
    calls = []
    read, pipeline.read_silver = pipeline.read_silver, lambda *a, **k: calls.append(a)
    try:
        lake.process_batch(batch((3, "P1", "SELL", 13.0)), 1)
        lake.process_batch(batch((3, "P1", "SELL", 13.0)), 1)
    finally:
        pipeline.read_silver = read
    got = {r.portfolio_id: (r.buy_qty, r.sell_qty, r.realized_pnl_usd) for r in lake.read(spark, "pnl").collect()}
    assert got == {"P1": (2, 2, 6.0), "P2": (2, 0, 0.0)} and not calls
    assert lake.read(spark, "liquidity").first().unique_portfolios == 2


def test_sketches_over_windows(spark):
    """Estimates of united days against exact counts; a day stored twice does
    not count twice."""
    rng, day = random.Random(5), dt.date(2024, 1, 1)
    rows = [(day + dt.timedelta(days=rng.randrange(40)), rng.choice("ab"), rng.randrange(30_000)) for _ in range(60_000)]
    df = spark.createDataFrame(rows + [(day, "hot", 1)] * 5000, "ds date, k string, v long")
    stored = sketches.daily(df, ["k"], ["v"])
    stored = stored.unionByName(stored)
    for as_of, days in (("2024-01-31", 30), ("2024-01-10", 3), ("2024-02-20", 100)):
        got = {r.k: r.approx_v for r in sketches.window(stored, ["k"], ["v"], as_of, days).collect()}
        want = {r.k: r.exact_v for r in sketches.exact_window(df, ["k"], ["v"], as_of, days).collect()}
        assert got.keys() == want.keys()
        for k, n in want.items():
            assert abs(got[k] - n) <= max(1, 4 * sketches.standard_error() * n)
    assert sketches.window(stored, ["k"], ["v"], "2020-01-01", 5).count() == 0
