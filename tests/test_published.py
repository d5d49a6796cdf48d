"""Atomic publication: what readers see before, between and after the steps of a
run, runs that die, emptied days, clean-up."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake import pipeline
from ledgerlake.published import Published
from ledgerlake.sources import files, fixtures

SF = "/root/testdata/sf0.001"
WINDOW = ("2024-01-01", "2024-01-03")


@pytest.fixture()
def tables(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    yield Published(spark, name, str(tmp_path / "tables"))
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(spark, *xs):
    return spark.createDataFrame([(dt.date(2024, 1, d), v) for d, v in xs], "ds date, v string")


def seen(tables, name="t"):
    return sorted((r.ds.day, r.v) for r in tables.read(name).collect())


def test_readers_see_whole_days(spark, tables):
    tables.replace_days(rows(spark, (1, "a"), (1, "b"), (2, "a"), (3, "a"), (3, "b")), "t", "ds", *WINDOW)
    old = [(1, "a"), (1, "b"), (2, "a"), (3, "a"), (3, "b")]
    assert seen(tables) == old
    early = tables.read("t").rdd        # planned: keeps the files it has listed
    assert early.count() == 5
    staged = tables.stage(rows(spark, (1, "c"), (3, "c"), (3, "d")), "t", "ds", *WINDOW)
    assert staged.rows == 3 and seen(tables) == old
    # between any two statements every day is whole, old or new
    new = {1: ["c"], 2: [], 3: ["c", "d"]}
    say, states = tables._say, []

    def watched(statement):
        say(statement)
        spark.catalog.refreshTable(tables.named("t"))
        states.append(seen(tables))

    tables._say = watched
    assert tables.publish(staged) == 3
    tables._say = say
    assert len(states) == 3
    for state in states:
        for day in (1, 2, 3):
            whole = [v for d, v in state if d == day]
            assert whole in ([v for d, v in old if d == day], new[day])
    assert seen(tables) == [(1, "c"), (3, "c"), (3, "d")] and early.count() == 5


def test_runs_that_die(spark, tables):
    tables.replace_days(rows(spark, (1, "a"), (2, "a")), "t", "ds", *WINDOW)
    dead = tables.stage(rows(spark, (1, "x")), "t", "ds", *WINDOW)      # dies before it publishes
    assert seen(tables) == [(1, "a"), (2, "a")]
    half = tables.stage(rows(spark, (1, "b"), (2, "b")), "t", "ds", *WINDOW)
    say = tables._say

    def dying(statement):
        if "2024-01-02" in statement:
            raise RuntimeError("lost the driver")
        say(statement)

    tables._say = dying
    with pytest.raises(RuntimeError):
        tables.publish(half)
    tables._say = say
    spark.catalog.refreshTable(tables.named("t"))
    assert seen(tables) == [(1, "b"), (2, "a")]
    tables.replace_days(rows(spark, (1, "b"), (2, "b")), "t", "ds", *WINDOW)        # run again
    assert seen(tables) == [(1, "b"), (2, "b")]
    # clean-up: what no partition names goes, after the time of grace only
    assert tables.retire("t", grace_seconds=3600) == []
    gone = tables.retire("t", grace_seconds=-1)
    assert len(gone) == 5 and not os.path.exists(dead.place("2024-01-01"))
    assert seen(tables) == [(1, "b"), (2, "b")]


def test_feeds_are_replaced_on_their_own(spark, tables):
    tables.replace_days(rows(spark, (1, "a"), (2, "a")), "t", "ds", *WINDOW, fixed={"feed": "batch"})
    tables.replace_days(rows(spark, (1, "s")), "t", "ds", "2024-01-01", "2024-01-01", fixed={"feed": "stream"})
    assert seen(tables) == [(1, "a"), (1, "s"), (2, "a")]
    tables.replace_days(rows(spark, (2, "b")), "t", "ds", *WINDOW, fixed={"feed": "batch"})
    assert seen(tables) == [(1, "s"), (2, "b")]


def test_tables_without_days(spark, tables):
    one, two = rows(spark, (1, "a")), rows(spark, (1, "b"), (2, "c"))
    assert tables.replace_table(one, "m") == 1 and seen(tables, "m") == [(1, "a")]
    assert tables.replace_table(two, "m") == 2 and seen(tables, "m") == [(1, "b"), (2, "c")]
    assert len(tables.retire("m", -1)) == 1 and seen(tables, "m") == [(1, "b"), (2, "c")]


def test_days_outside_the_run_stay_out(spark, tables):
    tables.replace_days(rows(spark, (1, "a"), (9, "z")), "t", "ds", *WINDOW)
    assert seen(tables) == [(1, "a")]


def test_published_run(spark, tables, tmp_path):
    t = fixtures.load(spark, SF)
    files.write_fx_csv(t.rate_feed, str(tmp_path / "fx"))
    files.write_symbols_csv(t.symbol_feed, str(tmp_path / "sym"))
    run = lambda trades, *w: pipeline.run_published(
        spark, tables, trades, str(tmp_path / "fx"), str(tmp_path / "sym"), *w)
    c = run(t.trades, "2024-01-01", "2024-01-31")
    assert c["trades_enriched"] == 1000 and c["br_fx_rates"] == 150 and c["br_symbols"] == 200
    before = {k: sorted(map(str, tables.read(k).drop("processed_ts").collect())) for k in pipeline.FACT_TABLES.values()}
    again = run(t.trades, "2024-01-10", "2024-01-10")
    assert 0 < again["fact_pnl_daily"] < c["fact_pnl_daily"]
    for k, want in before.items():
        assert sorted(map(str, tables.read(k).collect())) == want
    nothing = run(t.trades, "2030-01-01", "2030-01-02")
    assert nothing["trades_enriched"] == nothing["fact_pnl_daily"] == 0
    pnl = tables.read("fact_pnl_daily").where(F.col("ds") == F.lit("2024-01-10").cast("date"))
    assert pnl.count() == again["fact_pnl_daily"]
