"""As-of join against a plain loop, spread of a hot key; the symbol master's
history against its deliveries."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import history
from ledgerlake.operators.asof import asof_join

DAY0 = dt.date(2024, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


@pytest.mark.parametrize("width,salts", [(1, 1), (7, 3), (1000, 4)])
def test_asof_against_a_loop(spark, width, salts):
    rng = random.Random(width)
    rates = [(rng.choice(["EUR", "GBP", "JPY", None]), day(rng.randrange(60)) if rng.random() < 0.97 else None,
              rng.choice([1.5, 2.5, None]), i) for i in range(80)]
    asked = [(rng.choice(["EUR", "EUR", "EUR", "GBP", "AUD", None]), day(rng.randrange(-5, 70)) if rng.random() < 0.95 else None,
              i % 40) for i in range(600)]
    left = spark.createDataFrame(asked, "ccy string, ds date, n int")
    right = spark.createDataFrame(rates, "ccy string, ds date, rate double, v int")
    got = asof_join(left, right, ["ccy"], "ds", ["rate", "v"], width, salts, salt_by="n").collect()

    def last(ccy, ds):
        known = [(d, (r is not None, r or 0, v), (r, v)) for c, d, r, v in rates
                 if c is not None and c == ccy and d is not None and ds is not None and d <= ds]
        return max(known)[2] if known else (None, None)

    assert Counter(map(tuple, got)) == Counter((c, d, n, *last(c, d)) for c, d, n in asked)


def test_asof_with_timestamps_and_empty_sides(spark):
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    left = spark.createDataFrame([("a", t(5), 1), ("a", t(9), 2), ("a", t(10), 3)], "k string, at timestamp_ntz, n int")
    right = spark.createDataFrame([("a", t(4), 1.0), ("a", t(10), 2.0)], "k string, at timestamp_ntz, v double")
    got = {r.n: r.v for r in asof_join(left, right, ["k"], "at", ["v"], 3_000_000).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 2.0}
    assert {r.v for r in asof_join(left, right.limit(0), ["k"], "at", ["v"], 10).collect()} == {None}
    assert asof_join(left.limit(0), right, ["k"], "at", ["v"], 10).count() == 0


def test_hot_key_is_spread(spark):
    """One key with all rows, on one day: its rows meet in many groups."""
    left = spark.range(4000).select(F.lit("EUR").alias("ccy"), F.lit(day(3)).alias("ds"), "id")
    right = spark.createDataFrame([("EUR", day(1), 1.0)], "ccy string, ds date, rate double")
    out = asof_join(left, right, ["ccy"], "ds", ["rate"], 7, 8, salt_by="id")
    assert out.where("rate = 1.0").count() == 4000
    parts = left.groupBy(F.pmod(F.xxhash64("id"), F.lit(8))).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 700


STATES = [("A", "NYSE", "Tech"), ("A", "NYSE", None), ("A", "NYSE", "Oil"), None]


def deliveries(spark, seed):
    """Random whole deliveries of five symbols on six days."""
    rng, rows = random.Random(seed), []
    for n in range(6):
        rows.append(("always", "NYSE", "Tech", 0.01, day(4 * n)))
        for s in "abcde":
            state = rng.choice(STATES + STATES[:1])
            if state:
                rows.append((s, state[1], state[2], 0.01, day(4 * n)))
    return rows, spark.createDataFrame(rows, "symbol string, exchange string, sector string, tick_size double, ds date")


def test_history_against_its_deliveries(spark):
    for seed in range(3):
        rows, told = deliveries(spark, seed)
        whole = history.from_deliveries(told)
        step = history.from_deliveries(told.where(F.col("ds") == F.lit(day(0))))
        for n in range(1, 6):
            one = told.where(F.col("ds") == F.lit(day(4 * n)))
            step = history.deliver(step, one, str(day(4 * n)))
            if n == 3:
                step = history.deliver(step, one, str(day(4 * n)))      # told twice
        found = sorted(map(str, whole.collect()))
        assert sorted(map(str, step.collect())) == found
        states = [tuple(r) for r in whole.collect()]
        for d in (day(n) for n in range(-1, 30)):
            last = max([r[4] for r in rows if r[4] <= d], default=None)
            want = sorted((r[0], str(r[2])) for r in rows if r[4] == last)
            got = sorted((s[0], str(s[2])) for s in states if s[4] <= d and (s[5] is None or s[5] >= d))
            assert got == want, d
        assert len([s for s in states if s[0] == "always"]) == 1


def test_old_days_keep_their_sector(spark):
    """A changed sector in a later delivery leaves earlier silver days alone."""
    schema = "symbol string, exchange string, sector string, tick_size double"
    first = spark.createDataFrame([("A", "NYSE", "Tech", 0.01), ("B", "NYSE", "Oil", 0.01)], schema)
    second = spark.createDataFrame([("A", "NYSE", "Media", 0.01)], schema)
    trades = spark.createDataFrame([(1, "A", day(2)), (2, "A", day(12)), (3, "B", day(2)), (4, "B", day(12)), (5, "C", day(2))],
                                   "trade_id int, symbol string, event_date date")
    h = history.from_deliveries(first.withColumn("ds", F.lit(day(0))))
    before = {r.trade_id: r.sector for r in history.listed_on_day(trades, h).collect()}
    h = history.deliver(h, second, str(day(10)))
    after = {r.trade_id: r.sector for r in history.listed_on_day(trades, h).collect()}
    assert before == {1: "Tech", 2: "Tech", 3: "Oil", 4: "Oil", 5: None}
    assert after == {1: "Tech", 2: "Media", 3: "Oil", 4: None, 5: None}
    assert [r.symbol for r in history.as_of(h, str(day(11))).collect()] == ["A"]
    # corrected on the same day: what never lasted a day leaves no row
    h = history.deliver(h, first, str(day(10)))
    assert {(r.symbol, r.sector, r.valid_to) for r in h.collect()} >= {("A", "Tech", day(9))}
    assert not h.where("valid_to < valid_from").count() and not h.where("sector = 'Media'").count()
