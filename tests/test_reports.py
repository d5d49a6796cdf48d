"""Report semantics on tiny hand-made customer tables and facts."""

import datetime as dt

import pytest

from ledgerlake.plans import regional, risk, users

AS_OF = "2024-01-31"
D_IN, D_OLD = dt.date(2024, 1, 25), dt.date(2023, 12, 1)


@pytest.fixture()
def customers(spark):
    u = spark.createDataFrame(
        [("U1", "Ann", "EUROPE", "conservative", "verified", dt.datetime(2023, 6, 5), (25, 40000)),
         ("U2", "Bob", "EUROPE", "aggressive", "verified", dt.datetime(2023, 11, 20), (45, 150000)),
         ("U3", "Cid", "ASIA", "moderate", "pending", dt.datetime(2023, 11, 2), (65, 250000)),
         ("U4", "Dee", "ASIA", "very_aggressive", "verified", dt.datetime(2022, 1, 1), (35, 90000))],
        "user_id string, name string, region string, risk_profile string, kyc_status string, "
        "created_at timestamp_ntz, metadata struct<age:int, annual_income_usd:int>")
    p = spark.createDataFrame(
        [("PA", "U1"), ("PB", "U1"), ("PC", "U2"), ("PD", "U3"), ("PE", "U4")],
        "portfolio_id string, user_id string")
    return u, p


def pnl(spark, rows):
    return spark.createDataFrame(
        rows, "ds date, portfolio_id string, symbol string, realized_pnl_usd double, "
              "notional_traded_usd double, num_trades int")


def activity(spark, rows):
    return spark.createDataFrame(
        rows, "ds date, portfolio_id string, num_trades int, total_notional_usd double, "
              "activity_score int")


def test_left_join_keeps_non_traders_and_window_in_on(spark, customers):
    u, p = customers
    f = pnl(spark, [(D_IN, "PA", "X", 100.0, 1000.0, 2),
                    (D_OLD, "PC", "X", 999.0, 1000.0, 5)])   # outside window
    out = {r.region: r for r in regional.regional_profitability(u, p, f, AS_OF).collect()}
    # EUROPE: U1 (PA, PB) and U2 (PC, only an old fact) → 2 users survive
    assert out["EUROPE"].num_users == 2
    assert out["EUROPE"].total_pnl_usd == 100.0
    assert out["EUROPE"].avg_pnl_per_position == 100.0
    assert out["EUROPE"].roi_percentage == 10.0
    # ASIA: U3 not verified; U4 has no facts → NULL sums, not 0
    assert out["ASIA"].num_users == 1 and out["ASIA"].total_pnl_usd is None


def test_risk_profile_order_and_avg_over_rows(spark, customers):
    u, p = customers
    f = pnl(spark, [(D_IN, "PA", "X", 10.0, 100.0, 2), (D_IN, "PB", "Y", 20.0, 100.0, 4),
                    (D_IN, "PC", "X", -5.0, 50.0, 1)])
    rows = users.risk_profile_performance(u, p, f, AS_OF).collect()
    assert [r.risk_profile for r in rows] == ["very_aggressive", "aggressive", "conservative"]
    c = rows[2]
    assert (c.num_users, c.total_trades, c.avg_trades_per_portfolio) == (1, 6, 3.0)
    assert (c.total_pnl_usd, c.avg_pnl_per_position) == (30.0, 15.0)
    assert rows[0].total_trades is None


def test_activation_rate_residual_condition(spark, customers):
    u, p = customers
    a = activity(spark, [(dt.date(2023, 5, 1), "PA", 3, 10.0, 40),   # before U1's month
                         (dt.date(2023, 11, 1), "PC", 1, 10.0, 20)])  # U2: same month start
    rows = {r.signup_month: r for r in users.activation_rate(u, p, a, AS_OF).collect()}
    assert rows[dt.date(2023, 6, 1)].active_users == 0
    assert rows[dt.date(2023, 11, 1)].active_users == 1
    assert rows[dt.date(2023, 11, 1)].activation_rate_pct == 100.0
    assert dt.date(2022, 1, 1) not in rows          # older than 12 months


def test_age_and_income_bands(spark, customers):
    u, p = customers
    a = activity(spark, [(D_IN, "PA", 2, 100.0, 40), (D_IN, "PE", 10, 50.0, 80)])
    ages = {r.age_group: r for r in users.age_group_activity(u, p, a, AS_OF).collect()}
    assert set(ages) == {"18-29", "30-39", "40-49"}
    assert ages["18-29"].avg_activity_score == 40.0 and ages["18-29"].total_trades == 2
    inc = [r.income_bracket for r in users.income_bracket_activity(u, p, a, AS_OF).collect()]
    assert inc == ["< $50K", "$50K-$100K", "$100K-$200K"]


def test_concentration_levels(spark, customers):
    u, p = customers
    f = pnl(spark, [(D_IN, "PA", "X", 0.0, 60.0, 1), (D_IN, "PA", "Y", 0.0, 35.0, 1),
                    (D_IN, "PA", "Z", 0.0, 5.0, 1)])
    rows = {r.symbol: r for r in risk.portfolio_concentration(u, p, f, AS_OF).collect()}
    assert set(rows) == {"X", "Y"}
    assert rows["X"].risk_level == "CRITICAL" and rows["X"].concentration_pct == 60.0
    assert rows["Y"].risk_level == "HIGH" and rows["Y"].portfolio_total_usd == 100.0


def test_loss_making_and_mismatch(spark, customers):
    u, p = customers
    f = pnl(spark, [(D_IN, "PA", "X", -800.0, 40000.0, 6),
                    (dt.date(2024, 1, 26), "PB", "Y", -400.0, 1000.0, 6)])
    loss = risk.loss_making_users(u, p, f, AS_OF).collect()
    assert [(r.user_id, r.trading_days, r.total_trades, r.total_pnl_usd, r.avg_pnl_per_day)
            for r in loss] == [("U1", 2, 12, -1200.0, -600.0)]
    mm = risk.risk_mismatch(u, p, f, AS_OF).collect()
    assert [(r.user_id, r.declared_profile, r.actual_behavior, r.total_volume_usd)
            for r in mm] == [("U1", "conservative", "Conservative", 40000.0)]


def test_high_risk_having(spark, customers):
    u, p = customers
    f = pnl(spark, [(D_IN, "PC", "X", -50.0, 150000.0, 3), (D_IN, "PC", "Y", 150.0, 10.0, 1),
                    (D_IN, "PE", "X", 1.0, 99.0, 1)])
    rows = risk.high_risk_users(u, p, f, AS_OF).collect()
    assert [(r.user_id, r.unique_symbols, r.avg_absolute_pnl) for r in rows] == [("U2", 2, 100.0)]


def test_reports_end_at_their_date(spark, customers):
    u, p = customers
    f = pnl(spark, [(dt.date(2024, 1, 10), "PA", "X", 5.0, 100.0, 1),
                    (dt.date(2024, 1, 25), "PA", "X", 70.0, 900.0, 4)])     # after the date
    out = {r.region: r for r in regional.regional_profitability(u, p, f, "2024-01-15").collect()}
    assert out["EUROPE"].total_pnl_usd == 5.0
    a = activity(spark, [(dt.date(2024, 1, 25), "PC", 3, 10.0, 40)])
    rows = {r.signup_month: r for r in users.activation_rate(u, p, a, "2024-01-15").collect()}
    assert rows[dt.date(2023, 11, 1)].active_users == 0


def test_averages_skip_null_measures(spark, customers):
    u, p = customers
    f = pnl(spark, [(D_IN, "PA", "X", 10.0, 100.0, 2), (D_IN, "PA", "Y", None, 100.0, 2)])
    out = {r.risk_profile: r for r in users.risk_profile_performance(u, p, f, AS_OF).collect()}
    assert out["conservative"].avg_pnl_per_position == 10.0
    assert out["conservative"].avg_trades_per_portfolio == 2.0


def test_rounding_keeps_guard_digits(spark):
    from pyspark.sql import functions as F
    from ledgerlake.functions.exprs import round_half_up
    row = spark.createDataFrame(
        [(0.00499999999, 1.2344999999, 1.005, float("nan"), float("inf"))],
        "a double, b double, c double, d double, e double").select(
        round_half_up("a", 2), round_half_up("b", 3), round_half_up("c", 2),
        round_half_up("d", 2), round_half_up("e", 2)).first()
    assert tuple(row) == (0.0, 1.234, 1.01, None, None) and F is not None
