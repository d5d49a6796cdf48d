"""Reports written in Spark SQL over the registered views equal the
DataFrame reports."""

from ledgerlake.functions.exprs import stabilize
from ledgerlake.plans import documented, regional
from ledgerlake.plans.catalog import Lake
from ledgerlake.plans.views import register_views

SF = "/root/testdata/sf0.001"


def test_sql_over_views_matches_dataframe_reports(spark):
    names = register_views(spark, SF)
    assert {"users", "portfolios", "fact_pnl_daily", "fact_user_activity"} <= set(names)
    L = Lake(spark, SF)
    sql = spark.sql("""
        SELECT u.region, SUM(f.realized_pnl_usd) AS total_pnl_usd,
               SUM(CASE WHEN f.ds >= DATE '2024-01-31' - INTERVAL 7 DAYS
                        THEN f.realized_pnl_usd END) AS pnl_last_7d_usd
        FROM fact_pnl_daily f
        JOIN portfolios p ON f.portfolio_id = p.portfolio_id
        JOIN users u ON p.user_id = u.user_id
        GROUP BY u.region""")
    df = documented.pnl_by_region(L.users, L.portfolios, L.pnl, L.as_of)
    sums = ["total_pnl_usd", "pnl_last_7d_usd"]
    assert sorted(stabilize(sql, sums).collect()) == sorted(stabilize(df, sums).collect())

    sql2 = spark.sql("""
        SELECT u.region, u.risk_profile, COUNT(DISTINCT u.user_id) AS num_users,
               SUM(a.num_trades) AS total_trades
        FROM users u JOIN portfolios p ON u.user_id = p.user_id
        LEFT JOIN fact_user_activity a
          ON p.portfolio_id = a.portfolio_id AND a.ds >= DATE '2024-01-31' - INTERVAL 7 DAYS
        WHERE u.kyc_status = 'verified'
        GROUP BY u.region, u.risk_profile""")
    df2 = regional.regional_risk_distribution(L.users, L.portfolios, L.activity, L.as_of)
    assert sorted(sql2.collect()) == sorted(df2.collect())
