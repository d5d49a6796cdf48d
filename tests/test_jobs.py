"""The spark-submit job entry points, run in-process in order."""

from ledgerlake import jobs
from ledgerlake.sources import files, fixtures

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, tmp_path):
    t = fixtures.load(spark, SF)
    fx_dir, sym = str(tmp_path / "fx"), str(tmp_path / "sym")
    files.write_fx_csv(t.rate_feed, fx_dir)
    files.write_symbols_csv(t.symbol_feed, sym)
    trades = str(tmp_path / "trades")
    t.trades.write.parquet(trades)
    lake, out = str(tmp_path / "lake"), str(tmp_path / "reports")
    win = ["--start", "2024-01-01", "--end", "2024-01-31"]
    run = lambda *a: jobs.main(list(a), spark=spark)
    assert run("fx-bronze", "--lake", lake, "--fx-csv", fx_dir, *win)["bronze.fx_rates"] == 150
    assert run("symbols-bronze", "--lake", lake, "--symbols-csv", sym)["bronze.symbols"] == 200
    assert run("silver", "--lake", lake, "--trades", trades, *win)["silver.trades_enriched"] == 1000
    assert run("gold-pnl", "--lake", lake, *win, "--show", "3")["gold.pnl"] > 300
    assert run("gold-liquidity", "--lake", lake, *win)["gold.liquidity"] > 100
    assert run("gold-activity", "--lake", lake, *win)["gold.activity"] > 100
    # the customer store as documents, as an export delivers them
    t.users.write.json(str(tmp_path / "users"))
    t.portfolios.write.json(str(tmp_path / "portfolios"))
    c = run("reports", "--lake", lake, "--users", str(tmp_path / "users"),
            "--portfolios", str(tmp_path / "portfolios"), "--out", out, "--as-of", "2024-01-31")
    assert len(c) == 17 and c["report.top_profitable_users"] > 0
    got = spark.read.parquet(f"{out}/regional_volume")
    assert got.count() == 5 and "avg_activity_score" in got.columns
    # a day outside the data writes nothing and raises nothing
    empty = run("gold-pnl", "--lake", lake, "--start", "2030-01-01", "--end", "2030-01-01")
    assert empty == {"gold.pnl": 0}


def test_default_window_is_yesterday():
    a = jobs.parse(["gold-pnl", "--lake", "/x"])
    start, end = jobs._window(a)
    assert start == end == jobs._yesterday()
    a = jobs.parse(["gold-pnl", "--lake", "/x", "--end", "2024-01-05"])
    assert jobs._window(a) == ("2024-01-05", "2024-01-05")


def test_customer_documents_round_trip(spark, tmp_path):
    from ledgerlake.sources import customers
    t = fixtures.load(spark, SF)
    t.users.write.json(str(tmp_path / "u"))
    t.portfolios.write.json(str(tmp_path / "p"))
    u, p = customers.read_users(spark, str(tmp_path / "u")), customers.read_portfolios(spark, str(tmp_path / "p"))
    assert sorted(u.collect()) == sorted(t.users.select(*u.columns).collect())
    assert u.count() == 150 and p.count() == 200
    keys = ["portfolio_id", "user_id", "base_ccy", "holdings", "is_active"]
    assert sorted(p.select(*keys).collect()) == sorted(t.portfolios.select(*keys).collect())


def test_report_date_defaults_to_today():
    assert jobs.parse(["reports", "--lake", "/x"]).as_of is None
    assert jobs._today() > "2024-01-31"


def test_reports_from_written_gold_match_catalog(spark, tmp_path):
    from ledgerlake import pipeline
    from ledgerlake.plans.catalog import Lake, queries
    L = Lake(spark, SF)
    paths = pipeline.LakePaths(str(tmp_path))
    for kind, fact in (("pnl", L.pnl), ("activity", L.activity)):
        fact.write.partitionBy("ds").parquet(getattr(paths, kind))
    reps = jobs.build_reports(L.users, L.portfolios, pipeline.read_fact(spark, paths, "pnl"),
                              pipeline.read_fact(spark, paths, "activity"), L.as_of)
    for name in ("risk_mismatch", "activation_rate", "regional_risk_distribution"):
        assert sorted(map(str, reps[name].collect())) == sorted(map(str, queries()[name](spark, SF).collect()))
