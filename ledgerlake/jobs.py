"""spark-submit entry points, one per scheduled job of the layered pipeline.

    spark-submit --py-files ledgerlake.zip run_job.py <job> [options]
    (or, with PySpark installed: python -m ledgerlake.jobs <job> [options])

    fx-bronze      --fx-csv DIR --lake ROOT [--start D --end D]
    symbols-bronze --symbols-csv PATH --lake ROOT
    silver         --lake ROOT (--trades PATH | --sf-dir DIR) [--start D --end D]
    gold-pnl | gold-liquidity | gold-activity  --lake ROOT [--start D --end D]
    reports        --lake ROOT --out DIR [--as-of D]
                   (--users PATH --portfolios PATH [--form json|parquet] | --sf-dir DIR)
    tables         --lake ROOT

The report date defaults to today (UTC).
The run window defaults to yesterday (UTC) with start = end; every job
takes it as arguments (no environment reads).  Jobs write with dynamic
partition overwrite, skip empty inputs, and print the rows written as
observed on the write itself.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pipeline, sinks
from .plans import documented, regional, risk, users
from .sources import customers, files, fixtures


def _today() -> str:
    return dt.datetime.now(dt.timezone.utc).date().isoformat()


def _yesterday() -> str:
    return (dt.date.fromisoformat(_today()) - dt.timedelta(days=1)).isoformat()


def _window(a: argparse.Namespace) -> tuple[str, str]:
    end = a.end or _yesterday()
    return (a.start or end), end


def _session(app: str) -> SparkSession:
    return SparkSession.builder.appName(app).getOrCreate()


def fx_bronze(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    start, end = _window(a)
    return {"bronze.fx_rates":
            pipeline.ingest_fx(spark, pipeline.LakePaths(a.lake), a.fx_csv, start, end)}


def symbols_bronze(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    return {"bronze.symbols":
            pipeline.ingest_symbols(spark, pipeline.LakePaths(a.lake), a.symbols_csv)}


def _trades(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.trades:
        return files.read_trades(spark, a.trades)
    return fixtures.load(spark, a.sf_dir).trades


def silver_job(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    start, end = _window(a)
    paths = pipeline.LakePaths(a.lake)
    return {"silver.trades_enriched":
            pipeline.build_silver(spark, paths, _trades(spark, a), start, end)}


# Sample shown after a gold write: the fact's headline metric, descending.
SHOW_ORDER = {"pnl": "realized_pnl_usd", "liquidity": "total_turnover_usd",
              "activity": "activity_score"}


def _gold(kind: str) -> Callable[[SparkSession, argparse.Namespace], dict[str, int]]:
    def job(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
        start, end = _window(a)
        paths = pipeline.LakePaths(a.lake)
        n = pipeline.build_fact(spark, paths, kind, start, end)
        if n and a.show:
            written = pipeline.read_fact(spark, paths, kind).filter(
                F.col("ds").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            written.orderBy(F.desc(SHOW_ORDER[kind])).show(a.show, truncate=False)
        return {f"gold.{kind}": n}
    return job


REPORTS_ON_PNL = {
    "top_profitable_users": users.top_profitable_users,
    "risk_profile_performance": users.risk_profile_performance,
    "regional_profitability": regional.regional_profitability,
    "regional_symbol_preferences": regional.regional_symbol_preferences,
    "portfolio_concentration": risk.portfolio_concentration,
    "high_risk_users": risk.high_risk_users,
    "loss_making_users": risk.loss_making_users,
    "risk_mismatch": risk.risk_mismatch,
    "pnl_by_region": documented.pnl_by_region,
}
REPORTS_ON_ACTIVITY = {
    "age_group_activity": users.age_group_activity,
    "income_bracket_activity": users.income_bracket_activity,
    "activation_rate": users.activation_rate,
    "regional_volume": regional.regional_volume,
    "regional_risk_distribution": regional.regional_risk_distribution,
}
REPORTS_ALL_TIME = {
    "pnl_by_risk_profile": (documented.pnl_by_risk_profile, "pnl"),
    "activity_by_age_band": (documented.activity_by_age_band, "activity"),
    "activity_by_age_split": (documented.activity_by_age_split, "activity"),
}


def build_reports(u: DataFrame, p: DataFrame, pnl: DataFrame, activity: DataFrame,
                  as_of: str) -> dict[str, DataFrame]:
    """All 17 business reports over the given gold facts (lazy)."""
    out = {n: f(u, p, pnl, as_of) for n, f in REPORTS_ON_PNL.items()}
    out.update({n: f(u, p, activity, as_of) for n, f in REPORTS_ON_ACTIVITY.items()})
    facts = {"pnl": pnl, "activity": activity}
    out.update({n: f(u, p, facts[k]) for n, (f, k) in REPORTS_ALL_TIME.items()})
    return out


def reports_job(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    paths = pipeline.LakePaths(a.lake)
    as_of = a.as_of or _today()
    if a.users and a.portfolios:
        u = customers.read_users(spark, a.users, a.form)
        p = customers.read_portfolios(spark, a.portfolios, a.form)
    else:
        t = fixtures.load(spark, a.sf_dir)
        u, p = t.users, t.portfolios
    pnl = pipeline.read_fact(spark, paths, "pnl")
    act = pipeline.read_fact(spark, paths, "activity")
    return {f"report.{name}": sinks.write_table(df, f"{a.out.rstrip('/')}/{name}")
            for name, df in build_reports(u, p, pnl, act, as_of).items()}


def tables_job(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    return {f"table.{t}": spark.table(t).count()
            for t in pipeline.register_tables(spark, pipeline.LakePaths(a.lake))}


JOBS: dict[str, Callable[[SparkSession, argparse.Namespace], dict[str, int]]] = {
    "fx-bronze": fx_bronze,
    "symbols-bronze": symbols_bronze,
    "silver": silver_job,
    "gold-pnl": _gold("pnl"),
    "gold-liquidity": _gold("liquidity"),
    "gold-activity": _gold("activity"),
    "reports": reports_job,
    "tables": tables_job,
}


def parse(argv: Sequence[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="ledgerlake.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--lake", required=True, help="lake root (shared file system)")
    ap.add_argument("--start", help="first day, inclusive (default: --end)")
    ap.add_argument("--end", help="last day, inclusive (default: yesterday UTC)")
    ap.add_argument("--fx-csv", help="FX CSV base directory (ds=YYYY-MM-DD/ folders)")
    ap.add_argument("--symbols-csv", help="symbol master CSV path")
    ap.add_argument("--trades", help="trade Parquet path")
    ap.add_argument("--sf-dir", help="driver tables directory (fixtures)")
    ap.add_argument("--as-of", help="report date (default: today UTC)")
    ap.add_argument("--users", help="user documents")
    ap.add_argument("--portfolios", help="portfolio documents")
    ap.add_argument("--form", default="json", choices=["json", "parquet"], help="form of the documents")
    ap.add_argument("--out", help="report output directory")
    ap.add_argument("--show", type=int, default=0,
                    help="after a gold write, show the top N rows of the window")
    return ap.parse_args(list(argv))


def main(argv: Sequence[str] | None = None,
         spark: SparkSession | None = None) -> dict[str, int]:
    a = parse(sys.argv[1:] if argv is None else argv)
    spark = spark or _session(f"ledgerlake-{a.job}")
    counts = JOBS[a.job](spark, a)
    for k, v in counts.items():
        print(f"{k}: {v} rows written" if v else f"{k}: no input rows, nothing written")
    return counts


if __name__ == "__main__":
    main()
