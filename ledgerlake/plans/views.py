"""SQL access: the domain tables and layers as session temp views.

``register_views(spark, sf_dir)`` publishes the tables under the names the
reports use, so reports can also be written as ``spark.sql(...)``; the views
are the same lazy plans as the DataFrames.  For written layers, see
``pipeline.register_tables``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import bronze
from .catalog import Lake


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    L = Lake(spark, sf_dir)
    views = {
        "users": L.users,
        "portfolios": L.portfolios,
        "trades_stream": L.t.trades,
        "symbols": L.t.symbols,
        "trades_enriched": L.enriched,
        "fact_pnl_daily": L.pnl,
        "fact_liquidity": L.liquidity,
        "fact_user_activity": L.activity,
        "br_fx_rates": bronze.clean_rates(L.t.rate_feed),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
