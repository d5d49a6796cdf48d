"""Explicit schemas of the domain and layer tables (no inference)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType,
                               IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)


def _s(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


USER_METADATA = _s(
    ("age", IntegerType(), True),
    ("occupation", StringType(), True),
    ("annual_income_usd", IntegerType(), True),
    ("investment_experience_years", IntegerType(), True),
)

USERS = _s(
    ("user_id", StringType(), False),
    ("name", StringType(), True),
    ("email", StringType(), True),
    ("phone", StringType(), True),
    ("region", StringType(), True),
    ("risk_profile", StringType(), True),
    ("kyc_status", StringType(), True),
    ("created_at", TimestampNTZType(), True),
    ("last_login", TimestampNTZType(), True),
    ("metadata", USER_METADATA, True),
)

HOLDING = _s(("symbol", StringType(), True), ("qty", IntegerType(), True))

PORTFOLIOS = _s(
    ("portfolio_id", StringType(), False),
    ("user_id", StringType(), False),
    ("portfolio_name", StringType(), True),
    ("base_ccy", StringType(), True),
    ("holdings", ArrayType(HOLDING), True),
    ("cash_balance_usd", DoubleType(), True),
    ("created_at", TimestampNTZType(), True),
    ("updated_at", TimestampNTZType(), True),
    ("is_active", BooleanType(), True),
    ("total_deposits_usd", DoubleType(), True),
    ("total_withdrawals_usd", DoubleType(), True),
)

TRADES = _s(
    ("trade_id", StringType(), False),
    ("portfolio_id", StringType(), False),
    ("symbol", StringType(), False),
    ("side", StringType(), False),
    ("price", DoubleType(), True),
    ("qty", LongType(), True),
    ("ts", TimestampNTZType(), False),
    ("venue", StringType(), False),
    ("event_date", DateType(), False),
)

# Raw reference files (CSV): read with these, never with inferSchema.
FX_CSV = _s(
    ("base_ccy", StringType(), True),
    ("quote_ccy", StringType(), True),
    ("rate", DoubleType(), True),
    ("ds", DateType(), True),
)

SYMBOLS_CSV = _s(
    ("symbol", StringType(), True),
    ("exchange", StringType(), True),
    ("sector", StringType(), True),
    ("tick_size", DoubleType(), True),
)

BR_FX_RATES = _s(
    ("base_ccy", StringType(), True),
    ("quote_ccy", StringType(), True),
    ("rate", DoubleType(), True),
    ("ds", DateType(), True),
    ("ingestion_ts", TimestampType(), True),
)

BR_SYMBOLS = _s(
    ("symbol", StringType(), True),
    ("exchange", StringType(), True),
    ("sector", StringType(), True),
    ("tick_size", DoubleType(), True),
    ("ingestion_ts", TimestampType(), True),
)

# Column order contracts of the silver and gold tables.
TRADES_ENRICHED_COLUMNS = [
    "trade_id", "portfolio_id", "symbol", "side", "price", "qty", "ts",
    "venue", "event_date", "exchange", "sector", "price_usd", "notional_usd",
    "is_valid", "quality_score", "processed_ts",
]

FACT_PNL_COLUMNS = [
    "ds", "portfolio_id", "symbol", "buy_qty", "sell_qty", "net_qty",
    "avg_buy_price", "avg_sell_price", "realized_pnl_usd",
    "notional_traded_usd", "num_trades",
]

FACT_LIQUIDITY_COLUMNS = [
    "ds", "symbol", "exchange", "sector", "total_volume", "total_turnover_usd",
    "num_trades", "unique_portfolios", "avg_trade_size", "price_volatility",
]

FACT_ACTIVITY_COLUMNS = [
    "ds", "portfolio_id", "num_trades", "unique_symbols", "total_notional_usd",
    "buy_sell_ratio", "most_traded_symbol", "activity_score",
]
