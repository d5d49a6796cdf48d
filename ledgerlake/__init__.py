"""ledgerlake — a Spark-native trading-analytics lakehouse.

Bronze (typed reference data) → silver (enriched, validated trades) →
gold (daily PnL, liquidity, user activity facts) → business reports,
all as pure DataFrame functions built from Spark SQL built-ins.
"""

AS_OF_DEFAULT = "2024-01-31"

__all__ = ["AS_OF_DEFAULT"]
