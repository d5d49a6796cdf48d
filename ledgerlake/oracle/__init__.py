"""Independent DuckDB SQL for every catalog query (the correctness oracle)."""

from .sql import oracle_queries

__all__ = ["oracle_queries"]
