"""The customer store: user and portfolio documents with declared schemas.

Documents are nested (a user's ``metadata``, a portfolio's ``holdings``) and
come as an export of the store, one JSON document per line, or as Parquet.
Fields that the schemas do not name are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import PORTFOLIOS, USERS


def _documents(spark: SparkSession, path: str, schema: StructType, form: str) -> DataFrame:
    if form not in ("json", "parquet"):
        raise ValueError(f"unknown form of documents: {form!r}")
    return spark.read.schema(schema).format(form).load(path)


def read_users(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    return _documents(spark, path, USERS, form)


def read_portfolios(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    return _documents(spark, path, PORTFOLIOS, form)
