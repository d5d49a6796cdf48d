"""Shared column expressions (built-in Spark SQL functions only)."""
