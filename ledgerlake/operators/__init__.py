"""Layer operators: bronze (reference data), silver (enrichment), gold (facts)."""
