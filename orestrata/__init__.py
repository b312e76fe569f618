"""Batch medallion building blocks for Spark: sources, data quality, collapse, enrichment, answers."""
