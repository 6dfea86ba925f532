"""Scans and sinks: per-series Parquet, wide quarterly CSV, XML catalogue, tables."""
