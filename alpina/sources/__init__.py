"""Scans: delimited text, JSON-as-text, parquet, listings, binary content, landed web payloads."""
