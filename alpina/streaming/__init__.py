"""Structured Streaming: file-stream bronze, typed views, SCD type 1 upserts, expectations."""
