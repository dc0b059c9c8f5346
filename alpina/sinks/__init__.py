"""Table writers and maintenance on plain parquet paths (no transactional table format)."""
