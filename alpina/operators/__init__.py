"""DataFrame → DataFrame operators (joins, aggregations, windows, quality, terrain)."""
