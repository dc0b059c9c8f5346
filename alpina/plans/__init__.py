"""Query plans over the provided tables: one registered query (and, where SQL can express it,
one independent DuckDB oracle) per operator, plus the composed landing→silver flows."""
