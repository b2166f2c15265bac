"""End-to-end plans, the query catalogue and DuckDB reference SQL."""
