"""End-to-end plans: batch ingest, the query catalogue and its DuckDB oracle."""
