"""The registered queries restated in SQL for DuckDB, written apart from the Spark code."""
