"""Registered queries: each is (spark, sf_dir) -> DataFrame over the test
tables, with an independent DuckDB statement that must give the same rows."""
