"""Independent SQL restatement of every registered query, for DuckDB."""
