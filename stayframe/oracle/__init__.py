"""DuckDB text of every registered query, used as the correctness oracle."""
