"""The registered query catalogue (Spark side) and its DuckDB oracles."""
