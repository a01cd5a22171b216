"""Independent DuckDB oracle: adapter CTEs and one SQL statement per query."""
