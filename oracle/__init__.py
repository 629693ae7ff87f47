"""DuckDB oracle SQL for the registered queries (see __spark_entry__)."""
