"""Query catalogue on the driver's fixtures (Spark side) and the matching
DuckDB oracle SQL."""
