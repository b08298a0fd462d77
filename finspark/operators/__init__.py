"""Domain operators: ``DataFrame -> DataFrame`` functions built from Spark SQL
expressions, joins, aggregates and windows (SURVEY 2.11 D-01 .. D-26 and the
relational building blocks they share)."""
