"""finspark: financial planning & analysis operators on Spark DataFrames.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, joins, aggregates and windows. Operators take entity
key columns (``keys``) so one call handles many companies / scenarios.
"""

__version__ = "0.1.0"
