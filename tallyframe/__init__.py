"""Spark-first analytics for tabular regression workflows and their request logs.

Every operator takes a DataFrame plus column names and thresholds and returns a
DataFrame; sessions, storage locations and physical strategy stay with Spark.
"""

__version__ = "0.1.0"
