"""tallyspark: a Spark-native engine for tabular binary-classification analytics.

Every operator takes and returns Spark DataFrames and is built from Spark SQL
expressions, DataFrame joins/aggregates/windows, or MLlib estimators.
"""

__version__ = "0.1.0"
