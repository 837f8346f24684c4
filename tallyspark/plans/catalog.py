"""All registered queries and their SQL oracles."""

from tallyspark.plans import ml_oracle, ml_queries  # noqa: F401  (register queries and their SQL)
from tallyspark.plans.oracle import ORACLE
from tallyspark.plans.queries import REGISTRY

__all__ = ["ORACLE", "REGISTRY"]
