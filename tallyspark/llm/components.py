"""Connected components of an edge table by alternating star contractions (all steps are shuffles)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (``large``) or other neighbours to its smallest neighbour or itself."""
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = near.join(low, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node of each node's component, for nodes that have edges.

    ``edges`` has two columns of one orderable type. Each round is written to
    the shared folder; the rounds grow with the logarithm of the longest path.
    """
    now = stored(edges.toDF("u", "v").where("u != v").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        now = stored(_star(_star(now, True), False), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components didn't settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
