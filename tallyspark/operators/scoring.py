"""Scoring with linear coefficient tables and MLlib models (ML10, ML11, J2)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.scalar import half_even_int, sigmoid
from tallyspark.operators.prep import q


def linear_logit(coefs: Mapping[str, float], intercept: float = 0.0) -> Column:
    """intercept + sum(coef * feature) as one JVM expression."""
    z = F.lit(float(intercept))
    for name, w in coefs.items():
        z = z + F.lit(float(w)) * q(name)
    return z


def score_linear(df: DataFrame, coefs: Mapping[str, float], intercept: float = 0.0,
                 prob: str = "prob", pred: str | None = "prediction") -> DataFrame:
    """ML10/ML11 for a logistic model given as coefficients: probability, then
    half-to-even rounding to a 0/1 prediction (M1)."""
    out = df.withColumn(prob, sigmoid(linear_logit(coefs, intercept)))
    return out.withColumn(pred, half_even_int(prob)) if pred else out


def score_versions(df: DataFrame, coef_table: DataFrame, features: list[str],
                   prob: str = "prob", pred: str = "prediction") -> DataFrame:
    """Every model version scored on the same rows.

    ``coef_table`` holds one row per (model_name, version) with ``intercept``
    and one coefficient column per feature (``w_<feature>``). All versions
    travel as one array in one row, so each scored row meets them in place: the
    rows are neither shuffled nor joined with a table, and metrics per version
    are summed in the same stage.
    """
    one = coef_table.agg(F.collect_list(F.struct("model_name", "version", "intercept", *[f"w_{f}" for f in features])).alias("_versions"))

    def scored(v: Column) -> Column:
        z = v["intercept"]
        for f in features:
            z = z + v[f"w_{f}"] * q(f)
        return F.struct(v["model_name"].alias("model_name"), v["version"].alias("version"), sigmoid(z).alias(prob))

    rows = df.crossJoin(F.broadcast(one))   # a single row
    out = rows.select(*[q(c) for c in df.columns], F.inline(F.transform("_versions", scored)))
    return out.withColumn(pred, half_even_int(prob))


def score_ensembles(df: DataFrame, nodes: DataFrame, features: list[str], prob: str = "prob", pred: str = "prediction") -> DataFrame:
    """J2 for saved tree ensembles: every (model_name, version) of a node table scored on the same rows, in one scan.

    ``nodes`` holds ``boosting.NODES`` with model_name and version. Like coefficients, all ensembles travel
    as one row, as arrays of trees, and a row of data walks down each tree by higher-order functions: no join, no
    shuffle of the rows, no Python. The margins of a version's trees are summed in tree order.
    """
    node = F.struct("node", F.array_position(F.array(*[F.lit(f) for f in features]), F.coalesce("feature", F.lit(""))).cast("int").alias("at"),
                    "threshold", "left", "right", "value")
    trees = nodes.groupBy("model_name", "version", "tree").agg(
        F.sort_array(F.collect_list(node)).alias("nodes"), F.max("depth").alias("depth"))
    models = trees.groupBy("model_name", "version").agg(F.sort_array(F.collect_list(F.struct("tree", "depth", "nodes"))).alias("trees"))
    one = models.agg(F.collect_list(F.struct("model_name", "version", "trees")).alias("_models"))

    def step(tree: Column, at: Column) -> Column:
        here = tree["nodes"][at]
        x = F.get(F.col("_x"), here["at"] - 1)
        return F.when(here["at"] == 0, at).when(x.isNull() | (x <= here["threshold"]), here["left"]).otherwise(here["right"])

    def value(tree: Column) -> Column:
        leaf = F.when(tree["depth"] == 0, F.lit(0)).otherwise(
            F.aggregate(F.sequence(F.lit(1), F.greatest(tree["depth"], F.lit(1))), F.lit(0), lambda at, _: step(tree, at)))
        return tree["nodes"][leaf]["value"]

    def scored(v: Column) -> Column:
        margin = F.aggregate(v["trees"], F.lit(0.0), lambda z, t: z + value(t))
        return F.struct(v["model_name"].alias("model_name"), v["version"].alias("version"), sigmoid(margin).alias(prob))

    x = F.array(*[F.when(~F.isnan(q(f).cast("double")), q(f).cast("double")) for f in features]).alias("_x")
    rows = df.select(*[q(c) for c in df.columns], x).crossJoin(F.broadcast(one))   # a single row, as large as the models
    out = rows.select(*[q(c) for c in df.columns], F.inline(F.transform("_models", scored)))
    return out.withColumn(pred, half_even_int(prob))


def prob_of_positive(df: DataFrame, prob_vec: str = "probability", out: str = "prob") -> DataFrame:
    """ML10 for MLlib classifiers: P(class 1) out of the probability vector."""
    from pyspark.ml.functions import vector_to_array
    return df.withColumn(out, vector_to_array(F.col(prob_vec))[1])
