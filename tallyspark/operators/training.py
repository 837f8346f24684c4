"""Scaling, and models of MLlib as pipelines (ML1, ML3-ML7, ML10-ML12).

Training data is one DataFrame with a feature list and a 0/1 label; every fit
is a distributed MLlib job. Searches, cross-validated logistic models and
ensembles with all search parameters are in :mod:`boosting` and :mod:`logistic`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import metrics as M
from tallyspark.operators.prep import q
from tallyspark.operators.scoring import prob_of_positive
from tallyspark.functions.scalar import half_even_int


def minmax_scale(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """ML1: (x - min) / (max - min) per column; a constant column scales to 0.0.

    One aggregate gives all bounds (a single row, broadcast)."""
    bounds = df.agg(*[x for i, c in enumerate(cols)
                      for x in (F.min(q(c)).alias(f"_lo{i}"), F.max(q(c)).alias(f"_hi{i}"))])
    out = df.crossJoin(F.broadcast(bounds))
    for i, c in enumerate(cols):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        scaled = F.when(hi > lo, (q(c).cast("double") - lo) / (hi - lo)).otherwise(F.lit(0.0))
        out = out.withColumn(c + suffix, scaled)
    return out.drop(*[f"_{p}{i}" for i in range(len(cols)) for p in ("lo", "hi")])


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, reg: float = 0.0,
                 l1: bool = False, max_iter: int = 100) -> PipelineModel:
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=reg,
                            elasticNetParam=1.0 if l1 else 0.0, standardization=False,
                            maxIter=max_iter)
    return Pipeline(stages=[assembler(features), lr]).fit(df)


def coefficient_table(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """ML3: (feature, importance) from logistic coefficients."""
    coefs = model.stages[-1].coefficients.toArray().tolist()
    return spark.createDataFrame(list(zip(features, map(float, coefs))), "feature string, importance double")


def tree_importance(df: DataFrame, features: Sequence[str], label: str, kind: str = "rf",
                    seed: int = 42, num_trees: int = 100, max_iter: int = 100,
                    max_depth: int = 5) -> DataFrame:
    """ML4/ML5: random-forest or boosted-tree feature importances, ascending (O1)."""
    if kind == "rf":
        est = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees,
                                     maxDepth=max_depth, seed=seed)
    elif kind == "gbt":
        est = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter,
                            maxDepth=max_depth, seed=seed)
    else:
        raise ValueError("kind must be 'rf' or 'gbt'")
    model = Pipeline(stages=[assembler(features), est]).fit(df)
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = df.sparkSession
    out = spark.createDataFrame(list(zip(features, map(float, imp))), "feature string, importance double")
    return out.orderBy("importance", "feature")


def gbt_estimator(label: str, params: Mapping[str, float], rounds: int, seed: int = 42) -> GBTClassifier:
    # Parameters outside what the learner takes are its error, not silently others.
    return GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds,
                         stepSize=float(params.get("learning_rate", 0.1)),
                         maxDepth=int(params.get("max_depth", 5)),
                         minInstancesPerNode=max(1, int(round(params.get("min_child_weight", 1.0)))),
                         seed=seed)


def round_losses(model: PipelineModel, valid: DataFrame) -> list[float]:
    """Validation log loss after each boosting round.

    MLlib's classifier loss is 2 * log(1 + exp(-2 y F)) with y in {-1, 1},
    twice the usual binary cross-entropy; it is halved here.
    """
    gbt = model.stages[-1]
    feats = model.stages[0].transform(valid)
    return [v / 2.0 for v in gbt.evaluateEachIteration(feats)]


def first_trees(model: PipelineModel, n: int) -> PipelineModel:
    """The same boosted model with its first ``n`` trees only."""
    gbt = model.stages[-1]
    java, sc = gbt._java_obj, SparkContext._active_spark_context
    trees = java.trees()
    some = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = sc._gateway.new_array(sc._jvm.double, n)
    for i in range(n):
        some[i], weights[i] = trees[i], float(java.treeWeights()[i])
    cut = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), some, weights, java.numFeatures(), java.numClasses())
    out = GBTClassificationModel(java.copyValues(cut, sc._jvm.org.apache.spark.ml.param.ParamMap()))
    return PipelineModel([*model.stages[:-1], out])


def train_with_early_stop(train: DataFrame, valid: DataFrame, features: Sequence[str], label: str,
                          params: Mapping[str, float], rounds: int = 800, patience: int = 40,
                          seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """ML6: boosting that stops once ``patience`` rounds brought no better validation loss.

    Rounds are fitted in growing blocks (2 * patience, then twice as many each
    time; the same seed gives the same first trees), so at most twice the rounds
    up to the stop are fitted. The model keeps its first ``best_round + 1`` trees.
    Returns it and the loss curve up to the stop round
    (round, logloss, best_round, stop_round)."""
    train, valid = train.persist(), valid.persist()
    try:
        now = min(rounds, 2 * patience)
        while True:
            model = Pipeline(stages=[assembler(features), gbt_estimator(label, params, now, seed)]).fit(train)
            losses = round_losses(model, valid)
            best, stop = _stop_round(losses, patience)
            if stop is not None or now >= rounds:
                break
            now = min(rounds, 2 * now)
    finally:
        train.unpersist()
        valid.unpersist()
    curve = losses if stop is None else losses[:stop + 1]
    tbl = train.sparkSession.createDataFrame([(i, float(v), best, stop) for i, v in enumerate(curve)],
                                             "round int, logloss double, best_round int, stop_round int")
    return first_trees(model, best + 1), tbl


def _stop_round(losses: Sequence[float], patience: int) -> tuple[int, int | None]:
    """Best round so far, and the first round that came ``patience`` rounds after it (None: none did)."""
    best = 0
    for i, v in enumerate(losses):
        if v < losses[best]:
            best = i
        if i - best >= patience:
            return best, i
    return best, None


def train_final(train: DataFrame, features: Sequence[str], label: str, params: Mapping[str, float],
                rounds: int = 800, seed: int = 42) -> PipelineModel:
    """ML7: fixed number of rounds, no early stop."""
    return Pipeline(stages=[assembler(features), gbt_estimator(label, params, rounds, seed)]).fit(train)


def predict(model: PipelineModel, df: DataFrame, prob: str = "prob", pred: str = "pred") -> DataFrame:
    """ML10/ML11: P(label = 1) and its half-to-even rounding."""
    out = prob_of_positive(model.transform(df), "probability", prob)
    out = out.withColumn(pred, half_even_int(prob))
    return out.drop("features", "rawPrediction", "probability", "prediction")


def evaluate(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """ML12: metrics row of one model on a table."""
    return M.binary_metrics(predict(model, df), label, "pred")
