"""Queries that train and tune (ML2-ML9, ML12, ML13, J2, O1, O3).

Ensembles and logistic models are trained by the library's own operators, whose steps SQL can follow: each has
an oracle but the two searches at full budget (50 trials, 800 / 1000 rounds, patience 40 / 50, all five
parameters); ``search_steps`` runs the same search operators at a size that SQL can follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import boosting as B
from tallyspark.operators import logistic as LG
from tallyspark.operators import metrics as M
from tallyspark.operators import training as TR
from tallyspark.operators.ranking import argmin_by_group, sort_importance
from tallyspark.operators.registry import best_version, current_stage, gap_free_versions
from tallyspark.operators.scoring import score_ensembles, score_versions
from tallyspark.operators.split import kfold, stratified_split, train_valid_test
from tallyspark.plans.features import SPLIT_SEED, draw_params, imputed_order_features, trial_params
from tallyspark.plans.queries import r, register
from tallyspark.session import materialize, shared_path
from tallyspark.sources.tables import table

ORDER_FEATURES = ["price_scaled", "prio", "acctbal", "nation"]
DOC_FEATURES = ["log_chars", "n_words_k", "is_en", "n_lines"]


def order_training(spark: SparkSession, d: str) -> DataFrame:
    """Imputed order features joined with customer features (planner picks the
    join strategy from sizes; AQE may switch it at run time)."""
    o = imputed_order_features(spark, d, "o_custkey")
    c = table(spark, d, "customer").select(
        F.col("c_custkey"), (F.col("c_acctbal") / 10000.0).alias("acctbal"),
        F.col("c_nationkey").cast("double").alias("nation"))
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
             .select("o_orderkey", *ORDER_FEATURES, "label"))


def doc_training(spark: SparkSession, d: str) -> DataFrame:
    """labels joined to documents; features from the whole text."""
    docs = table(spark, d, "documents").select(
        "doc_id",
        F.log1p(F.col("n_chars").cast("double")).alias("log_chars"),
        (F.size(F.split(F.col("text"), r"\s+")) / 1000.0).alias("n_words_k"),
        (F.col("lang") == "en").cast("double").alias("is_en"),
        F.size(F.split(F.col("text"), "\n")).cast("double").alias("n_lines"))
    lab = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return docs.join(lab, "doc_id")


@register("logit_importance")
def logit_importance(spark, d):
    """ML2, ML3, O1: weights at the best of 11 strengths over 10 folds, ascending."""
    weights, _ = LG.logistic_cv(order_training(spark, d), ORDER_FEATURES, "label", "o_orderkey", "f1", "l2", seed=SPLIT_SEED)
    return sort_importance(weights.select("feature", r("importance").alias("importance")))


@register("logit_importance_l1")
def logit_importance_l1(spark, d):
    """The same with the other penalty and metric."""
    weights, _ = LG.logistic_cv(order_training(spark, d), ORDER_FEATURES, "label", "o_orderkey", "accuracy", "l1", seed=SPLIT_SEED)
    return sort_importance(weights.select("feature", r("importance").alias("importance")))


@register("logit_scores")
def logit_scores(spark, d):
    """ML2: the mean score of every strength for each metric on the labelled documents."""
    docs = materialize(doc_training(spark, d), "documents")
    each = [LG.logistic_cv(docs, DOC_FEATURES, "label", "doc_id", m, "l2", folds=5, seed=SPLIT_SEED)[1].select(
        F.lit(m).alias("metric"), F.col("C").alias("strength"), r("score").alias("score")) for m in ("accuracy", "precision", "recall", "f1")]
    return each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3])


# The defaults of the boosted and bagged learners whose importances are shown.
BOOST_DEFAULTS = {"max_depth": 6, "learning_rate": 0.3, "reg_alpha": 0.0, "reg_lambda": 1.0, "min_child_weight": 1.0}
BOOST_ROUNDS, FOREST_TREES, FOREST_DEPTH = 100, 100, 5
# Parameters of gbt_train_eval, and of the versions of model_lifecycle.
TRAIN_PARAMS = {"max_depth": 3, "learning_rate": 0.3, "reg_alpha": 0.0, "reg_lambda": 1.0, "min_child_weight": 1.0}
TRAIN_ROUNDS, TRAIN_PATIENCE = 800, 40


def importance_rows(spark: SparkSession, shares: list[float]) -> DataFrame:
    rows = spark.createDataFrame(list(zip(ORDER_FEATURES, shares, strict=True)), "feature string, importance double")
    return sort_importance(rows.select("feature", r("importance").alias("importance")))


@register("rf_importance")
def rf_importance(spark, d):
    data = B.binned(materialize(order_training(spark, d)), ORDER_FEATURES, "label", key="o_orderkey")
    trees = B.forest(data, FOREST_TREES, FOREST_DEPTH, seed=SPLIT_SEED)
    return importance_rows(spark, B.impurity_importance(trees, len(ORDER_FEATURES)))


@register("gbt_importance")
def gbt_importance(spark, d):
    data = B.binned(materialize(order_training(spark, d)), ORDER_FEATURES, "label")
    got = B.boost(data, [B.Spec.of(BOOST_DEFAULTS)], BOOST_ROUNDS)
    return importance_rows(spark, B.gain_importance(got.trees[0], len(ORDER_FEATURES)))


@register("gbt_train_eval")
def gbt_train_eval(spark, d):
    """ML6, ML10, ML11: early-stopped boosting, its first trees as a node table, scored on the test part."""
    train, valid, test = _parts(spark, d)
    data = fold_parts(train, valid)
    got = B.boost(data, [B.Spec.of(TRAIN_PARAMS, 1)], TRAIN_ROUNDS, TRAIN_PATIENCE)
    nodes = B.node_table(spark, data, got.trees[0][:got.best[0] + 1])
    scored = materialize(score_ensembles(test, nodes.withColumns({"model_name": F.lit("orders"), "version": F.lit(1)}), ORDER_FEATURES), "scored")
    m = M.binary_metrics(scored, "label", "prediction").select("tp", "fp", "tn", "fn", *[r(x).alias(x) for x in M.METRICS])
    loss = M.log_loss(scored, "label", "prob").select(r("logloss").alias("test_logloss"))
    rounds = m.withColumns({"best_round": F.lit(got.best[0]), "stop_round": F.lit(got.stop[0]).cast("int"), "n_rounds": F.lit(len(got.losses[0])),
                            "valid_logloss": r(F.lit(got.losses[0][got.best[0]]))})
    return rounds.crossJoin(F.broadcast(loss))


def fold_parts(train: DataFrame, valid: DataFrame) -> B.Binned:
    """Blocks of a training part (fold 0) and a validation part (fold 1); bins come from the training part."""
    both = train.withColumn("fold", F.lit(0)).unionByName(valid.withColumn("fold", F.lit(1)))
    return B.binned(both, ORDER_FEATURES, "label", "fold", cuts=B.bin_cuts(train, ORDER_FEATURES))


def _parts(spark: SparkSession, d: str) -> list[DataFrame]:
    """Train, valid and test table of the order data, each written once."""
    parts = train_valid_test(order_training(spark, d), "label", "o_orderkey", seed=SPLIT_SEED)
    whole = materialize(parts.repartition("split"), "parts")
    return [whole.filter(F.col("split") == s).drop("split") for s in ("train", "valid", "test")]


@register("part_sizes")
def part_sizes(spark, d):
    """Rows and class counts of the three parts that the learners get."""
    parts = train_valid_test(order_training(spark, d).select("o_orderkey", "label"), "label", "o_orderkey", seed=SPLIT_SEED)
    return parts.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


@register("search_trials")
def search_trials(spark, d):
    """The search's trials as the learner gets them: one draw per run of the event table's user ids."""
    users = table(spark, d, "events").select("user_id").distinct()
    t = trial_params(users, "user_id")
    return t.select("user_id", "max_depth", *[r(c).alias(c) for c in ("learning_rate", "reg_alpha", "reg_lambda", "min_child_weight")])


# Versions of model_lifecycle: changes of TRAIN_PARAMS. The third one's files are damaged after it was registered.
LIFE_PARAMS = [{"max_depth": 2}, {"max_depth": 3, "learning_rate": 0.5}, {"max_depth": 4}, {"max_depth": 4, "reg_alpha": 0.05, "reg_lambda": 0.2}]
LIFE_ROUNDS, LIFE_PATIENCE, LIFE_DAMAGED = 30, 5, 3


@register("model_lifecycle")
def model_lifecycle(spark, d):
    """ML6, ML7, ML10, ML12, ML13, J2, R1-R4, F4-F6, O3, O5: train, save, log the run, register, check, score, promote.

    All versions are trained together and saved as node tables with manifests; a damaged one ends the versions that
    count. Those are scored on the test part in one scan, the best by accuracy goes to production, is found there
    again, and gives its share of ones.
    """
    from tallyspark.operators.models import ModelRegistry
    reg = ModelRegistry(spark, shared_path(spark, "registry"))
    train, valid, test = _parts(spark, d)
    data = fold_parts(train, valid)
    params = [{**TRAIN_PARAMS, **p} for p in LIFE_PARAMS]
    got = B.boost(data, [B.Spec.of(p, 1) for p in params], LIFE_ROUNDS, LIFE_PATIENCE)
    for i, p in enumerate(params):
        run = f"run-{i + 1}"
        reg.add_runs([(run, "orders", {k: str(v) for k, v in p.items()}, {"valid_logloss": got.losses[i][got.best[i]]}, {"kind": "boosted"})])
        version = reg.save_ensemble(B.node_table(spark, data, got.trees[i][:got.best[i] + 1]), "orders", run)
        if version == LIFE_DAMAGED:
            nodes = spark.read.schema(B.NODES).parquet(reg.uri("orders", run_id=run)).where("node > 0")
            nodes.write.mode("append").parquet(reg.uri("orders", version=version))
    live = materialize(reg.live_versions("orders"), "live")
    scored = score_ensembles(test, reg.ensembles(live), ORDER_FEATURES)
    mets = materialize(M.binary_metrics(scored, "label", "prediction", by=["model_name", "version"]), "metrics")
    best = best_version(mets.withColumnRenamed("version", "model_version"), "accuracy").first()
    reg.promote("orders", best["model_version"] if best else None)
    served = reg.uri("orders", stage="Production")
    one = reg.ensembles(live.where(F.col("uri") == served))
    share = score_ensembles(test, one, ORDER_FEATURES).agg(F.avg("prediction").alias("share"), F.count(F.lit(1)).alias("n"))
    runs = reg.runs().select("run_id", F.col("params")["max_depth"].alias("depth"), r(F.col("metrics")["valid_logloss"]).alias("valid_logloss"))
    state = reg.sound_versions("orders").join(reg.versions().select("model_name", "version", "run_id"), ["model_name", "version"])
    stages = current_stage(reg.stage_events()).select("model_name", "version", "stage")
    rows = state.join(runs, "run_id").join(mets, ["model_name", "version"], "left").join(stages, ["model_name", "version"], "left")
    out = rows.crossJoin(F.broadcast(share)).select(      # one row
        "model_name", "version", "run_id", "depth", "valid_logloss", "is_sound", "tp", "fp", "tn", "fn", r("accuracy").alias("accuracy"),
        r("f1").alias("f1"), "stage", F.when(F.col("stage").isNotNull(), r("share")).alias("served_share"), F.col("n").alias("served_rows"))
    return out


# Budgets of the searches: trials, rounds and patience on a validation part, and in a cross-validation.
TRIALS, ROUNDS, PATIENCE, CV_ROUNDS, CV_PATIENCE, CV_FOLDS = 50, 800, 40, 1000, 50, 5


def _trials(spark: SparkSession, n: int) -> list[dict]:
    """``n`` parameter sets, over the whole range of each."""
    return [x.asDict() for x in draw_params(spark.range(n).withColumnRenamed("id", "trial_id"), "trial_id").orderBy("trial_id").collect()]


@register("random_search")
def random_search(spark, d):
    """ML8, O4: the best of all trials on the validation part."""
    train, valid, _ = _parts(spark, d)
    res = spark.createDataFrame(B.random_search(fold_parts(train, valid), _trials(spark, TRIALS), "f1", ROUNDS, PATIENCE))
    return argmin_by_group(res.withColumn("_g", F.lit(1)), ["_g"], "loss", "trial_id",
                           ["learning_rate", "max_depth", "reg_alpha", "reg_lambda", "min_child_weight", "best_round"]).drop("_g")


@register("cv_search")
def cv_search(spark, d):
    """ML9: every trial's mean score over the folds, on the labelled documents."""
    data = B.binned(materialize(kfold(doc_training(spark, d), "doc_id", CV_FOLDS, SPLIT_SEED)), DOC_FEATURES, "label", "fold")
    res = spark.createDataFrame(B.cv_search(data, _trials(spark, TRIALS), CV_FOLDS, "f1", CV_ROUNDS, CV_PATIENCE))
    return res.select("trial_id", "max_depth", *[r(c).alias(c) for c in ("learning_rate", "reg_alpha", "reg_lambda", "min_child_weight", "mean_f1", "loss")],
                      F.col("rounds").cast("int").alias("rounds"))


# The search at a size that SQL can follow: its trials, their greatest depth, rounds and patience.
STEP_TRIALS, STEP_DEPTH, STEP_ROUNDS, STEP_PATIENCE, STEP_FOLDS = 6, 3, 12, 3, 3


@register("search_steps")
def search_steps(spark, d):
    """ML8, ML9: folds of every trial with all five parameters, to the round where it stopped."""
    data = B.binned(materialize(kfold(doc_training(spark, d), "doc_id", STEP_FOLDS, SPLIT_SEED)), DOC_FEATURES, "label", "fold")
    trials = [{**t, "max_depth": min(t["max_depth"], STEP_DEPTH)} for t in _trials(spark, STEP_TRIALS)]
    got = B.boost(data, [B.Spec.of(t, f) for t in trials for f in range(STEP_FOLDS)], STEP_ROUNDS, STEP_PATIENCE, keep=False)
    rows = [(m // STEP_FOLDS, m % STEP_FOLDS, got.best[m], len(got.losses[m]), got.losses[m][got.best[m]], *got.counts[m][got.best[m]])
            for m in range(len(got.losses))]
    out = spark.createDataFrame(rows, "trial_id int, fold int, best_round int, n_rounds int, logloss double, tp bigint, fp bigint, tn bigint, fn bigint")
    return out.withColumn("logloss", r("logloss"))


@register("all_versions_eval")
def all_versions_eval(spark, d):
    """ML13: fit one version per regularization strength on the train split,
    keep the gap-free version prefix, score every version on the test split
    (coefficients in one row), metrics per version, best by f1."""
    data = materialize(stratified_split(doc_training(spark, d), "label", "doc_id", 0.2, seed=SPLIT_SEED))
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    rows = []
    for v, reg in enumerate((0.0, 0.01, 0.1, 1.0), start=1):
        lr = TR.fit_logistic(train, DOC_FEATURES, "label", reg=reg, max_iter=50).stages[-1]
        rows.append(("doc_quality", v, float(lr.intercept), *map(float, lr.coefficients.toArray())))
    schema = "model_name string, version int, intercept double, " + ", ".join(
        f"w_{f} double" for f in DOC_FEATURES)
    versions = spark.createDataFrame(rows, schema)
    live = gap_free_versions(versions.select("model_name", "version"))
    versions = versions.join(live, ["model_name", "version"], "left_semi")
    scored = score_versions(test, versions, DOC_FEATURES)
    mets = M.binary_metrics(scored, "label", "prediction", by=["model_name", "version"])
    best = best_version(mets.withColumnRenamed("version", "model_version"), "f1").select(
        "model_name", F.col("model_version").alias("version"), F.lit(True).alias("is_best"))
    out = mets.join(best, ["model_name", "version"], "left").fillna({"is_best": False})
    return out.select("model_name", "version", "tp", "fp", "tn", "fn",
                      *[r(m).alias(m) for m in M.METRICS], "is_best")

