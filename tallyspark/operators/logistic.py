"""Penalized logistic regression for many (fold, C) at once (ML2, ML3), by joint Newton steps.

Each step is one scan: a task turns its rows into the loss, gradient and second derivatives (X'WX, packed) of
every model, and Spark adds them up. What comes back doesn't depend on the number of rows; the small systems
are solved on the driver. A step that doesn't lower a model's objective is halved, within the same scans.

The objective is C * sum of log losses + |w|^2 / 2 (l2) or |w|_1 (l1), the intercept being penalized like any
other weight.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.boosting import metric_name, rates
from tallyspark.operators.training import minmax_scale
from tallyspark.session import materialize, workers_import

#: The inverse strengths that are tried.
CS = [10.0 ** e for e in range(-5, 6)]
#: Largest change of a weight that ends the steps, and steps at most.
CLOSE, STEPS = 1e-10, 100


def logistic_cv(df: DataFrame, features: Sequence[str], label: str, key: str, metric: str = "f1", penalty: str = "l2",
                cs: Sequence[float] = CS, folds: int = 10, seed: str = "42") -> tuple[DataFrame, DataFrame]:
    """ML2, ML3: ((feature, importance), (C, score)): the weights of the best C fitted on all rows, and each C's mean score.

    Features are min-max scaled (ML1); folds are the exact-size ones (SP3). The best score wins, of equal ones
    (to 12 digits) the smallest C. Rows with a null in a feature are refused by the scaling's caller: none may be there.
    """
    from tallyspark.operators.split import kfold
    spark, name, features, cs = df.sparkSession, metric_name(metric), list(features), list(cs)
    scaled = minmax_scale(df, features).select(
        F.array(*[F.col(f"`{f}`") for f in features], F.lit(1.0)).alias("x"), F.col(label).cast("double").alias("y"), key)
    table = materialize(kfold(scaled, key, folds, seed).select("x", "y", "fold"), "folds")
    models = [(f, c) for c in cs for f in (-1, *range(folds))]           # fold -1: all rows
    w = fit(table, np.array([f for f, _ in models]), np.array([c for _, c in models]), penalty, len(features) + 1)
    seen = confusion(table, models, w)
    score = {}
    for c in cs:
        each = [rates(tuple(map(int, seen[m])))[name] for m, (f, d) in enumerate(models) if d == c and f >= 0]
        score[c] = sum(each) / len(each)
    best = max(cs, key=lambda c: (round(score[c], 12), -c))
    weights = w[models.index((-1, best))]
    return (spark.createDataFrame(list(zip(features, map(float, weights[:-1]), strict=True)), "feature string, importance double"),
            spark.createDataFrame([(float(c), float(score[c])) for c in cs], "C double, score double"))


def fit(table: DataFrame, folds: np.ndarray, cs: np.ndarray, penalty: str, width: int) -> np.ndarray:
    """Weights (models x width): each model learns from the rows outside its fold."""
    if penalty not in ("l1", "l2"):
        raise ValueError("penalty must be 'l1' or 'l2'")
    n = len(cs)
    w, at, value = np.zeros((n, width)), np.zeros((n, width)), np.full(n, np.inf)
    open_ = np.arange(n)
    for _ in range(STEPS):
        loss, g, h = sums(table, folds[open_], at[open_])
        closed = []
        for i, m in enumerate(open_):
            c = cs[m]
            pen = 0.5 * at[m] @ at[m] if penalty == "l2" else np.abs(at[m]).sum()
            now = c * loss[i] + pen
            if now > value[m] + 1e-12 * abs(value[m]):
                at[m] = 0.5 * (at[m] + w[m])            # too far: half the way
                if np.abs(at[m] - w[m]).max() < CLOSE:
                    closed.append(m)
                continue
            w[m], value[m] = at[m], now
            if penalty == "l2":
                at[m] = w[m] - np.linalg.solve(c * h[i] + np.eye(width), c * g[i] + w[m])
            else:
                at[m] = _soft_step(w[m], c * g[i], c * h[i])
            if np.abs(at[m] - w[m]).max() < CLOSE:
                closed.append(m)
        open_ = np.setdiff1d(open_, closed)
        if not len(open_):
            return w
    raise RuntimeError(f"{len(open_)} logistic models did not settle in {STEPS} steps")


def _soft_step(w: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The least of g'(v - w) + (v - w)'h(v - w) / 2 + |v|_1, one weight after another."""
    v = w.copy()
    for _ in range(10_000):
        before = v.copy()
        for j in range(len(v)):
            slope = g[j] + h[j] @ (v - w)
            u = h[j, j] * v[j] - slope
            v[j] = np.sign(u) * max(abs(u) - 1.0, 0.0) / h[j, j] if h[j, j] > 0 else 0.0
        if np.abs(v - before).max() < CLOSE / 10:
            break
    return v


def sums(table: DataFrame, folds: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, gradient and second derivatives of every model, in one scan."""
    n, width = w.shape
    a, b = np.triu_indices(width)
    size = 1 + width + len(a)
    workers_import(table.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, n))
        for x, y, fold in _matrices(batches, width):
            z = x @ w.T
            mine = fold[:, None] != folds[None, :]
            p = 1.0 / (1.0 + np.exp(-z))
            total[0] += (np.logaddexp(0.0, z) - y[:, None] * z)[:, :].sum(axis=0, where=mine)
            total[1:1 + width] += x.T @ ((p - y[:, None]) * mine)
            total[1 + width:] += (x[:, a] * x[:, b]).T @ (p * (1.0 - p) * mine)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * n)), pa.array(total.ravel())], names=["at", "v"])

    got = table.select("x", "y", "fold").mapInArrow(scan, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(size * n)
    for r in got:                                        # models x width^2 / 2 numbers
        total[r["at"]] = r["v"]
    total = total.reshape(size, n).T
    h = np.zeros((n, width, width))
    h[:, a, b] = h[:, b, a] = total[:, 1 + width:]
    return total[:, 0], total[:, 1:1 + width], h


def confusion(table: DataFrame, models: list[tuple[int, float]], w: np.ndarray) -> np.ndarray:
    """tp, fp, tn, fn of every model on its fold; a row is said to be 1 if its probability is over 0.5."""
    folds = np.array([f for f, _ in models])
    width = w.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, len(folds)), np.int64)
        for x, y, fold in _matrices(batches, width):
            said, mine, one = x @ w.T > 0, fold[:, None] == folds[None, :], y[:, None] == 1
            for i, hit in enumerate((one & said, ~one & said, ~one & ~said, one & ~said)):
                total[i] += (hit & mine).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "v"])

    out = np.zeros(4 * len(folds), np.int64)
    for r in table.select("x", "y", "fold").mapInArrow(scan, "at bigint, v bigint").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out.reshape(4, -1).T


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            yield x, b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
