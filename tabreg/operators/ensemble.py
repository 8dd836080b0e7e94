"""Ensembles.

* averaging and voting are column expressions over chained ``transform``s;
* optimal convex weights come from **one** aggregate (the k x k Gram
  matrix of the prediction columns, ``P'y`` and ``y'y``); the tiny
  simplex-constrained least-squares problem is solved exactly on the driver;
* stacking fits members per fold on ``fold != f`` and predicts ``fold == f``
  (out-of-fold rows are unioned and checkpointed), blending uses a salted
  hash hold-out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Mapping, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.functions.rowwise import linear_combination, mean_of
from tabreg.operators.cells import TrainingRows
from tabreg.operators.models import FIT_PARALLELISM, fit_built, fit_many, predict, ridge
from tabreg.operators.prep import train_test_split, with_kfold
from tabreg.session import cut_lineage, persist_for_passes

# Independent fits (fold x member, members) run FIT_PARALLELISM at a time from
# driver threads, as the reference runs its stacking workers in parallel.


def simple_average(df: DataFrame, cols: Sequence[str], out: str = "avg_pred") -> DataFrame:
    """Unweighted mean of k prediction columns."""
    return df.withColumn(out, mean_of(cols))


@dataclass
class VotingModel:
    """Fitted members; the prediction is their (weighted) mean."""
    members: Mapping[str, object]
    weights: Sequence[float] | None = None
    pred: str = "prediction"

    def transform(self, df: DataFrame, keep_members: bool = False) -> DataFrame:
        out = df
        for name, m in self.members.items():
            out = predict(m, out, f"__vote_{name}")
        cols = [f"__vote_{n}" for n in self.members]
        if self.weights is None:
            out = out.withColumn(self.pred, mean_of(cols))
        else:
            w = np.asarray(self.weights, dtype=float)
            out = out.withColumn(self.pred, linear_combination(cols, w / w.sum()))
        if keep_members:
            return out.withColumnsRenamed({f"__vote_{n}": n for n in self.members})
        return out.drop(*cols)


def voting(estimators: Mapping[str, object], df: DataFrame,
           weights: Sequence[float] | None = None, pred: str = "prediction",
           parallelism: int = FIT_PARALLELISM) -> VotingModel:
    """Fit every member on the same rows."""
    return VotingModel(_fit_all(estimators, df, parallelism), weights, pred)


# ------------------------------------------------------------------ optimal weights

def gram_statistics(df: DataFrame, label: str, cols: Sequence[str]) -> dict:
    """One aggregate: ``n``, ``SST`` and the Gram matrix of the error columns.

    Because the weights sum to one, ``P w - y = E w`` with ``E = P - y``
    (per-row errors), so ``SSE(w) = w' (E'E) w``: no linear term and no
    cancellation between huge sums of squares of the raw predictions.
    """
    k = len(cols)
    y = F.col(label).cast("double")
    errs = [F.col(c).cast("double") - y for c in cols]
    aggs = [F.count(y).alias("n"), F.var_pop(y).alias("vy")]
    for i in range(k):
        for j in range(i, k):
            aggs.append(F.sum(errs[i] * errs[j]).alias(f"ee_{i}_{j}"))
    row = df.agg(*aggs).first()
    H = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            H[i, j] = H[j, i] = row[f"ee_{i}_{j}"]
    return {"n": row["n"], "sst": row["vy"] * row["n"], "H": H}


def simplex_least_squares(H: np.ndarray, tol: float = 1e-13) -> np.ndarray:
    """``argmin w' H w`` s.t. ``w >= 0, sum(w) = 1`` (H = Gram of errors).

    Active sets: the support grows by the model whose slope lies most below
    the mixture's own; the optimum on the plane of the support is approached
    until a weight would turn negative, and that model leaves. It ends with a
    certificate: with ``g = H w``, no model has ``g_i < w' g``, up to ``tol`` of
    the scale, and ``2 (w' g - min g)`` bounds the distance to the optimum.
    Dependent models (H without full rank) share weight by least squares.
    """
    k = H.shape[0]
    Hs = H / (float(np.max(np.diag(H))) or 1.0)
    w = np.zeros(k)
    w[int(np.argmin(np.diag(Hs)))] = 1.0
    best = float(w @ Hs @ w)
    for _ in range(50 * k + 50):
        g = Hs @ w
        enter = int(np.argmin(g))
        if g[enter] >= w @ g - tol:
            break
        support = np.flatnonzero((w > 0) | (np.arange(k) == enter))
        trial = w.copy()
        while True:
            u = _plane_optimum(Hs[np.ix_(support, support)])
            now = trial[support]
            # as far towards the plane's optimum as all weights stay positive
            falls = u < 0
            step = min(1.0, float(np.min(now[falls] / (now[falls] - u[falls])))) if falls.any() else 1.0
            now = np.maximum(now + step * (u - now), 0.0)
            now[now < 1e-15] = 0.0
            trial[support] = now / now.sum()
            if step >= 1.0:
                break
            support = np.flatnonzero(trial > 0)
        value = float(trial @ Hs @ trial)
        if value >= best - 1e-16:  # rounding is all that is left
            break
        w, best = trial, value
    return w


def _plane_optimum(H: np.ndarray) -> np.ndarray:
    """``argmin u' H u`` s.t. ``sum(u) = 1``, signs free."""
    n = len(H)
    system = np.block([[H, np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
    return np.linalg.lstsq(system, np.append(np.zeros(n), 1.0), rcond=1e-14)[0][:n]


def optimise_weights(df: DataFrame, label: str, cols: Sequence[str]) -> tuple[list[float], float]:
    """Weights in [0, 1] summing to 1 that maximise R^2; returns (w, r2)."""
    s = gram_statistics(df, label, cols)
    w = simplex_least_squares(s["H"])
    sse = float(w @ s["H"] @ w)
    return [float(x) for x in w], float(1.0 - sse / s["sst"])


def weights_frame(spark: SparkSession, names: Sequence[str], weights: Sequence[float],
                  value: str = "weight") -> DataFrame:
    """``model, weight`` (one row per member)."""
    return spark.createDataFrame([(n, float(w)) for n, w in zip(names, weights)],
                                 f"model string, {value} double")


# ------------------------------------------------------------------ stacking, blending

EstimatorFactory = Callable[[DataFrame], object]


def _fit(factory, df: DataFrame):
    est = factory(df) if callable(factory) and not hasattr(factory, "fit") else factory
    return est.fit(df)


def _fit_many(jobs: Sequence[tuple[object, DataFrame]], parallelism: int) -> list:
    return fit_many(jobs, parallelism, _fit)


def _fit_all(members: Mapping[str, object], df: DataFrame,
             parallelism: int = FIT_PARALLELISM) -> dict:
    cached = persist_for_passes(df)
    try:
        fitted = _fit_many([(e, cached) for e in members.values()], parallelism)
        return dict(zip(members, fitted))
    finally:
        cached.unpersist()


def out_of_fold(df: DataFrame, key: Sequence[str], label: str,
                members: Mapping[str, object], k: int = 10, fold_col: str = "fold",
                salt: str = "fold", parallelism: int = FIT_PARALLELISM) -> DataFrame:
    """N4 level-1 data: every row predicted by members fitted without its fold.

    ``members`` maps a name to an estimator (or a factory taking the
    training frame, for estimators that need its statistics). The
    ``k x members`` fits are independent and run ``parallelism`` at a time.
    """
    if fold_col not in df.columns:
        df = with_kfold(df, list(key), k, salt, fold_col)
    base = persist_for_passes(df)
    folds = TrainingRows(base, [fold_col])
    try:
        jobs = [(f, name, est) for f in range(k) for name, est in members.items()]
        folds._direct = base
        fitted = fit_many([(est, f) for f, _, est in jobs], parallelism, lambda est, f: (
            _fit(est, base.filter(F.col(fold_col) != f)) if callable(est) and not hasattr(est, "fit")
            else folds.fit(est, F.col(fold_col) != f)))
        models = {(f, name): m for (f, name, _), m in zip(jobs, fitted)}
        parts = []
        for f in range(k):
            hold = base.filter(F.col(fold_col) == f)
            for name in members:
                hold = predict(models[(f, name)], hold, name)
            parts.append(hold.select(*key, fold_col, label, *members))
        oof = cut_lineage(reduce(lambda a, b: a.unionByName(b), parts))
    finally:
        folds.release()
        base.unpersist()
    return oof


@dataclass
class StackedModel:
    members: Mapping[str, object]
    meta: object
    pred: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for name, m in self.members.items():
            out = predict(m, out, name)
        out = VectorAssembler(inputCols=list(self.members), outputCol="__meta_x").transform(out)
        out = predict(self.meta, out, self.pred)
        return out.drop("__meta_x")


def stacking(df: DataFrame, key: Sequence[str], label: str, members: Mapping[str, object],
             k: int = 10, alpha: float = 1.0, features: str = "features",
             pred: str = "prediction",
             parallelism: int = FIT_PARALLELISM) -> tuple[StackedModel, DataFrame]:
    """Ridge meta-model on out-of-fold predictions; members re-fitted on all rows."""
    oof = out_of_fold(df, key, label, members, k, parallelism=parallelism)
    x = VectorAssembler(inputCols=list(members), outputCol="__meta_x").transform(oof)
    meta = fit_built(lambda d: ridge(d, alpha, "__meta_x", label), x)
    full = _fit_all(members, df, parallelism)
    return StackedModel(full, meta, pred), oof


def blending(df: DataFrame, key: Sequence[str], label: str, members: Mapping[str, object],
             holdout_fraction: float = 0.2, alpha: float = 1.0, salt: str = "blend",
             pred: str = "prediction", parallelism: int = FIT_PARALLELISM) -> StackedModel:
    """Members fitted on the base part only; ridge meta-model on the hold-out."""
    base, hold = train_test_split(df, list(key), holdout_fraction, salt)
    fitted = _fit_all(members, base, parallelism)
    h = hold
    for name, m in fitted.items():
        h = predict(m, h, name)
    x = VectorAssembler(inputCols=list(members), outputCol="__meta_x").transform(h)
    meta = fit_built(lambda d: ridge(d, alpha, "__meta_x", label), x)
    return StackedModel(fitted, meta, pred)


def meta_coefficients(spark: SparkSession, stacked: StackedModel) -> DataFrame:
    """``model, coefficient`` of the meta-model, intercept as its own row."""
    names = list(stacked.members)
    coefs = list(stacked.meta.coefficients.toArray())
    rows = [(n, float(c)) for n, c in zip(names, coefs)]
    rows.append(("intercept", float(stacked.meta.intercept)))
    return spark.createDataFrame(rows, "model string, coefficient double")
