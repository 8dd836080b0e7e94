"""Regression models (M1-M16) on ``pyspark.ml``.

Thin constructors with the reference's defaults translated to Spark
parameters; a few fits need statistics of the data first (ridge and
elastic-net penalty scaling). Gradient-boosting libraries of the
reference are re-aimed at ``GBTRegressor`` presets: parity of predictions
with another engine is impossible, the contract is the operator's shape.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass
from functools import reduce
from typing import Any, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.functions.rowwise import linear_combination
from tabreg.operators.cells import training
from tabreg.session import persist_for_passes

FEATURES = "features"
LABEL = "label"


def _stats(df: DataFrame, label: str) -> tuple[int, float]:
    row = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return int(row["n"]), float(row["s"] or 0.0)


def fit(estimator, df: DataFrame):
    """Fit once: trees of many rows on their cells (``cells``), others with
    the input persisted for the duration of the fit.

    Iterative solvers pass over their input many times; without this every
    pass re-reads and re-derives it. The cache is dropped right after (an
    executor loss only costs recomputation).
    """
    with training(df) as rows:
        return rows.fit(estimator)


# Independent fits are submitted from driver threads: on small inputs each
# fit is latency-bound, on large ones the scheduler interleaves the tasks of
# concurrent fits.
FIT_PARALLELISM = 4


def fit_many(jobs, parallelism: int = FIT_PARALLELISM, fit_one=None) -> list:
    """Fit ``(estimator, frame)`` pairs, ``parallelism`` at a time, in order.

    Every job gets its own estimator copy, so concurrent fits never share
    the parameters of one JVM object.
    """
    fit_one = fit_one or (lambda e, d: e.fit(d))
    jobs = list(jobs)
    if parallelism <= 1 or len(jobs) <= 1:
        return [fit_one(e, d) for e, d in jobs]
    jobs = [(e.copy() if hasattr(e, "fit") and hasattr(e, "copy") else e, d) for e, d in jobs]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(min(parallelism, len(jobs))) as pool:
        return list(pool.map(lambda j: fit_one(*j), jobs))


def fit_built(build, df: DataFrame):
    """Fit ``build(df)`` for estimators that need statistics of their input
    first (ridge, elastic net): the statistics pass and the fit both read the
    same persisted frame, so the input is derived once, not twice."""
    cached = persist_for_passes(df)
    try:
        return build(cached).fit(cached)
    finally:
        cached.unpersist()


# ------------------------------------------------------------ linear family (M1-M4)

def linear_regression(features: str = FEATURES, label: str = LABEL,
                      pred: str = "prediction") -> LinearRegression:
    """M1: ordinary least squares (normal equations: one Gram aggregate)."""
    return LinearRegression(featuresCol=features, labelCol=label, predictionCol=pred,
                            solver="normal", regParam=0.0, standardization=False)


def ridge(df: DataFrame, alpha: float = 1.0, features: str = FEATURES,
          label: str = LABEL, pred: str = "prediction") -> LinearRegression:
    """M2: ``||y - Xw||^2 + alpha ||w||^2`` (intercept not penalised).

    Spark standardises the label inside the normal solver, so the
    equivalent ``regParam`` is ``alpha / n * std_pop(y)``.
    """
    n, s = _stats(df, label)
    return LinearRegression(featuresCol=features, labelCol=label, predictionCol=pred,
                            solver="normal", standardization=False, elasticNetParam=0.0,
                            regParam=alpha / max(n, 1) * s)


def lasso(df: DataFrame, alpha: float = 1.0, features: str = FEATURES,
          label: str = LABEL, pred: str = "prediction", max_iter: int = 1000,
          tol: float = 1e-10) -> LinearRegression:
    """M3: ``1/(2n) ||y - Xw||^2 + alpha ||w||_1`` (no rescaling needed)."""
    return LinearRegression(featuresCol=features, labelCol=label, predictionCol=pred,
                            standardization=False, elasticNetParam=1.0, regParam=alpha,
                            maxIter=max_iter, tol=tol)


def elastic_net(df: DataFrame, alpha: float = 1.0, l1_ratio: float = 0.5,
                features: str = FEATURES, label: str = LABEL, pred: str = "prediction",
                max_iter: int = 1000, tol: float = 1e-10) -> LinearRegression:
    """M4: L1 part ``alpha*rho``, L2 part ``alpha*(1-rho)`` (scaled by std(y))."""
    _, s = _stats(df, label)
    l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio) * s
    reg = l1 + l2
    return LinearRegression(featuresCol=features, labelCol=label, predictionCol=pred,
                            standardization=False, regParam=reg,
                            elasticNetParam=(l1 / reg) if reg > 0 else 0.0,
                            maxIter=max_iter, tol=tol)


# ------------------------------------------------------------ trees

MAX_TREE_DEPTH = 30  # Spark's own limit


def tree_depth(depth: int) -> int:
    """The depth as given; one that Spark can't build is an error, never cut."""
    if not 0 <= depth <= MAX_TREE_DEPTH:
        raise ValueError(f"tree depth {depth}: 0 to {MAX_TREE_DEPTH} can be built")
    return depth


def decision_tree(max_depth: int = 5, seed: int = 42, features: str = FEATURES,
                  label: str = LABEL, pred: str = "prediction", max_bins: int = 32):
    """M5: CART regression tree."""
    return DecisionTreeRegressor(featuresCol=features, labelCol=label, predictionCol=pred,
                                 maxDepth=tree_depth(max_depth), seed=seed, maxBins=max_bins)


def random_forest(num_trees: int = 100, max_depth: int = 5, seed: int = 42,
                  features: str = FEATURES, label: str = LABEL, pred: str = "prediction",
                  feature_subset: str = "all"):
    """M6: forest; all features per split as in the reference's default."""
    return RandomForestRegressor(featuresCol=features, labelCol=label, predictionCol=pred,
                                 numTrees=num_trees, maxDepth=tree_depth(max_depth), seed=seed,
                                 featureSubsetStrategy=feature_subset, bootstrap=True,
                                 subsamplingRate=1.0)


def bagging_trees(n_estimators: int = 50, max_depth: int = 5, seed: int = 42,
                  features: str = FEATURES, label: str = LABEL, pred: str = "prediction"):
    """M7: bagged regression trees = bootstrap forest using all features."""
    return random_forest(n_estimators, max_depth, seed, features, label, pred, "all")


@dataclass
class BaggedModel:
    """M7 with any base learner: mean of models fitted on bootstrap samples."""
    models: list
    pred: str

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        names = []
        for i, m in enumerate(self.models):
            name = f"__bag_{i}"
            out = m.copy({m.predictionCol: name}).transform(out)
            names.append(name)
        mean = sum((F.col(n) for n in names), F.lit(0.0)) / F.lit(float(len(names)))
        return out.withColumn(self.pred, mean).drop(*names)


# P(Poisson(1) <= k) for k = 0, 1, ...: how often a row is drawn in a bootstrap
# sample of a large table, as thresholds of a uniform number.
_POISSON_CDF = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(15)]).tolist()


def _bootstrap_hash(key: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in key])


def bootstrap_weight(key: Sequence[str], seed: int) -> Column:
    """Times a row is drawn, from a hash of its key: the same after any
    repartitioning or recomputation, with no shuffle and no copied rows."""
    u = F.pmod(_bootstrap_hash(key, seed), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return sum((F.when(u >= t, 1.0).otherwise(0.0) for t in _POISSON_CDF), F.lit(0.0))


#: Members whose moments one pass takes, and the numbers that a task holds for them at most.
_MEMBERS_A_PASS, _MOMENTS_MOST = 64, 1 << 20


def _merged(a: tuple, b: tuple) -> tuple:
    """Moments (rows, means, sums of centred products) of each member over both parts."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    d = b[1] - a[1]
    return (n, a[1] + share[:, None] * d,
            a[2] + b[2] + (a[0] * share)[:, None, None] * d[:, :, None] * d[:, None, :])


def _member_moments(df: DataFrame, key: Sequence[str], seeds: Sequence[int], features: str, label: str,
                    width: int) -> list[tuple] | None:
    """(rows, means, covariances) of features and label of each member's bootstrap
    sample, in one pass: a task reduces its batches to one row a member, whose
    parts are centred, so nothing cancels. None where the pass finds a value that
    is null or not finite, a vector of another width or a member without rows."""
    m, p = len(seeds), width + 1
    names = [f"x{i}" for i in range(width)]
    drawn = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
                      *[_bootstrap_hash(key, s).alias(f"u{i}") for i, s in enumerate(seeds)])
    rows = drawn.select(*[F.get("x", F.lit(i)).alias(c) for i, c in enumerate(names)],
                        F.when(F.size("x") == width, F.col("y")).alias("y"), *[f"u{i}" for i in range(m)])
    cdf = np.array(_POISSON_CDF)

    def partial(batches):
        total, odd = (np.zeros(m), np.zeros((m, p)), np.zeros((m, p, p))), False
        for pdf in (b.iloc[i:i + _LIFT_ROWS] for b in batches for i in range(0, len(b), _LIFT_ROWS)):
            z = pdf[[*names, "y"]].to_numpy(np.float64)
            if not np.isfinite(z).all():
                odd = True
                break
            u = (pdf[[f"u{i}" for i in range(m)]].to_numpy(np.int64) & ((1 << 52) - 1)) / float(1 << 52)
            w = np.searchsorted(cdf, u.ravel(), side="right").reshape(u.shape).astype(np.float64)
            near = z.mean(axis=0)
            z -= near
            n, s = w.sum(axis=0), w.T @ z
            mean = np.divide(s, n[:, None], out=np.zeros_like(s), where=n[:, None] > 0)
            products = np.stack([(z * w[:, [i]]).T @ z for i in range(m)])
            total = _merged(total, (n, mean + near, products - n[:, None, None] * mean[:, :, None] * mean[:, None, :]))
        yield pd.DataFrame({"member": np.arange(m), "n": total[0], "mean": total[1].tolist(),
                            "m2": total[2].reshape(m, -1).tolist(), "odd": odd})

    def merged(pdf):
        total = (np.zeros(1), np.zeros((1, p)), np.zeros((1, p, p)))
        for r in pdf.itertuples():
            total = _merged(total, (np.array([r.n]), np.array([r.mean]), np.array(r.m2).reshape(1, p, p)))
        return pd.DataFrame({"member": pdf["member"].iloc[:1], "n": total[0], "mean": total[1].tolist(),
                             "m2": total[2].reshape(1, -1).tolist(), "odd": pdf["odd"].any()})

    schema = "member int, n double, mean array<double>, m2 array<double>, odd boolean"
    found = {r["member"]: r for r in rows.mapInPandas(partial, schema).groupBy("member").applyInPandas(merged, schema).collect()}
    if len(found) < m or any(r["odd"] or r["n"] == 0 for r in found.values()):
        return None
    return [(r["n"], np.array(r["mean"]), np.array(r["m2"]).reshape(p, p) / r["n"]) for _, r in sorted(found.items())]


def _few_rows(n: float, mean: np.ndarray, cov: np.ndarray) -> list[tuple[float, list[float], float]]:
    """(weight, features, label) of a few rows with this weight, mean and covariance."""
    p, scale = len(mean), np.sqrt(np.maximum(np.diag(cov), 0.0))
    unit = np.where(scale > 0, scale, 1.0)
    value, vector = np.linalg.eigh(cov / np.outer(unit, unit))
    step = (vector * np.sqrt(np.maximum(value, 0.0) * p)) * scale[:, None]
    return [(n / (2 * p), at[:-1].tolist(), float(at[-1])) for j in range(p) for at in (mean + step[:, j], mean - step[:, j])]


def _fit_by_moments(estimator, df: DataFrame, key: Sequence[str], seeds: Sequence[int], weight: str,
                    parallelism: int) -> list | None:
    """Members of a linear regression that is solved by normal equations: these
    take from the rows only moments, so Spark's solver gets a few rows with the
    moments of a member's sample instead of the sample. The models have no
    training summary, which would take the rows. None where this doesn't hold."""
    if not (isinstance(estimator, LinearRegression) and estimator.getSolver() == "normal"
            and estimator.getLoss() == "squaredError"):
        return None
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    first = df.select(features).first()
    if first is None or first[0] is None or first[0].size == 0:
        return None
    width = first[0].size
    at_once = min(_MEMBERS_A_PASS, _MOMENTS_MOST // (width + 1) ** 2)
    if not at_once:
        return None
    rows = []
    for i in range(0, len(seeds), at_once):
        part = _member_moments(df, key, seeds[i:i + at_once], features, label, width)
        if part is None:
            return None
        rows += [(i + j, *r) for j, moments in enumerate(part) for r in _few_rows(*moments)]
    few = df.sparkSession.createDataFrame(rows, "member int, w double, x array<double>, y double").coalesce(1).select(
        "member", F.col("w").alias(weight), array_to_vector("x").alias(features), F.col("y").alias(label)).persist()
    try:
        models = fit_many([(estimator, few.filter(F.col("member") == i)) for i in range(len(seeds))], parallelism)
    finally:
        few.unpersist()
    for model in models:
        model._java_obj.setSummary(df.sparkSession._jvm.scala.Option.empty())
    return models


def bagging(estimator, df: DataFrame, key: Sequence[str], n_estimators: int = 10, seed: int = 42,
            pred: str = "prediction", parallelism: int = FIT_PARALLELISM) -> BaggedModel:
    """M7 generic: member i sees every row ``bootstrap_weight(key, seed + i)``
    times, as its weight. Linear regressions by normal equations take the moments
    of up to 64 members from one pass over the rows; other members are fitted
    concurrently over one cached frame. The estimator must take row weights."""
    if not hasattr(estimator, "weightCol"):
        raise ValueError(f"{type(estimator).__name__} takes no row weights")
    weight = "__bag_weight"
    member = estimator.copy({estimator.weightCol: weight})
    models = _fit_by_moments(member, df, key, [seed + i for i in range(n_estimators)], weight, parallelism)
    if models is not None:
        return BaggedModel(models, pred)
    cached = persist_for_passes(df)
    try:
        models = fit_many([(member, cached.withColumn(weight, bootstrap_weight(key, seed + i)).filter(F.col(weight) > 0))
                           for i in range(n_estimators)], parallelism)
    finally:
        cached.unpersist()
    return BaggedModel(models, pred)


# Boosting presets: the reference's boosting libraries re-aimed at Spark's GBT
# ("classic" = plain gradient boosting defaults: 100 rounds, depth 3, rate 0.1).
GBT_PRESETS: dict[str, dict[str, Any]] = {
    "classic": {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "maxBins": 32},
    "depthwise": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.3, "maxBins": 256},
    "histogram": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "maxBins": 255},
    "binned": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "maxBins": 254},
}

# Parameter-name translation (library name -> Spark GBT name).
_GBT_NAMES = {
    "n_estimators": "maxIter", "iterations": "maxIter", "max_depth": "maxDepth",
    "depth": "maxDepth", "learning_rate": "stepSize", "subsample": "subsamplingRate",
    "border_count": "maxBins", "gamma": "minInfoGain", "max_bin": "maxBins",
    "min_child_weight": "minInstancesPerNode", "random_state": "seed",
}
_NO_COUNTERPART = {"reg_alpha", "reg_lambda", "l2_leaf_reg", "bagging_temperature",
                   "random_strength", "num_leaves"}


def gbt_params(params: Mapping[str, Any]) -> dict[str, Any]:
    """Translate boosting-library parameters; refuse those Spark has no analogue for."""
    out: dict[str, Any] = {}
    for k, v in params.items():
        if k in _NO_COUNTERPART:
            if v not in (0, 0.0, None):
                raise ValueError(f"{k} has no Spark GBT counterpart")
            continue
        if k == "colsample_bytree":
            out["featureSubsetStrategy"] = str(float(v))
            continue
        name = _GBT_NAMES.get(k, k)
        if name in ("maxIter", "maxDepth", "maxBins", "minInstancesPerNode", "seed"):
            v = int(v)
        out[name] = v
    return out


def gbt(preset: str = "depthwise", features: str = FEATURES, label: str = LABEL,
        pred: str = "prediction", seed: int = 42, **params) -> GBTRegressor:
    """``GBTRegressor`` with a preset plus translated overrides."""
    conf = dict(GBT_PRESETS[preset])
    conf.update(gbt_params(params))
    conf["maxDepth"] = tree_depth(int(conf["maxDepth"]))
    conf.setdefault("seed", seed)
    return GBTRegressor(featuresCol=features, labelCol=label, predictionCol=pred, **conf)


# ------------------------------------------------------------ linear SVR

@dataclass
class LinearSVRModel:
    feature_cols: list[str]
    coefficients: list[float]
    intercept: float
    pred: str = "prediction"
    objective: float = math.nan
    converged: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.pred, linear_combination(
            self.feature_cols, self.coefficients, self.intercept)
            if self.intercept else linear_combination(self.feature_cols, self.coefficients))


@dataclass
class FourierFeatures:
    """Random Fourier features of the Gaussian kernel ``exp(-gamma |x - y|^2)``.

    ``sqrt(2 / n) cos(W x + b)`` with normal directions of variance ``2 gamma``
    and uniform phases: the inner product of two lifted rows is the kernel on
    average, with an error of the order of ``1 / sqrt(n)``. Directions and
    phases follow from the seed, so every task lifts alike.
    """
    width: int
    n: int = 200
    gamma: float | None = None
    seed: int = 42

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        if self.gamma is None:  # features of variance 1: one over their number
            self.gamma = 1.0 / max(self.width, 1)
        self.directions = rng.normal(0.0, math.sqrt(2.0 * self.gamma), (self.width, self.n))
        self.phases = rng.uniform(0.0, 2.0 * math.pi, self.n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = x @ self.directions
        out += self.phases
        np.cos(out, out=out)
        out *= math.sqrt(2.0 / self.n)
        return out


#: Rows that a task lifts at once.
_LIFT_ROWS = 4096
#: Rows on which a fit of more than ten times as many finds its first point. The
#: steps from there, and the test of convergence, are on all rows.
_START_ROWS = 100_000


def _svr_sums(data: DataFrame, center: np.ndarray, scale: np.ndarray, theta: np.ndarray,
              eps: float, mu: float, lift=None) -> tuple[float, float, np.ndarray, np.ndarray]:
    """Exact loss, smoothed loss, gradient and Hessian sums in one pass.

    A task reduces its Arrow batches to one row of (k + 1)^2 + k + 3 numbers;
    those are summed by position, so the driver gets as many numbers whatever
    the number of rows or tasks.
    """
    k = len(theta) - 1

    def partial(batches):
        total = np.zeros(2 + (k + 1) + (k + 1) ** 2)
        for pdf in (b.iloc[i:i + _LIFT_ROWS] for b in batches for i in range(0, len(b), _LIFT_ROWS)):
            m = (pdf.to_numpy(np.float64) - center) / scale
            x = np.ones((len(m), k + 1))
            x[:, :-1] = m[:, :-1] if lift is None else lift(m[:, :-1])
            r = m[:, -1] - x @ theta
            d = np.abs(r) - eps
            slope = np.clip(d / mu, 0, 1)
            smooth = np.where(d >= mu, d - mu / 2, 0.5 * mu * slope * slope)
            curved = x[(d > 0) & (d < mu)]
            total += np.concatenate([[np.maximum(d, 0).sum(), smooth.sum()],
                                     -(slope * np.sign(r)) @ x, ((curved.T @ curved) / mu).ravel()])
        yield pd.DataFrame({"s": [total.tolist()]})

    rows = (data.mapInPandas(partial, "s array<double>").select(F.posexplode("s").alias("i", "v"))
            .groupBy("i").agg(F.sum("v").alias("v")).collect())
    v = np.zeros(2 + (k + 1) + (k + 1) ** 2)
    for r in rows:
        v[r["i"]] = r["v"]
    return v[0], v[1], v[2:k + 3], v[k + 3:].reshape(k + 1, k + 1)


def fit_linear_svr(df: DataFrame, feature_cols: Sequence[str], label: str,
                   epsilon: float = 0.1, C: float = 1.0, max_iter: int = 200,
                   tol: float = 1e-3, pred: str = "prediction") -> LinearSVRModel:
    """Epsilon-insensitive linear regression, fitted to convergence.

    Objective (standardised units): ``mean(max(0, |r| - eps)) + ||w||^2 / (2 C n)``.
    The kink of the loss is rounded by a parabola of width ``mu``, which
    changes the objective by ``mu / 2`` at most. Damped Newton steps (one pass
    each over the persisted input, k^2 numbers to the driver) solve for one
    ``mu``, then ``mu`` is quartered, until the rounding is below ``tol`` times
    the objective. A large input is first solved on ``_START_ROWS`` of its rows
    (loss on those, scaling and penalty of all): the passes over all rows start
    near their solution. Rows with a null feature or label are left out. A fit that
    needs more than ``max_iter`` passes warns and has ``converged`` false.
    """
    cols = list(feature_cols)
    theta, center, scale, objective, converged = _fit_svr(df, cols, label, epsilon, C, max_iter, tol, None)
    k = len(cols)
    coef = theta[:k] * scale[-1] / scale[:k]
    intercept = center[-1] + scale[-1] * theta[k] - float(coef @ center[:k])
    return LinearSVRModel(cols, coef.tolist(), float(intercept), pred, float(objective), converged)


@dataclass
class KernelSVRModel:
    """Linear in the Fourier features of the standardised columns."""
    feature_cols: list[str]
    lift: FourierFeatures
    theta: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    pred: str = "prediction"
    objective: float = math.nan
    converged: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        """Null features give a null prediction."""
        lift, theta, center, scale = self.lift, self.theta, self.center, self.scale

        @F.pandas_udf("double")
        def scored(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for cols in parts:
                x = (np.column_stack([c.to_numpy(np.float64) for c in cols]) - center[:-1]) / scale[:-1]
                out = [lift(x[i:i + _LIFT_ROWS]) @ theta[:-1] for i in range(0, len(x), _LIFT_ROWS)]
                yield pd.Series(center[-1] + scale[-1] * (theta[-1] + np.concatenate([*out, np.zeros(0)])))

        columns = [F.col(c).cast("double") for c in self.feature_cols]
        known = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
        return df.withColumn(self.pred, F.when(known, scored(*columns)))


def fit_kernel_svr(df: DataFrame, feature_cols: Sequence[str], label: str, epsilon: float = 0.1, C: float = 1.0,
                   n_features: int = 200, gamma: float | None = None, seed: int = 42, max_iter: int = 200,
                   tol: float = 1e-3, pred: str = "prediction") -> KernelSVRModel:
    """M12 with the Gaussian kernel, by random Fourier features.

    The kernel's dual needs all pairs of rows; here rows are lifted to
    ``n_features`` cosines and the linear problem is solved on those by the
    Newton steps of ``fit_linear_svr``: one pass each, ``n_features ** 2``
    numbers to the driver, whatever the number of rows.
    """
    cols = list(feature_cols)
    lift = FourierFeatures(len(cols), n_features, gamma, seed)
    theta, center, scale, objective, converged = _fit_svr(df, cols, label, epsilon, C, max_iter, tol, lift)
    return KernelSVRModel(cols, lift, theta, center, scale, pred, float(objective), converged)


def _fit_svr(df: DataFrame, cols: list[str], label: str, epsilon: float, C: float, max_iter: int, tol: float, lift):
    """(theta, center, scale, objective, converged) in standardised units."""
    n_columns = len(cols)
    k = n_columns if lift is None else lift.n
    data = persist_for_passes(df.select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
        F.col(label).cast("double").alias("y")).dropna())
    try:
        names = [f"x{i}" for i in range(n_columns)] + ["y"]
        moments = data.agg(*[f for c in names for f in (
            F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))],
            F.count(F.lit(1)).alias("n")).first()
        n = max(int(moments["n"]), 1)
        center = np.array([moments[f"m_{c}"] or 0.0 for c in names])
        scale = np.array([moments[f"s_{c}"] or 1.0 for c in names])
        eps = epsilon / scale[-1]
        penalty = np.full(k + 1, 1.0 / (C * n))
        penalty[k] = 0.0

        def on(rows, count):
            def at(theta, mu):
                exact, smooth, g, h = _svr_sums(rows, center, scale, theta, eps, mu, lift)
                own = 0.5 * float(penalty @ (theta * theta))
                return exact / count + own, smooth / count + own, g / count + penalty * theta, h / count + np.diag(penalty)
            return at

        theta, mu, shrink, floor = np.zeros(k + 1), 1.0, 4.0, 0.0
        if n > 10 * _START_ROWS:
            some = persist_for_passes(data.sample(_START_ROWS / n, seed=42))
            try:
                (exact, theta), *_ = _newton(on(some, max(some.count(), 1)), theta, mu, shrink, max_iter, max(tol, 0.03))
            finally:
                some.unpersist()
            mu, shrink, floor = min(1.0, 0.1 * exact), 10.0, 0.99
        best, passes, converged = _newton(on(data, n), theta, mu, shrink, max_iter, tol, floor)
    finally:
        data.unpersist()
    if not converged:
        warnings.warn(f"SVR not converged after {passes} passes")
    return best[1], center, scale, best[0], converged


def _newton(at, theta: np.ndarray, mu: float, shrink: float, max_iter: int, tol: float, floor: float = 0.0):
    """((objective, theta), passes, converged) of damped Newton steps from ``theta``;
    ``at(theta, mu)`` is one pass, ``mu`` falls by ``shrink`` where it is solved,
    to ``floor`` of its last value at least."""
    eye = np.eye(len(theta))
    damping, passes, converged = 1e-8, 1, False
    exact, smooth, g, h = at(theta, mu)
    best = (exact, theta)
    while passes < max_iter:
        step = np.linalg.solve(h + damping * eye, -g)
        gain = -0.5 * float(g @ step)
        if gain <= 0.1 * tol * smooth or damping > 1e8:
            if mu <= tol * exact or exact <= 1e-12:
                converged = True
                break
            mu, damping = max(mu / shrink, floor * tol * exact), max(damping / 100, 1e-8)
            exact, smooth, g, h = at(theta, mu)
            passes += 1
            continue
        new = at(theta + step, mu)
        passes += 1
        if new[1] < smooth - 1e-4 * gain:
            theta, damping = theta + step, max(damping / 10, 1e-8)
            exact, smooth, g, h = new
            if exact < best[0]:
                best = (exact, theta)
        else:
            damping = max(damping * 10, 1e-6)
    return best, passes, converged


# ------------------------------------------------------------ predictions, importances

def predict(model, df: DataFrame, name: str) -> DataFrame:
    """Add one prediction column named after the model."""
    if hasattr(model, "predictionCol"):
        return model.copy({model.predictionCol: name}).transform(df)
    model.pred = name
    return model.transform(df)


def slot_names(df: DataFrame, features: str = FEATURES) -> list[str]:
    """Names of the vector slots from the ``ml_attr`` metadata."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = {}
    for group in attrs.values():
        for a in group:
            slots[a["idx"]] = a["name"]
    n = meta.get("num_attrs", len(slots))
    return [slots.get(i, f"Feature {i}") for i in range(n)]


def feature_importance(spark, model, names: Sequence[str], model_name: str) -> DataFrame:
    """``model, feature, importance`` (coefficients for linear models)."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
    else:
        vals = list(model.coefficients.toArray())
    rows = [(model_name, str(n), float(v)) for n, v in zip(names, vals)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def learning_curve(spark, gbt_model, datasets: Mapping[str, DataFrame],
                   metrics: Mapping[str, str] | None = None) -> DataFrame:
    """Error after each boosting round on each named dataset.

    ``metrics`` maps a metric name to a Spark loss: ``rmse`` (sqrt of the
    mean squared error) and ``mae`` (``absolute``). ``evaluateEachIteration``
    is one distributed pass per dataset and metric.
    """
    metrics = metrics or {"rmse": "squared"}
    rows = []
    for name, df in datasets.items():
        for metric, loss in metrics.items():
            losses = gbt_model.evaluateEachIteration(df, loss)
            vals = [math.sqrt(v) if loss == "squared" else float(v) for v in losses]
            rows += [(i, name, metric, float(v)) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "round int, dataset string, metric string, value double")
