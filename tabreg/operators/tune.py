"""Hyper-parameter search and trial analysis.

Trials are Spark jobs submitted from driver threads (``parallelism``)
over cached training and validation frames; the driver keeps only the
trial records. Trial analysis (best so far, importance, contour, early
stopping) is plain DataFrame work, so a trial table from many studies, or
a per-entity learning curve with billions of rounds, scales the same way.
"""

from __future__ import annotations

import math
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any, Callable, Mapping, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.functions.attach import attach
from tabreg.functions.scan import running_aggregate
from tabreg.operators.cells import TrainingRows
from tabreg.operators.boosting import boost_until_stopped, stageable
from tabreg.operators.evaluate import metrics
from tabreg.operators.models import learning_curve, predict
from tabreg.operators.rounds import PackedRows
from tabreg.session import persist_for_passes


# ------------------------------------------------------------------ search space (H1)

@dataclass(frozen=True)
class IntRange:
    low: int
    high: int

    def sample(self, rng: np.random.Generator) -> float:
        return float(rng.integers(self.low, self.high + 1))


@dataclass(frozen=True)
class FloatRange:
    low: float
    high: float
    log: bool = False

    def sample(self, rng: np.random.Generator) -> float:
        if self.log:
            return float(math.exp(rng.uniform(math.log(self.low), math.log(self.high))))
        return float(rng.uniform(self.low, self.high))


def sample_params(space: Mapping[str, IntRange | FloatRange], n: int,
                  seed: int = 42) -> list[dict[str, float]]:
    """Seeded random parameter maps (the TPE sampler is not rebuilt)."""
    rng = np.random.default_rng(seed)
    return [{k: r.sample(rng) for k, r in space.items()} for _ in range(n)]


# ------------------------------------------------------------------ random search (H2-H4)

TRIAL_SCHEMA = "trial int, value double, params map<string,double>, seconds double"


def random_search(spark: SparkSession, build: Callable[[dict], Any],
                  space: Mapping[str, IntRange | FloatRange], train: DataFrame,
                  val: DataFrame, n_trials: int = 50, metric: str = "r2",
                  direction: str = "maximize", label: str = "label", seed: int = 42,
                  timeout: float | None = None, parallelism: int = 1) -> DataFrame:
    """H2/H3: fit ``build(params)`` on train, score ``metric`` on validation.

    ``timeout`` (seconds) ends the search: no trial starts after it, and the
    jobs of those that run are cancelled. Such a trial is recorded without a
    value, its ``state`` "pruned"; the others are "complete". Trials that did
    not start are not recorded.
    """
    rows = PackedRows(TrainingRows(train))
    val = val.persist(StorageLevel.MEMORY_AND_DISK)
    param_sets = sample_params(space, n_trials, seed)
    if param_sets:
        rows.prepare(build(param_sets[0]))
    deadline = math.inf if timeout is None else time.time() + timeout

    def run(i_params):
        i, params = i_params
        t0 = time.time()
        if t0 > deadline:
            return None
        try:
            with _cancelled_at(spark, deadline):
                model = rows.fit(build(params))
                scored = predict(model, val, "__pred")
                value = metrics(scored, label, {"m": "__pred"}).first()[metric]
        except Exception:
            if time.time() < deadline:
                raise
            return (i, None, params, time.time() - t0, "pruned")
        return (i, float(value), params, time.time() - t0, "complete")

    try:
        if parallelism > 1:
            with ThreadPoolExecutor(parallelism) as pool:
                results = list(pool.map(run, enumerate(param_sets)))
        else:
            results = [run(x) for x in enumerate(param_sets)]
    finally:
        rows.release()
        val.unpersist()
    records = [r for r in results if r is not None]
    return spark.createDataFrame(records, TRIAL_SCHEMA + ", state string")


@contextmanager
def _cancelled_at(spark: SparkSession, deadline: float):
    """Tags this thread's jobs; at the deadline those that run are cancelled,
    and, until the block is left, those that still follow."""
    if deadline == math.inf:
        yield
        return
    sc, tag, over = spark.sparkContext, f"trial-{uuid.uuid4().hex}", threading.Event()

    def watch():
        if not over.wait(max(0.0, deadline - time.time())):
            while not over.wait(0.2):
                sc.cancelJobsWithTag(tag)

    watcher = threading.Thread(target=watch, daemon=True)
    sc.addJobTag(tag)
    watcher.start()
    try:
        yield
    finally:
        over.set()
        watcher.join()
        sc.removeJobTag(tag)


def grid_search_cv(spark: SparkSession, estimator, grid: Mapping[str, Sequence[Any]],
                   df: DataFrame, fold_col: str, k: int, metric: str = "rmse",
                   label: str = "label", parallelism: int = 1) -> DataFrame:
    """H5: exhaustive grid with k-fold cross-validation on a hash fold column."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    ev = RegressionEvaluator(metricName=metric, labelCol=label,
                             predictionCol=estimator.getPredictionCol())
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=ev,
                        numFolds=k, foldCol=fold_col, parallelism=parallelism)
    cached = persist_for_passes(df)
    try:
        model = cv.fit(cached)
    finally:
        cached.unpersist()
    rows = []
    for i, (pm, score) in enumerate(zip(maps, model.avgMetrics)):
        rows.append((i, float(score), {p.name: float(v) for p, v in pm.items()}, 0.0))
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


def best_trial(trials: DataFrame, direction: str = "maximize",
               study_cols: Sequence[str] = (), trial_col: str = "trial",
               value_col: str = "value") -> DataFrame:
    """Best trial per study; ties go to the earliest trial.

    A grouped ``max_by``/``min_by`` (partial aggregation), never a sort of
    the whole study. Trials without a value are never the best.
    """
    trials = trials.filter(F.col(value_col).isNotNull())
    payload = F.struct(*[F.col(c) for c in trials.columns if c not in study_cols])
    if direction == "maximize":
        best = F.max_by(payload, F.struct(F.col(value_col), -F.col(trial_col)))
    else:
        best = F.min_by(payload, F.struct(F.col(value_col), F.col(trial_col)))
    g = list(study_cols)
    agg = trials.groupBy(*g).agg(best.alias("b")) if g else trials.agg(best.alias("b"))
    return agg.select(*g, "b.*")


def refit_best(build: Callable[[dict], Any], trials: DataFrame, train: DataFrame,
               direction: str = "maximize"):
    """H4: re-fit the best parameter map on the full training frame."""
    params = best_trial(trials, direction).first()["params"]
    from tabreg.operators.models import fit
    return fit(build(dict(params)), train)


# ------------------------------------------------------------------ trial analysis

def trials_long(trials: DataFrame, trial_col: str = "trial", value_col: str = "value",
                params_col: str = "params", keep: Sequence[str] = ()) -> DataFrame:
    """H6: ``trial, value, param, param_value`` (one row per parameter)."""
    return trials.select(*keep, trial_col, value_col,
                         F.explode(params_col).alias("param", "param_value"))


def best_so_far(trials: DataFrame, study_cols: Sequence[str] = (), trial_col: str = "trial",
                value_col: str = "value", direction: str = "maximize",
                out: str = "best_so_far") -> DataFrame:
    """Running best objective by trial order, split across partitions."""
    g = list(study_cols) or ["__study"]
    src = trials if study_cols else trials.withColumn("__study", F.lit(0))
    op = "max" if direction == "maximize" else "min"
    res = running_aggregate(src, g, [trial_col], op, value=value_col, out=out)
    return res.drop("__study") if not study_cols else res


def _binned(long: DataFrame, bins: int, by: Sequence[str]) -> DataFrame:
    """Equal-width bin of ``param_value`` per parameter (bounds per parameter)."""
    bounds = long.groupBy(*by, "param").agg(F.min("param_value").alias("lo"),
                                            F.max("param_value").alias("hi"))
    w = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(w > 0, F.floor((F.col("param_value") - F.col("lo")) / w)).otherwise(F.lit(0))
    return attach(long, bounds, [*by, "param"], ["lo", "hi"]).withColumn(
        "bin", F.least(b, F.lit(bins - 1)).cast("int"))


def param_importance(trials: DataFrame, bins: int = 10, study_cols: Sequence[str] = (),
                     params_col: str = "params", value_col: str = "value",
                     trial_col: str = "trial") -> DataFrame:
    """H7: share of the objective's variance explained by each parameter's bins.

    ``eta2 = sum_b n_b (mean_b - mean)^2 / sum (v - mean)^2`` per parameter
    (a correlation ratio), and ``importance`` = eta2 normalised to sum 1.
    Stands in for the fANOVA evaluator; one grouped aggregate.
    """
    by = list(study_cols)
    long = trials_long(trials, trial_col, value_col, params_col, keep=by)
    tot = trials.groupBy(*by).agg(F.avg(value_col).alias("mu"),
                                  (F.var_pop(value_col) * F.count(value_col)).alias("sst"))
    cells = _binned(long, bins, by).groupBy(*by, "param", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg(value_col).alias("m"))
    if by:
        eta = cells.join(tot, by)
    else:
        t = tot.first()
        eta = cells.withColumns({"mu": F.lit(t["mu"]).cast("double"),
                                 "sst": F.lit(t["sst"]).cast("double")})
    eta = eta.groupBy(*by, "param").agg(
        F.try_divide(F.sum(F.col("n") * (F.col("m") - F.col("mu")) ** 2),
                     F.first("sst")).alias("eta2"))
    from pyspark.sql import Window
    wsum = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return eta.withColumn("importance", F.try_divide(F.col("eta2"), F.sum("eta2").over(wsum)))


def param_contour(trials: DataFrame, a: str, b: str, bins: int = 10,
                  params_col: str = "params", value_col: str = "value") -> DataFrame:
    """H7: mean objective on a 2-D grid of two parameters (contour data)."""
    pa, pb = F.col(params_col)[a], F.col(params_col)[b]
    src = trials.select(pa.alias("xa"), pb.alias("xb"), F.col(value_col).alias("v")) \
        .filter(F.col("xa").isNotNull() & F.col("xb").isNotNull())
    bounds = src.agg(F.min("xa").alias("la"), F.max("xa").alias("ha"),
                     F.min("xb").alias("lb"), F.max("xb").alias("hb"))
    bnd = bounds.first()
    la, ha, lb, hb = [F.lit(bnd[c]).cast("double") for c in ("la", "ha", "lb", "hb")]

    def binexpr(x, lo, hi):
        w = (hi - lo) / F.lit(float(bins))
        raw = F.when(w > 0, F.floor((x - lo) / w)).otherwise(F.lit(0))
        return F.least(raw, F.lit(bins - 1)).cast("int")
    return src.select(binexpr(F.col("xa"), la, ha).alias(f"bin_{a}"),
                      binexpr(F.col("xb"), lb, hb).alias(f"bin_{b}"), "v") \
        .groupBy(f"bin_{a}", f"bin_{b}").agg(F.avg("v").alias("mean_value"),
                                             F.count(F.lit(1)).alias("n"))


def parallel_coordinates(trials: DataFrame, params: Sequence[str],
                         params_col: str = "params") -> DataFrame:
    """H7: one column per parameter next to the objective."""
    return trials.select("trial", "value", *[F.col(params_col)[p].alias(p) for p in params])


# ------------------------------------------------------------------ early stopping

def early_stop(curve: DataFrame, group_cols: Sequence[str], round_col: str = "round",
               metric_col: str = "rmse", patience: int = 30) -> DataFrame:
    """Where training with ``early_stopping_rounds=patience`` stops.

    The first round r with ``r - round_of_best(r) >= patience`` (best =
    strictly lower metric; ties keep the earlier round), else the last round.
    Returns ``group..., stop_round, best_round, best_<metric>``.
    """
    g = list(group_cols)
    cur = running_aggregate(curve, g, [round_col], "argmin", value=metric_col,
                            out="__best", at_col="__best_at")
    # one grouped aggregate, no join back: min_by skips rows whose ordering
    # is null, so it sees only the rounds where patience ran out
    state = F.struct(F.col(round_col).alias("r"), F.col("__best_at").alias("at"),
                     F.col("__best").alias("best"))
    hit = F.col(round_col) - F.col("__best_at") >= patience
    agg = cur.groupBy(*g).agg(
        F.min_by(state, F.when(hit, F.col(round_col))).alias("__stop"),
        F.max_by(state, F.col(round_col)).alias("__last"))
    s = F.coalesce(F.col("__stop"), F.col("__last"))
    return agg.select(*g, s["r"].alias("stop_round"), s["at"].alias("best_round"),
                      s["best"].alias(f"best_{metric_col}"))


def fit_early_stopped(spark: SparkSession, estimator, train: DataFrame, val: DataFrame,
                      patience: int = 30, loss: str = "squared"):
    """M11 + W2: boosting that ends when patience runs out, and keeps the
    rounds up to its best one.

    Squared loss on all rows and features is fitted stage by stage
    (``boosting.boost_until_stopped``), so no round after the stop is fitted.
    Other losses and sampled rows are Spark's own: all rounds are fitted, the
    error on ``val`` after each tells the stop, and the best round's number is
    fitted again with the same seed.

    Returns ``(model, curve, stop)``: ``curve`` has round, dataset, metric and
    value, ``stop`` one row with stop_round, best_round and best_value.
    """
    if loss == "squared" and stageable(estimator):
        model, rounds, stop = boost_until_stopped(estimator, train, val, patience)
        return (model, spark.createDataFrame([(r, "validation", "rmse", e) for r, _, e in rounds],
                                             "round int, dataset string, metric string, value double"),
                spark.createDataFrame([(stop["stop_round"], stop["best_round"], stop["best_rmse"])],
                                      "stop_round int, best_round int, best_value double"))
    train = persist_for_passes(train)
    val = val.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        curve = learning_curve(spark, estimator.fit(train), {"validation": val},
                               {"rmse" if loss == "squared" else "mae": loss})
        stop = early_stop(curve, ["dataset"], "round", "value", patience)
        best = int(stop.first()["best_round"])  # rounds count from 0
        model = estimator.copy({estimator.maxIter: best + 1}).fit(train)
    finally:
        train.unpersist()
        val.unpersist()
    return model, curve, stop.drop("dataset")
