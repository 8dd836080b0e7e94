"""Boosting that stops while it is fitted; a search that ends at its deadline."""

import time

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabreg.operators import boosting as B
from tabreg.operators import models as M
from tabreg.operators import tune as H


def _noisy(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 2))
    y = np.sin(6 * x[:, 0]) + x[:, 1] + rng.normal(0, 0.7, n)
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(
        [(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id long, a double, b double, label double"))
    return df.filter("id % 3 > 0"), df.filter("id % 3 = 0")


@pytest.mark.parametrize("patience,checkpoint_every", [(3, 2), (6, 100)])
def test_stops_where_the_full_curve_says_so(spark, patience, checkpoint_every):
    train, val = _noisy(spark)
    est = M.gbt("binned", iterations=25, depth=4, learning_rate=0.3, border_count=64)
    full = M.learning_curve(spark, M.fit(est, train), {"v": val}).orderBy("round").collect()
    want = H.early_stop(spark.createDataFrame([(r["round"], r["value"]) for r in full], "round int, rmse double"),
                        [], patience=patience).first()
    model, curve, stop = B.boost_until_stopped(est, train, val, patience, checkpoint_every)
    assert (stop["stop_round"], stop["best_round"]) == (want["stop_round"], want["best_round"])
    assert stop["stop_round"] < 24 and len(curve) == stop["stop_round"] + 1  # fewer trees than the full curve
    assert np.allclose([e for _, _, e in curve], [r["value"] for r in full[:len(curve)]])
    # the model is Spark's own kind, with the best round's trees
    assert model.getNumTrees == stop["best_round"] + 1
    short = M.fit(est.copy({est.maxIter: stop["best_round"] + 1}), train)
    both = short.transform(val).withColumnRenamed("prediction", "p").select("id", "p").join(
        M.predict(model, val, "q").select("id", "q"), "id")
    assert both.count() == val.count() and both.filter("abs(p - q) > 1e-9").count() == 0
    assert len(M.feature_importance(spark, model, ["a", "b"], "m").collect()) == 2


def test_all_rounds_without_a_stop_and_without_validation_rows(spark):
    train, val = _noisy(spark, 200)
    est = M.gbt("binned", iterations=4, depth=2)
    model, curve, stop = B.boost_until_stopped(est, train, val, patience=30)
    assert len(curve) == 4 and stop["stop_round"] == 3
    model, curve, stop = B.boost_until_stopped(est, train, val.filter("id < 0"), patience=30)
    assert model.getNumTrees == 4 and np.isnan(stop["best_rmse"])
    with pytest.raises(ValueError, match="squared"):
        B.boost_until_stopped(M.gbt("binned", subsample=0.5), train, val)


class _Slow:
    """An estimator whose fit runs one Spark job of ``seconds`` on each of two tasks."""

    def __init__(self, spark, seconds):
        self.spark, self.seconds = spark, seconds

    def fit(self, df):
        seconds = self.seconds

        def wait(batches):
            for b in batches:
                time.sleep(seconds)
                yield b

        self.spark.range(2, numPartitions=2).mapInPandas(wait, "id long").count()
        return self

    def transform(self, df):
        return df.withColumn(self.pred, F.col("label"))


def test_a_slow_trial_is_cut_at_the_deadline(spark):
    train, val = _noisy(spark, 60)
    slow = {"wait": H.IntRange(0, 1)}
    params = [p["wait"] for p in H.sample_params(slow, 4, 42)]
    assert 0.0 in params and 1.0 in params
    t0 = time.time()
    trials = H.random_search(spark, lambda p: _Slow(spark, 60 * p["wait"]), slow, train, val, n_trials=4, timeout=8, parallelism=4)
    assert time.time() - t0 < 40
    got = {r["trial"]: r for r in trials.collect()}
    assert {i: r["state"] for i, r in got.items()} == {i: "pruned" if p else "complete" for i, p in enumerate(params)}
    assert all((r["value"] is None) == (r["state"] == "pruned") for r in got.values())
    best = H.best_trial(trials, "minimize").first()
    assert best["state"] == "complete" and best["value"] == 1.0
    # the session goes on, and nothing of the trials is left
    time.sleep(0.5)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()
    assert spark.range(10).count() == 10 and not spark.sparkContext.getJobTags()


def test_a_failing_trial_is_an_error(spark):
    train, val = _noisy(spark, 30)

    def broken(_):
        raise KeyError("no such parameter")
    with pytest.raises(KeyError):
        H.random_search(spark, broken, {"a": H.IntRange(0, 1)}, train, val, n_trials=2, timeout=600)
