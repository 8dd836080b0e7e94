"""Boosting of all rounds in one task: Spark's trees where nothing is drawn, every round and row where it is."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabreg.operators import models as M
from tabreg.operators import rounds as R
from tabreg.operators import tune as H
from tabreg.operators.cells import TrainingRows
from tabreg.plans import q_tune


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    a, b, c = rng.integers(0, 12, 1500), rng.integers(0, 20, 1500) * 0.5, rng.integers(0, 30, 1500) * 0.25
    y = 3.0 * a - b * b + 4 * (c > 0.4) + rng.normal(0, 2, 1500)
    df = spark.createDataFrame([(i, float(p), float(q), float(r), float(z)) for i, (p, q, r, z) in enumerate(zip(a, b, c, y))],
                               "id long, a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


def _packed(df, est):
    packed = R.PackedRows(TrainingRows(df))
    try:
        return packed.fit(est)
    finally:
        packed.release()


def _predicted(model, df):
    return np.array([r[0] for r in M.predict(model, df, "p").orderBy("id").select("p").collect()])


@pytest.mark.parametrize("build", [
    lambda: M.gbt("classic", n_estimators=5), lambda: M.gbt("depthwise", n_estimators=3, max_depth=7),
    lambda: M.gbt("depthwise", n_estimators=3, max_depth=5, min_child_weight=20, gamma=0.5)])
def test_trees_are_sparks(rows, build):
    own, sparks = _packed(rows, build()), build().fit(rows)
    assert isinstance(own, R.RoundsModel) and np.allclose(_predicted(own, rows), _predicted(sparks, rows), atol=1e-9)
    assert [len(t) for t in own.trees] == [t.numNodes for t in sparks.trees]


def test_drawn_rows_and_features_are_fitted_in_all_rounds():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 16, (3000, 3)).astype(np.uint8)
    y = codes[:, 0] * 2.0 - codes[:, 1] + rng.normal(0, 1, 3000)
    plan = R.Rounds(300, 4, 0.1, 0.6, 5, 0.0, 2, 42)
    trees = R.fit_codes(codes, [16, 16, 16], y, plan)
    model = R.RoundsModel("x", [np.arange(15) + 0.5] * 3, trees, 4)
    assert len(trees) == 300 and all(np.array_equal(s, t) for s, t in zip(trees, R.fit_codes(codes, [16, 16, 16], y, plan)))
    assert len({t["feature"][0] for t in trees}) == 3  # a root that may look at two features takes all of them in turn
    error = [np.sqrt(np.mean((y - R.RoundsModel("x", model.middles, trees[:k], 4).predicted(codes.astype(float))) ** 2)) for k in (1, 30, 300)]
    assert error[0] > error[1] > error[2] and error[2] < 1.0


@pytest.mark.parametrize("strategy,width,want", [("all", 4, 4), ("0.6", 4, 3), ("1.0", 4, 4), ("1", 4, 1), ("sqrt", 5, 3), ("log2", 4, 2), ("onethird", 4, 2)])
def test_features_a_node(strategy, width, want):
    assert R.features_a_node(strategy, width) == want


def test_other_fits_are_sparks_own(spark, rows, monkeypatch):
    assert not isinstance(_packed(rows, M.decision_tree(3)), R.RoundsModel)
    with pytest.raises(Exception, match="Null"):
        _packed(rows.withColumn("label", F.when(F.col("id") != 7, F.col("label"))), M.gbt("classic", n_estimators=1))
    monkeypatch.setattr(R, "TASK_BYTES", 1000)
    assert _packed(rows, M.gbt("classic", n_estimators=1)).getNumTrees == 1


def test_a_search_fits_every_round_of_its_trials(spark, rows, monkeypatch):
    seen, plain = [], H.predict
    monkeypatch.setattr(H, "predict", lambda m, *a: seen.append(len(m.trees)) or plain(m, *a))
    space = {"n_estimators": H.IntRange(300, 400), "max_depth": H.IntRange(3, 5), "subsample": H.FloatRange(0.6, 1.0),
             "colsample_bytree": H.FloatRange(0.6, 1.0)}
    train, val = rows.filter("id % 4 > 0"), rows.filter("id % 4 = 0")
    trials = H.random_search(spark, lambda p: M.gbt("depthwise", **p), space, train, val, n_trials=3, parallelism=2).collect()
    assert sorted(seen) == sorted(int(r["params"]["n_estimators"]) for r in trials) and min(seen) >= 300
    assert all(r["state"] == "complete" and r["value"] > 0.85 for r in trials)


def test_the_query_searches_the_references_space(spark, monkeypatch):
    """50 trials of 300 to 1200 rounds and depth 3 to 10."""
    asked = {}
    monkeypatch.setattr(q_tune.H, "random_search", lambda spark, build, space, train, val, **kw: asked.update(kw, space=space))
    monkeypatch.setattr(q_tune, "_li_three_way", lambda spark, sf: spark.createDataFrame([("train",), ("val",)], "split string"))
    q_tune.random_search_trials(spark, "")
    space = asked["space"]
    assert asked["n_trials"] == 50 and asked.get("timeout") is None
    assert (space["n_estimators"], space["max_depth"]) == (H.IntRange(300, 1200), H.IntRange(3, 10))
    assert space["learning_rate"] == H.FloatRange(0.01, 0.3, log=True)
    assert space["subsample"] == space["colsample_bytree"] == H.FloatRange(0.6, 1.0) and space["gamma"] == H.FloatRange(0.0, 5.0)
