import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors

from tabreg.operators import models as M
from tabreg.operators.evaluate import metrics


@pytest.fixture(scope="module")
def one_feature(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(50, 10, 400)
    y = 3.0 * x + 20 + rng.normal(0, 5, 400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, label double")
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df), x, y


def _closed(x, y, l2=0.0, l1=0.0):
    n = len(x)
    cxy = np.mean((x - x.mean()) * (y - y.mean()))
    vxx = np.mean((x - x.mean()) ** 2)
    z = np.sign(cxy) * max(abs(cxy) - l1, 0.0)
    a = z / (vxx + l2)
    return a, y.mean() - a * x.mean()


def test_ols_closed_form(one_feature):
    df, x, y = one_feature
    m = M.fit(M.linear_regression(), df)
    a, b = _closed(x, y)
    assert math.isclose(m.coefficients[0], a, rel_tol=1e-9) and math.isclose(m.intercept, b, rel_tol=1e-9)


def test_ridge_penalty_scaling(one_feature):
    df, x, y = one_feature
    alpha = 5e4
    m = M.fit(M.ridge(df, alpha), df)
    a, _ = _closed(x, y, l2=alpha / len(x))
    assert math.isclose(m.coefficients[0], a, rel_tol=1e-8)


def test_lasso_and_elastic_net(one_feature):
    df, x, y = one_feature
    m = M.fit(M.lasso(df, 50.0), df)
    a, _ = _closed(x, y, l1=50.0)
    assert math.isclose(m.coefficients[0], a, rel_tol=1e-6)
    m = M.fit(M.elastic_net(df, 50.0, 0.5), df)
    a, _ = _closed(x, y, l1=25.0, l2=25.0)
    assert math.isclose(m.coefficients[0], a, rel_tol=1e-6)


@pytest.mark.parametrize("build", [
    lambda: M.decision_tree(4), lambda: M.random_forest(5, 4), lambda: M.bagging_trees(5, 4),
    lambda: M.gbt("histogram", n_estimators=5, max_depth=3)])
def test_tree_models_beat_mean(one_feature, build):
    df, _, _ = one_feature
    pred = M.predict(M.fit(build(), df), df, "p")
    assert metrics(pred, "label", ["p"]).first()["r2"] > 0.5


def test_svr_beats_mean(one_feature):
    df, _, _ = one_feature
    m = M.fit_linear_svr(df, ["x"], "label")
    assert m.converged
    assert metrics(M.predict(m, df, "p"), "label", ["p"]).first()["r2"] > 0.5


def test_learning_curve_and_importance(spark, one_feature):
    df, _, _ = one_feature
    m = M.fit(M.gbt("depthwise", n_estimators=6, max_depth=2), df)
    curve = M.learning_curve(spark, m, {"train": df}, {"rmse": "squared", "mae": "absolute"})
    rm = curve.filter("metric = 'rmse'").orderBy("round").collect()
    assert len(rm) == 6 and rm[-1]["value"] < rm[0]["value"]
    assert {r.metric for r in curve.select("metric").distinct().collect()} == {"rmse", "mae"}
    imp = M.feature_importance(spark, m, M.slot_names(df), "gbt").collect()
    assert imp[0]["feature"] == "x" and math.isclose(imp[0]["importance"], 1.0)


def test_gbt_param_translation():
    p = M.gbt_params({"n_estimators": 300, "max_depth": 4, "learning_rate": 0.1,
                      "subsample": 0.8, "reg_alpha": 0})
    assert p == {"maxIter": 300, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8}
    with pytest.raises(ValueError):
        M.gbt_params({"reg_lambda": 1.0})


def test_svr_reaches_the_minimum(spark):
    """With outliers: the objective of any point near the solution is no lower."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (600, 3)) * [1.0, 50.0, 0.01]
    y = x @ [2.0, 0.1, 300.0] + rng.normal(0, 0.3, 600)
    y[::17] += 40
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)],
                               "a double, b double, c double, label double")
    m = M.fit_linear_svr(df, ["a", "b", "c"], "label", epsilon=0.1, C=1.0, tol=1e-4)
    sx, sy = x.std(0), y.std()

    def objective(w, b):
        r = np.abs(y - x @ w - b) / sy
        own = w * sx / sy
        return np.maximum(r - 0.1 / sy, 0).mean() + own @ own / (2 * len(y))
    w, b = np.array(m.coefficients), m.intercept
    least = objective(w, b)
    assert m.converged and math.isclose(least, m.objective, rel_tol=1e-6)
    for _ in range(300):
        size = 10.0 ** rng.uniform(-4, 0)
        assert objective(w + rng.normal(0, size, 3) * sy / sx, b + rng.normal(0, size) * sy) >= least * (1 - 2e-3)
    np.testing.assert_allclose(w, [2.0, 0.1, 300.0], rtol=0.05)


def test_svr_leaves_out_null_rows_and_warns_unconverged(spark):
    rows = [(float(i), 2.0 * i + 1) for i in range(50)]
    schema = "x double, label double"
    whole = M.fit_linear_svr(spark.createDataFrame(rows, schema), ["x"], "label")
    holes = M.fit_linear_svr(spark.createDataFrame(rows + [(None, 5.0), (3.0, None)], schema), ["x"], "label")
    assert math.isclose(whole.coefficients[0], holes.coefficients[0], rel_tol=1e-9)
    with pytest.warns(UserWarning, match="not converged"):
        assert not M.fit_linear_svr(spark.createDataFrame(rows, schema), ["x"], "label", max_iter=2).converged


@pytest.mark.parametrize("build", [
    M.linear_regression, lambda: M.linear_regression().setFitIntercept(False),
    lambda: M.linear_regression().setRegParam(0.3).setStandardization(True),
    lambda: M.linear_regression().setRegParam(5.0).setElasticNetParam(0.5)])
def test_bagged_linear_members_take_moments_of_one_pass(spark, monkeypatch, build):
    rng = np.random.default_rng(3)
    x = rng.normal([1e6, 5.0, 0.05], [40.0, 3.0, 0.02], (3000, 3))
    y = x @ [0.5, -2.0, 300.0] + rng.normal(0, 1, 3000)
    keys = [None if i % 50 == 0 else i // 2 for i in range(3000)]
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(spark.createDataFrame(
        [(k, *map(float, r), float(v)) for k, r, v in zip(keys, x, y)], "k long, a double, b double, c double, label double"))
    fitted = []
    monkeypatch.setattr(M, "fit_many", lambda jobs, *a, real=M.fit_many: real(fitted.extend(jobs) or fitted, *a))
    bag = M.bagging(build(), df, ["k"], n_estimators=5, seed=7)
    assert len(fitted) == 5 and max(d.count() for _, d in fitted) <= 8  # however many rows there are
    for i, m in enumerate(bag.models):
        e = build()
        own = e.copy({e.weightCol: "w"}).fit(df.withColumn("w", M.bootstrap_weight(["k"], 7 + i)).filter("w > 0"))
        center = x.mean(axis=0)
        np.testing.assert_allclose(m.coefficients.toArray(), own.coefficients.toArray(), rtol=1e-4, atol=1e-6)
        assert math.isclose(m.predict(Vectors.dense(center)), own.predict(Vectors.dense(center)), rel_tol=1e-8)
        assert not m.hasSummary
    monkeypatch.setattr(M, "_MEMBERS_A_PASS", 2)
    again = M.bagging(build(), df, ["k"], n_estimators=5, seed=7)
    for a, b in zip(bag.models, again.models):
        np.testing.assert_allclose(a.coefficients.toArray(), b.coefficients.toArray(), rtol=1e-6)


def test_bagging_of_other_rows_and_learners_is_as_before(spark):
    rows = [(i, Vectors.dense([float(i % 7)]), 2.0 * (i % 7) + i % 3) for i in range(200)]
    frame = lambda more=(): spark.createDataFrame([*rows, *more], ["id", "features", "label"])
    for odd in (Vectors.dense([math.nan]), Vectors.dense([math.inf]), Vectors.dense([1.0, 2.0])):
        with pytest.raises(Exception):
            M.bagging(M.linear_regression(), frame([(999, odd, 1.0)]), ["id"], n_estimators=8)
    with pytest.raises(Exception):
        M.bagging(M.linear_regression(), frame([(999, rows[0][1], None)]), ["id"], n_estimators=8)
    flat = spark.createDataFrame([(i, Vectors.dense([4.0]), 3.0) for i in range(50)], ["id", "features", "label"])
    assert M.bagging(M.linear_regression(), flat, ["id"], n_estimators=2).transform(flat).filter("abs(prediction - 3) > 1e-9").count() == 0
    trees = M.bagging(M.decision_tree(2), frame(), ["id"], n_estimators=2)
    assert trees.transform(frame()).filter("abs(prediction - label) < 2").count() == 200


def test_bagging_is_independent_of_the_layout(spark):
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(500).selectExpr("id", "CAST(id % 37 AS DOUBLE) AS x", "CAST(3 * (id % 37) + id % 5 AS DOUBLE) AS label"))
    sums = [M.bagging(M.linear_regression(), df.repartition(n), ["id"], n_estimators=3).transform(df)
            .groupBy().sum("prediction").first()[0] for n in (3, 11)]
    assert math.isclose(sums[0], sums[1], rel_tol=1e-9)
    w = df.select(M.bootstrap_weight(["id"], 1).alias("w")).agg({"w": "avg"}).first()[0]
    assert 0.85 < w < 1.15
    with pytest.raises(ValueError):
        M.bagging(object(), df, ["id"])
