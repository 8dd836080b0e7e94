import itertools
import math

import numpy as np
from pyspark.ml.feature import VectorAssembler

from tabreg.operators import ensemble as N
from tabreg.operators import models as M


def test_simplex_weights_match_brute_force(spark):
    rng = np.random.default_rng(5)
    y = rng.normal(100, 10, 300)
    P = np.stack([y + rng.normal(0, s, 300) + b for s, b in [(3, 1), (5, -2), (8, 0)]], 1)
    df = spark.createDataFrame([(float(a), *map(float, p)) for a, p in zip(y, P)],
                               "label double, a double, b double, c double")
    w, r2 = N.optimise_weights(df, "label", ["a", "b", "c"])
    assert math.isclose(sum(w), 1.0) and all(0 <= x <= 1 for x in w)
    best = min(((np.mean((y - P @ np.array([i, j, 1 - i - j])) ** 2), (i, j))
                for i, j in itertools.product(np.linspace(0, 1, 101), repeat=2) if i + j <= 1))
    sse = np.mean((y - P @ np.array(w)) ** 2)
    assert sse <= best[0] + 1e-9
    assert math.isclose(r2, 1 - sse / np.var(y), rel_tol=1e-9)


def test_out_of_fold_one_prediction_per_row(spark):
    df = spark.range(300).selectExpr("id AS k", "CAST(id AS DOUBLE) AS x", "CAST(2 * id + 1 AS DOUBLE) AS label")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    oof = N.out_of_fold(df, ["k"], "label", {"ols": M.linear_regression()}, k=4)
    assert oof.count() == 300 and oof.select("k").distinct().count() == 300
    assert all(abs(r.ols - r.label) < 1e-6 for r in oof.collect())


def test_stacking_and_blending_run(spark):
    df = spark.range(400).selectExpr("id AS k", "CAST(id % 37 AS DOUBLE) AS x", "CAST(3 * (id % 37) AS DOUBLE) AS label")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    members = {"ols": M.linear_regression(), "tree": M.decision_tree(3)}
    stacked, _ = N.stacking(df, ["k"], "label", members, k=3)
    assert stacked.transform(df).count() == 400
    blended = N.blending(df, ["k"], "label", members)
    coef = N.meta_coefficients(spark, blended).collect()
    assert [r.model for r in coef] == ["ols", "tree", "intercept"]


def test_voting_average(spark):
    df = spark.range(50).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(2 * id AS DOUBLE) AS label")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    v = N.voting({"a": M.linear_regression(), "b": M.linear_regression()}, df)
    out = v.transform(df, keep_members=True).first()
    assert math.isclose(out["prediction"], (out["a"] + out["b"]) / 2)


def test_parallel_fold_fits_equal_sequential(spark):
    df = spark.range(400).selectExpr("id AS k", "CAST(id % 23 AS DOUBLE) AS x",
                                     "CAST(5 * (id % 23) + id % 7 AS DOUBLE) AS label")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    members = {"ols": M.linear_regression(), "tree": M.decision_tree(3)}
    seq = {r.k: (r.ols, r.tree) for r in
           N.out_of_fold(df, ["k"], "label", members, k=4, parallelism=1).collect()}
    par = {r.k: (r.ols, r.tree) for r in
           N.out_of_fold(df, ["k"], "label", members, k=4, parallelism=4).collect()}
    assert seq.keys() == par.keys() and len(seq) == 400
    for key, (a, b) in seq.items():
        assert abs(par[key][0] - a) < 1e-9 and abs(par[key][1] - b) < 1e-9
