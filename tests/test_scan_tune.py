import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabreg.functions.scan import running_aggregate
from tabreg.operators import tune as H


@pytest.fixture(scope="module")
def hot(spark):
    # one group holds most rows, so it spans many range partitions
    rng = np.random.default_rng(11)
    g = np.where(rng.random(4000) < 0.7, 0, rng.integers(1, 30, 4000))
    pdf = pd.DataFrame({"g": g, "o": np.arange(4000), "v": rng.normal(size=4000).round(3)})
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    df = spark.createDataFrame(pdf)
    yield df, pdf
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("op", ["count", "sum", "max", "min"])
def test_running_aggregate_matches_pandas(hot, op):
    df, pdf = hot
    got = running_aggregate(df, ["g"], ["o"], op, value="v", out="r").toPandas() \
        .sort_values("o").reset_index(drop=True)
    s = pdf.sort_values("o").groupby("g")["v"]
    exp = {"count": s.cumcount() + 1, "sum": s.cumsum(), "max": s.cummax(), "min": s.cummin()}[op]
    np.testing.assert_allclose(got["r"].to_numpy(), exp.sort_index().to_numpy(), rtol=1e-9)


def test_running_argmin_first_occurrence(hot):
    df, pdf = hot
    got = running_aggregate(df, ["g"], ["o"], "argmin", value="v", out="best",
                            at_col="at").toPandas().sort_values("o").reset_index(drop=True)
    p = pdf.sort_values("o")
    exp_at = []
    state = {}
    for g, o, v in p[["g", "o", "v"]].itertuples(index=False):
        if g not in state or v < state[g][0]:
            state[g] = (v, o)
        exp_at.append(state[g][1])
    assert got["at"].tolist() == exp_at


def test_early_stop_hand_curve(spark):
    rm = [5.0, 4.0, 4.0, 3.0, 3.5, 3.6, 3.7, 2.0]
    df = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(rm)], "u int, round int, rmse double")
    r = H.early_stop(df, ["u"], patience=3).first()
    assert (r.stop_round, r.best_round, r.best_rmse) == (7, 4, 3.0)
    r = H.early_stop(df, ["u"], patience=10).first()
    assert (r.stop_round, r.best_round, r.best_rmse) == (8, 8, 2.0)


def test_best_trial_ties_and_best_so_far(spark):
    t = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 3.0), (3, 2.0)], "trial int, value double")
    assert H.best_trial(t, "maximize").first().trial == 1
    assert H.best_trial(t, "minimize").first().trial == 0
    got = [r.best_so_far for r in H.best_so_far(t).orderBy("trial").collect()]
    assert got == [1.0, 3.0, 3.0, 3.0]


def test_param_importance_sums_to_one(spark):
    rows = [(i, float(i % 5) * 2 + (i % 3) * 0.1, {"a": float(i % 5), "b": float(i % 3)})
            for i in range(60)]
    t = spark.createDataFrame(rows, "trial int, value double, params map<string,double>")
    imp = {r.param: r.importance for r in H.param_importance(t, bins=5).collect()}
    assert abs(sum(imp.values()) - 1.0) < 1e-9 and imp["a"] > imp["b"]


def test_random_search_records_trials(spark):
    from pyspark.ml.feature import VectorAssembler
    from tabreg.operators import models as M
    df = spark.range(200).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id * 2 AS DOUBLE) AS label")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    trials = H.random_search(spark, lambda p: M.decision_tree(int(p["d"])), {"d": H.IntRange(1, 3)},
                             df, df, n_trials=3, parallelism=2)
    assert trials.count() == 3
    assert H.sample_params({"d": H.IntRange(1, 3)}, 3, 1) == H.sample_params({"d": H.IntRange(1, 3)}, 3, 1)


@pytest.mark.parametrize("op", ["count", "sum", "max", "min", "argmin"])
def test_null_groups_and_leading_nulls(spark, op):
    rows = [(g, i, None if i < 2 or i % 7 == 3 else float((i * 37) % 11)) for g in (None, "a", "b") for i in range(60)]
    df = spark.createDataFrame(rows, "g string, o long, v double").repartition(9)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # several partitions for each group
    try:
        got = running_aggregate(df, ["g"], ["o"], op, value="v", out="r",
                                at_col="at" if op == "argmin" else None).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(got) == len(rows)
    for r in got:
        seen = [(v, o) for g, o, v in rows if g == r["g"] and o <= r["o"] and v is not None]
        want = {"count": r["o"] + 1, "sum": sum(v for v, _ in seen), "max": max(seen, default=(None,))[0],
                "min": min(seen, default=(None,))[0], "argmin": min(seen, default=(None,))[0]}[op]
        assert r["r"] == want
        if op == "argmin":
            assert r["at"] == min(seen, default=(None, None))[1]


def test_early_stopped_fit_keeps_the_best_rounds(spark):
    from pyspark.ml.feature import VectorAssembler
    from tabreg.operators import models as M
    rng = np.random.default_rng(5)
    x = rng.random(300)
    y = np.where(x > 0.5, 1.0, 0.0) + rng.normal(0, 1.0, 300)
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, label double"))
    train, val = df.filter("x * 1000 % 3 >= 1"), df.filter("x * 1000 % 3 < 1")
    model, curve, stop = H.fit_early_stopped(
        spark, M.gbt("binned", iterations=12, depth=4, learning_rate=0.5), train, val, patience=3)
    rows = [r["value"] for r in curve.orderBy("round").collect()]
    best, at = min(rows), rows.index(min(rows))
    s = stop.first()
    if s["stop_round"] == len(rows) - 1:
        assert (s["best_round"], s["best_value"]) == (at, best)
    assert s["best_round"] < 11 and model.getNumTrees == s["best_round"] + 1
    refit = M.learning_curve(spark, model, {"v": val}).orderBy("round").collect()
    assert abs(refit[-1]["value"] - s["best_value"]) < 1e-9
