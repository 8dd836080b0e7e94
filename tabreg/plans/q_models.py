"""Registered queries: regression models (M1-M16), stacking/blending
and the training-log sink/source (IO5)."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabreg.functions.scan import running_aggregate
from tabreg.operators import ensemble as N
from tabreg.operators import models as M
from tabreg.operators.cells import training
from tabreg.operators.prep import train_test_split
from tabreg.plans.data import lineitem_net, orders_customers
from tabreg.plans.sql import LINEITEM_NET, ORDERS_CUSTOMERS, bucket
from tabreg.session import shared_scratch
from tabreg.sources.tables import read_table
from tabreg.sources.text import read_training_log, write_training_log

QUERIES = {}
ORACLES = {}
KEY = ["l_orderkey", "l_linenumber"]
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ linear family, one feature

# Penalties chosen so the shrinkage is visible at the data's scale.
RIDGE_ALPHA = 1e12
LASSO_ALPHA = 1e6
ENET_ALPHA, ENET_RHO = 1e6, 0.5


def _one_feature(spark, sf):
    li = lineitem_net(spark, sf)
    return VectorAssembler(inputCols=["l_extendedprice"], outputCol="x").transform(li)


def _coef_frame(spark, name, model):
    return spark.createDataFrame(
        [(name, float(model.coefficients[0]), float(model.intercept))],
        "model string, coefficient double, intercept double").select(
        "model", F.round("coefficient", 6).alias("coefficient"),
        F.round("intercept", 3).alias("intercept"))


def _linear_q(name, build):
    def run(spark, sf):
        df = _one_feature(spark, sf)
        return _coef_frame(spark, name, M.fit_built(build, df))
    QUERIES[name] = run


@q("ols_one_feature")
def ols_one_feature(spark, sf):
    """The normal equations are one pass: nothing is cached."""
    model = M.linear_regression("x", "net").fit(_one_feature(spark, sf))
    return _coef_frame(spark, "ols_one_feature", model)


_linear_q("ridge_one_feature", lambda df: M.ridge(df, RIDGE_ALPHA, "x", "net"))
_linear_q("lasso_one_feature", lambda df: M.lasso(df, LASSO_ALPHA, "x", "net"))
_linear_q("elastic_net_one_feature",
          lambda df: M.elastic_net(df, ENET_ALPHA, ENET_RHO, "x", "net"))

_MOM = f"""WITH {LINEITEM_NET}, m AS (
  SELECT avg(l_extendedprice) AS mx, avg(net) AS my, var_pop(l_extendedprice) AS vxx,
         covar_pop(l_extendedprice, net) AS cxy, count(*) AS n FROM li)"""


def _closed_form(name, slope):
    return f"""{_MOM}, w AS (SELECT *, {slope} AS a FROM m)
SELECT '{name}' AS model, round(a, 6) AS coefficient, round(my - a * mx, 3) AS intercept FROM w"""


def _soft(z, t):
    return f"sign({z}) * greatest(abs({z}) - {t}, 0)"


ORACLES["ols_one_feature"] = _closed_form("ols_one_feature", "cxy / vxx")
ORACLES["ridge_one_feature"] = _closed_form(
    "ridge_one_feature", f"(cxy * n) / (vxx * n + {RIDGE_ALPHA})")
ORACLES["lasso_one_feature"] = _closed_form(
    "lasso_one_feature", f"{_soft('cxy', LASSO_ALPHA)} / vxx")
ORACLES["elastic_net_one_feature"] = _closed_form(
    "elastic_net_one_feature",
    f"{_soft('cxy', ENET_ALPHA * ENET_RHO)} / (vxx + {ENET_ALPHA * (1 - ENET_RHO)})")

# ------------------------------------------------------------------ linear family, two features of unlike scale

TWO = ["l_extendedprice", "l_discount"]
TWO_ALPHA = 100.0  # of the order of the discount's sum of squares: only that coefficient shrinks


def _two_features(name, build):
    def run(spark, sf):
        df = VectorAssembler(inputCols=TWO, outputCol="x").transform(lineitem_net(spark, sf))
        m = build(df).fit(df)
        return spark.createDataFrame(
            [(float(m.coefficients[0]), float(m.coefficients[1]), float(m.intercept))],
            "a1 double, a2 double, b double").select(
            F.round("a1", 6).alias("a1"), F.round("a2", 2).alias("a2"), F.round("b", 2).alias("b"))
    QUERIES[name] = run


_two_features("ols_two_features", lambda df: M.linear_regression("x", "net"))
_two_features("ridge_two_features", lambda df: M.ridge(df, TWO_ALPHA, "x", "net"))


def _two_oracle(alpha):
    return f"""
WITH {LINEITEM_NET}, m AS (
  SELECT avg({TWO[0]}) AS m1, avg({TWO[1]}) AS m2, avg(net) AS my,
         var_pop({TWO[0]}) + {alpha} / count(*) AS v1, var_pop({TWO[1]}) + {alpha} / count(*) AS v2,
         covar_pop({TWO[0]}, {TWO[1]}) AS c12, covar_pop({TWO[0]}, net) AS c1,
         covar_pop({TWO[1]}, net) AS c2 FROM li),
w AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS a1,
             (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS a2 FROM m)
SELECT round(a1, 6) AS a1, round(a2, 2) AS a2, round(my - a1 * m1 - a2 * m2, 2) AS b FROM w"""


ORACLES["ols_two_features"] = _two_oracle(0.0)
ORACLES["ridge_two_features"] = _two_oracle(TWO_ALPHA)

# ------------------------------------------------------------------ trees, boosting, SVR (rows-only)


def _li_split(spark, sf):
    li = VectorAssembler(inputCols=LI_FEATURES, outputCol="features").transform(
        lineitem_net(spark, sf)).withColumnRenamed("net", "label")
    return train_test_split(li, KEY, 0.2)


def _fit_predict(name, build):
    def run(spark, sf):
        train, test = _li_split(spark, sf)
        model = M.fit(build(), train)
        return M.predict(model, test, "prediction").select(*KEY, "label", "prediction")
    QUERIES[name] = run


_fit_predict("decision_tree", lambda: M.decision_tree(max_depth=5))
_fit_predict("random_forest", lambda: M.random_forest(num_trees=100, max_depth=5))
_fit_predict("bagging", lambda: M.bagging_trees(n_estimators=50, max_depth=5))
_fit_predict("gbt_classic", lambda: M.gbt("classic"))  # 100 rounds
_fit_predict("gbt_depthwise", lambda: M.gbt("depthwise", n_estimators=10, max_depth=4))
_fit_predict("gbt_histogram", lambda: M.gbt("histogram", n_estimators=10, max_depth=4))
_fit_predict("gbt_binned", lambda: M.gbt("binned", iterations=10, depth=4, border_count=64))


@q("bagging_generic")
def bagging_generic(spark, sf):
    """M7 with a non-tree base learner: OLS members on bootstrap samples."""
    train, test = _li_split(spark, sf)
    bag = M.bagging(M.linear_regression(), train, KEY, n_estimators=50)
    return M.predict(bag, test, "prediction").select(*KEY, "label", "prediction")


@q("svr_linear")
def svr_linear(spark, sf):
    train, test = _li_split(spark, sf)
    model = M.fit_linear_svr(train, LI_FEATURES, "label", epsilon=0.1, C=1.0)
    return M.predict(model, test, "prediction").select(*KEY, "label", "prediction")


@q("svr_rbf")
def svr_rbf(spark, sf):
    """M12 with the Gaussian kernel on random Fourier features."""
    train, test = _li_split(spark, sf)
    model = M.fit_kernel_svr(train, LI_FEATURES, "label", epsilon=0.1, C=1.0)
    return M.predict(model, test, "prediction").select(*KEY, "label", "prediction")


@q("feature_importance")
def feature_importance(spark, sf):
    train, _ = _li_split(spark, sf)
    names = M.slot_names(train)
    builds = {"random_forest": M.random_forest(100, 5),
              "gbt_depthwise": M.gbt("depthwise", n_estimators=10, max_depth=4),
              "linear_regression": M.linear_regression()}
    with training(train) as rows:
        fitted = M.fit_many([(b, rows) for b in builds.values()], fit_one=lambda e, r: r.fit(e))  # concurrent fits
    frames = [M.feature_importance(spark, m, names, n) for n, m in zip(builds, fitted)]
    return reduce(lambda a, b: a.unionByName(b), frames)


@q("learning_curve")
def learning_curve(spark, sf):
    train, test = _li_split(spark, sf)
    model = M.fit(M.gbt("histogram", n_estimators=10, max_depth=4), train)
    return M.learning_curve(spark, model, {"train": train, "test": test},
                            {"rmse": "squared", "mae": "absolute"})


@q("curve_metric_names")
def curve_metric_names(spark, sf):
    """E17 on the curves of events: an event's type is the metric it records."""
    from tabreg.operators.evaluate import curve_metric_names as names
    ev = read_table(spark, sf, "events", ["event_type"])
    return names(ev.withColumnRenamed("event_type", "metric"))


ORACLES["curve_metric_names"] = "SELECT DISTINCT event_type AS metric FROM events"

# ------------------------------------------------------------------ training log TSV (IO5)


def events_curve(spark, sf):
    """Per-user curve: round = rank of the event in time, rmse = value."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "value"])
    ranked = running_aggregate(ev, ["user_id"], ["ts", "event_id"], "count", out="round")
    return ranked.select("user_id", "event_id", F.col("round").cast("int").alias("round"),
                         F.col("value").alias("rmse"))


EVENTS_CURVE = """cv AS (SELECT user_id, event_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS round,
  value AS rmse FROM events)"""


@q("training_log_roundtrip")
def training_log_roundtrip(spark, sf):
    path = shared_scratch(spark, "training-log")
    write_training_log(events_curve(spark, sf), path)
    return read_training_log(spark, path)


ORACLES["training_log_roundtrip"] = f"WITH {EVENTS_CURVE} SELECT round AS iter, rmse AS RMSE FROM cv"

# ------------------------------------------------------------------ stacking, blending


def _oc_vector(spark, sf):
    oc = orders_customers(spark, sf)
    return VectorAssembler(inputCols=["c_acctbal"], outputCol="x_acct").transform(oc)


@q("stacking_oof")
def stacking_oof(spark, sf):
    oc = _oc_vector(spark, sf)
    oof = N.out_of_fold(oc, ["o_orderkey"], "o_totalprice",
                        {"ols": M.linear_regression("x_acct", "o_totalprice")}, k=5)
    return oof.select("o_orderkey", "fold", F.round("ols", 4).alias("oof"))


ORACLES["stacking_oof"] = f"""
WITH {ORDERS_CUSTOMERS},
f AS (SELECT *, {bucket('o_orderkey', 5, 'fold')} AS fold FROM oc),
k AS (SELECT DISTINCT fold FROM f),
coef AS (SELECT k.fold, regr_slope(t.o_totalprice, t.c_acctbal) AS a,
                regr_intercept(t.o_totalprice, t.c_acctbal) AS b
         FROM k JOIN f t ON t.fold <> k.fold GROUP BY k.fold)
SELECT o_orderkey, fold, round(a * c_acctbal + b, 4) AS oof FROM f JOIN coef USING (fold)"""


def _blend_members():
    return {"ols_price": M.linear_regression("x_price", "label"),
            "ols_qty": M.linear_regression("x_qty", "label"),
            "tree": M.decision_tree(4, features="x_both", label="label")}


def _li_blend(spark, sf):
    li = lineitem_net(spark, sf).withColumnRenamed("net", "label")
    for cols, out in ((["l_extendedprice"], "x_price"), (["l_quantity"], "x_qty"),
                      (["l_extendedprice", "l_quantity"], "x_both")):
        li = VectorAssembler(inputCols=cols, outputCol=out).transform(li)
    return li


@q("blending")
def blending(spark, sf):
    train, test = train_test_split(_li_blend(spark, sf), KEY, 0.2)
    stacked = N.blending(train, KEY, "label", _blend_members())
    return stacked.transform(test).select(*KEY, "label", "prediction")


@q("meta_weights")
def meta_weights(spark, sf):
    train, _ = train_test_split(_li_blend(spark, sf), KEY, 0.2)
    stacked = N.blending(train, KEY, "label", _blend_members())
    return N.meta_coefficients(spark, stacked)


@q("stacking")
def stacking(spark, sf):
    train, test = train_test_split(_li_blend(spark, sf), KEY, 0.2)
    stacked, _ = N.stacking(train, KEY, "label", _blend_members(), k=10)
    return stacked.transform(test).select(*KEY, "label", "prediction")


# ------------------------------------------------------------------ k nearest neighbours


@q("knn_exact")
def knn_exact(spark, sf):
    """kNN regression (k = 5) of held-out embeddings on the rest; exact."""
    from tabreg.operators.knn import knn_regress
    e = read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    train, test = train_test_split(e, "vec_id", 0.2)
    out = knn_regress(train, test, "vec_id", "embedding", "label", k=5)
    return out.select("vec_id", F.round("prediction", 9).alias("prediction"),
                      F.round("kth_dist2", 6).alias("kth_dist2"))


ORACLES["knn_exact"] = f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
                  {bucket('vec_id')} < 20 AS is_test FROM embeddings),
tr AS (SELECT * FROM e WHERE NOT is_test), te AS (SELECT * FROM e WHERE is_test),
p AS (SELECT te.vec_id AS q, tr.vec_id AS tid, tr.label,
             round(power(list_distance(te.v, tr.v), 2), 9) AS d2 FROM te CROSS JOIN tr),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, tid) AS rn FROM p)
SELECT q AS vec_id, round(avg(label), 9) AS prediction, round(max(d2), 6) AS kth_dist2
FROM r WHERE rn <= 5 GROUP BY q"""


# ------------------------------------------------------------------ leaderboard of fitted models


def _probing(spark, sf):
    """All embeddings against those whose id is divisible by 20."""
    e = read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    return e.filter("vec_id % 20 <> 0"), e.filter("vec_id % 20 = 0")


@q("knn_approximate")
def knn_approximate(spark, sf):
    """M13 by multi-probe random-projection buckets, exact re-ranking."""
    from tabreg.operators.knn_approx import knn_regress_approximate
    train, asked = _probing(spark, sf)
    return knn_regress_approximate(train, asked, "vec_id", "embedding", "label", k=5)


@q("knn_recall")
def knn_recall(spark, sf):
    """Each query's share of its exact neighbours that the probed buckets hold."""
    from tabreg.operators import knn, knn_approx
    train, asked = _probing(spark, sf)
    args = (train, asked, "vec_id", "embedding", "label", 5)
    found = knn_approx.approximate_neighbours(*args)
    return knn_approx.recall(found, knn.exact_neighbours(*args)).withColumnRenamed("q_id", "vec_id")


@q("model_leaderboard")
def model_leaderboard(spark, sf):
    """Test metrics ranked by RMSE, fit seconds, train-test RMSE gap."""
    import time
    from tabreg.operators.evaluate import leaderboard, metrics
    train, test = _li_split(spark, sf)
    builds = {"linear_regression": M.linear_regression(),
              "decision_tree": M.decision_tree(5),
              "random_forest": M.random_forest(100, 5)}
    fitted, seconds = {}, []
    with training(train) as rows:
        for name, est in builds.items():
            t0 = time.perf_counter()
            fitted[name] = rows.fit(est)
            seconds.append((name, time.perf_counter() - t0))

    def scored(df):
        for name, m in fitted.items():
            df = M.predict(m, df, name)
        return metrics(df, "label", list(fitted))
    fit_s = spark.createDataFrame(seconds, "model string, fit_seconds double")
    return leaderboard(scored(test), fit_s, scored(train))
