"""Registered queries: evaluation tables (E*), ensembles on checkable members
(N1-N3, N7) and the scalar helpers X5-X12, on the lineitem predictor columns."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabreg.functions.rowwise import feature_name, linear_combination, mean_of
from tabreg.operators import ensemble as N
from tabreg.operators import evaluate as E
from tabreg.operators.models import linear_regression
from tabreg.operators.prep import train_test_split
from tabreg.operators.profile import corr_long
from tabreg.plans.data import lineitem_net, predictor_columns
from tabreg.plans.q_profile import BOX_COLS, box_sql, hist_sql, rounded_box, rounded_hist
from tabreg.plans.sql import LINEITEM_NET, PREDICTORS, is_test

QUERIES = {}
ORACLES = {}
KEY = ["l_orderkey", "l_linenumber"]
PREDS = ["p_a", "p_b", "p_c"]
ROUND = {"mse": 3, "rmse": 6, "mae": 6, "r2": 9}


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _rounded_metrics(m):
    return m.select("model", "n", *[F.round(c, d).alias(c) for c, d in ROUND.items()])


def _metric_sql(model: str, pred: str, src: str = "pc") -> str:
    return (f"SELECT '{model}' AS model, count(*) AS n, "
            f"round(avg(power(label - {pred}, 2)), 3) AS mse, "
            f"round(sqrt(avg(power(label - {pred}, 2))), 6) AS rmse, "
            f"round(avg(abs(label - {pred})), 6) AS mae, "
            f"round(1 - sum(power(label - {pred}, 2)) / (var_pop(label) * count(*)), 9) AS r2 "
            f"FROM {src}")


def _metrics_sql(preds=PREDS, src="pc"):
    return " UNION ALL ".join(_metric_sql(p, p, src) for p in preds)


@q("metrics_long")
def metrics_long(spark, sf):
    m = _rounded_metrics(E.metrics(predictor_columns(spark, sf), "label", PREDS))
    return m.unpivot(["model"], list(ROUND), "metric", "value")


ORACLES["metrics_long"] = f"""
WITH {PREDICTORS}, m AS ({_metrics_sql()})
SELECT model, 'mse' AS metric, mse AS value FROM m UNION ALL SELECT model, 'rmse', rmse FROM m
UNION ALL SELECT model, 'mae', mae FROM m UNION ALL SELECT model, 'r2', r2 FROM m"""


@q("model_comparison")
def model_comparison(spark, sf):
    m = E.model_comparison(predictor_columns(spark, sf), "label", PREDS)
    return m.select("model", F.round("mse", 3).alias("mse"), F.round("r2", 9).alias("r2"))


ORACLES["model_comparison"] = f"""
WITH {PREDICTORS}, m AS ({_metrics_sql()}) SELECT model, mse, r2 FROM m"""


@q("leaderboard")
def leaderboard(spark, sf):
    m = _rounded_metrics(E.metrics(predictor_columns(spark, sf), "label", PREDS))
    return E.leaderboard(m)


ORACLES["leaderboard"] = f"""
WITH {PREDICTORS}, m AS ({_metrics_sql()})
SELECT *, CAST(rank() OVER (ORDER BY rmse, model) AS INTEGER) AS rank FROM m"""


@q("rmse_sqrt")
def rmse_sqrt(spark, sf):
    m = E.metrics(predictor_columns(spark, sf), "label", PREDS)
    return m.select("model", F.round(F.sqrt("mse"), 6).alias("rmse"))


ORACLES["rmse_sqrt"] = f"WITH {PREDICTORS}, m AS ({_metrics_sql()}) SELECT model, rmse FROM m"


@q("rounded_metrics")
def rounded_metrics(spark, sf):
    m = E.metrics(predictor_columns(spark, sf), "label", PREDS)
    return m.select("model", F.round("mse", 2).alias("mse"), F.round("r2", 4).alias("r2"))


ORACLES["rounded_metrics"] = f"""
WITH {PREDICTORS}, m AS (SELECT model, avg(power(label - p, 2)) AS mse,
  1 - sum(power(label - p, 2)) / (var_pop(label) * count(*)) AS r2 FROM (
  SELECT 'p_a' AS model, label, p_a AS p FROM pc UNION ALL SELECT 'p_b', label, p_b FROM pc
  UNION ALL SELECT 'p_c', label, p_c FROM pc) GROUP BY model)
SELECT model, round(mse, 2) AS mse, round(r2, 4) AS r2 FROM m"""

# ------------------------------------------------------------------ ensembles on checkable members


@q("ensemble_average")
def ensemble_average(spark, sf):
    df = N.simple_average(predictor_columns(spark, sf), PREDS, "avg_pred")
    return df.select(*KEY, F.round("avg_pred", 6).alias("avg_pred"))


ORACLES["ensemble_average"] = f"""
WITH {PREDICTORS} SELECT l_orderkey, l_linenumber, round((p_a + p_b + p_c) / 3.0, 6) AS avg_pred
FROM pc"""


@q("mean_of_predictions")
def mean_of_predictions(spark, sf):
    df = predictor_columns(spark, sf)
    return df.select(*KEY, F.round(mean_of(["p_b", "p_c"]), 6).alias("mean_pred"))


ORACLES["mean_of_predictions"] = f"""
WITH {PREDICTORS} SELECT l_orderkey, l_linenumber, round((p_b + p_c) / 2.0, 6) AS mean_pred FROM pc"""


@q("linear_combination")
def linear_combination_q(spark, sf):
    df = predictor_columns(spark, sf)
    return df.select(*KEY, F.round(linear_combination(PREDS, [0.2, 0.3, 0.5]), 6).alias("combo"))


ORACLES["linear_combination"] = f"""
WITH {PREDICTORS} SELECT l_orderkey, l_linenumber, round(0.2 * p_a + 0.3 * p_b + 0.5 * p_c, 6)
AS combo FROM pc"""

W2_SQL = """w AS (SELECT greatest(0.0, least(1.0,
    sum((label - p_c) * (p_b - p_c)) / sum(power(p_b - p_c, 2)))) AS wb FROM pc)"""


@q("ensemble_weights_two")
def ensemble_weights_two(spark, sf):
    w, _ = N.optimise_weights(predictor_columns(spark, sf), "label", ["p_b", "p_c"])
    return N.weights_frame(spark, ["p_b", "p_c"], w).select(
        "model", F.round("weight", 9).alias("weight"))


ORACLES["ensemble_weights_two"] = f"""
WITH {PREDICTORS}, {W2_SQL}
SELECT 'p_b' AS model, round(wb, 9) AS weight FROM w UNION ALL SELECT 'p_c', round(1 - wb, 9) FROM w"""


@q("simple_vs_weighted")
def simple_vs_weighted(spark, sf):
    df = predictor_columns(spark, sf)
    w, _ = N.optimise_weights(df, "label", ["p_b", "p_c"])
    df = df.withColumns({"simple": mean_of(["p_b", "p_c"]),
                         "weighted": linear_combination(["p_b", "p_c"], w)})
    m = E.model_comparison(df, "label", ["simple", "weighted"])
    return m.select("model", F.round("mse", 3).alias("mse"), F.round("r2", 9).alias("r2"))


ORACLES["simple_vs_weighted"] = f"""
WITH {PREDICTORS}, {W2_SQL},
s AS (SELECT label, (p_b + p_c) / 2.0 AS simple, wb * p_b + (1 - wb) * p_c AS weighted FROM pc, w)
SELECT 'simple' AS model, round(avg(power(label - simple, 2)), 3) AS mse,
       round(1 - sum(power(label - simple, 2)) / (var_pop(label) * count(*)), 9) AS r2 FROM s
UNION ALL
SELECT 'weighted', round(avg(power(label - weighted, 2)), 3),
       round(1 - sum(power(label - weighted, 2)) / (var_pop(label) * count(*)), 9) FROM s"""


@q("ensemble_voting")
def ensemble_voting(spark, sf):
    li = lineitem_net(spark, sf)
    li = VectorAssembler(inputCols=["l_extendedprice"], outputCol="x_price").transform(li)
    li = VectorAssembler(inputCols=["l_quantity"], outputCol="x_qty").transform(li)
    train, test = train_test_split(li, KEY, 0.2)
    members = {"ols_price": linear_regression("x_price", "net"),
               "ols_qty": linear_regression("x_qty", "net")}
    vote = N.voting(members, train)
    return vote.transform(test).select(*KEY, F.round("prediction", 4).alias("prediction"))


ORACLES["ensemble_voting"] = f"""
WITH {LINEITEM_NET},
s AS (SELECT *, {is_test("l_orderkey || '|' || l_linenumber")} AS is_test FROM li),
tr AS (SELECT * FROM s WHERE NOT is_test), te AS (SELECT * FROM s WHERE is_test),
c AS (SELECT regr_slope(net, l_extendedprice) AS a1, regr_intercept(net, l_extendedprice) AS b1,
             regr_slope(net, l_quantity) AS a2, regr_intercept(net, l_quantity) AS b2 FROM tr)
SELECT l_orderkey, l_linenumber,
       round(((a1 * l_extendedprice + b1) + (a2 * l_quantity + b2)) / 2.0, 4) AS prediction
FROM te, c"""

# ------------------------------------------------------------------ diagnostics


@q("actual_vs_predicted")
def actual_vs_predicted(spark, sf):
    return E.actual_vs_predicted(predictor_columns(spark, sf), KEY, "label", "p_b").select(
        *KEY, F.round("actual", 6).alias("actual"), F.round("predicted", 6).alias("predicted"))


ORACLES["actual_vs_predicted"] = f"""
WITH {PREDICTORS} SELECT l_orderkey, l_linenumber, round(label, 6) AS actual,
round(p_b, 6) AS predicted FROM pc"""


@q("residuals")
def residuals(spark, sf):
    df = E.residuals(predictor_columns(spark, sf), "label", "p_b")
    return df.select(*KEY, F.round("p_b", 6).alias("fitted"),
                     F.round("residual", 6).alias("residual"))


ORACLES["residuals"] = f"""
WITH {PREDICTORS} SELECT l_orderkey, l_linenumber, round(p_b, 6) AS fitted,
round(label - p_b, 6) AS residual FROM pc"""


@q("residual_histogram")
def residual_histogram(spark, sf):
    return rounded_hist(E.residual_histogram(predictor_columns(spark, sf), "label", "p_b"))


ORACLES["residual_histogram"] = hist_sql("SELECT label - p_b AS x FROM pc", 30, PREDICTORS)


@q("abs_error_box")
def abs_error_box(spark, sf):
    b = E.abs_error_box(predictor_columns(spark, sf), KEY, "label", {p: p for p in PREDS})
    return rounded_box(b, ["model"])


ORACLES["abs_error_box"] = box_sql(
    " UNION ALL ".join(f"SELECT '{p}' AS model, abs(label - {p}) AS x FROM pc" for p in PREDS),
    "model", PREDICTORS)


@q("improvement_over_best")
def improvement_over_best(spark, sf):
    df = E.improvement_over_best(predictor_columns(spark, sf), "label", ["p_a", "p_c"], "p_b")
    from tabreg.operators.profile import histogram
    return rounded_hist(histogram(df, "improvement", 30))


ORACLES["improvement_over_best"] = hist_sql(
    "SELECT least(abs(label - p_a), abs(label - p_c)) - abs(label - p_b) AS x FROM pc",
    30, PREDICTORS)


@q("prediction_corr")
def prediction_corr(spark, sf):
    c = corr_long(predictor_columns(spark, sf), PREDS)
    return c.select("Feature1", "Feature2", F.round("Correlation", 9).alias("Correlation"))


def _corr(a, b):
    if a == b:
        return f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END"
    return (f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 "
            f"THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END")


ORACLES["prediction_corr"] = f"WITH {PREDICTORS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS Feature1, '{b}' AS Feature2, round({_corr(a, b)}, 9) AS Correlation FROM pc"
    for a in PREDS for b in PREDS)


@q("prediction_pairs")
def prediction_pairs(spark, sf):
    df = E.prediction_pairs(predictor_columns(spark, sf), KEY, "p_a", "p_b")
    return df.select(*KEY, F.round("p_a", 6).alias("p_a"), F.round("p_b", 6).alias("p_b"))


ORACLES["prediction_pairs"] = f"""
WITH {PREDICTORS} SELECT l_orderkey, l_linenumber, round(p_a, 6) AS p_a, round(p_b, 6) AS p_b
FROM pc"""


@q("constant_feature_names")
def constant_feature_names(spark, sf):
    df = predictor_columns(spark, sf)
    return df.select(*KEY, feature_name(F.col("l_linenumber") - 1).alias("feature"))


ORACLES["constant_feature_names"] = f"""
WITH {PREDICTORS} SELECT l_orderkey, l_linenumber,
'Feature ' || CAST(l_linenumber - 1 AS VARCHAR) AS feature FROM pc"""

# ------------------------------------------------------------------ trade-off (E15), mergeable profiles


@q("model_trade_off")
def model_trade_off(spark, sf):
    """Of all orders' estimates by ``p_b``, those that no other beats in
    both cost (lines read) and error (mean absolute, in whole cents)."""
    per = predictor_columns(spark, sf).groupBy("l_orderkey").agg(
        F.sum("l_linenumber").alias("cost"), F.round(F.avg(F.abs(F.col("label") - F.col("p_b"))), 2).alias("error"))
    return E.trade_off(per, "cost", "error")


ORACLES["model_trade_off"] = f"""
WITH {PREDICTORS},
g AS (SELECT l_orderkey, sum(l_linenumber)::BIGINT AS cost, round(avg(abs(label - p_b)), 2) AS error FROM pc GROUP BY l_orderkey)
SELECT * FROM g WHERE NOT EXISTS (
  SELECT 1 FROM g o WHERE o.cost <= g.cost AND o.error <= g.error AND (o.cost < g.cost OR o.error < g.error))"""

SKETCHED = ["l_orderkey", "l_linenumber", "label"]


@q("profile_sketch")
def profile_sketch(spark, sf):
    """Two parts' states merged; the estimates beside the stated error bounds."""
    from tabreg.operators import sketch as S
    df = predictor_columns(spark, sf).select(*SKETCHED)
    part = [S.profile_state(df.filter(F.col("l_orderkey") % 2 == d), SKETCHED) for d in range(2)]
    rows = S.profile_of(S.merged(*part), [0.5]).collect()  # one row a column
    exact = df.agg(*[x for r in rows for x in (
        F.count_distinct(r["column"]).alias(f"n_{r['column']}"),
        # the ranks that the estimate's copies take
        F.avg((F.col(r["column"]) < r["quantiles"][0]).cast("double")).alias(f"lo_{r['column']}"),
        F.avg((F.col(r["column"]) <= r["quantiles"][0]).cast("double")).alias(f"hi_{r['column']}"))])
    checks = F.array(*[F.struct(
        F.lit(r["column"]).alias("column"), F.lit(r["n_rows"]).alias("n_rows"), F.lit(r["null_ratio"]).alias("null_ratio"),
        F.round(F.lit(r["low"]), 6).alias("low"), F.round(F.lit(r["high"]), 6).alias("high"), F.round(F.lit(r["mean"]), 6).alias("mean"),
        (F.abs(r["n_distinct"] / F.col(f"n_{r['column']}") - 1) <= 4 * S.distinct_error()).alias("distinct_within"),
        ((F.col(f"lo_{r['column']}") <= 0.5 + S.rank_error()) & (F.col(f"hi_{r['column']}") >= 0.5 - S.rank_error()))
        .alias("median_within")) for r in rows])
    return exact.select(F.inline(checks))


ORACLES["profile_sketch"] = f"WITH {PREDICTORS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, 0.0::DOUBLE AS null_ratio, round(min({c})::DOUBLE, 6) AS low, "
    f"round(max({c})::DOUBLE, 6) AS high, round(avg({c}), 6) AS mean, true AS distinct_within, true AS median_within FROM pc"
    for c in SKETCHED)
