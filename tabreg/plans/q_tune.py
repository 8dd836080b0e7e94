"""Registered queries: search (H1-H5), best trial (S4), trial analysis
(H6, H7, W1) and early stopping (W2).

Trial tables for the analysis queries are derived from ``events`` so they
grow with the data: study = event type, trial = event id, objective =
value, parameters = hour, minute and user of the event.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabreg.functions.hashing import hash_bucket
from tabreg.operators import models as M
from tabreg.operators import tune as H
from tabreg.operators.prep import three_way_split, with_kfold
from tabreg.plans.data import lineitem_net
from tabreg.plans.q_models import EVENTS_CURVE, LI_FEATURES, events_curve
from tabreg.sources.tables import read_table

QUERIES = {}
ORACLES = {}
KEY = ["l_orderkey", "l_linenumber"]
PARAMS = ["hour", "minute", "user"]


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def events_trials(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(
        F.col("event_type").alias("study"), F.col("event_id").alias("trial"), "value",
        F.create_map(F.lit("hour"), F.hour("ts").cast("double"),
                     F.lit("minute"), F.minute("ts").cast("double"),
                     F.lit("user"), F.col("user_id").cast("double")).alias("params"))


TRIALS_SQL = """t AS (SELECT event_type AS study, event_id AS trial, value,
  CAST(hour(ts) AS DOUBLE) AS hour, CAST(minute(ts) AS DOUBLE) AS minute,
  CAST(user_id AS DOUBLE) AS "user" FROM events),
l AS (SELECT study, trial, value, 'hour' AS param, hour AS param_value FROM t
      UNION ALL SELECT study, trial, value, 'minute', minute FROM t
      UNION ALL SELECT study, trial, value, 'user', "user" FROM t)"""


@q("best_trial")
def best_trial(spark, sf):
    b = H.best_trial(events_trials(spark, sf), "maximize", ["study"])
    return b.select("study", "trial", "value")


ORACLES["best_trial"] = f"""
WITH {TRIALS_SQL}
SELECT study, trial, value FROM (
  SELECT *, row_number() OVER (PARTITION BY study ORDER BY value DESC, trial) AS rn FROM t)
WHERE rn = 1"""


@q("trial_table")
def trial_table(spark, sf):
    return H.trials_long(events_trials(spark, sf))


ORACLES["trial_table"] = f"WITH {TRIALS_SQL} SELECT trial, value, param, param_value FROM l"


@q("best_so_far")
def best_so_far(spark, sf):
    t = H.best_so_far(events_trials(spark, sf), ["study"])
    return t.select("study", "trial", "value", "best_so_far")


ORACLES["best_so_far"] = f"""
WITH {TRIALS_SQL}
SELECT study, trial, value, max(value) OVER (PARTITION BY study ORDER BY trial
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far FROM t"""


@q("param_importance")
def param_importance(spark, sf):
    imp = H.param_importance(events_trials(spark, sf), bins=10)
    return imp.select("param", F.round("eta2", 9).alias("eta2"),
                      F.round("importance", 9).alias("importance"))


ORACLES["param_importance"] = f"""
WITH {TRIALS_SQL},
b AS (SELECT param, min(param_value) AS lo, max(param_value) AS hi FROM l GROUP BY param),
c AS (SELECT param, value, CAST(least(CASE WHEN (hi - lo) / 10.0 > 0
        THEN floor((param_value - lo) / ((hi - lo) / 10.0)) ELSE 0 END, 9) AS INTEGER) AS bin
      FROM l JOIN b USING (param)),
cells AS (SELECT param, bin, count(*) AS n, avg(value) AS m FROM c GROUP BY param, bin),
tot AS (SELECT avg(value) AS mu, var_pop(value) * count(value) AS sst FROM t),
e AS (SELECT param, sum(n * power(m - mu, 2)) / max(sst) AS eta2 FROM cells, tot GROUP BY param)
SELECT param, round(eta2, 9) AS eta2, round(eta2 / sum(eta2) OVER (), 9) AS importance FROM e"""


@q("param_contour")
def param_contour(spark, sf):
    c = H.param_contour(events_trials(spark, sf), "hour", "minute", bins=10)
    return c.select("bin_hour", "bin_minute", F.round("mean_value", 6).alias("mean_value"), "n")


def _bin_sql(x, lo, hi):
    return (f"CAST(least(CASE WHEN ({hi} - {lo}) / 10.0 > 0 THEN floor(({x} - {lo}) / "
            f"(({hi} - {lo}) / 10.0)) ELSE 0 END, 9) AS INTEGER)")


ORACLES["param_contour"] = f"""
WITH {TRIALS_SQL},
b AS (SELECT min(hour) AS la, max(hour) AS ha, min(minute) AS lb, max(minute) AS hb FROM t)
SELECT {_bin_sql('hour', 'la', 'ha')} AS bin_hour, {_bin_sql('minute', 'lb', 'hb')} AS bin_minute,
       round(avg(value), 6) AS mean_value, count(*) AS n
FROM t, b GROUP BY 1, 2"""


@q("parallel_coordinates")
def parallel_coordinates(spark, sf):
    return H.parallel_coordinates(events_trials(spark, sf), PARAMS)


ORACLES["parallel_coordinates"] = f'WITH {TRIALS_SQL} SELECT trial, value, hour, minute, "user" FROM t'


@q("early_stop_round")
def early_stop_round(spark, sf):
    return H.early_stop(events_curve(spark, sf), ["user_id"], "round", "rmse", patience=30)


ORACLES["early_stop_round"] = f"""
WITH {EVENTS_CURVE},
r AS (SELECT *, min(rmse) OVER w AS best,
             min(rmse) OVER (PARTITION BY user_id ORDER BY round
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best
      FROM cv WINDOW w AS (PARTITION BY user_id ORDER BY round
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
a AS (SELECT *, max(CASE WHEN prev_best IS NULL OR rmse < prev_best THEN round END)
             OVER (PARTITION BY user_id ORDER BY round
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_at FROM r),
s AS (SELECT user_id, coalesce(min(CASE WHEN round - best_at >= 30 THEN round END), max(round))
             AS stop_round FROM a GROUP BY user_id)
SELECT a.user_id, s.stop_round, a.best_at AS best_round, a.best AS best_rmse
FROM a JOIN s ON a.user_id = s.user_id AND a.round = s.stop_round"""

# ------------------------------------------------------------------ search (rows-only)


def _li_three_way(spark, sf):
    li = VectorAssembler(inputCols=LI_FEATURES, outputCol="features").transform(
        lineitem_net(spark, sf)).withColumnRenamed("net", "label")
    return three_way_split(li, KEY)


#: The reference's ranges; Spark's boosting has no counterpart of its two penalties (reg_alpha, reg_lambda).
GBT_SPACE = {"n_estimators": H.IntRange(300, 1200), "max_depth": H.IntRange(3, 10),
             "learning_rate": H.FloatRange(0.01, 0.3, log=True),
             "subsample": H.FloatRange(0.6, 1.0), "colsample_bytree": H.FloatRange(0.6, 1.0),
             "gamma": H.FloatRange(0.0, 5.0)}
GBT_TRIALS = 50
#: Rounds at most, and rounds without a better one that end the fit.
STOPPED_ROUNDS, STOPPED_PATIENCE = 60, 3
TREE_SPACE = {"max_depth": H.IntRange(2, 8), "min_child_weight": H.IntRange(1, 50)}


def _tree(params):
    return M.decision_tree(max_depth=int(params["max_depth"])).setMinInstancesPerNode(
        int(params["min_child_weight"]))


@q("random_search_trials")
def random_search_trials(spark, sf):
    """H2: maximise validation R^2 of the re-aimed boosting model."""
    df = _li_three_way(spark, sf)
    return H.random_search(spark, lambda p: M.gbt("depthwise", **p), GBT_SPACE,
                           df.filter("split = 'train'"), df.filter("split = 'val'"),
                           n_trials=GBT_TRIALS, metric="r2", direction="maximize",
                           parallelism=spark.sparkContext.defaultParallelism)


@q("random_search_minimize")
def random_search_minimize(spark, sf):
    """H3: minimise validation MSE with a time budget."""
    df = _li_three_way(spark, sf)
    return H.random_search(spark, _tree, TREE_SPACE, df.filter("split = 'train'"),
                           df.filter("split = 'val'"), n_trials=30, metric="mse",
                           direction="minimize", timeout=600, parallelism=4)


@q("grid_search_cv")
def grid_search_cv(spark, sf):
    """H5: grid x 3-fold cross-validation on a hash fold column."""
    df = _li_three_way(spark, sf).filter("split <> 'test'")
    df = with_kfold(df, KEY, 3)
    est = M.linear_regression()
    return H.grid_search_cv(spark, est, {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.5]},
                            df, "fold", 3, parallelism=2)


@q("refit_best")
def refit_best(spark, sf):
    """H4: best parameters re-fitted on train+validation, scored on test."""
    df = _li_three_way(spark, sf)
    trials = H.random_search(spark, _tree, TREE_SPACE, df.filter("split = 'train'"),
                             df.filter("split = 'val'"), n_trials=30, metric="mse",
                             direction="minimize", parallelism=4)
    model = H.refit_best(_tree, trials, df.filter("split <> 'test'"), "minimize")
    return M.predict(model, df.filter("split = 'test'"), "prediction").select(
        *KEY, "label", "prediction")


@q("early_stopped_boosting")
def early_stopped_boosting(spark, sf):
    """M11 + W2: boosting with an evaluation set that ends when patience runs
    out. The kept model's own validation error stands beside its best round."""
    # noise by a hash of the key: from some round on more trees fit it, and validation gets no better
    noise = 200.0 * (hash_bucket(KEY, 100, "noise") - 50)
    li = VectorAssembler(inputCols=LI_FEATURES, outputCol="features").transform(
        lineitem_net(spark, sf)).withColumn("label", F.col("net") + noise)
    df = three_way_split(li, KEY)
    val = df.filter("split = 'val'")
    model, _, stop = H.fit_early_stopped(
        spark, M.gbt("binned", iterations=STOPPED_ROUNDS, depth=4, learning_rate=0.5, border_count=64),
        df.filter("split = 'train'"), val, patience=STOPPED_PATIENCE)
    from tabreg.operators.evaluate import metrics
    own = metrics(M.predict(model, val, "m"), "label", ["m"]).first()["rmse"]
    return stop.withColumn("model_value", F.lit(float(own)))
