"""Fits with a closed form, so that SQL can check their numbers: stumps and
boosted stumps over one feature (M5, M8, M14, M16, E16), stacking, blending and
meta weights of linear members (N4-N6), cross-validated ridge (H5), assembly (F12)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabreg.operators import ensemble as N
from tabreg.operators import models as M
from tabreg.operators import prep as R
from tabreg.operators import tune as H
from tabreg.plans.data import lineitem_net
from tabreg.plans.sql import LINEITEM_NET, bucket, is_test

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
KEY = ["l_orderkey", "l_linenumber"]
KEY_SQL = "concat_ws('|', l_orderkey, l_linenumber)"


def q(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _assembled(spark, sf, cols=("l_quantity",), out="features"):
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(lineitem_net(spark, sf)).withColumnRenamed("net", "label")


def _split(df):
    return R.train_test_split(df, KEY, 0.2)


SPLIT = f"""{LINEITEM_NET},
a AS (SELECT *, net AS label, {is_test(KEY_SQL)} AS is_test FROM li),
tr AS (SELECT * FROM a WHERE NOT is_test), te AS (SELECT * FROM a WHERE is_test)"""

# ------------------------------------------------------------------ stumps


def _stump_sql(t: int) -> str:
    """The best cut of round ``t``: the largest sum of squared sums over counts."""
    return f"""c{t} AS (SELECT l_quantity, sum(n) OVER w AS nl, sum(s{t}) OVER w AS sl, sum(n) OVER () AS n0, sum(s{t}) OVER () AS s0
  FROM g{t} WINDOW w AS (ORDER BY l_quantity)),
b{t} AS (SELECT l_quantity AS cut, sl / nl AS below, (s0 - sl) / (n0 - nl) AS above FROM c{t} WHERE nl < n0
  ORDER BY sl * sl / nl + (s0 - sl) * (s0 - sl) / (n0 - nl) DESC, l_quantity LIMIT 1)"""


_FIRST = "g0 AS (SELECT l_quantity, count(*) AS n, sum(label) AS s, sum(label) AS s0 FROM tr GROUP BY l_quantity)"


@q("decision_stump")
def decision_stump(spark, sf):
    train, test = _split(_assembled(spark, sf))
    model = M.fit(M.decision_tree(max_depth=1, max_bins=64), train)
    return M.predict(model, test, "prediction").select(*KEY, F.round("prediction", 4).alias("prediction"))


ORACLES["decision_stump"] = f"""
WITH {SPLIT}, {_FIRST}, {_stump_sql(0)}
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity <= cut THEN below ELSE above END, 4) AS prediction FROM te, b0"""

ROUNDS, RATE = 4, 0.1


def _boosted(spark, sf):
    train, test = _split(_assembled(spark, sf))
    return M.fit(M.gbt("classic", n_estimators=ROUNDS, max_depth=1, learning_rate=RATE, max_bin=64), train), train, test


def _rounds_sql() -> str:
    """Round after round: each stump is fitted on twice the residual, its
    prediction counts RATE (the first one's whole)."""
    out, total = [_FIRST], None
    for t in range(ROUNDS):
        step = f"(CASE WHEN l_quantity <= b{t}.cut THEN b{t}.below ELSE b{t}.above END)"
        total = step if total is None else f"f{t - 1} + {RATE} * {step}"
        out.append(_stump_sql(t))
        seen = "g0" if t == 0 else f"p{t - 1}"
        out.append(f"p{t} AS (SELECT {seen}.*, {total} AS f{t} FROM {seen}, b{t})")
        out.append(f"g{t + 1} AS (SELECT l_quantity, n, 2 * (s - n * f{t}) AS s{t + 1} FROM p{t})")
    return ",\n".join(out)


@q("boosted_stumps")
def boosted_stumps(spark, sf):
    model, _, test = _boosted(spark, sf)
    return M.predict(model, test, "prediction").select(*KEY, F.round("prediction", 3).alias("prediction"))


ORACLES["boosted_stumps"] = f"""
WITH {SPLIT}, {_rounds_sql()}
SELECT l_orderkey, l_linenumber, round(f{ROUNDS - 1}, 3) AS prediction FROM te JOIN p{ROUNDS - 1} USING (l_quantity)"""


@q("boosted_stumps_curve")
def boosted_stumps_curve(spark, sf):
    model, train, test = _boosted(spark, sf)
    curve = M.learning_curve(spark, model, {"train": train, "test": test})
    return curve.withColumn("value", F.round("value", 4))


ORACLES["boosted_stumps_curve"] = f"""
WITH {SPLIT}, {_rounds_sql()},
e AS (SELECT 'train' AS dataset, * FROM tr JOIN p{ROUNDS - 1} USING (l_quantity)
      UNION ALL SELECT 'test', * FROM te JOIN p{ROUNDS - 1} USING (l_quantity))
""" + " UNION ALL ".join(
    f"SELECT CAST({t} AS INTEGER) AS round, dataset, 'rmse' AS metric, round(sqrt(avg(power(label - f{t}, 2))), 4) AS value FROM e GROUP BY dataset"
    for t in range(ROUNDS))


@q("staged_stumps_stop")
def staged_stumps_stop(spark, sf):
    """M11 + W2 fitted stage by stage: one row a fitted round, the stop beside it."""
    from tabreg.operators.boosting import boost_until_stopped
    train, test = _split(_assembled(spark, sf))
    est = M.gbt("classic", n_estimators=ROUNDS, max_depth=1, learning_rate=RATE, max_bin=64)
    _, curve, stop = boost_until_stopped(est, train, test, patience=ROUNDS)
    return spark.createDataFrame(curve, "round int, train_rmse double, test_rmse double").select(
        "round", F.round("train_rmse", 4).alias("train_rmse"), F.round("test_rmse", 4).alias("test_rmse"),
        F.lit(stop["best_round"]).alias("best_round"))


ORACLES["staged_stumps_stop"] = f"""
WITH {SPLIT}, {_rounds_sql()},
x AS (SELECT * FROM tr JOIN p{ROUNDS - 1} USING (l_quantity)), y AS (SELECT * FROM te JOIN p{ROUNDS - 1} USING (l_quantity)),
r AS ({" UNION ALL ".join(
    f"SELECT CAST({t} AS INTEGER) AS round, (SELECT sqrt(avg(power(label - f{t}, 2))) FROM x) AS a, (SELECT sqrt(avg(power(label - f{t}, 2))) FROM y) AS b"
    for t in range(ROUNDS))})
SELECT round, round(a, 4) AS train_rmse, round(b, 4) AS test_rmse, (SELECT arg_min(round, b) FROM r) AS best_round FROM r"""

# ------------------------------------------------------------------ linear members

MEMBERS = {"by_price": ("l_extendedprice", "x_price"), "by_quantity": ("l_quantity", "x_quantity")}
ALPHA, FOLDS = 1.0, 5


def _members():
    return {n: M.linear_regression(x, "label") for n, (_, x) in MEMBERS.items()}


def _member_rows(spark, sf):
    df = lineitem_net(spark, sf).withColumnRenamed("net", "label")
    for c, x in MEMBERS.values():
        df = VectorAssembler(inputCols=[c], outputCol=x).transform(df)
    return _split(df)


def _lines_sql(name: str, rows: str, group: str = "") -> str:
    cols = ", ".join(f"regr_slope(label, {c}) AS a{i}, regr_intercept(label, {c}) AS b{i}" for i, (c, _) in enumerate(MEMBERS.values()))
    return f"{name} AS (SELECT {group + ', ' if group else ''}{cols} FROM {rows}{f' GROUP BY {group}' if group else ''})"


_PREDICTED = ", ".join(f"a{i} * {c} + b{i} AS p{i}" for i, (c, _) in enumerate(MEMBERS.values()))


def _meta_sql(rows: str) -> str:
    """Ridge of the label on both predictions, the intercept free."""
    return f"""k AS (SELECT avg(p0) AS m0, avg(p1) AS m1, avg(label) AS my, var_pop(p0) + {ALPHA} / count(*) AS v0,
  var_pop(p1) + {ALPHA} / count(*) AS v1, covar_pop(p0, p1) AS c01, covar_pop(p0, label) AS c0, covar_pop(p1, label) AS c1 FROM {rows}),
u AS (SELECT *, (c0 * v1 - c1 * c01) / (v0 * v1 - c01 * c01) AS w0, (c1 * v0 - c0 * c01) / (v0 * v1 - c01 * c01) AS w1 FROM k),
w AS (SELECT w0, w1, my - w0 * m0 - w1 * m1 AS wi FROM u)"""


_HOLD = f"({bucket(KEY_SQL, 100, 'blend')} < 20)"
_BLEND = f"""{_lines_sql("z", f"(SELECT * FROM tr WHERE NOT {_HOLD})")},
h AS (SELECT label, {_PREDICTED} FROM tr, z WHERE {_HOLD}), {_meta_sql("h")}"""


@q("blending_linear")
def blending_linear(spark, sf):
    train, test = _member_rows(spark, sf)
    blended = N.blending(train, KEY, "label", _members(), alpha=ALPHA)
    return blended.transform(test).select(*KEY, F.round("prediction", 2).alias("prediction"))


ORACLES["blending_linear"] = f"""
WITH {SPLIT}, {_BLEND}
SELECT l_orderkey, l_linenumber, round(w0 * p0 + w1 * p1 + wi, 2) AS prediction FROM (SELECT *, {_PREDICTED} FROM te, z), w"""


@q("meta_weights_linear")
def meta_weights_linear(spark, sf):
    train, _ = _member_rows(spark, sf)
    weights = N.meta_coefficients(spark, N.blending(train, KEY, "label", _members(), alpha=ALPHA))
    model, value = weights.columns
    return weights.select(F.col(model).alias("model"), F.round(value, 4).alias("weight"))


ORACLES["meta_weights_linear"] = f"""
WITH {SPLIT}, {_BLEND}
SELECT 'by_price' AS model, round(w0, 4) AS weight FROM w UNION ALL SELECT 'by_quantity', round(w1, 4) FROM w
UNION ALL SELECT 'intercept', round(wi, 4) FROM w"""


@q("stacking_linear")
def stacking_linear(spark, sf):
    train, test = _member_rows(spark, sf)
    stacked, _ = N.stacking(train, KEY, "label", _members(), k=FOLDS, alpha=ALPHA)
    return stacked.transform(test).select(*KEY, F.round("prediction", 2).alias("prediction"))


ORACLES["stacking_linear"] = f"""
WITH {SPLIT}, f AS (SELECT *, {bucket(KEY_SQL, FOLDS, 'fold')} AS fold FROM tr),
o AS (SELECT k.fold AS own, f.* FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold),
{_lines_sql("zf", "o", "own")},
h AS (SELECT label, {_PREDICTED} FROM f JOIN zf ON fold = own), {_meta_sql("h")}, {_lines_sql("z", "tr")}
SELECT l_orderkey, l_linenumber, round(w0 * p0 + w1 * p1 + wi, 2) AS prediction FROM (SELECT *, {_PREDICTED} FROM te, z), w"""

# ------------------------------------------------------------------ cross-validation (H5), assembly

REG = [0.0, 1e12]


@q("grid_search_ridge")
def grid_search_ridge(spark, sf):
    df = R.with_kfold(_assembled(spark, sf, ("l_extendedprice",)), KEY, 3)
    trials = H.grid_search_cv(spark, M.linear_regression(), {"regParam": REG}, df, "fold", 3, metric="rmse")
    return trials.select("trial", F.col("params")["regParam"].alias("reg"), F.round("value", 4).alias("rmse"))


# the solver's penalty is on the scale of a standardised label
ORACLES["grid_search_ridge"] = f"""
WITH {LINEITEM_NET}, f AS (SELECT l_extendedprice AS x, net AS y, {bucket(KEY_SQL, 3, 'fold')} AS fold FROM li),
r(trial, reg) AS (VALUES {", ".join(f"(CAST({i} AS INTEGER), CAST({v} AS DOUBLE))" for i, v in enumerate(REG))}),
k AS (SELECT DISTINCT fold AS own FROM f),
m AS (SELECT own, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vxx, covar_pop(x, y) AS cxy, stddev_pop(y) AS sy
      FROM k JOIN f ON fold <> own GROUP BY own),
w AS (SELECT trial, reg, own, cxy / (vxx + reg / sy) AS a, mx, my FROM m, r),
e AS (SELECT trial, reg, own, sqrt(avg(power(y - my - a * (x - mx), 2))) AS rmse FROM w JOIN f ON fold = own GROUP BY trial, reg, own)
SELECT trial, reg, round(avg(rmse), 4) AS rmse FROM e GROUP BY trial, reg"""


@q("assembled_features")
def assembled_features(spark, sf):
    df = R.assemble(lineitem_net(spark, sf), ["l_quantity", "l_discount", "l_tax"])
    x = vector_to_array("features")
    return df.select(*KEY, F.size(x).alias("width"), *[F.round(x[i], 6).alias(f"x{i}") for i in range(3)])


ORACLES["assembled_features"] = f"""
WITH {LINEITEM_NET}
SELECT l_orderkey, l_linenumber, CAST(3 AS INTEGER) AS width, round(l_quantity::DOUBLE, 6) AS x0,
       round(l_discount::DOUBLE, 6) AS x1, round(l_tax::DOUBLE, 6) AS x2 FROM li"""
