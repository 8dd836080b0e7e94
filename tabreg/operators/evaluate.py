"""Evaluation and diagnostic tables (E1-E17): the data behind each chart.

All metrics of all models come from one grouped aggregate over the
unpivoted prediction columns (partial aggregation, one row per model and
task is shuffled). R^2 is
``1 - SSE / SST`` with the total sum of squares taken centred
(``var_pop * n``, a numerically stable moment), not ``regr_r2``.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.functions.rowwise import abs_error, least_of
from tabreg.functions.scan import running_aggregate
from tabreg.operators.profile import box_summary, histogram


def metrics(df: DataFrame, label: str, preds: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """``model, n, mse, rmse, mae, r2``, one row per prediction column.

    The prediction columns are unpivoted and aggregated per model: a few
    buffer fields whatever the number of models (the aggregate stays in
    whole-stage codegen), partial aggregation, a shuffle of one row per
    model and task.
    """
    items = list(preds.items()) if isinstance(preds, Mapping) else [(p, p) for p in preds]
    names = [n for n, _ in items]
    wide = df.select(F.col(label).cast("double").alias("__y"),
                     *[F.col(c).cast("double").alias(n) for n, c in items])
    long = wide.unpivot(["__y"], names, "model", "__p")
    both = F.col("__y").isNotNull() & F.col("__p").isNotNull()
    err = F.when(both, F.col("__y") - F.col("__p"))
    yb = F.when(both, F.col("__y"))
    sse = F.sum(err * err)
    n = F.count(err)
    return long.groupBy("model").agg(
        n.alias("n"),
        (sse / n).alias("mse"),
        F.sqrt(sse / n).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(sse, F.var_pop(yb) * F.count(yb))).alias("r2"))


def metrics_long(df: DataFrame, label: str, preds: Sequence[str]) -> DataFrame:
    """IO6: ``model, metric, value`` long frame (what the reference prints)."""
    return metrics(df, label, preds).unpivot(
        ["model"], ["mse", "rmse", "mae", "r2"], "metric", "value")


def model_comparison(df: DataFrame, label: str, preds: Sequence[str]) -> DataFrame:
    """MSE and R^2 side by side per model."""
    return metrics(df, label, preds).select("model", "mse", "r2")


def leaderboard(metric_frame: DataFrame, fit_seconds: DataFrame | None = None,
                train_metrics: DataFrame | None = None) -> DataFrame:
    """Metrics ranked by RMSE, with fit time and train-test gap if given.

    The frame has one row per model, so the global rank window is tiny.
    """
    out = metric_frame
    if fit_seconds is not None:
        out = out.join(fit_seconds, "model", "left")
    if train_metrics is not None:
        out = out.join(train_metrics.select("model", F.col("rmse").alias("train_rmse")),
                       "model", "left").withColumn("gap", F.col("rmse") - F.col("train_rmse"))
    return out.withColumn("rank", F.rank().over(Window.orderBy("rmse", "model")))


def trade_off(rows: DataFrame, cost: str, error: str) -> DataFrame:
    """The rows that no other beats on both criteria, smaller is better.

    A row is beaten by one with at most its cost and at most its error, less in
    one of them; equal rows stay together. Each cost's least error, in order
    of cost, counts where it lowers the running minimum (a distributed scan,
    no pairs of rows). Rows without a cost or an error are left out.
    """
    both = rows.filter(F.col(cost).isNotNull() & F.col(error).isNotNull() & ~F.isnan(F.col(cost).cast("double"))
                       & ~F.isnan(F.col(error).cast("double")))
    steps = both.groupBy(F.col(cost).alias("__cost")).agg(F.min(error).alias("__error")).withColumn("__all", F.lit(0))
    front = running_aggregate(steps, ["__all"], ["__cost"], "argmin", value="__error", out="__best", at_col="__at")
    # a cost that only equals the minimum so far keeps the earlier, cheaper place
    front = front.filter(F.col("__at") == F.col("__cost")).select("__cost", "__error")
    return both.join(front, (F.col(cost) == F.col("__cost")) & (F.col(error) == F.col("__error"))).drop("__cost", "__error")


def actual_vs_predicted(df: DataFrame, key: Sequence[str], label: str, pred: str) -> DataFrame:
    """Scatter points, keyed."""
    return df.select(*key, F.col(label).alias("actual"), F.col(pred).alias("predicted"))


def prediction_line(df: DataFrame, label: str) -> DataFrame:
    """Endpoints of the perfect-prediction line (min, max of the label)."""
    return df.agg(F.min(label).alias("label_min"), F.max(label).alias("label_max"))


def residuals(df: DataFrame, label: str, pred: str, out: str = "residual") -> DataFrame:
    """``y - p`` next to the fitted value."""
    return df.withColumn(out, F.col(label) - F.col(pred))


def residual_histogram(df: DataFrame, label: str, pred: str, bins: int = 30) -> DataFrame:
    """30-bin histogram of residuals."""
    return histogram(residuals(df, label, pred), "residual", bins)


def abs_errors_long(df: DataFrame, key: Sequence[str], label: str,
                    preds: Mapping[str, str]) -> DataFrame:
    """E11 table: ``key, model, abs_error`` for every model (one unpivot)."""
    wide = df.select(*key, *[abs_error(label, c).alias(name) for name, c in preds.items()])
    return wide.unpivot(list(key), list(preds), "model", "abs_error")


def abs_error_box(df: DataFrame, key: Sequence[str], label: str,
                  preds: Mapping[str, str]) -> DataFrame:
    """Box summary of absolute errors per model."""
    return box_summary(abs_errors_long(df, key, label, preds), "abs_error", ["model"])


def improvement_over_best(df: DataFrame, label: str, base: Sequence[str], blended: str,
                          out: str = "improvement") -> DataFrame:
    """Best base-model absolute error minus the blender's (> 0: blender better)."""
    best = least_of([abs_error(label, c) for c in base])
    return df.withColumn(out, best - abs_error(label, blended))


def prediction_pairs(df: DataFrame, key: Sequence[str], a: str, b: str) -> DataFrame:
    """Prediction of model a against model b."""
    return df.select(*key, F.col(a), F.col(b))


def curve_metric_names(curve: DataFrame) -> DataFrame:
    """Metric names present in a learning-curve frame."""
    return curve.select("metric").distinct()
