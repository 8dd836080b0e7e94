"""Boosting that stops while it is fitted.

Squared-loss boosting as ``GBTRegressor`` does it, one tree a stage, so that
the validation error is known after each stage and fitting ends as soon as
patience runs out: no round beyond it is ever fitted, and nothing is fitted
again for the best one, whose trees are kept.

The running prediction is a column of both frames. A stage fits one tree on
the residuals, adds its prediction to the column in a new persisted frame
(which its aggregate fills) and drops the one before. The frames' lineage, and
with it the plan, grows by one stage at a time and is cut by a reliable
checkpoint every ``checkpoint_every`` stages, so a lost executor costs at most
those stages, and the plan stays small for any number of rounds. The frames of
a large input are its cells (``cells``), which give the same trees and errors.
"""

from __future__ import annotations

import math
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabreg.operators import cells
from tabreg.operators.cells import TrainingRows, training
from tabreg.session import cut_lineage, persist_for_passes

_SUM, _RESIDUAL, _TREE = "__boost_sum", "__boost_residual", "__boost_tree"


def stageable(estimator: GBTRegressor) -> bool:
    """Whether a stage is one tree on all rows and features."""
    return (estimator.getLossType() == "squared" and estimator.getSubsamplingRate() == 1.0
            and estimator.getFeatureSubsetStrategy() == "all")


def _tree(estimator: GBTRegressor) -> DecisionTreeRegressor:
    """The estimator's tree. One seed for all stages: they split at the same
    candidate values, as Spark's own boosting does."""
    own = {p: estimator.getOrDefault(p) for p in (
        "maxDepth", "maxBins", "minInstancesPerNode", "minWeightFractionPerNode", "minInfoGain", "maxMemoryInMB", "cacheNodeIds")}
    return DecisionTreeRegressor(featuresCol=estimator.getFeaturesCol(), labelCol=_RESIDUAL, predictionCol=_TREE,
                                 impurity="variance", seed=estimator.getSeed(), **own)


def _cells(estimator: GBTRegressor, train: TrainingRows, val: TrainingRows) -> tuple[cells.Cells, DataFrame] | None:
    """Cells of both inputs by the candidates of the training rows: every row of
    a cell has the same prediction, so errors follow from the cells as well."""
    table = train.cells(estimator)
    if table is None:
        return None
    own = val.grouped(estimator.getFeaturesCol(), estimator.getLabelCol(), table.points)
    return own and (table, cells.with_points(own[0], table.points))


def boost_until_stopped(estimator: GBTRegressor, train: DataFrame, val: DataFrame, patience: int = 30,
                        checkpoint_every: int = 10) -> tuple[GBTRegressionModel, list[tuple[int, float, float]], dict[str, Any]]:
    """(model, curve, stop) of boosting by the parameters of ``estimator``.

    ``maxIter`` is the most rounds. The first tree is fitted on the label and
    weighs 1, each later one on twice the residual and weighs ``stepSize``, as
    in Spark's own boosting with squared loss. ``curve`` has (round, train
    RMSE, validation RMSE) of every fitted round; rounds count from 0. Fitting
    ends after the first round r with ``r - best round >= patience`` (ties
    keep the earlier round). ``model`` holds the trees up to the best round;
    ``stop`` has stop_round, best_round, best_rmse.
    """
    if not stageable(estimator):
        raise ValueError("stages are fitted with squared loss on all rows and features")
    if patience < 1:
        raise ValueError("patience is one round at least")
    spark, label = train.sparkSession, estimator.getLabelCol()
    columns = [estimator.getFeaturesCol(), label]
    with training(train) as train_rows, training(val) as val_rows:
        found = _cells(estimator, train_rows, val_rows)
        if found:
            columns, label = [cells._FEATURES, cells._LABEL, cells._WEIGHT, cells._VARIANCE], cells._LABEL
            w = F.col(cells._WEIGHT)
            error = F.sqrt(F.sum(w * (F.col(cells._VARIANCE) + (F.col(label) - F.col(_SUM)) ** 2)) / F.sum(w))
            learner = cells._tree_of(estimator, found[0]).setLabelCol(_RESIDUAL).setPredictionCol(_TREE)
            inputs = [found[0].frame, found[1]]
        else:
            error, learner, inputs = F.sqrt(F.avg((F.col(label) - F.col(_SUM)) ** 2)), _tree(estimator), [train, val]
        first, second = [f.select(*columns).withColumn(_SUM, F.lit(0.0)) for f in inputs]
        frames = [persist_for_passes(first), second.persist(StorageLevel.MEMORY_AND_DISK)]
        trees, curve, best = _stages(estimator, learner, frames, columns, label, error, patience, checkpoint_every)
    if best[1] < 0:  # no validation row: all rounds count
        best = (math.nan, len(trees) - 1)
    kept = trees[:best[1] + 1]
    model = cells.boosted(spark, estimator, kept, [1.0] + [estimator.getStepSize()] * (len(kept) - 1),
                          estimator.getFeaturesCol(), estimator.getPredictionCol())
    return model, curve, {"stop_round": len(trees) - 1, "best_round": best[1], "best_rmse": best[0]}


def _stages(estimator: GBTRegressor, learner, frames: list[DataFrame], columns: list[str], label: str, error,
            patience: int, checkpoint_every: int):
    """(trees, curve, (best error, best round)); the frames are released."""
    trees, curve, best = [], [], (math.inf, -1)
    try:
        for stage in range(estimator.getMaxIter()):
            residual = F.col(label) - F.col(_SUM)
            tree = learner.fit(frames[0].withColumn(_RESIDUAL, residual * 2.0 if stage else residual))
            weight = estimator.getStepSize() if stage else 1.0
            errors, grown = [], []
            for old in frames:
                new = tree.transform(old).withColumn(_SUM, F.col(_SUM) + F.lit(weight) * F.col(_TREE)).select(*columns, _SUM)
                new = cut_lineage(new) if (stage + 1) % checkpoint_every == 0 else new
                grown.append(new.persist(StorageLevel.MEMORY_AND_DISK))
                # the aggregate also fills the cache; only then may the frame before go
                errors.append(new.agg(error).first()[0])
                old.unpersist()
            frames = grown
            trees.append(tree)
            curve.append((stage, *(math.nan if e is None else float(e) for e in errors)))
            if curve[-1][2] < best[0]:
                best = (curve[-1][2], stage)
            if stage - max(best[1], 0) >= patience:
                break
    finally:
        for f in frames:
            f.unpersist()
    return trees, curve, best
