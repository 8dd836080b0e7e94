"""Tree fits of many rows on cells of equal candidate bins.

A tree that splits at the candidate values of its features can't tell rows
apart that lie in the same bin of every feature, and the gain of a split by
variance depends on counts and label sums alone. So one aggregate over all
rows gives everything a fit needs: the rows of each cell, as a weight, and
their mean label. ``pyspark.ml``'s own trees are fitted on these weighted
cells, level by level and round by round, with the gains they would have on
the rows. There are at most bins ^ features cells, however many rows.

* Bins: up to ``maxBins`` values of each feature stand for it, all its values
  or quantiles of a sample, as Spark finds its candidates (from 10,000 rows;
  here from ``_SAMPLE_ROWS``). A row belongs to the nearest one, the lower of
  two. Spark splits halfway between the values it sees, so a fitted threshold
  parts rows and cells alike, and the model takes unbinned rows.
* Draws (forests, boosting on sampled rows): every row is drawn by its own
  random number for each tree, then weights and label sums of a cell are
  added up. Rows are range-partitioned by cell, so a task holds the sums of
  its own cells only and a cell of many rows is spread over tasks.
* Small inputs, those with null or not finite values, losses without such
  sums, and inputs with nearly as many cells as rows are fitted row by row.
"""

from __future__ import annotations

import math
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.session import cut_lineage, persist_for_passes, written

#: Inputs of no more rows are fitted row by row.
DIRECT_ROWS = 1_000_000
_SAMPLE_ROWS = 200_000
#: Draws held by a task at once, trees fitted at a time.
_DRAW_ROWS, _TREES_AT_ONCE = 4096, 8
_TREES = (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor)
_FEATURES, _LABEL, _WEIGHT, _VARIANCE = "__cell_x", "__cell_y", "__cell_n", "__cell_v"


@dataclass
class Cells:
    """``codes`` (a bin for each feature), rows ``__cell_n`` and mean label
    ``__cell_y`` of each cell, with ``__cell_x`` the values that stand for it."""
    frame: DataFrame
    points: list[np.ndarray]
    n_cells: int
    n_rows: int


def _representatives(x: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(x + 0.0)
    if len(values) <= bins:
        return values
    return np.unique(np.quantile(x, (np.arange(bins) + 0.5) / bins, method="inverted_cdf"))


def _ends(points: np.ndarray) -> np.ndarray:
    """The first value of each next bin."""
    return np.nextafter((points[:-1] + points[1:]) / 2.0, math.inf)


def _uniform_to_count(rate: float, replace: bool) -> np.ndarray:
    """How often a row is drawn, for each of 2^16 equally likely numbers."""
    u = (np.arange(1 << 16) + 0.5) / (1 << 16)
    if not replace:
        return (u < rate).astype(np.uint8)
    cdf = np.cumsum([math.exp(-rate) * rate ** k / math.factorial(k) for k in range(15)])
    return np.searchsorted(cdf, u).astype(np.uint8)


class TrainingRows:
    """The rows of several fits. ``by`` columns are kept in the cells, so that
    a fit may leave out some of their values (folds)."""

    def __init__(self, df: DataFrame, by: Sequence[str] = ()):
        self.df, self.by = df, list(by)
        self._lock, self._kept, self._direct, self._tables = threading.RLock(), [], None, {}

    def rows(self) -> DataFrame:
        """All rows, persisted for fits row by row."""
        with self._lock:
            if self._direct is None:
                self._direct = persist_for_passes(self.df)
                self._kept.append(self._direct)
            return self._direct

    def prepare(self, estimator):
        """Does what fits share before the first one."""
        if not (isinstance(estimator, _TREES) and _sums_suffice(estimator) and self.cells(estimator)):
            self.rows()

    def release(self):
        for f in self._kept:
            f.unpersist()
        self._kept, self._direct, self._tables = [], None, {}

    def fit(self, estimator, keep: Column | None = None):
        """``estimator`` fitted on the rows (where ``keep`` holds of ``by``)."""
        if isinstance(estimator, _TREES) and _sums_suffice(estimator):
            table = self.cells(estimator)
            if table is not None:
                frame = table.frame if keep is None else table.frame.filter(keep)
                if isinstance(estimator, DecisionTreeRegressor):
                    return _fit_cells(estimator, frame, table)
                if isinstance(estimator, GBTRegressor) and estimator.getSubsamplingRate() == 1.0:
                    return _fit_cells(estimator, frame, table)
                if keep is None:
                    return self._drawn(estimator, table)
        rows = self.rows()
        return estimator.fit(rows if keep is None else rows.filter(keep))

    # ---- cells

    def cells(self, estimator) -> Cells | None:
        """The cells for this estimator's columns and bins; none if it is fitted row by row."""
        key = (estimator.getFeaturesCol(), estimator.getLabelCol(), estimator.getMaxBins())
        with self._lock:
            if key not in self._tables:
                self._tables[key] = self._cells(*key)
            return self._tables[key]

    def values(self, features: str, label: str, width: int) -> DataFrame:
        # the array in a projection of its own: it is made once a row
        x = self.df.select(*self.by, F.col(label).cast("double").alias("__y"), vector_to_array(features).alias("__x"))
        return x.select(*self.by, "__y", *[F.col("__x")[i].alias(f"__x{i}") for i in range(width)])

    def _cells(self, features: str, label: str, bins: int) -> Cells | None:
        n = self.df.count()
        first = self.df.select(features).first() if n > DIRECT_ROWS else None
        if first is None or first[0] is None or first[0].size == 0 or bins ** first[0].size > 2 ** 62:
            return None
        points = self.candidates(features, label, first[0].size, bins, n)
        if points is None:
            return None
        found = self.grouped(features, label, points)
        if found is None:
            return None
        frame, n_cells = found
        return None if n_cells > n / 4 else Cells(with_points(frame, points), points, n_cells, n)

    def candidates(self, features: str, label: str, width: int, bins: int, n: int) -> list[np.ndarray] | None:
        """The values of each feature that stand for its bins; none if a sampled one is not finite."""
        names = [f"__x{i}" for i in range(width)]
        some = self.values(features, label, width).select(*names).sample(min(1.0, _SAMPLE_ROWS / n), seed=42).toPandas()
        if some.empty or not np.isfinite(some.to_numpy(np.float64)).all():
            return None
        points = [_representatives(some[c].to_numpy(np.float64), bins) for c in names]
        if any(len(np.unique(_ends(p))) < len(p) - 1 for p in points):  # points too near for a middle
            return None
        return points

    def grouped(self, features: str, label: str, points: list[np.ndarray]) -> tuple[DataFrame, int] | None:
        """(cells of all rows, their number); none if a value is null or not finite."""
        values = self.values(features, label, len(points))
        odd = F.col("__y").isNull() | F.isnan("__y")
        for i in range(len(points)):
            c = F.col(f"__x{i}")
            odd = odd | c.isNull() | F.isnan(c) | (F.abs(c) == math.inf)
        frame = cut_lineage(self._coded(values, points).groupBy(*self.by, *[f"__c{i}" for i in range(len(points))]).agg(
            F.count(F.lit(1)).cast("double").alias(_WEIGHT), F.avg("__y").alias(_LABEL),
            F.var_pop("__y").alias(_VARIANCE), F.max(odd.cast("int")).alias("__odd"))).persist(StorageLevel.MEMORY_AND_DISK)
        self._kept.append(frame)
        seen = frame.agg(F.count(F.lit(1)).alias("n"), F.max("__odd").alias("odd")).first()
        return None if seen["odd"] else (frame, int(seen["n"]))

    @staticmethod
    def _coded(values: DataFrame, points: list[np.ndarray]) -> DataFrame:
        """Adds ``__c<i>``, the place of the nearest point: bins end at the
        middle of two points, which belongs to the lower one."""
        splits, from_, to = [], [], []
        for i, p in enumerate(points):
            if len(p) > 1:
                splits.append([-math.inf, *_ends(p).tolist(), math.inf])
                from_.append(f"__x{i}")
                to.append(f"__d{i}")
        out = Bucketizer(splitsArray=splits, inputCols=from_, outputCols=to, handleInvalid="keep").transform(values) \
            if splits else values
        return out.withColumns({f"__c{i}": (F.col(f"__d{i}") if len(p) > 1 else F.lit(0)).cast("int")
                                for i, p in enumerate(points)})

    # ---- draws

    def _drawn(self, estimator, table: Cells):
        forest = isinstance(estimator, RandomForestRegressor)
        n = estimator.getNumTrees() if forest else estimator.getMaxIter()
        replace = forest and estimator.getBootstrap()
        if forest and not replace and estimator.getSubsamplingRate() == 1.0:
            draws = None
        else:
            draws = self._draws(estimator, table, n, estimator.getSubsamplingRate(), replace)
        spark = self.df.sparkSession
        own = _tree_of(estimator, table)
        if forest:
            def one(i):
                frame = table.frame if draws is None else with_points(_draw(draws, i, table), table.points)
                return own.copy().fit(frame)
            with ThreadPoolExecutor(min(n, _TREES_AT_ONCE)) as pool:
                return _forest(spark, estimator, list(pool.map(one, range(n))), len(table.points))
        trees, weights = [], []
        for i in range(n):
            frame = with_points(_draw(draws, i, table), table.points)
            if trees:
                so_far = boosted(spark, estimator, trees, weights, _FEATURES, "__sum").transform(frame)
                frame = so_far.withColumn(_LABEL, (F.col(_LABEL) - F.col("__sum")) * 2.0).drop("__sum")
            trees.append(own.fit(frame))
            weights.append(estimator.getStepSize() if i else 1.0)
        return boosted(spark, estimator, trees, weights, estimator.getFeaturesCol(), estimator.getPredictionCol())

    def _draws(self, estimator, table: Cells, n: int, rate: float, replace: bool) -> DataFrame:
        """A row for each cell (a cell of many rows: a few): weight ``w<i>``
        and label sum ``s<i>`` of each of ``n`` draws."""
        points, sizes = table.points, [len(p) for p in table.points]
        seed, counts = estimator.getSeed(), _uniform_to_count(rate, replace)
        place = F.lit(0).cast("long")
        for i, p in enumerate(points):
            place = place * F.lit(len(p)) + F.col(f"__c{i}")
        values = self.values(estimator.getFeaturesCol(), estimator.getLabelCol(), len(points))
        rows = self._coded(values, points).select(place.alias("cell"), F.col("__y").alias("y"))
        parts = max(rows.sparkSession.sparkContext.defaultParallelism, table.n_rows // 1_000_000)
        spread = rows.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(parts, "cell", "at")

        def summed(batches):
            from pyspark import TaskContext
            rng = np.random.default_rng([seed % (1 << 63), TaskContext.get().partitionId()])
            places, w, s, used = {}, np.zeros((64, n)), np.zeros((64, n)), 0
            for pdf in (b.iloc[i:i + _DRAW_ROWS] for b in batches for i in range(0, len(b), _DRAW_ROWS)):
                order = np.argsort(pdf["cell"].to_numpy(), kind="stable")
                cell, y = pdf["cell"].to_numpy()[order], pdf["y"].to_numpy()[order]
                found, start = np.unique(cell, return_index=True)
                drawn = counts[rng.integers(0, 1 << 16, (len(cell), n), dtype=np.uint16)].astype(np.float64)
                at = np.array([places.setdefault(int(c), len(places)) for c in found])
                while len(places) > len(w):
                    w, s = np.vstack([w, np.zeros_like(w)]), np.vstack([s, np.zeros_like(s)])
                w[at] += np.add.reduceat(drawn, start, axis=0)
                s[at] += np.add.reduceat(drawn * y[:, None], start, axis=0)
                used = len(places)
            ids = np.fromiter(places, np.int64, used)
            for i in range(0, used, _DRAW_ROWS):
                part = slice(i, min(i + _DRAW_ROWS, used))
                out, rest = {}, ids[part]
                for j in reversed(range(len(sizes))):
                    rest, out[f"__c{j}"] = np.divmod(rest, sizes[j])
                for t in range(n):
                    out[f"w{t}"], out[f"s{t}"] = w[part, t], s[part, t]
                yield pd.DataFrame(out)

        schema = ", ".join(f"__c{j} long" for j in range(len(sizes))) + ", " + ", ".join(f"w{t} double, s{t} double" for t in range(n))
        return written(spread.mapInPandas(summed, schema), "drawn-cells")


def _draw(draws: DataFrame, i: int, table: Cells) -> DataFrame:
    """The cells of one draw: codes, weight and mean label."""
    return draws.filter(F.col(f"w{i}") > 0).select(
        *[F.col(f"__c{j}").cast("int").alias(f"__c{j}") for j in range(len(table.points))], F.col(f"w{i}").alias(_WEIGHT),
        (F.col(f"s{i}") / F.col(f"w{i}")).alias(_LABEL))


def with_points(frame: DataFrame, points: list[np.ndarray]) -> DataFrame:
    """Adds the feature vector of the values that stand for a cell's bins."""
    names = [f"__p{i}" for i in range(len(points))]
    out = frame.withColumns({c: F.element_at(F.lit(p.tolist()), F.col(f"__c{i}") + 1)
                             for i, (c, p) in enumerate(zip(names, points))})
    return VectorAssembler(inputCols=names, outputCol=_FEATURES).transform(out).drop(*names)


def _sums_suffice(estimator) -> bool:
    if estimator.getOrDefault("impurity") != "variance" or (estimator.hasParam("weightCol") and estimator.isSet("weightCol")):
        return False
    if isinstance(estimator, DecisionTreeRegressor):
        return True
    if estimator.getFeatureSubsetStrategy() not in ("all", "1.0"):
        return False
    return isinstance(estimator, RandomForestRegressor) or (
        estimator.getLossType() == "squared" and not estimator.isSet("validationIndicatorCol"))


def _on_cells(table: Cells, own: dict[str, Any]) -> dict[str, Any]:
    """Tree parameters for cells. The least rows of a node become the least
    weight; with bins enough for Spark to look at every cell, its candidates
    are all values that stand for a bin."""
    least = (own["minInstancesPerNode"] - 0.5) / table.n_rows if own["minInstancesPerNode"] > 1 else 0.0
    return own | {"minInstancesPerNode": 1, "minWeightFractionPerNode": min(0.499, max(own["minWeightFractionPerNode"], least)),
                  "maxBins": max(own["maxBins"], math.isqrt(table.n_cells) + 2)}


_OWN = ("maxDepth", "maxBins", "minInstancesPerNode", "minWeightFractionPerNode", "minInfoGain", "maxMemoryInMB", "cacheNodeIds")


def _tree_of(estimator, table: Cells) -> DecisionTreeRegressor:
    own = {p: estimator.getOrDefault(p) for p in _OWN}
    return DecisionTreeRegressor(featuresCol=_FEATURES, labelCol=_LABEL, weightCol=_WEIGHT, predictionCol="__tree",
                                 impurity="variance", seed=estimator.getSeed(), **_on_cells(table, own))


def _fit_cells(estimator, frame: DataFrame, table: Cells):
    own = _on_cells(table, {p: estimator.getOrDefault(p) for p in _OWN})
    own |= {"featuresCol": _FEATURES, "labelCol": _LABEL, "weightCol": _WEIGHT}
    model = estimator.copy({estimator.getParam(k): v for k, v in own.items()}).fit(frame)
    model = model.copy({model.featuresCol: estimator.getFeaturesCol(), model.labelCol: estimator.getLabelCol()})
    model.clear(model.weightCol)  # only cells have this column; a model's errors are taken on rows
    return model


def _java_trees(spark, trees: list):
    gateway = spark.sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml.regression
    java = gateway.new_array(ml.DecisionTreeRegressionModel, len(trees))
    for i, t in enumerate(trees):
        java[i] = t._java_obj
    return gateway, ml, java


def _wrapped(kind, java, estimator, features: str, pred: str):
    model = kind(java)
    model._resetUid(java.uid())
    model._transfer_params_from_java()
    return model.copy({model.featuresCol: features, model.labelCol: estimator.getLabelCol(), model.predictionCol: pred})


def boosted(spark, estimator, trees: list, weights: list[float], features: str, pred: str) -> GBTRegressionModel:
    """The trees as one of Spark's own boosted models."""
    gateway, ml, java_trees = _java_trees(spark, trees)
    java_weights = gateway.new_array(gateway.jvm.double, len(weights))
    for i, w in enumerate(weights):
        java_weights[i] = float(w)
    java = ml.GBTRegressionModel(f"GBTRegressor_{uuid.uuid4().hex[:12]}", java_trees, java_weights)
    return _wrapped(GBTRegressionModel, java, estimator, features, pred)


def _forest(spark, estimator, trees: list, width: int) -> RandomForestRegressionModel:
    _, ml, java_trees = _java_trees(spark, trees)
    java = ml.RandomForestRegressionModel(f"RandomForestRegressor_{uuid.uuid4().hex[:12]}", java_trees, width)
    model = _wrapped(RandomForestRegressionModel, java, estimator, estimator.getFeaturesCol(), estimator.getPredictionCol())
    return model.copy({model.numTrees: len(trees)})  # the sum of predictions is divided by this parameter


@contextmanager
def training(df: DataFrame, by: Sequence[str] = ()):
    """The rows of ``df`` for several fits; released at the end."""
    rows = TrainingRows(df, by)
    try:
        yield rows
    finally:
        rows.release()
