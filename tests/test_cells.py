"""Tree fits on cells: the trees and errors of the rows themselves."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabreg.operators import boosting as B
from tabreg.operators import cells as C
from tabreg.operators import models as M


@pytest.fixture(scope="module")
def rows(spark):
    """3,000 rows; 240 cells of the first two features, the third has more values than bins."""
    rng = np.random.default_rng(1)
    a, b, c = rng.integers(0, 12, 3000), rng.integers(0, 20, 3000) * 0.5, rng.random(3000)
    y = 3.0 * a - b * b + 4 * (c > 0.4) + rng.normal(0, 2, 3000)
    df = spark.createDataFrame([(i, float(p), float(q), float(r), float(z)) for i, (p, q, r, z) in enumerate(zip(a, b, c, y))],
                               "id long, a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()


def _predicted(model, df):
    return np.array([r[0] for r in M.predict(model, df, "p").orderBy("id").select("p").collect()])


def _both(monkeypatch, fit):
    direct = fit()
    monkeypatch.setattr(C, "DIRECT_ROWS", 100)
    seen, plain = [], C.with_points
    monkeypatch.setattr(C, "with_points", lambda *a: seen.append(1) or plain(*a))
    return direct, fit(), bool(seen)


@pytest.mark.parametrize("build", [
    lambda: M.decision_tree(5), lambda: M.decision_tree(6).setMinInstancesPerNode(40),
    lambda: M.gbt("classic", n_estimators=4)])
def test_cells_give_the_trees_of_the_rows(rows, monkeypatch, build):
    direct, by_cells, used = _both(monkeypatch, lambda: M.fit(build(), rows))
    assert used and np.allclose(_predicted(direct, rows), _predicted(by_cells, rows), atol=1e-9)
    assert np.allclose(direct.featureImportances.toArray(), by_cells.featureImportances.toArray(), atol=1e-9)


@pytest.mark.parametrize("build", [
    lambda: M.random_forest(6, 5), lambda: M.gbt("classic", n_estimators=6, subsample=0.7)])
def test_drawn_rows(rows, monkeypatch, build):
    direct, by_cells, used = _both(monkeypatch, lambda: M.fit(build(), rows))
    y = np.array([r[0] for r in rows.orderBy("id").select("label").collect()])
    errors = [np.sqrt(np.mean((_predicted(m, rows) - y) ** 2)) for m in (direct, by_cells)]
    assert used and abs(errors[1] / errors[0] - 1) < 0.1 and len(by_cells.trees) == 6  # over seeds: 3.80 to 3.98 by rows, 3.82 to 4.05 by cells


def test_draws_are_those_of_rows(rows, monkeypatch):
    """Weights are Poisson in the mean and over the trees; label sums are of the drawn rows."""
    monkeypatch.setattr(C, "DIRECT_ROWS", 100)
    with C.training(rows) as t:
        table = t.cells(M.random_forest(8, 5))
        got = t._draws(M.random_forest(8, 5), table, 8, 1.0, True).toPandas()
        counts = table.frame.toPandas()
    w = got[[f"w{i}" for i in range(8)]].to_numpy()
    s = got[[f"s{i}" for i in range(8)]].to_numpy()
    assert np.all(np.abs(w.sum(0) - 3000) < 5 * np.sqrt(3000)) and len({tuple(c) for c in w.T}) == 8
    assert counts["__cell_n"].sum() == 3000
    means = counts.set_index(["__c0", "__c1"])["__cell_y"]
    total = (means * counts.set_index(["__c0", "__c1"])["__cell_n"]).sum()
    assert np.all(np.abs(s.sum(0) - total) < 0.15 * abs(total) + 3000)


def test_thresholds_part_rows_as_they_part_cells(spark, rows, monkeypatch):
    """More values than bins: what a cell's rows are predicted is their leaf's mean."""
    monkeypatch.setattr(C, "DIRECT_ROWS", 100)
    x = VectorAssembler(inputCols=["a", "c"], outputCol="x").transform(rows)
    p = M.fit(M.decision_tree(4, features="x"), x).transform(x)
    leaves = p.groupBy("prediction").agg(F.avg("label").alias("m")).collect()
    assert len(leaves) > 8 and all(abs(r["m"] - r["prediction"]) < 1e-9 for r in leaves)


def test_stopped_boosting_and_folds_on_cells(spark, rows, monkeypatch):
    train, val = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    est = M.gbt("binned", iterations=6, depth=3, learning_rate=0.5)
    (_, curve, stop), (model, by_cells, same), used = _both(monkeypatch, lambda: B.boost_until_stopped(est, train, val, 2))
    assert used and stop["stop_round"] == same["stop_round"] and np.allclose(curve, by_cells)
    with C.training(rows.withColumn("f", F.col("id") % 3), ["f"]) as t:
        out = _predicted(t.fit(M.decision_tree(4), F.col("f") != 0), val)
        monkeypatch.setattr(C, "DIRECT_ROWS", 10 ** 9)
        assert np.allclose(out, _predicted(M.fit(M.decision_tree(4), train), val), atol=1e-9)


def test_rows_with_nulls_are_not_grouped(spark, rows, monkeypatch):
    monkeypatch.setattr(C, "DIRECT_ROWS", 100)
    holes = rows.withColumn("label", F.when(F.col("id") != 7, F.col("label")))
    with C.training(holes) as t:
        assert t.cells(M.decision_tree(3)) is None


def test_learning_curve_of_stumps_fitted_on_cells(spark, rows, monkeypatch):
    """The model is fitted on weighted cells; its errors are those of the rows, which have no weight."""
    est = lambda: M.gbt("classic", n_estimators=4, max_depth=1, max_bin=64)
    curve = lambda: [r["value"] for r in M.learning_curve(spark, M.fit(est(), rows), {"v": rows}).orderBy("round").collect()]
    direct, by_cells, used = _both(monkeypatch, curve)
    assert used and len(by_cells) == 4 and np.allclose(direct, by_cells, atol=1e-9)


def test_learning_curve_of_both_metrics_on_two_datasets(spark, rows, monkeypatch):
    train, test = rows.filter("id % 4 > 0"), rows.filter("id % 4 = 0")
    est = lambda: M.gbt("histogram", n_estimators=2, max_depth=3)
    curve = lambda: M.learning_curve(spark, M.fit(est(), train), {"train": train, "test": test},
                                     {"rmse": "squared", "mae": "absolute"}).orderBy("dataset", "metric", "round").collect()
    direct, by_cells, used = _both(monkeypatch, curve)
    assert used and len(by_cells) == 8 and [r[:3] for r in direct] == [r[:3] for r in by_cells]
    assert np.allclose([r["value"] for r in direct], [r["value"] for r in by_cells], atol=1e-9)
