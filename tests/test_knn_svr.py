"""Approximate neighbours against exact ones; the kernel SVR's features and fit."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabreg.operators import knn, knn_approx
from tabreg.operators import models as M

VECTORS = "vec_id long, embedding array<double>, label double"


def _points(spark, x, first=0):
    return spark.createDataFrame([(first + i, v.tolist(), float(i % 7)) for i, v in enumerate(x)], VECTORS)


def test_cheapest_sets():
    rng = np.random.default_rng(0)
    for width in (0, 1, 4, 9):
        costs = np.sort(rng.uniform(0, 1, width))
        every = sorted((sum(costs[list(s)]) if s else 0.0) for r in range(width + 1) for s in itertools.combinations(range(width), r))
        got = knn_approx.cheapest_sets(costs, 1 << width)
        assert len(set(got)) == 1 << width
        assert np.allclose([sum(costs[list(s)]) if s else 0.0 for s in got], every)
        for limit in rng.uniform(0, 3, 5):
            assert knn_approx._sets_below(costs, limit) == sum(e < limit - 1e-9 * (1 + limit) for e in every)


def test_probe_order_and_ranks_agree():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(20, 6)), rng.normal(size=(20, 6))
    index = knn_approx.ProjectionIndex(rng.normal(size=(3, 6, 7)), rng.normal(size=(3, 7)))
    order, home = index.probe_order(x, 128), index.buckets(y)
    assert all(sorted(o) == list(range(128)) for row in order for o in row)
    want = [min(int(np.flatnonzero(order[i, t] == home[i, t])[0]) for t in range(3)) for i in range(20)]
    assert knn_approx._bucket_ranks(index, x, list(enumerate(y))).tolist() == want


@pytest.mark.parametrize("rows,tables", [(32, 8), (64, 2)])
def test_recall_on_given_embeddings(spark, rows, tables):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    train, asked = e.filter("vec_id % 20 <> 0"), e.filter("vec_id % 20 = 0")
    args = (train, asked, "vec_id", "embedding", "label", 5)
    found = knn_approx.approximate_neighbours(*args, bucket_rows=rows, tables=tables).cache()
    exact = knn.exact_neighbours(*args)
    assert knn_approx.recall(found, exact).agg(F.avg("recall")).first()[0] >= 0.9
    assert found.count() == 5 * asked.count() == 5 * found.select("q_id", "t_id").distinct().count() / 5
    # distances of what is found are exact
    both = found.join(exact.select("q_id", "t_id", F.col("d2").alias("exact_d2")), ["q_id", "t_id"])
    assert both.filter("d2 <> exact_d2").count() == 0


def test_clustered_points_need_few_buckets(spark):
    """Neighbours in a cluster: a small part of all pairs is compared."""
    rng = np.random.default_rng(2)
    centers = rng.normal(0, 10, (40, 16))
    x = centers[rng.integers(0, 40, 4000)] + rng.normal(0, 0.3, (4000, 16))
    q = centers[rng.integers(0, 40, 60)] + rng.normal(0, 0.3, (60, 16))
    train, asked = _points(spark, x), _points(spark, q, 10_000)
    args = (train, asked, "vec_id", "embedding", "label", 5)
    found = knn_approx.approximate_neighbours(*args, tables=4).cache()
    assert knn_approx.recall(found, knn.exact_neighbours(*args)).agg(F.avg("recall")).first()[0] >= 0.9
    assert found.agg(F.avg("compared")).first()[0] < 0.25 * 4000


def test_hot_bucket_is_tiled(spark):
    """A third of the points are copies of one: its bucket is many tiles, and nothing is lost."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 5))
    x[::3] = x[0]
    train, asked = _points(spark, x), _points(spark, rng.normal(size=(12, 5)), 1000)
    index = knn_approx.fit_index(train, "vec_id", "embedding", k=4, bucket_rows=100, tables=2, recall=1.0, margin=0.0)
    index.probes = 1 << index.bits
    args = (train, asked, "vec_id", "embedding", "label", 4)
    found = knn_approx.approximate_neighbours(*args, index=index, tile_rows=20)
    key = lambda df: sorted((r["q_id"], r["t_id"], r["d2"], r["rank"]) for r in df.collect())
    assert key(found.drop("compared")) == key(knn.exact_neighbours(*args))


def test_few_or_no_points(spark):
    rng = np.random.default_rng(4)
    asked = _points(spark, rng.normal(size=(3, 4)), 100)
    one = knn_approx.knn_regress_approximate(_points(spark, rng.normal(size=(1, 4))), asked, "vec_id", "embedding", "label")
    assert {r["prediction"] for r in one.collect()} == {0.0} and one.count() == 3
    none = spark.createDataFrame([], VECTORS)
    assert knn_approx.approximate_neighbours(none, asked, "vec_id", "embedding", "label").collect() == []
    assert knn_approx.approximate_neighbours(_points(spark, rng.normal(size=(9, 4))), none, "vec_id", "embedding", "label").collect() == []


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 3))
    want = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(-1))
    errors = []
    for n in (100, 400, 6400):
        lift = M.FourierFeatures(3, n, gamma=0.5)
        errors.append(np.abs(lift(x) @ lift(x).T - want))
    # Hoeffding: each entry is a mean of n terms within [-2, 2], the chance of a larger error below 1e-6 for all pairs
    for n, e in zip((100, 400, 6400), errors):
        assert e.max() <= np.sqrt(8 * np.log(2 * 60 * 60 / 1e-6) / n)
    assert errors[2].mean() < 0.3 * errors[0].mean()


def test_kernel_svr_beats_linear_on_a_ring(spark):
    rng = np.random.default_rng(6)
    x = rng.uniform(-2, 2, (1500, 2))
    y = 10 * np.exp(-8 * (np.hypot(*x.T) - 1.2) ** 2) + rng.normal(0, 0.1, 1500)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    rmse = lambda m, f: f(m).transform(df).select(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    linear = rmse(M.fit_linear_svr(df, ["a", "b"], "y"), lambda m: m)
    model = M.fit_kernel_svr(df, ["a", "b"], "y", C=100.0, n_features=160, gamma=3.0)
    assert model.converged and rmse(model, lambda m: m) < 0.35 * linear
    # the same model on any partitioning, nulls have no prediction
    again = M.fit_kernel_svr(df.repartition(5), ["a", "b"], "y", C=100.0, n_features=160, gamma=3.0)
    assert np.allclose(again.theta, model.theta, atol=0.02)
    odd = spark.createDataFrame([(None, 1.0), (0.5, 1.0)], "a double, b double")
    assert [r["prediction"] is None for r in model.transform(odd).collect()] == [True, False]


def test_svr_of_many_rows_passes_over_them_a_few_times(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.uniform(-2, 2, (4000, 2))
    y = np.sin(2 * x[:, 0]) * x[:, 1] + rng.normal(0, 0.1, 4000)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    passes, plain = [], M._svr_sums
    monkeypatch.setattr(M, "_svr_sums", lambda data, *a: passes.append(data.count()) or plain(data, *a))
    fit = lambda: M.fit_linear_svr(df, ["a", "b"], "y", epsilon=0.05)
    whole = fit()
    before = len(passes)
    assert set(passes) == {4000}
    monkeypatch.setattr(M, "_START_ROWS", 390)
    passes.clear()
    started = fit()
    assert started.converged and abs(started.objective / whole.objective - 1) < 3e-3
    assert max(passes[:3]) < 600 and 0 < passes.count(4000) < 0.7 * before


def test_search_steps_are_bounded_by_pairs(monkeypatch):
    """Distances to all pivots are held for a bounded number of rows at once, whatever the batch."""
    rng = np.random.default_rng(8)
    pivots = rng.normal(size=(64, 4))
    sizes, plain = [], knn._pivot_distances
    monkeypatch.setattr(knn, "_BLOCK_PAIRS", 6400)
    monkeypatch.setattr(knn, "_pivot_distances", lambda v, p: sizes.append(len(v) * len(p)) or plain(v, p))
    batch = pd.DataFrame({"t_id": range(1000), "t_vec": list(rng.normal(size=(1000, 4))), "t_label": 0.0})
    cells = pd.concat(list(knn._assigned(pivots)([batch])))
    d = plain(batch["t_vec"], pivots)
    assert (cells["cell"].to_numpy() == d.argmin(1)).all() and (cells["d_cell"].to_numpy() == d.min(1)).all()
    count = np.bincount(cells["cell"], minlength=64)
    radius = np.array([cells["d_cell"][cells["cell"] == c].max() if count[c] else -np.inf for c in range(64)])
    asked = pd.DataFrame({"q_id": range(500), "q_vec": list(rng.normal(size=(500, 4)))})
    reached = knn._reached(pivots, radius, count, 5)
    parts = pd.concat(list(reached([asked])))
    assert max(sizes) <= 6400 and parts["q_id"].tolist() == list(range(500))
    monkeypatch.setattr(knn, "_BLOCK_PAIRS", 10 ** 9)
    whole = pd.concat(list(reached([asked])))
    assert [c.tolist() for c in parts["cells"]] == [c.tolist() for c in whole["cells"]]
