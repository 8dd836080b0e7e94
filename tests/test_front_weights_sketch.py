"""Skyline, active-set weights and mergeable profiles against plain computations."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabreg.operators import ensemble as N
from tabreg.operators import evaluate as E
from tabreg.operators import sketch as S


def _by_supports(H):
    """Every support's optimum on its plane; the best feasible one."""
    best = None
    for size in range(1, len(H) + 1):
        for s in map(list, itertools.combinations(range(len(H)), size)):
            u = np.linalg.pinv(H[np.ix_(s, s)]) @ np.ones(size)
            if u.sum() > 1e-12 and (u / u.sum() >= -1e-12).all():
                w = np.zeros(len(H))
                w[s] = u / u.sum()
                best = min(best or math.inf, float(w @ H @ w))
    return best


@pytest.mark.parametrize("seed", range(25))
def test_weights_equal_all_supports(seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 11))
    errors = rng.normal(rng.normal(0, 1, k), rng.uniform(0.1, 3, k), (60, k)) + rng.normal(0, 2, (60, 1))
    if seed % 3 == 0 and k > 2:  # dependent models
        errors[:, 1] = errors[:, 0]
        errors[:, 2] = (errors[:, 0] + errors[:, -1]) / 2
    H = errors.T @ errors * 10.0 ** rng.integers(-6, 9)
    w = N.simplex_least_squares(H)
    assert (w >= 0).all() and abs(w.sum() - 1) < 1e-12
    assert w @ H @ w <= _by_supports(H) * (1 + 1e-9) + 1e-9 * H.max() * 1e-3


def test_two_hundred_models_with_a_certificate():
    rng = np.random.default_rng(0)
    errors = rng.normal(0, 1, (1000, 200)) * rng.uniform(0.5, 2, 200) + rng.normal(0, 0.5, (1000, 1))
    H = errors.T @ errors / 1000
    w = N.simplex_least_squares(H)
    g = H @ w
    assert 2 * (w @ g - g.min()) < 1e-9 * H.max() and (w > 0).sum() > 20
    few = rng.normal(0, 1, (40, 200))  # rank 40
    H = few.T @ few
    w = N.simplex_least_squares(H)
    assert 2 * (w @ H @ w - (H @ w).min()) < 1e-6 * H.max()


def _front(rows):
    return sorted(r for r in rows if None not in r[1:] and not any(
        None not in o[1:] and o[1] <= r[1] and o[2] <= r[2] and (o[1] < r[1] or o[2] < r[2]) for o in rows))


@pytest.mark.parametrize("n,values", [(0, 5), (1, 5), (300, 6), (400, 1000), (50, 1)])
def test_trade_off_equals_dominance(spark, n, values):
    rng = random.Random(n + values)
    rows = [(i, float(rng.randrange(values)) if i % 17 else None, float(rng.randrange(values))) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, cost double, error double").repartition(5)
    assert sorted(map(tuple, E.trade_off(df, "cost", "error").collect())) == _front(rows)


def test_trade_off_of_many_rows_with_ties(spark):
    n = 100_000
    df = spark.range(n).select("id", ((F.col("id") * 7919) % 5003).alias("cost"), ((F.col("id") * 104729) % 4999).alias("error"))
    got = {(r["cost"], r["error"]) for r in E.trade_off(df, "cost", "error").collect()}
    best, want = math.inf, set()
    pairs = sorted({((i * 7919) % 5003, (i * 104729) % 4999) for i in range(n)})
    for c, e in pairs:
        if e < best:
            best = e
            want.add((c, e))
    assert got == want


def test_merged_state_is_within_the_bounds(spark):
    rng = np.random.default_rng(1)
    x = rng.lognormal(0, 2, 30_000)
    rows = [(i, float(v) if i % 10 else None, f"k{i % 7001}") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, x double, name string")
    cols = ["id", "x", "name"]
    days = [S.profile_state(df.filter(F.col("id") % 3 == d).repartition(2), cols) for d in range(3)]
    one = S.profile_of(S.profile_state(df, cols)).collect()
    both = S.profile_of(S.merged(S.merged(days[0], days[1]), days[2])).collect()
    values = np.sort([r[1] for r in rows if r[1] is not None])
    for r in (*one, *both):
        want = {"id": 30_000, "x": len(values), "name": 7001}[r["column"]]
        assert r["n_rows"] == 30_000 and abs(r["n_distinct"] / want - 1) < 4 * S.distinct_error()
        assert r["null_ratio"] == (0.1 if r["column"] == "x" else 0.0)
        if r["column"] == "x":
            assert (r["low"], r["high"]) == (values[0], values[-1]) and abs(r["mean"] / values.mean() - 1) < 1e-9
            for q, v in zip((0.25, 0.5, 0.75), r["quantiles"]):
                assert abs(np.searchsorted(values, v) / len(values) - q) < 2 * S.rank_error()
        if r["column"] == "name":
            assert r["quantiles"] is None and r["mean"] is None
    assert S.merged(days[0], S.profile_state(df.filter("false"), cols)).count() == 3
