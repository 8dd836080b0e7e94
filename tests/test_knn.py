import numpy as np
import pytest

from tabreg.operators.knn import knn_regress


@pytest.mark.parametrize("query_block_rows", [20_000, 7])
def test_knn_matches_brute_force_with_hot_cell(spark, query_block_rows):
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 10, (6, 8))
    pts = np.concatenate([c + rng.normal(0, 0.5, (60, 8)) for c in centers])
    pts = np.concatenate([pts, np.repeat(pts[:1], 150, axis=0)])  # one hot cell of duplicates
    labels = rng.integers(0, 100, len(pts)).astype(float)
    ids = np.arange(len(pts))
    q_mask = ids % 5 == 0
    rows = [(int(i), [float(x) for x in v], float(l)) for i, v, l in zip(ids, pts, labels)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y double")
    train = df.filter("id % 5 <> 0")
    query = df.filter("id % 5 = 0")
    got = {r.id: r.prediction for r in
           knn_regress(train, query, "id", "v", "y", k=4, chunk_rows=40,
                             query_block_rows=query_block_rows).collect()}
    tr_ids = ids[~q_mask]
    for q in ids[q_mask]:
        d2 = np.round(((pts[tr_ids] - pts[q]) ** 2).sum(1), 9)
        order = np.lexsort((tr_ids, d2))[:4]
        assert abs(got[int(q)] - labels[tr_ids[order]].mean()) < 1e-9
