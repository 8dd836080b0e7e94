"""Exact k-nearest-neighbour regression (M13) without an all-pairs join.

Metric-space pruning with pivots (triangle inequality):

1. ``P`` pivots are the training points with the smallest hash of their id
   (a bounded ``orderBy().limit(P)``; P is capped, so they fit the driver).
2. Every training point is assigned to its nearest pivot ("cell"); per
   cell we keep the radius ``R_c`` (largest distance to the pivot) and the
   point count - one grouped aggregate, P rows.
3. For a query q, the nearest cells holding at least k points give an upper
   bound ``U_q`` on the distance to its k-th neighbour
   (``d(q, x) <= d(q, p_c) + R_c`` for every x in cell c).
4. A cell can only hold one of the k nearest points if
   ``d(q, p_c) - R_c <= U_q``; only those (query, cell) pairs are joined,
   and the distances there are computed exactly in Spark SQL.
5. Cells are split into chunks of at most ``chunk_rows`` points, and the
   queries that reach a cell into blocks of at most ``query_block_rows``
   (each training chunk is repeated once per query block). A hot cell -
   many identical or clustered points, or a third of all queries - is
   spread over many bounded tiles, never one task. Each tile is one
   cogroup; numpy computes its distances (a matrix product shortlists, the
   shortlist is recomputed exactly) and Spark ranks the shortlists per
   query.

The result equals a brute-force search (ties broken by training id); only
the amount of work depends on how well the data clusters.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.session import cut_lineage

MAX_PIVOTS = 1024
_SLACK = 1e-9


def squared_distance(a: Column, b: Column) -> Column:
    """Exact squared Euclidean distance of two numeric arrays, in double."""
    return F.aggregate(
        F.zip_with(a.cast("array<double>"), b.cast("array<double>"),
                   lambda x, y: (x - y) * (x - y)),
        F.lit(0.0), lambda acc, v: acc + v)


def _pivot_distances(vecs: pd.Series, pivots: np.ndarray) -> np.ndarray:
    x = np.stack(vecs.to_numpy()).astype(np.float64)
    d2 = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2.0 * x @ pivots.T
    return np.sqrt(np.maximum(d2, 0.0))


def _blocks(batches, n_pivots: int):
    """Slices of the batches with at most ``_BLOCK_PAIRS`` / 8 distances to
    pivots: the dozen arrays of that size in a search step stay bounded."""
    rows = max(1, _BLOCK_PAIRS // (8 * n_pivots))
    for pdf in batches:
        for i in range(0, len(pdf), rows):
            yield pdf.iloc[i:i + rows].copy()


def _assigned(pivots: np.ndarray):
    """Adds each training point's cell and its distance to that pivot."""
    def assign(it):
        for pdf in _blocks(it, len(pivots)):
            d = _pivot_distances(pdf["t_vec"], pivots)
            c = d.argmin(1)
            pdf["cell"] = c.astype("int32")
            pdf["d_cell"] = d[np.arange(len(c)), c]
            yield pdf
    return assign


def _reached(pivots: np.ndarray, radius: np.ndarray, count: np.ndarray, k: int):
    """Adds the cells that can hold one of a query's k nearest points."""
    nonempty = count > 0

    def candidates(it):
        for pdf in _blocks(it, len(pivots)):
            d = _pivot_distances(pdf["q_vec"], pivots)
            order = np.argsort(np.where(nonempty, d, np.inf), axis=1, kind="stable")
            cum = np.cumsum(count[order], axis=1)
            reach = np.where(nonempty[order], np.take_along_axis(d, order, 1) + radius[order],
                             -np.inf)
            run_max = np.maximum.accumulate(reach, axis=1)
            hit = cum >= k
            idx = np.where(hit.any(1), hit.argmax(1), d.shape[1] - 1)
            upper = run_max[np.arange(len(idx)), idx]
            bound = upper * (1 + _SLACK) + _SLACK
            mask = nonempty[None, :] & (d - radius[None, :] <= bound[:, None])
            pdf["cells"] = [np.nonzero(m)[0].astype("int32") for m in mask]
            yield pdf
    return candidates


def knn_regress(train: DataFrame, query: DataFrame, id_col: str, vec_col: str,
                label_col: str, k: int = 5, n_pivots: int | None = None,
                chunk_rows: int = 20_000, query_block_rows: int = 20_000,
                out: str = "prediction") -> DataFrame:
    """Mean label of the k nearest training points of every query row.

    Returns ``id_col, out, kth_dist2`` (squared distance to the k-th
    neighbour), one row per query. Distances are ranked on their value
    rounded to 9 decimals, ties by training id.
    """
    return _regressed(exact_neighbours(train, query, id_col, vec_col, label_col, k, n_pivots, chunk_rows,
                                       query_block_rows), id_col, out)


def _regressed(neighbours: DataFrame, id_col: str, out: str) -> DataFrame:
    return neighbours.groupBy("q_id").agg(F.avg("t_label").alias(out), F.max("d2").alias("kth_dist2")) \
        .withColumnRenamed("q_id", id_col)


_NEIGHBOURS = "t_label double, d2 double"


def _top(short: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query's shortlists, by rounded distance, then id."""
    nearest = Window.partitionBy("q_id").orderBy("d2", "t_id")  # a bounded shortlist for each tile
    return short.withColumn("d2", F.round("d2", 9)).withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)


def _no_neighbours(train: DataFrame, query: DataFrame, id_col: str) -> DataFrame:
    kinds = [f.schema[id_col].dataType.simpleString() for f in (query, train)]
    return train.sparkSession.createDataFrame([], f"q_id {kinds[0]}, t_id {kinds[1]}, {_NEIGHBOURS}, rank int")


def exact_neighbours(train: DataFrame, query: DataFrame, id_col: str, vec_col: str, label_col: str, k: int = 5,
                     n_pivots: int | None = None, chunk_rows: int = 20_000,
                     query_block_rows: int = 20_000) -> DataFrame:
    """(q_id, t_id, t_label, d2, rank): the k nearest training points of every query row."""
    t = train.select(F.col(id_col).alias("t_id"), F.col(vec_col).alias("t_vec"),
                     F.col(label_col).cast("double").alias("t_label"))
    n_train = t.count()
    if n_train == 0:
        return _no_neighbours(train, query, id_col)
    p = n_pivots or min(MAX_PIVOTS, max(1, int(math.sqrt(n_train))))
    piv_rows = t.orderBy(F.xxhash64("t_id"), "t_id").limit(p).select("t_vec").collect()
    pivots = np.array([r["t_vec"] for r in piv_rows], dtype=np.float64)

    # -- 1. assign training points to cells
    t_schema = T.StructType(t.schema.fields + [T.StructField("cell", T.IntegerType()),
                                               T.StructField("d_cell", T.DoubleType())])
    assigned = cut_lineage(t.mapInPandas(_assigned(pivots), t_schema))  # read by 2 jobs + the join
    stats = assigned.groupBy("cell").agg(F.max("d_cell").alias("r"),
                                         F.count(F.lit(1)).alias("n")).collect()  # <= P rows
    radius = np.full(len(pivots), -np.inf)
    count = np.zeros(len(pivots), dtype=np.int64)
    for r in stats:
        radius[r["cell"]], count[r["cell"]] = r["r"], r["n"]
    chunks = {int(c): max(1, math.ceil(n / chunk_rows)) for c, n in enumerate(count) if n > 0}

    # -- 2. candidate cells per query
    q = query.select(F.col(id_col).alias("q_id"), F.col(vec_col).alias("q_vec"))
    q_schema = T.StructType(q.schema.fields + [
        T.StructField("cells", T.ArrayType(T.IntegerType()))])
    qc = cut_lineage(q.mapInPandas(_reached(pivots, radius, count, k), q_schema).select(
        "q_id", "q_vec", F.explode("cells").alias("cell")))  # counted, then joined
    q_count = {int(r["cell"]): int(r["n"]) for r in
               qc.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= P rows
    blocks = {c: max(1, math.ceil(n / query_block_rows)) for c, n in q_count.items()}

    # -- 3. split every cell into (query block x training chunk) tiles of at
    #       most query_block_rows x chunk_rows pairs: a cell that draws a
    #       third of all queries is spread over many tasks, not one
    def cell_lookup(m: dict[int, int]) -> Column:
        if not m:
            return F.lit(1)
        lm = F.create_map(*[x for c, v in m.items() for x in (F.lit(c), F.lit(v))])
        return F.coalesce(F.element_at(lm, F.col("cell")), F.lit(1))
    n_chunks, n_blocks = cell_lookup(chunks), cell_lookup(blocks)
    qc = qc.withColumns({"qblock": F.pmod(F.xxhash64("q_id"), n_blocks).cast("int"),
                         "chunk": F.explode(F.sequence(F.lit(0), n_chunks - 1))})
    tc = assigned.withColumns({"chunk": F.pmod(F.xxhash64("t_id"), n_chunks).cast("int"),
                               "qblock": F.explode(F.sequence(F.lit(0), n_blocks - 1))}) \
        .drop("d_cell")
    # every tile is one cogroup (bounded on both sides); distances run in
    # numpy per tile and only each query's shortlist leaves the task
    tile = ["cell", "chunk", "qblock"]
    out_schema = T.StructType([T.StructField("q_id", q.schema["q_id"].dataType),
                               T.StructField("t_id", t.schema["t_id"].dataType),
                               T.StructField("t_label", T.DoubleType()),
                               T.StructField("d2", T.DoubleType())])
    short = qc.groupBy(*tile).cogroup(tc.groupBy(*tile)).applyInPandas(
        _tile_shortlist(k), out_schema)
    return _top(short, k)


_EPS = np.finfo(np.float64).eps
_BLOCK_PAIRS = 4_000_000   # distance-matrix cells per numpy step (32 MB)


def _tile_shortlist(k: int):
    """Per tile: the training rows that can be among a query's k nearest.

    ``|q|^2 + |t|^2 - 2 q.t`` (one matrix product) gives approximate
    distances with a proven error bound; rows within the k-th smallest +
    rounding step + twice that bound are recomputed exactly, summing
    ``(q_i - t_i)^2`` left to right (as ``aggregate(zip_with(...))`` would).
    Kept are the rows within one rounding step (1e-9) of the exact k-th
    distance - only they can win once Spark ranks by the value rounded to 9
    decimals - and of identical values only the k smallest ids (ties go by
    id), so copies of one point never multiply the output.
    """
    def fn(qdf: pd.DataFrame, tdf: pd.DataFrame) -> pd.DataFrame:
        cols = ["q_id", "t_id", "t_label", "d2"]
        if qdf.empty or tdf.empty:
            return pd.DataFrame({c: [] for c in cols})
        Q = np.stack(qdf["q_vec"].to_numpy()).astype(np.float64)
        Tm = np.stack(tdf["t_vec"].to_numpy()).astype(np.float64)
        qn, tn = (Q * Q).sum(1), (Tm * Tm).sum(1)
        d = Q.shape[1]
        kk = min(k, len(Tm))
        t_ids, t_lab = tdf["t_id"].to_numpy(), tdf["t_label"].to_numpy(dtype=np.float64)
        q_ids = qdf["q_id"].to_numpy()
        step = max(1, _BLOCK_PAIRS // len(Tm))
        parts = []
        for s0 in range(0, len(Q), step):
            qb = Q[s0:s0 + step]
            approx = qn[s0:s0 + step, None] + tn[None, :] - 2.0 * (qb @ Tm.T)
            err = (2 * d + 8) * _EPS * (qn[s0:s0 + step] + tn.max())
            kth = np.partition(approx, kk - 1, axis=1)[:, kk - 1]
            rows, cand = np.nonzero(approx <= (kth + 2e-9 + 2.0 * err)[:, None])
            diff = qb[rows] - Tm[cand]
            c = pd.DataFrame({"row": rows, "t_id": t_ids[cand], "t_label": t_lab[cand],
                              "d2": np.cumsum(diff * diff, axis=1)[:, -1]})
            c = c.sort_values(["row", "d2", "t_id"], kind="stable")
            rank = c.groupby("row").cumcount().to_numpy()
            ek = c["d2"].to_numpy()[rank == kk - 1]        # exact k-th per query
            limit = ek + 1e-9 + 1e-12 * np.abs(ek)
            keep = (c["d2"].to_numpy() <= limit[c["row"].to_numpy()]) & \
                (c.groupby(["row", "d2"]).cumcount().to_numpy() < k)
            c = c[keep]
            parts.append(pd.DataFrame({"q_id": q_ids[s0 + c["row"].to_numpy()],
                                       "t_id": c["t_id"].to_numpy(),
                                       "t_label": c["t_label"].to_numpy(),
                                       "d2": c["d2"].to_numpy()}))
        return pd.concat(parts, ignore_index=True)
    return fn
