"""Approximate k-nearest neighbours (M13): multi-probe random-projection
buckets, exact re-ranking, and a recall that is measured.

Index: each of ``tables`` tables has its own ``bits`` random directions. A
point's side of each (split at the median of a bounded sample) is a bit, the
bits are its bucket; every training point is in one bucket of each table.
``bits`` follow from the number of points, so buckets keep about
``bucket_rows`` points at any size.

Search: a query probes the buckets in the order of the squared margins that
the point would have to cross, nearest first, the same number in each table.
Bucket and probing queries meet in bounded tiles (as in exact search: a bucket
with a third of all points, or one that a third of the queries probe, is many
tiles), which compute distances and pass on shortlists; Spark ranks these.

The number of probes is found by measuring: for a stated number of calibration
queries the exact neighbours are found among all points, and the rank of the
bucket that holds each of them is known. So the recall of any number of probes
follows at once, and the smallest number is taken that reaches the target. If
no fewer will do, all buckets are probed, which is an exact search.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.operators.knn import _no_neighbours, _regressed, _tile_shortlist, _top
from tabreg.session import written

#: Directions of a table: 2 ** MAX_BITS buckets of each.
MAX_BITS = 30


@dataclass
class ProjectionIndex:
    """``directions`` (tables, width, bits), ``middles`` (tables, bits)."""
    directions: np.ndarray
    middles: np.ndarray
    probes: int = 1
    recall: float = math.nan

    @property
    def bits(self) -> int:
        return self.middles.shape[1]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables, bits): signed distances to the middles."""
        return np.einsum("nd,tdb->ntb", x, self.directions) - self.middles

    def buckets(self, x: np.ndarray) -> np.ndarray:
        return (self.margins(x) > 0) @ (1 << np.arange(self.bits, dtype=np.int64))

    def probe_order(self, x: np.ndarray, probes: int) -> np.ndarray:
        """(rows, tables, probes): buckets by the squared margins to cross."""
        m = self.margins(x)
        home = (m > 0) @ (1 << np.arange(self.bits, dtype=np.int64))
        cost = m * m
        order = np.argsort(cost, axis=2, kind="stable")
        ranked = np.take_along_axis(cost, order, 2)
        out = np.empty((*home.shape, probes), np.int64)
        for i in range(len(x)):
            for t in range(home.shape[1]):
                flips = cheapest_sets(ranked[i, t], probes)
                bit = 1 << order[i, t].astype(np.int64)
                out[i, t] = [home[i, t] ^ sum(int(bit[j]) for j in s) for s in flips]
        return out


def cheapest_sets(costs: np.ndarray, n: int) -> list[tuple[int, ...]]:
    """The ``n`` sets of positions of least total cost; ``costs`` ascend.

    A heap yields them in order: each set's successors replace its last
    position by the next one or add the next one, so every set comes once.
    """
    found: list[tuple[int, ...]] = [()]
    heap = [(float(costs[0]), (0,))] if len(costs) else []
    while heap and len(found) < n:
        total, s = heapq.heappop(heap)
        found.append(s)
        last = s[-1]
        if last + 1 < len(costs):
            step = float(costs[last + 1])
            heapq.heappush(heap, (total + step, (*s, last + 1)))
            heapq.heappush(heap, (total - float(costs[last]) + step, (*s[:-1], last + 1)))
    return found


def _vectors(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def fit_index(train: DataFrame, id_col: str, vec_col: str, k: int = 5, tables: int = 8, bucket_rows: int = 32,
              recall: float = 0.9, margin: float = 0.02, sample_rows: int = 2000, calibration_queries: int = 100,
              seed: int = 17) -> ProjectionIndex:
    """Directions, their middles (from ``sample_rows`` points by hash of the
    id) and the number of probes that reaches ``recall + margin`` on
    ``calibration_queries`` other points against all points."""
    t = train.select(F.col(id_col).alias("t_id"), F.col(vec_col).alias("t_vec"))
    n = t.count()
    drawn = t.orderBy(F.xxhash64("t_id", F.lit(seed)), "t_id").limit(sample_rows + calibration_queries).collect()
    x = np.array([r["t_vec"] for r in drawn], np.float64)
    asked, x = x[:calibration_queries], x[-sample_rows:]
    ids = [r["t_id"] for r in drawn[:calibration_queries]]
    bits = int(min(MAX_BITS, max(0, round(math.log2(max(n, 1) / bucket_rows)))))
    directions = np.random.default_rng(seed).normal(size=(tables, x.shape[1], bits))
    index = ProjectionIndex(directions, np.median(np.einsum("nd,tdb->ntb", x, directions), axis=0))
    near = _calibration_neighbours(t, asked, ids, k)
    # the rank of each true neighbour's bucket among its query's probes, in the best table
    most = 1 << bits
    ranks = _bucket_ranks(index, asked, near)
    ranks = np.sort(ranks)
    need = math.ceil(min(1.0, recall + margin) * len(ranks)) if len(ranks) else 0
    index.probes = int(min(most, ranks[need - 1] + 1)) if need else 1
    index.recall = float((ranks < index.probes).mean()) if len(ranks) else 1.0
    return index


def _calibration_neighbours(t: DataFrame, asked: np.ndarray, ids: list, k: int) -> list[np.ndarray]:
    """Each calibration query's k nearest other points, in one pass over all points."""
    def nearest(batches):
        # (k + 1) best of each batch: the batches' winners are ranked by Spark
        for pdf in batches:
            if pdf.empty:
                continue
            x = _vectors(pdf["t_vec"])
            d = (asked * asked).sum(1)[:, None] + (x * x).sum(1)[None] - 2 * asked @ x.T
            kk = min(k + 1, len(x))
            at = np.argpartition(d, kk - 1, axis=1)[:, :kk]
            rows = np.repeat(np.arange(len(asked)), kk)
            yield pd.DataFrame({"q": rows, "t_id": pdf["t_id"].to_numpy()[at.ravel()], "d2": d[rows, at.ravel()],
                                "v": [x[j].tolist() for j in at.ravel()]})

    kind = t.schema["t_id"].dataType.simpleString()
    found = t.mapInPandas(nearest, f"q int, t_id {kind}, d2 double, v array<double>")
    best = found.groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct("d2", "t_id", "v"))), 1, k + 1).alias("near"))
    out = []
    for r in best.collect():  # calibration_queries rows of k + 1 vectors
        own = [c for c in r["near"] if c["t_id"] != ids[r["q"]]][:k]
        out += [(r["q"], np.array(c["v"])) for c in own]
    return out


def _bucket_ranks(index: ProjectionIndex, asked: np.ndarray, near: list) -> np.ndarray:
    """How many buckets come before that of each (query, neighbour), at least in one table."""
    if not near:
        return np.zeros(0, np.int64)
    q = np.array([i for i, _ in near])
    m = index.margins(asked)[q]
    crossed = (index.margins(np.stack([v for _, v in near])) > 0) != (m > 0)
    cost = (crossed * m * m).sum(2)
    ranks = np.empty(cost.shape, np.int64)
    for i, t in np.ndindex(*cost.shape):
        ranks[i, t] = _sets_below(np.sort(m[i, t] ** 2), cost[i, t])
    return ranks.min(1)


def _sets_below(costs: np.ndarray, limit: float) -> int:
    """Number of sets of positions of total cost below ``limit``, counted by
    meeting two halves; rounding leaves the set itself out."""
    limit -= 1e-9 * (1 + limit)
    half = len(costs) // 2
    sums = [np.zeros(1), np.zeros(1)]
    for side, part in enumerate((costs[:half], costs[half:])):
        for c in part:
            sums[side] = np.concatenate([sums[side], sums[side] + c])
    other = np.sort(sums[1])
    return int(np.searchsorted(other, limit - sums[0], side="left").sum())


def approximate_neighbours(train: DataFrame, query: DataFrame, id_col: str, vec_col: str, label_col: str,
                           k: int = 5, index: ProjectionIndex | None = None, tile_rows: int = 20_000,
                           **fit) -> DataFrame:
    """(q_id, t_id, t_label, d2, rank, compared): ``compared`` training points
    of the probed buckets were measured for the query (counted anew for each table)."""
    if train.isEmpty():
        return _no_neighbours(train, query, id_col).withColumn("compared", F.lit(0).cast("long"))
    index = index or fit_index(train, id_col, vec_col, k=k, **fit)
    t = train.select(F.col(id_col).alias("t_id"), F.col(vec_col).alias("t_vec"),
                     F.col(label_col).cast("double").alias("t_label"))
    q = query.select(F.col(id_col).alias("q_id"), F.col(vec_col).alias("q_vec"))
    places = T.ArrayType(T.ArrayType(T.LongType()))

    def dealt(vec: str, ordered: bool):
        def run(batches):
            for pdf in batches:
                if not pdf.empty:
                    x = _vectors(pdf[vec])
                    at = index.probe_order(x, index.probes) if ordered else index.buckets(x)[:, :, None]
                    yield pdf.assign(at=at.tolist())
        return run

    def in_buckets(df: DataFrame, vec: str, ordered: bool) -> DataFrame:
        every = df.mapInPandas(dealt(vec, ordered), T.StructType([*df.schema.fields, T.StructField("at", places)]))
        return every.select("*", F.posexplode("at").alias("table", "own")).drop("at").select(
            "*", F.explode("own").alias("bucket")).drop("own")

    tb, qb = written(in_buckets(t, "t_vec", False), "knn-buckets"), written(in_buckets(q, "q_vec", True), "knn-probes")
    place = ["table", "bucket"]

    def sizes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias(name))

    # only buckets of more than one tile: few, whatever the size, as buckets keep their size
    large = written(sizes(tb, "chunks").join(sizes(qb, "blocks"), place, "full").select(
        *place, F.coalesce("chunks", F.lit(1)).alias("chunks"), F.coalesce("blocks", F.lit(1)).alias("blocks"))
        .filter("chunks > 1 OR blocks > 1"), "knn-large")

    def tiled(df: DataFrame, own: str, number: str, every: str, other: str, key: str) -> DataFrame:
        out = df.join(large, place, "left")
        n, m = (F.coalesce(F.col(c), F.lit(1)) for c in (number, other))
        return out.select(*df.columns, F.pmod(F.xxhash64(key), n).cast("int").alias(own),
                          F.explode(F.sequence(F.lit(0), m - 1)).alias(every))

    tile = [*place, "chunk", "block"]
    short = tiled(qb, "block", "blocks", "chunk", "chunks", "q_id").groupBy(*tile).cogroup(
        tiled(tb, "chunk", "chunks", "block", "blocks", "t_id").groupBy(*tile)).applyInPandas(
        _counted(_tile_shortlist(k)), T.StructType([
            T.StructField("q_id", q.schema["q_id"].dataType), T.StructField("t_id", t.schema["t_id"].dataType),
            T.StructField("t_label", T.DoubleType()), T.StructField("d2", T.DoubleType()), T.StructField("compared", T.LongType())]))
    short = written(short, "knn-shortlists")
    # a point that several tables find counts once
    once = short.groupBy("q_id", "t_id").agg(F.first("t_label").alias("t_label"), F.min("d2").alias("d2"))
    compared = short.groupBy("q_id").agg(F.sum("compared").alias("compared"))
    return _top(once, k).join(compared, "q_id")


def _counted(shortlist):
    """The tile's size, on the first row of each query."""
    def run(qdf: pd.DataFrame, tdf: pd.DataFrame) -> pd.DataFrame:
        out = shortlist(qdf, tdf)
        first = ~out["q_id"].duplicated()
        return out.assign(compared=np.where(first, len(tdf), 0).astype(np.int64))
    return run


def knn_regress_approximate(train: DataFrame, query: DataFrame, id_col: str, vec_col: str, label_col: str,
                            k: int = 5, out: str = "prediction", **options) -> DataFrame:
    """Mean label of the k nearest points found, ``kth_dist2`` and ``compared``."""
    found = written(approximate_neighbours(train, query, id_col, vec_col, label_col, k, **options), "knn-found")
    compared = found.groupBy("q_id").agg(F.max("compared").alias("compared")).withColumnRenamed("q_id", id_col)
    return _regressed(found, id_col, out).join(compared, id_col)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(q_id, recall): the share of each query's exact neighbours among those found."""
    hit = exact.select("q_id", "t_id").join(
        found.select("q_id", "t_id", F.lit(1.0).alias("hit")), ["q_id", "t_id"], "left")
    return hit.groupBy("q_id").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("recall"))
