"""Codes for vectors: one codebook entry for each of a vector's equal parts.

Codebooks are trained by rounds of assignment and mean over all vectors. An
assignment keeps, for each part of a vector and each group of entries, a lower
bound of the distance to the group's entries (the part's own entry left out)
and the stamp of the round in which the bound was exact. All rounds' codebooks
are retained. So a bound is not worn down by the sum of an entry's moves from
round to round but by the norm of their sum: the net displacement between the
codebook of the stamp and the present one, of the group's entry that went
farthest. Only groups whose bound does not exceed the exact distance to the
part's own entry are scanned again, exactly, and get a new bound and stamp.

Vectors are integers (``floor(scale * x)``), squared distances exact in 64
bits, ties go to the lower entry. Bounds are whole sixteenths, rounded down,
displacements are rounded up, so no tie and no nearer entry is ever missed.

Each round is one pass over the last one's stored table (vector, code, bounds,
stamps) and one over its codes for the sums; the driver holds the codebooks
and parts x entries sums, whatever the number of vectors.

Defined cases: vectors that are null or hold null or non-finite components are
left out, as are vectors that ``parts`` doesn't divide and those of another
length than most (of equally frequent ones the shorter counts). Fewer vectors
than entries make a smaller codebook; equal start entries leave the higher one
unused, and it stays. Null ids are larger than others when the start entries
are taken; repeated rows count each. An empty table gives no codes and empty
codebooks. Components whose squares could leave 64 bits are an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.llm.common import stored

#: Bounds are whole parts of this kind of a unit of distance.
STEPS = 16
MOST = 2 ** 31 - 1
#: More than the rounding of a square root and a product.
SLACK = 2.0 ** -50


def group_bounds(entries: int, groups: int) -> list[tuple[int, int]]:
    """Consecutive entries in at most ``groups`` groups of about equal size."""
    at = np.linspace(0, entries, min(groups, max(entries, 1)) + 1).astype(int)
    return list(zip(at[:-1].tolist(), at[1:].tolist()))


def _least(squares: np.ndarray) -> np.ndarray:
    """Sixteenths of the distances, rounded down."""
    return np.minimum(np.floor(STEPS * np.sqrt(squares.astype(np.float64)) * (1 - SLACK)), MOST).astype(np.int64)


def net_moves(history: np.ndarray, groups: list[tuple[int, int]]) -> np.ndarray:
    """(stamp, part, group): the farthest net move of an entry of the group
    from the stamp's codebook to the last one, in sixteenths, rounded up."""
    moved = history[-1][None] - history
    norm = STEPS * np.sqrt((moved * moved).sum(-1).astype(np.float64)) * (1 + SLACK)
    return np.stack([norm[:, :, lo:hi].max(-1) for lo, hi in groups], -1)


def assign(x: np.ndarray, code: np.ndarray, lower: np.ndarray, stamp: np.ndarray, history: np.ndarray,
           groups: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Moves every part to its nearest entry of the last codebook.

    ``x`` (rows, parts, width); ``code`` (rows, parts), ``lower`` and ``stamp``
    (rows, parts, groups) are changed in place. Returns the squared error and
    the number of entries compared, by row.
    """
    now, book = len(history) - 1, history[-1]
    moves = net_moves(history, groups)
    error, compared = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    group_of = np.concatenate([np.full(hi - lo, g) for g, (lo, hi) in enumerate(groups)])
    for p in range(x.shape[1]):
        own = code[:, p].astype(np.int64)
        gap = x[:, p] - book[p][own]
        near = (gap * gap).sum(-1)
        old, old_near = own.copy(), near.copy()
        left = lower[:, p] - moves[stamp[:, p], p, np.arange(len(groups))]
        scans = []
        for g, (lo, hi) in enumerate(groups):
            at = np.flatnonzero(left[:, g] <= STEPS * np.sqrt(near.astype(np.float64)) * (1 + SLACK))
            if not len(at):
                continue
            d = np.zeros((len(at), hi - lo), np.int64)
            for q in range(x.shape[2]):
                gap = x[at, p, q][:, None] - book[p, lo:hi, q]
                d += gap * gap
            first = d.argmin(1)
            least = d[np.arange(len(at)), first]
            better = (least < near[at]) | ((least == near[at]) & (lo + first < own[at]))
            near[at] = np.where(better, least, near[at])
            own[at] = np.where(better, lo + first, own[at])
            d[np.arange(len(at)), first] = np.iinfo(np.int64).max
            scans.append((g, at, lo + first, least, d.min(1)))
            compared[at] += hi - lo
        # groups that were not scanned again now also bound the entry that was left
        gone = np.flatnonzero(own != old)
        g = group_of[old[gone]]
        lower[gone, p, g] = np.minimum(np.floor(left[gone, g]), _least(old_near[gone]))
        stamp[gone, p, g] = now
        for g, at, first, least, second in scans:
            lower[at, p, g] = _least(np.where(first == own[at], second, least))
            stamp[at, p, g] = now
        code[:, p] = own
        error += near
    return error, compared


STATE = "x array<int>, code binary, lower array<int>, stamp binary, error long, compared long"


def _lists(values: np.ndarray) -> pa.Array:
    width = values.shape[1] if values.ndim == 2 else 0
    at = np.arange(len(values) + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.reshape(-1).astype(np.int32)))


def _rows(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(n, -1)


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in values.astype(np.uint8)], pa.binary())


def _round(state: DataFrame, history: np.ndarray, groups: list[tuple[int, int]], keep: str) -> DataFrame:
    """``state`` (id, label, x and, after the first round, code, lower, stamp,
    compared) assigned to the last codebook. ``keep`` is the kept columns' schema."""
    parts, opened = history.shape[1], "code" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _rows(batch.column("x"), n).astype(np.int64)
            if opened:  # nothing is known: every group is scanned
                code, stamp = np.zeros((n, parts), np.uint8), np.zeros((n, parts, len(groups)), np.uint8)
                lower, before = np.full(stamp.shape, -1, np.int64), 0
            else:
                code, stamp = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, parts, -1).copy()
                               for c in ("code", "stamp"))
                code = code[:, :, 0]
                lower = _rows(batch.column("lower"), n).astype(np.int64).reshape(stamp.shape)
                before = np.asarray(batch.column("compared"))
            error, compared = assign(x.reshape(n, parts, -1), code, lower, stamp, history, groups)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("x"), _bytes(code), _lists(lower.reshape(n, -1)),
                 _bytes(stamp.reshape(n, -1)), pa.array(error), pa.array(compared * (not opened) + before)],
                ["id", "label", "x", "code", "lower", "stamp", "error", "compared"])

    return state.mapInArrow(run, f"{keep}, {STATE}")


def _means(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebook of the next round: floors of the means, unused entries as they are."""
    parts, entries, width = book.shape
    size = width + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, size), np.int64)
        for batch in batches:
            n = batch.num_rows
            if n:
                x = _rows(batch.column("x"), n).astype(np.int64).reshape(n, parts, width)
                code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts)
                for p in range(parts):
                    np.add.at(total[p, :, :width], code[:, p], x[:, p])
                    total[p, :, width] += np.bincount(code[:, p], minlength=entries)
        slot = np.flatnonzero(total.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total.reshape(-1)[slot])], ["slot", "total"])

    # one row for each component of the codebooks and each task, summed before the driver sees them
    sums = state.select("x", "code").mapInArrow(partial, "slot long, total long").groupBy("slot").agg(
        F.sum("total").alias("total"))
    flat = np.zeros(parts * entries * size, np.int64)
    for r in sums.collect():
        flat[r["slot"]] = r["total"]
    flat = flat.reshape(parts, entries, size)
    count = flat[:, :, -1:]
    return np.where(count > 0, flat[:, :, :-1] // np.maximum(count, 1), book)


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    return vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = 16, entries: int = 64, rounds: int = 2, groups: int = 8,
           scale: int = 256) -> tuple[DataFrame, np.ndarray]:
    """((id, label, code, error, compared), codebooks (parts, entries, width)).

    ``code`` is binary, a byte for each part; ``compared`` counts the entries
    that bounds did not rule out after the first round.
    """
    if not (1 <= entries <= 256 and 1 <= rounds <= 255):
        raise ValueError("a code is a byte for each part, a stamp a byte: 1 to 256 entries, 1 to 255 rounds")
    kinds = [vectors.schema[c].dataType.simpleString() for c in (id_col, label_col)]
    keep = f"id {kinds[0]}, label {kinds[1]}"
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v")).filter(usable(F.col("v")))
    sizes = kept.groupBy(F.size("v").alias("size")).agg(
        F.count("*").alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("most"))
    top = sizes.filter((F.col("size") > 0) & (F.col("size") % parts == 0)).orderBy(F.desc("n"), "size").first()
    if top is None:
        empty = kept.filter(F.lit(False)).select(
            "id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("compared"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    most = 2.0 ** 30 / math.sqrt(top["size"]) - 2
    if top["most"] * scale > most:
        raise ValueError(f"components beyond {most / scale:.6g} have squared distances of more than 64 bits")
    kept = kept.filter(F.size("v") == top["size"]).select(
        "id", "label", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("x"))
    start = kept.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    book = np.array([r["x"] for r in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2)
    history, cut = [book], group_bounds(len(start), groups)
    state = kept
    for t in range(rounds + 1):
        state = stored(_round(state, np.stack(history), cut, keep), f"codes-{t}")
        if t < rounds:
            history.append(_means(state, history[-1]))
    return state.select("id", "label", "code", "error", "compared"), history[-1]


def codebook_digest(books: np.ndarray) -> str:
    """Hexadecimal SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over equal labels.

    Sums are made before anything moves. They are a written table, so the
    planner knows its size: few labels are broadcast, many are joined by
    label, where skewed ones are split at run time.
    """
    sums = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    sums = sums.withColumnRenamed("label", "s_label")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("s_label")), "left").drop("s_label")

