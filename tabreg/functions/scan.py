"""Running aggregates per group without putting a group into one task.

``Window.partitionBy(g).orderBy(o).rowsBetween(unboundedPreceding, 0)``
sends every row of a group to a single task; one group holding a third of
a 100 TB table would then be a single 33 TB task. The scan here is split
across range partitions instead:

1. ``orderBy(group, order)``: a range shuffle; a hot group spans many
   partitions of bounded size.
2. ``mapInPandas``: each task scans its own partition (sorted) and emits
   the local running value; a reliable checkpoint keeps the partition
   numbering stable through executor loss.
3. One tiny aggregate gives, per partition, its first and last group and
   the last group's local total: at most one row per partition.
4. The driver folds those totals forward, once, into a carry per partition
   (again at most one entry per partition: only a partition's *first* group
   can continue from earlier partitions). The carry table is a broadcast
   variable, bounded by the partition count, not by the rows, and a
   vectorised ``mapInPandas`` combines it into the rows of that first
   group. No join, no second shuffle.

A null group is a group like any other. ``max``/``min``/``argmax``/``argmin``
are null until the group has a value.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.session import cut_lineage

_OPS = ("count", "sum", "max", "min", "argmin", "argmax")
_PID = "__pid"


def _combine(op: str, carry, local):
    if op in ("count", "sum"):
        return carry + local
    if op == "max":
        return max(carry, local)
    if op == "min":
        return min(carry, local)
    raise ValueError(op)


def _local_scan_fn(group_cols: list[str], value: str | None, op: str, out: str,
                   at_col: str | None, order_col: str | None):
    def scan(it):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        prev_key = before_key = None
        before_seen = False
        prev_val = None
        prev_at = None
        for pdf in it:
            if pdf.empty:
                continue
            kdf = pdf[group_cols]
            before = kdf.shift(1)
            new = ((kdf != before) & ~(kdf.isna() & before.isna())).any(axis=1).to_numpy()
            new[0] = True
            gid = np.cumsum(new)
            first_key, last_key = (tuple(None if pd.isna(x) else x for x in kdf.iloc[i]) for i in (0, -1))
            g = pd.Series(gid, index=pdf.index)
            if op == "count":
                local = g.groupby(g).cumcount().astype("int64") + 1
            else:
                v = pdf[value].astype("float64")
                if op == "sum":
                    local = v.fillna(0.0).groupby(g).cumsum()
                elif op in ("max", "argmax"):
                    local = v.fillna(-np.inf).groupby(g).cummax()
                else:
                    local = v.fillna(np.inf).groupby(g).cummin()
                if op in ("argmin", "argmax"):
                    prev_best = local.groupby(g).shift(1)
                    better = (v < prev_best) if op == "argmin" else (v > prev_best)
                    is_new = prev_best.isna() | better.fillna(False)
                    at = pdf[order_col].where(is_new).groupby(g).ffill()
            first = gid == 1
            if prev_key is not None and first_key == prev_key:
                if op in ("argmin", "argmax"):
                    wins = (local[first] >= prev_val) if op == "argmin" \
                        else (local[first] <= prev_val)
                    idx = local[first].index[wins.values]
                    local.loc[idx] = prev_val
                    at.loc[idx] = prev_at
                else:
                    local.loc[first] = [_combine(op, prev_val, x) for x in local[first]]
            prev_key = last_key
            prev_val = local.iloc[-1]
            if op in ("argmin", "argmax"):
                prev_at = at.iloc[-1]
            if op in ("count", "sum"):
                seen = pd.Series(True, index=pdf.index)
            else:  # null until the group has a value
                seen = v.notna().groupby(g).cummax()
                if first_key == before_key and before_seen:
                    seen |= first
                before_seen = bool(seen.iloc[-1])
            before_key = last_key
            pdf = pdf.copy()
            pdf[out] = local.where(seen).values if not seen.all() else local.values
            if op in ("argmin", "argmax"):
                pdf[at_col] = at.where(seen).values if not seen.all() else at.values
            pdf[_PID] = pid
            yield pdf
    return scan


def running_aggregate(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                      op: str, value: str | None = None, out: str = "running",
                      at_col: str | None = None) -> DataFrame:
    """Running ``op`` of ``value`` per group in ``order_cols`` order.

    ``op``: ``count`` (1-based row number), ``sum``, ``max``, ``min``,
    ``argmin``/``argmax`` (running extreme plus, in ``at_col``, the value
    of the first order column where that extreme was first reached; ties
    keep the earlier row). ``order_cols`` must make rows unique within a
    group for a deterministic result. Nulls in ``value`` are skipped.
    """
    if op not in _OPS:
        raise ValueError(op)
    group_cols, order_cols = list(group_cols), list(order_cols)
    if op in ("argmin", "argmax") and at_col is None:
        at_col = f"{out}_at"
    fields = list(df.schema.fields)
    out_type = T.LongType() if op == "count" else T.DoubleType()
    fields.append(T.StructField(out, out_type))
    if at_col:
        fields.append(T.StructField(at_col, df.schema[order_cols[0]].dataType))
    fields.append(T.StructField(_PID, T.IntegerType()))
    schema = T.StructType(fields)

    ordered = df.orderBy(*group_cols, *order_cols)
    local = ordered.mapInPandas(
        _local_scan_fn(group_cols, value, op, out, at_col, order_cols[0]), schema)
    local = cut_lineage(local)

    gstruct = F.struct(*[F.col(c) for c in group_cols])
    ostruct = F.struct(*[F.col(c) for c in order_cols])
    last_payload = [F.col(out).alias("v")] + ([F.col(at_col).alias("at")] if at_col else [])
    summary = local.groupBy(_PID).agg(
        F.min(F.struct(gstruct.alias("g"), ostruct.alias("o"))).alias("first"),
        F.max(F.struct(gstruct.alias("g"), ostruct.alias("o"),
                       *last_payload)).alias("last"),
    ).collect()  # at most one row per partition
    parts = sorted(summary, key=lambda r: r[_PID])

    # forward fold: what the group open at a partition's start has so far
    carries: dict[int, tuple] = {}
    open_group, acc = None, None
    for r in parts:
        first, last = tuple(r["first"]["g"]), tuple(r["last"]["g"])
        ends = (r["last"]["v"], r["last"]["at"] if at_col else None)
        if acc is not None and open_group == first:
            carries[r[_PID]] = (first, acc)
            acc = _merge(op, acc, ends) if first == last else ends
        else:
            acc = ends
        open_group = last
    if not carries:
        return local.drop(_PID)
    return _apply_carries(local, carries, group_cols, op, out, at_col, schema)


def _merge(op: str, earlier: tuple, later: tuple) -> tuple:
    """(value, at) of two neighbouring stretches of a group; ties stay earlier."""
    if earlier[0] is None or later[0] is None:
        return later if earlier[0] is None else earlier
    if op in ("argmin", "argmax"):
        wins = earlier[0] <= later[0] if op == "argmin" else earlier[0] >= later[0]
        return earlier if wins else later
    return _combine(op, earlier[0], later[0]), None


def _apply_carries(local: DataFrame, carries: dict, group_cols: list[str], op: str,
                   out: str, at_col: str | None, schema: T.StructType) -> DataFrame:
    """Apply per-partition carries from a broadcast table (one entry per
    partition at most) with a vectorised pass over each partition's rows."""
    bc = local.sparkSession.sparkContext.broadcast(carries)
    out_schema = T.StructType([f for f in schema.fields if f.name != _PID])

    def apply(it):
        table = bc.value
        for pdf in it:
            if pdf.empty:
                continue
            pdf = pdf.copy()
            pids = pdf[_PID].to_numpy()
            for pid in np.unique(pids):
                entry = table.get(int(pid))
                if entry is None:
                    continue
                g, (v, at) = entry
                mask = pids == pid
                for c, gv in zip(group_cols, g):
                    mask &= (pdf[c].isna() if gv is None else (pdf[c] == gv)).to_numpy()
                if v is None or not mask.any():
                    continue
                cur = pdf.loc[mask, out].astype("float64")
                if op in ("count", "sum"):
                    new = cur + v
                elif op == "max":
                    new = np.fmax(cur, v)
                elif op == "min":
                    new = np.fmin(cur, v)
                else:
                    wins = cur.isna() | ((v <= cur) if op == "argmin" else (v >= cur))
                    new = cur.where(~wins, v)
                    idx = pdf.index[mask][wins.to_numpy()]
                    pdf.loc[idx, at_col] = at
                pdf.loc[mask, out] = new.astype(pdf[out].dtype).to_numpy()
            yield pdf.drop(columns=[_PID])
    return local.mapInPandas(apply, out_schema)


def running_last(df: DataFrame, order_cols: Sequence[str], value: str, out: str = "running",
                 group_cols: Sequence[str] = ()) -> DataFrame:
    """The last value that is not null up to each row, of any type.

    Spread over range partitions like ``running_aggregate``: without groups
    (or in a hot one) no task sees more than its partition. ``order_cols``
    must make rows unique; a null group is a group.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    kind = df.schema[value].dataType
    schema = T.StructType([*df.schema.fields, T.StructField(out, kind), T.StructField(_PID, T.IntegerType())])

    # Arrow batches: pandas would turn whole numbers beside nulls into doubles
    def scan(batches):
        from pyspark import TaskContext
        pid, key, carried = TaskContext.get().partitionId(), None, None
        for batch in batches:
            own = []
            for v, k in zip(batch.column(value).to_pylist(), _keys(batch, group_cols)):
                if k != key:
                    key, carried = k, None
                carried = carried if v is None else v
                own.append(carried)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own, batch.column(value).type), pa.array([pid] * len(own), pa.int32())],
                [*batch.schema.names, out, _PID])

    local = cut_lineage(df.orderBy(*group_cols, *order_cols).mapInArrow(scan, schema))
    g, o = (F.struct(F.lit(0), *[F.col(c) for c in cols]) for cols in (group_cols, order_cols))
    place = F.struct(g.alias("g"), o.alias("o"))
    ends = sorted(local.groupBy(_PID).agg(F.min(place).alias("first"), F.max_by(F.struct(g.alias("g"), F.col(out).alias("v")), place)
                                          .alias("last")).collect(), key=lambda r: r[_PID])  # one row a partition
    carries, open_group, value_now = {}, None, None
    for r in ends:
        if open_group == tuple(r["first"]["g"]) and value_now is not None:
            carries[r[_PID]] = (tuple(r["first"]["g"])[1:], value_now)
        if r["last"]["v"] is not None or open_group != tuple(r["last"]["g"]):
            value_now = r["last"]["v"]
        open_group = tuple(r["last"]["g"])
    if not carries:
        return local.drop(_PID)
    table = df.sparkSession.sparkContext.broadcast(carries)

    def apply(batches):
        for batch in batches:
            at = batch.schema.names.index(out)
            own = batch.column(at).to_pylist()
            for i, (pid, k) in enumerate(zip(batch.column(_PID).to_pylist(), _keys(batch, group_cols))):
                entry = table.value.get(pid)
                if entry and own[i] is None and k == entry[0]:
                    own[i] = entry[1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(own, batch.column(at).type)], batch.schema.names[:at + 1])

    return local.mapInArrow(apply, T.StructType(schema.fields[:-1]))


def _keys(batch: pa.RecordBatch, cols: list[str]) -> list[tuple]:
    if not cols:
        return [()] * batch.num_rows
    return list(zip(*[batch.column(c).to_pylist() for c in cols]))
