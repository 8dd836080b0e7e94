"""Attach per-group values (bounds, fences, targets) to the rows of a big frame.

A null-safe equi-join in every case. A small table is broadcast once its
size has been checked (at most ``max_rows`` rows are counted): the big side
then keeps its partitioning, where a shuffle on a low-cardinality key would
send everything to a few tasks. A larger table has many keys, which an
ordinary join spreads well (AQE splits remaining skew).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 10_000


def attach(big: DataFrame, small: DataFrame, keys: Sequence[str], values: Sequence[str],
           max_rows: int | None = MAX_BROADCAST_ROWS) -> DataFrame:
    """Inner join: rows of ``big`` whose key is in ``small`` get ``values``.

    A null key is a key like any other. With ``max_rows`` None nothing is
    counted and the join is the planner's: for a ``big`` that is itself small,
    or a ``small`` that is dear to compute twice.
    """
    keys, values = list(keys), list(values)
    table = small.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *values)
    if max_rows is not None and table.limit(max_rows + 1).count() <= max_rows:
        table = F.broadcast(table)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & big[k].eqNullSafe(F.col(f"__k{i}"))
    return big.join(table, on).drop(*[f"__k{i}" for i in range(len(keys))])
