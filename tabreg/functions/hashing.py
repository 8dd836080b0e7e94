"""Deterministic hash buckets and row keys.

The split is a pure function of the row key, so it is the same after any
repartitioning, after executor loss and recomputation, and it can be
written in plain SQL (the DuckDB oracle uses the same formula):

    bucket = conv(substr(md5(key || salt), 1, 7), 16, 10) % n
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key_text(key_cols: Sequence[str]) -> Column:
    if len(key_cols) == 1:
        return F.col(key_cols[0]).cast("string")
    return F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])


def hash_bucket(key_cols: str | Sequence[str], n: int = 100,
                salt: str = "") -> Column:
    """Bucket in ``[0, n)`` from the md5 of the key text plus a salt."""
    if isinstance(key_cols, str):
        key_cols = [key_cols]
    text = _key_text(key_cols)
    if salt:
        text = F.concat(text, F.lit(salt))
    h = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")
    return (h % F.lit(n)).cast("int")


def hash_bucket_sql(key_sql: str, n: int = 100, salt: str = "") -> str:
    """The same bucket in DuckDB SQL, for oracles."""
    text = f"CAST({key_sql} AS VARCHAR)"
    if salt:
        text = f"({text} || '{salt}')"
    return f"CAST(CAST(('0x' || substr(md5({text}), 1, 7)) AS BIGINT) % {n} AS INTEGER)"


def row_key(key_cols: Sequence[str]) -> Column:
    """Stable row key from natural-key columns (P7): md5 of their text."""
    return F.md5(_key_text(key_cols))
