"""Scalar and row-wise functions.

All of these return ``Column`` expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_skipnull(cols: Sequence[str | Column],
                 weights: Sequence[float] | None = None) -> Column:
    """Row sum that skips nulls; an all-null row sums to 0.

    A plain ``a + b`` is null as soon as one term is null; the pandas
    ``sum(axis=1)`` being rebuilt treats missing as 0.
    """
    if not cols:
        return F.lit(0.0)
    weights = list(weights) if weights is not None else [1.0] * len(cols)
    if len(weights) != len(cols):
        raise ValueError("one weight per column")
    terms = [F.coalesce(_col(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
             if w != 1.0 else F.coalesce(_col(c).cast("double"), F.lit(0.0))
             for c, w in zip(cols, weights)]
    return reduce(add, terms)


def ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields null on a zero or null denominator."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def abs_error(label: str | Column, pred: str | Column) -> Column:
    """``|y - p|``."""
    return F.abs(_col(label) - _col(pred))


def least_of(cols: Sequence[str | Column]) -> Column:
    """Row-wise minimum (X6). Nulls are skipped, as ``least`` does."""
    if len(cols) == 1:
        return _col(cols[0])
    return F.least(*[_col(c) for c in cols])


def sqrt_of(c: str | Column) -> Column:
    """Square root."""
    return F.sqrt(_col(c))


def mean_of(cols: Sequence[str | Column]) -> Column:
    """Mean of k prediction columns (X8): ``(a + b + ...) / k``."""
    return reduce(add, [_col(c) for c in cols]) / F.lit(float(len(cols)))


def linear_combination(cols: Sequence[str | Column],
                       weights: Iterable[float],
                       intercept: float = 0.0) -> Column:
    """``intercept + sum(w_i * c_i)`` (X9, also a fitted linear meta-model)."""
    terms = [F.lit(float(w)) * _col(c) for c, w in zip(cols, weights)]
    expr = reduce(add, terms)
    return expr + F.lit(float(intercept)) if intercept else expr


def whole_number_to_long(c: str | Column) -> Column:
    """Whole-number double -> long, other values stay null."""
    c = _col(c)
    return F.when(c == F.floor(c), c.cast("long"))


def whole_number_text(c: str | Column) -> Column:
    """Text rendering that prints 1900.0 as ``1900`` and keeps 2.5."""
    c = _col(c)
    return F.when(c.isNull(), None) \
        .when(c == F.floor(c), c.cast("long").cast("string")) \
        .otherwise(c.cast("string"))


def round_to(c: str | Column, decimals: int) -> Column:
    """Fixed-decimals rounding for metric tables (X11)."""
    return F.round(_col(c), decimals)


def feature_name(i: str | Column) -> Column:
    """``Feature {i}`` constant names."""
    return F.concat(F.lit("Feature "), _col(i).cast("string"))
