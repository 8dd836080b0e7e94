"""Projections, row keys and keyed combination of frames.

The reference aligns rows by position (``pd.concat(axis=1)``,
``np.column_stack``, Series minus array). Spark rows have no position, so
every alignment here is by an explicit key, and the cheapest form is used:
same-row columns when possible, one union + grouped aggregate (a single
shuffle) for a horizontal concat of many frames; joins carry no broadcast
hints, so the planner's size threshold decides (sort-merge join beyond it).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.functions.hashing import row_key

MAX_DICTIONARY_ROWS = 10_000  # literal rows in the plan; larger: a table, joined


def select_group(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Project a column group (missing names raise, as in pandas)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; unlike ``DataFrame.drop`` an unknown name raises."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def features_and_label(df: DataFrame, feature_cols: Sequence[str], label: str,
                       key: Sequence[str] = ()) -> DataFrame:
    """Features and target stay in one row (never two aligned objects)."""
    return df.select(*key, *feature_cols, F.col(label).cast("double").alias("label"))


def with_derived(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """P5: add derived columns in one projection."""
    return df.withColumns(dict(exprs))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    if len(names) != len(df.columns):
        raise ValueError("one name per column")
    return df.toDF(*names)


def with_row_key(df: DataFrame, key_cols: Sequence[str], out: str = "row_key") -> DataFrame:
    """Stable key from natural-key columns (same after any recomputation)."""
    return df.withColumn(out, row_key(key_cols))


def prediction_table(df: DataFrame, key: Sequence[str], preds: Mapping[str, str]) -> DataFrame:
    """Key plus one renamed column per model."""
    return df.select(*key, *[F.col(c).alias(name) for name, c in preds.items()])


def keyed_concat(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Horizontal concat by key, outer semantics (a key in any frame is kept).

    One ``unionByName`` and one grouped aggregate: a single shuffle for any
    number of frames (k - 1 full outer joins would shuffle k - 1 times).
    Keys must be unique within each frame (a repeated key is an error when
    its row is computed); other columns must not overlap.
    """
    key = list(key)
    value_cols: list[str] = []
    for f in frames:
        for c in f.columns:
            if c not in key:
                if c in value_cols:
                    raise ValueError(f"column {c} in two frames")
                value_cols.append(c)
    types = {c: t for f in frames for c, t in f.dtypes}
    parts = []
    for i, f in enumerate(frames):
        parts.append(f.select(*key, F.lit(i).alias("__frame"), *[
            F.col(c) if c in f.columns else F.lit(None).cast(types[c]).alias(c)
            for c in value_cols]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    merged = u.groupBy(*key).agg(
        F.greatest(*[F.count(F.when(F.col("__frame") == i, 1)) for i in range(len(frames))], F.lit(0)).alias("__most"),
        *[F.first(c, ignorenulls=True).alias(c) for c in value_cols])
    unique = F.col("__most") <= 1
    return merged.select(*key, *[
        F.when(unique, F.col(c)).otherwise(F.raise_error(F.lit("keyed_concat: repeated key")).cast(types[c])).alias(c)
        for c in value_cols])


def stack_predictions(a: DataFrame, b: DataFrame, key: Sequence[str],
                      assemble_to: str | None = None) -> DataFrame:
    """Rows present in both prediction frames, optionally as one vector."""
    out = a.join(b, list(key), "inner")
    if assemble_to:
        from pyspark.ml.feature import VectorAssembler
        cols = [c for c in out.columns if c not in key]
        out = VectorAssembler(inputCols=cols, outputCol=assemble_to).transform(out)
    return out


def aligned_subtract(a: DataFrame, b: DataFrame, key: Sequence[str], left: str, right: str,
                     out: str = "difference") -> DataFrame:
    """``a.left - b.right`` matched by key (inner)."""
    return a.join(b, list(key), "inner").select(
        *key, (F.col(left) - F.col(right)).alias(out))


def dictionary_frame(spark: SparkSession,
                     entries: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``column, code, meaning`` from a data dictionary (codes trimmed)."""
    if len(entries) > MAX_DICTIONARY_ROWS:
        raise ValueError("dictionary too large for literal rows; read it as a table "
                         "and pass that frame to lookup()")
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k.strip()).alias("code"),
                              F.lit(m).alias("meaning")) for c, k, m in entries])
    # literal rows: the planner knows the size, so the join broadcasts it
    return spark.range(1).select(F.inline(rows))


def lookup(df: DataFrame, col: str, dictionary: DataFrame, out: str | None = None,
           column_name: str | None = None) -> DataFrame:
    """Left join of a code column to its meaning; codes compared trimmed.

    No broadcast hint: the planner broadcasts the dictionary when its size
    is under the broadcast threshold (a literal dictionary always is) and
    falls back to a sort-merge join for a large one.
    """
    name = column_name or col
    d = dictionary.filter(F.col("column") == name).select(
        F.col("code").alias("__code"), F.col("meaning").alias(out or f"{col}_meaning"))
    return df.join(d, F.trim(F.col(col)) == F.col("__code"), "left") \
        .drop("__code")


def out_of_domain(df: DataFrame, cols: Sequence[str], dictionary: DataFrame) -> DataFrame:
    """Codes absent from the dictionary, with their row counts.

    Codes are counted first (partial aggregation), so only the distinct
    codes meet the dictionary in the anti join.
    """
    long = df.select(*[F.trim(F.col(c)).alias(c) for c in cols]) \
        .unpivot([], list(cols), "column", "code").filter(F.col("code").isNotNull())
    counts = long.groupBy("column", "code").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(dictionary.select("column", "code"), ["column", "code"], "left_anti")
