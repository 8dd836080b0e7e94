"""Column profiling (A1-A15), drop lists (S3, S5, P11) and previews.

Every profile is computed with as few passes as possible:

* per-column counts of values use one ``unpivot`` followed by one
  ``groupBy(column, value)`` - map-side partial aggregation collapses a hot
  value (one value holding a third of the rows) before the shuffle;
* moments of all columns come out of one wide ``agg`` (no shuffle at all,
  just one row of partial aggregates per task); pairwise moments for the
  correlation matrix are a vectorised partial aggregate (masked matrix
  products per task, k^2 partial rows merged by a tiny grouped sum);
* quantiles are exact by default through a distributed selection (a few
  bucket-count aggregates narrowing an interval per target rank, no sort);
  ``method="approx"`` switches to the one-pass ``percentile_approx`` sketch.
"""

from __future__ import annotations

from itertools import combinations
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.functions.attach import attach
from tabreg.functions.rowwise import whole_number_text

QUANTILE_ACCURACY = 100_000


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def _nan_to_null(df: DataFrame, c: str) -> Column:
    """NaN and null are both 'missing', as in pandas."""
    col = F.col(c)
    if _is_float(df, c):
        return F.when(F.isnan(col), F.lit(None)).otherwise(col)
    return col


def _as_text(df: DataFrame, c: str) -> Column:
    col = _nan_to_null(df, c)
    if _is_float(df, c):
        col = col + F.lit(0.0)  # -0.0 and 0.0 are one value
    return col.cast("string")


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value)`` text pairs; nulls kept (``DataFrame.unpivot`` keeps them)."""
    wide = df.select(*[_as_text(df, c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "value")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, cnt)``: null counted as a value (``dropna=False``)."""
    return long_values(df, cols).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("cnt"))


def dominance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A1: share of the most frequent value per column, null included."""
    return value_counts(df, cols).groupBy("column").agg(
        (F.max("cnt") / F.sum("cnt")).alias("top_freq"))


def null_ratio(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2: share of null/NaN per column, all columns in one pass.

    Computed on the unpivoted frame (``Expand`` + ``groupBy(column)``), so
    the aggregate has two buffer fields whatever the number of columns and
    stays in whole-stage codegen.
    """
    flags = df.select(*[_nan_to_null(df, c).isNull().cast("double").alias(c) for c in cols])
    return flags.unpivot([], list(cols), "column", "is_null").groupBy("column").agg(
        F.avg("is_null").alias("nan_ratio"))


def low_information_columns(df: DataFrame, cols: Sequence[str],
                            dominance_threshold: float = 0.95) -> DataFrame:
    """A3: columns whose top value share is ``>=`` the threshold."""
    return dominance(df, cols).filter(F.col("top_freq") >= F.lit(dominance_threshold))


def excessive_null_columns(df: DataFrame, cols: Sequence[str],
                           threshold: float = 0.5) -> DataFrame:
    """A4: columns whose null share is strictly ``>`` the threshold."""
    return null_ratio(df, cols).filter(F.col("nan_ratio") > F.lit(threshold))


def drop_union(*frames: DataFrame) -> DataFrame:
    """Union of column-name lists, duplicates removed."""
    out = frames[0].select("column")
    for f in frames[1:]:
        out = out.union(f.select("column"))
    return out.distinct()


def column_names(frame: DataFrame) -> list[str]:
    """Driver-side list of a (small) column-name frame."""
    return sorted(r["column"] for r in frame.select("column").collect())


def column_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null ratio, distinct count, dominance, min, max, mean, std per column.

    Both parts run on the unpivoted frame: moments are one
    ``groupBy(column)`` with six aggregates (codegen-friendly for any
    number of columns), counts one ``groupBy(column, value)``. The two
    per-column results (one row per column each) are joined.
    """
    num = {c: (_nan_to_null(df, c).cast("double") if _is_numeric(df, c)
               else F.lit(None).cast("double")) for c in cols}
    pairs = df.select(*[F.struct(_as_text(df, c).alias("t"), num[c].alias("x")).alias(c)
                        for c in cols])
    long = pairs.unpivot([], list(cols), "column", "v").select(
        "column", F.col("v.t").alias("t"), F.col("v.x").alias("x"))
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col("t").isNull().cast("double")).alias("null_ratio"),
        F.min("x").alias("min"), F.max("x").alias("max"),
        F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"))
    counts = long.groupBy("column", "t").agg(F.count(F.lit(1)).alias("cnt")) \
        .groupBy("column").agg(F.count("t").alias("n_distinct"),
                               (F.max("cnt") / F.sum("cnt")).alias("top_freq"))
    return moments.join(counts, "column", "left").select(
        "column", "n_rows", "null_ratio", "n_distinct", "top_freq",
        "min", "max", "mean", "std")


def distinct_sorted_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, sorted.

    Values stay rows (never one collected array per column), so a column
    with billions of distinct values is still a distributed distinct and a
    range-partitioned sort. Whole-number floats print as integers.
    """
    pairs = []
    for c in cols:
        v = _nan_to_null(df, c)
        if _is_numeric(df, c):
            text = whole_number_text(v.cast("double")) if _is_float(df, c) \
                else v.cast("string")
            key = v.cast("double")
        else:
            text, key = v.cast("string"), F.lit(None).cast("double")
        pairs.append(F.struct(key.alias("sort_key"), text.alias("value")).alias(c))
    # all columns in one scan
    out = df.select(*pairs).unpivot([], list(cols), "column", "v").select(
        "column", "v.sort_key", "v.value").filter(F.col("value").isNotNull())
    return out.distinct().orderBy("column", "sort_key", "value").drop("sort_key")


def _pair_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete moment sums of every column pair, long form.

    A vectorised partial aggregate: each task turns its Arrow batches into
    masked k x k matrix products (counts, sums, squares, cross products of
    the values shifted by the column means), emits k^2 partial rows, and a
    grouped sum merges them (tiny shuffle). One aggregate per pair in SQL
    would need ~10 buffer fields per pair and fall out of whole-stage
    codegen beyond a handful of columns.
    """
    cols = list(cols)
    k = len(cols)
    means = df.agg(*[F.avg(_nan_to_null(df, c).cast("double")).alias(f"m{i}")
                     for i, c in enumerate(cols)]).first()
    shift = [float(means[f"m{i}"]) if means[f"m{i}"] is not None else 0.0 for i in range(k)]
    src = df.select(*[(_nan_to_null(df, c).cast("double") - F.lit(shift[i])).alias(f"c{i}")
                      for i, c in enumerate(cols)])

    def partial(it):
        import numpy as np
        import pandas as pd
        n = np.zeros((k, k)); sx = np.zeros((k, k)); sxx = np.zeros((k, k))
        sxy = np.zeros((k, k))
        for pdf in it:
            x = pdf.to_numpy(dtype=np.float64, na_value=np.nan)
            m = ~np.isnan(x)
            mf = m.astype(np.float64)
            xz = np.where(m, x, 0.0)
            n += mf.T @ mf
            sx += xz.T @ mf
            sxx += (xz * xz).T @ mf
            sxy += xz.T @ xz
        ii, jj = np.meshgrid(np.arange(k), np.arange(k), indexing="ij")
        yield pd.DataFrame({"i": ii.ravel().astype("int32"), "j": jj.ravel().astype("int32"),
                            "n": n.ravel(), "sx": sx.ravel(), "sy": sx.T.ravel(),
                            "sxx": sxx.ravel(), "syy": sxx.T.ravel(), "sxy": sxy.ravel()})

    schema = ("i int, j int, n double, sx double, sy double, sxx double, syy double, "
              "sxy double")
    return src.mapInPandas(partial, schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ["n", "sx", "sy", "sxx", "syy", "sxy"]])


def _corr_from_sums() -> Column:
    n = F.col("n")
    mx, my = F.col("sx") / n, F.col("sy") / n
    vx = F.col("sxx") / n - mx * mx
    vy = F.col("syy") / n - my * my
    cxy = F.col("sxy") / n - mx * my
    ok = (n > 0) & (vx > 0) & (vy > 0)
    return F.when(ok & (F.col("i") == F.col("j")), F.lit(1.0)) \
        .when(ok, cxy / (F.sqrt(vx) * F.sqrt(vy)))


def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5 + A6: pairwise-complete Pearson matrix in long form.

    Rows where either value is null (or NaN) are left out pair by pair, as
    pandas does; a constant column gives null (pandas: NaN) instead of a
    division-by-zero error.
    """
    names = F.array(*[F.lit(c) for c in cols])
    return _pair_sums(df, cols).select(
        F.element_at(names, F.col("i") + 1).alias("Feature1"),
        F.element_at(names, F.col("j") + 1).alias("Feature2"),
        _corr_from_sums().alias("Correlation"))


def top_correlated(df: DataFrame, cols: Sequence[str], target: str,
                   k: int = 10) -> DataFrame:
    """S3: the k predictors most correlated with the target (|r| desc, name)."""
    c = corr_long(df, [*cols, target])
    ranked = c.filter((F.col("Feature2") == target) & (F.col("Feature1") != target)
                      & F.col("Correlation").isNotNull()) \
        .select(F.col("Feature1").alias("feature"), F.col("Correlation").alias("correlation"))
    return ranked.orderBy(F.abs("correlation").desc(), "feature").limit(k)


def _bin_expr(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    width = (hi - lo) / F.lit(float(bins))
    raw = F.when(width > 0, F.floor(F.try_divide(x - lo, width))).otherwise(F.lit(0))
    return F.least(raw, F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over ``[min, max]``; empty bins included.

    Bounds are one small aggregate (two numbers to the driver), then the
    counting is one grouped aggregate with partial aggregation over literal
    bin edges. The last bin is closed on the right, as ``numpy.histogram``.
    """
    x = _nan_to_null(df, col).cast("double")
    vals = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    b = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    spark = df.sparkSession
    if b["lo"] is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, count long")
    lo, hi = F.lit(float(b["lo"])), F.lit(float(b["hi"]))
    counts = vals.select(_bin_expr(F.col("x"), lo, hi, bins).alias("bin")) \
        .groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / F.lit(float(bins))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_lo"),
        (lo + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def feature_distributions(df: DataFrame, cols: Sequence[str],
                          bins: int = 30) -> DataFrame:
    """One histogram per numeric column, through a single unpivot.

    Per-column bounds are a grouped aggregate (one row per column),
    attached to the rows as literals (no join on the column name, which
    would send each column's rows to one reducer).
    """
    long = df.select(*[_nan_to_null(df, c).cast("double").alias(c) for c in cols]) \
        .unpivot([], list(cols), "column", "x").filter(F.col("x").isNotNull())
    bounds = long.groupBy("column").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    counts = attach(long, bounds, ["column"], ["lo", "hi"]) \
        .select("column", _bin_expr(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin")) \
        .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = bounds.select("column", "lo", "hi",
                         F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def _with_targets(vals: DataFrame, targets: DataFrame, g: list[str], n: int,
                  more: Sequence[str] = ()) -> DataFrame:
    """Rows x their group's open targets.

    The target table (at most ``n`` rows per group) is pivoted to one row
    per group, attached (see ``functions.attach``) and exploded back into
    (row, target) pairs.
    """
    fields = ["__r", "__lo", "__hi", "__below", *more]
    wide = targets.groupBy(*g).agg(*[
        F.max(F.when(F.col("__t") == i, F.col(f))).alias(f"{f}_{i}")
        for i in range(n) for f in fields])
    cols = [f"{f}_{i}" for i in range(n) for f in fields]
    rows = attach(vals, wide, g, cols)
    per_target = F.explode(F.array(*[
        F.struct(F.lit(i).alias("__t"), *[F.col(f"{f}_{i}").alias(f) for f in fields])
        for i in range(n)]))
    return rows.select(*g, "__x", per_target.alias("__tt")).select(
        *g, "__x", "__tt.*").filter(F.col("__lo").isNotNull())


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), buckets: int = 64,
                    final_rows: int = 50_000, linear: bool = False) -> DataFrame:
    """Exact quantiles per group: the value of rank ``ceil(q * n)``, or with
    ``linear`` the interpolation between the two ranks around ``(n - 1) * q``.

    Distributed selection, no sort of the data and no group in one task:

    * one aggregate gives ``n, min, max`` per group, hence the target rank
      of every (group, quantile) and a first interval ``[lo, hi]``;
    * while an interval holds more than ``final_rows`` values that differ,
      a sketch gives edges of about equal *rank* inside it (every
      ``buckets``-th of the values), and one aggregate counts the values
      below, at, between, at and above the two edges around the target rank;
      the part with the target rank is the next interval. Values of an edge
      are a part of their own, so whatever repeats often is settled, every
      round leaves out a value at least, and about ``4 / buckets`` of the
      rows remain, however the values spread (infinities are values like
      others);
    * the remaining values per target are ranked with a window whose
      partitions are bounded by ``final_rows``.

    Null and NaN are left out; a null group is a group.
    """
    from pyspark import StorageLevel
    from pyspark.sql import Window
    from tabreg.session import cut_lineage
    g = list(group_cols) or ["__all"]
    x = _nan_to_null(df, col).cast("double")
    keys = [F.col(c) for c in group_cols] or [F.lit(0).alias("__all")]
    vals = df.select(*keys, x.alias("__x")).filter(F.col("__x").isNotNull()) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stats = vals.groupBy(*g).agg(F.count(F.lit(1)).alias("__n"), F.min("__x").alias("__lo"),
                                 F.max("__x").alias("__hi"))
    if linear:
        at = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
        ranks = [r for h in at for r in (F.floor(h) + 1, F.ceil(h) + 1)]
    else:
        ranks = [F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col("__n"))) for p in probs]
    tgt = F.explode(F.array(*[F.struct(F.lit(i).alias("__t"), r.cast("long").alias("__r"))
                              for i, r in enumerate(ranks)]))
    targets = cut_lineage(stats.select(*g, "__lo", "__hi", "__n", tgt.alias("tt")).select(
        *g, "tt.__t", "tt.__r", "__lo", "__hi", F.lit(0).cast("long").alias("__below"),
        F.col("__n").alias("__cnt")))
    open_ = (F.col("__cnt") > final_rows) & (F.col("__lo") < F.col("__hi"))
    whole = True
    while not targets.filter(open_).isEmpty():
        active = targets.filter(open_)
        # at first all targets of a group share its whole range: one sketch
        by = g if whole else [*g, "__t"]
        inside = vals if whole else _with_targets(vals, active, g, len(ranks)) \
            .filter((F.col("__x") >= F.col("__lo")) & (F.col("__x") <= F.col("__hi")))
        whole = False
        sketch = inside.groupBy(*by).agg(F.percentile_approx(
            "__x", [i / buckets for i in range(1, buckets)], 20 * buckets).alias("__e"))
        # the edges around the target rank, one more on each side for the sketch's error
        j = F.floor((F.col("__r") - F.col("__below") - 1) * F.lit(float(buckets)) / F.col("__cnt")).cast("int")
        active = cut_lineage(attach(active, sketch, by, ["__e"], max_rows=None).select(
            *g, "__t", "__r", "__lo", "__hi", "__below",
            F.get("__e", F.greatest(j - 2, F.lit(0))).alias("__from"),
            F.get("__e", F.least(j + 1, F.lit(buckets - 2))).alias("__to")).coalesce(parts))
        x_, from_, to_ = F.col("__x"), F.col("__from"), F.col("__to")
        bucket = (F.when(x_ < from_, 0).when(x_ == from_, 1).when(x_ < to_, 2)
                  .when(x_ == to_, 3).otherwise(4))
        h = _with_targets(vals, active, g, len(ranks), ("__from", "__to")) \
            .filter((x_ >= F.col("__lo")) & (x_ <= F.col("__hi"))) \
            .groupBy(*g, "__t", bucket.alias("__b")).agg(
                F.count(F.lit(1)).alias("__c"), F.min("__x").alias("__bmin"), F.max("__x").alias("__bmax"))
        w = Window.partitionBy(*g, "__t").orderBy("__b")  # five rows each
        h = h.withColumn("__cum", F.sum("__c").over(w))
        picked = attach(h, active.select(*g, "__t", "__r", "__below"), [*g, "__t"], ["__r", "__below"], max_rows=None) \
            .filter((F.col("__below") + F.col("__cum") - F.col("__c") < F.col("__r"))
                    & (F.col("__r") <= F.col("__below") + F.col("__cum"))) \
            .select(*g, "__t", "__r", F.col("__bmin").alias("__lo"),
                    F.col("__bmax").alias("__hi"),
                    (F.col("__below") + F.col("__cum") - F.col("__c")).alias("__below"),
                    F.col("__c").alias("__cnt"))
        # as many partitions every round
        targets = cut_lineage(targets.filter(~open_).unionByName(picked).coalesce(parts))
    # values of every target interval; equal-valued intervals need no ranking
    single = targets.filter(F.col("__lo") == F.col("__hi")).select(
        *g, "__t", F.col("__lo").alias("__q"))
    multi = targets.filter(F.col("__lo") < F.col("__hi"))
    cand = _with_targets(vals, multi, g, len(ranks)) \
        .filter((F.col("__x") >= F.col("__lo")) & (F.col("__x") <= F.col("__hi")))
    wr = Window.partitionBy(*g, "__t").orderBy("__x")  # <= final_rows rows each
    ranked = cand.withColumn("__rk", F.col("__below") + F.row_number().over(wr)) \
        .filter(F.col("__rk") == F.col("__r")).select(*g, "__t", F.col("__x").alias("__q"))
    picks = single.unionByName(ranked)

    def found(i: int):
        return F.max(F.when(F.col("__t") == i, F.col("__q")))

    wide = picks.groupBy(*g).agg(*[found(i).alias(f"v{i}") for i in range(len(ranks))])
    if linear:
        wide = attach(wide, stats.select(*g, "__n"), g, ["__n"], max_rows=None)
        cols = []
        for i, p in enumerate(probs):
            low, high = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
            h = (F.col("__n") - 1) * F.lit(float(p))
            cols.append(F.when(low == high, low).otherwise(low + (high - low) * (h - F.floor(h))).alias(f"q{i}"))
    else:
        cols = [F.col(f"v{i}").alias(f"q{i}") for i in range(len(probs))]
    out = cut_lineage(wide.select(*g, *cols))
    vals.unpersist()
    return out.drop("__all") if not group_cols else out


def quantiles(df: DataFrame, col: str, probs: Sequence[float],
              group_cols: Sequence[str] = (), method: str = "exact",
              accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Quantiles per group: ``exact`` (distributed selection, rank
    ``ceil(q * n)``), ``linear`` (exact, interpolated between ranks) or
    ``approx`` (``percentile_approx`` sketch, one pass, rank error at most
    ``n / accuracy``)."""
    if method in ("exact", "linear"):
        return exact_quantiles(df, col, probs, group_cols, linear=method == "linear")
    if method != "approx":
        raise ValueError(method)
    x = _nan_to_null(df, col).cast("double")
    q = F.percentile_approx(x, list(probs), accuracy)
    agg = df.groupBy(*group_cols).agg(q.alias("q")) if group_cols else df.agg(q.alias("q"))
    return agg.select(*group_cols, *[F.col("q")[i].alias(f"q{i}") for i in range(len(probs))])


def box_summary(df: DataFrame, col: str, group_cols: Sequence[str] = (),
                method: str = "exact", accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Quartiles, IQR fences and whiskers (extreme points inside the fences).

    Two aggregates: quantiles per group, then whiskers/outlier counts over
    the rows with their group's fences attached (literals per group, no
    shuffle by a low-cardinality group key). Without groups the fences are
    two literals.
    """
    g = list(group_cols)
    x = _nan_to_null(df, col).cast("double")
    vals = df.select(*g, x.alias("x")).filter(F.col("x").isNotNull())
    qs = quantiles(vals, "x", [0.25, 0.5, 0.75], g, method, accuracy).select(
        *g, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    qs = qs.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr")) \
        .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr"))
    if g:
        joined = attach(vals, qs, g, ["lower_fence", "upper_fence"])
    else:
        qs = df.sparkSession.createDataFrame([qs.first()], qs.schema)  # one row of numbers
        f = qs.first()
        joined = vals.withColumns({"lower_fence": F.lit(f["lower_fence"]).cast("double"),
                                   "upper_fence": F.lit(f["upper_fence"]).cast("double")})
    inside = (F.col("x") >= F.col("lower_fence")) & (F.col("x") <= F.col("upper_fence"))
    wh = joined.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("long").alias("n_outliers"))
    if g:
        return attach(qs, wh, g, ["n", "whisker_lo", "whisker_hi", "n_outliers"], max_rows=None)
    w = wh.first()
    return qs.withColumns({c: F.lit(w[c]).cast(t) for c, t in
                           [("n", "long"), ("whisker_lo", "double"), ("whisker_hi", "double"),
                            ("n_outliers", "long")]})


def skewness(df: DataFrame, col: str) -> DataFrame:
    """Population skewness of one column (one row)."""
    return df.agg(F.skewness(_nan_to_null(df, col).cast("double")).alias("skewness"))


def preview_head(df: DataFrame, order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """Deterministic ``head(n)``: order by a key, then limit."""
    return df.orderBy(*order_cols).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """``(n_rows, n_cols)`` as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)))


def drop_nulls(df: DataFrame, col: str) -> DataFrame:
    """P10: drop rows where one column is null (or NaN)."""
    return df.filter(_nan_to_null(df, col).isNotNull())
