"""Splits, encoders, scalers, imputation, outliers, assembly.

Fitting is a small number of aggregates whose results (moments, category
lists behind a size check, quantiles) become literals of a single
``select`` at transform time, so applying a fitted pipeline is one
whole-stage-codegen projection with no shuffle, and it works unchanged on
a streaming DataFrame.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from typing import Any, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.functions.hashing import hash_bucket
from tabreg.operators.dictionary import Dictionary, fit_dictionaries
from tabreg.operators.profile import QUANTILE_ACCURACY, _as_text, _nan_to_null, long_values

MAX_CATEGORIES = 10_000


# ----------------------------------------------------------------- splits

def _threshold(fraction: float, buckets: int = 100) -> int:
    t = round(fraction * buckets)
    if abs(t - fraction * buckets) > 1e-9:
        raise ValueError(f"fraction {fraction} must be a multiple of 1/{buckets}")
    return t


def with_split(df: DataFrame, key_cols: str | Sequence[str], test_fraction: float = 0.2,
               salt: str = "", out: str = "is_test") -> DataFrame:
    """F1 as a column: ``is_test`` from a salted md5 bucket of the row key.

    No shuffle, independent of partitioning, reproducible in SQL.
    """
    return df.withColumn(out, hash_bucket(key_cols, 100, salt) < F.lit(_threshold(test_fraction)))


def train_test_split(df: DataFrame, key_cols: str | Sequence[str],
                     test_fraction: float = 0.2, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` frames by a deterministic hash of the key."""
    b = hash_bucket(key_cols, 100, salt)
    t = F.lit(_threshold(test_fraction))
    return df.filter(b >= t), df.filter(b < t)


def three_way_split(df: DataFrame, key_cols: str | Sequence[str],
                    test_fraction: float = 0.2, val_fraction: float = 0.2,
                    salts: tuple[str, str] = ("", "val"), out: str = "split") -> DataFrame:
    """nested split - test first, then validation out of the rest."""
    b1 = hash_bucket(key_cols, 100, salts[0])
    b2 = hash_bucket(key_cols, 100, salts[1])
    return df.withColumn(out, F.when(b1 < _threshold(test_fraction), F.lit("test"))
                         .when(b2 < _threshold(val_fraction), F.lit("val"))
                         .otherwise(F.lit("train")))


def with_kfold(df: DataFrame, key_cols: str | Sequence[str], k: int,
               salt: str = "fold", out: str = "fold") -> DataFrame:
    """fold number in ``[0, k)`` (usable as ``CrossValidator(foldCol=...)``)."""
    return df.withColumn(out, hash_bucket(key_cols, k, salt))


# ------------------------------------------------------------ one-hot

def _render(v: Any) -> str:
    return "nan" if v is None else str(v)


def _typed_sort_key(dtype: T.DataType):
    numeric = isinstance(dtype, T.NumericType)

    def key(v):
        if v is None:
            return (1, 0.0, "")
        return (0, float(v), "") if numeric else (0, 0.0, v)
    return key


class TooManyCategories(ValueError):
    """A column has more values than fit in literals; ``dictionary`` encodes it."""


def fit_categories(df: DataFrame, cols: Sequence[str],
                   max_categories: int = MAX_CATEGORIES) -> dict[str, list]:
    """A10: sorted distinct values per column, null last as its own category.

    One grouped aggregate. A column of more than ``max_categories`` values is
    an error here, so the driver receives at most ``max_categories`` values for
    each column, and one more; the encoders go on with a dictionary table.
    """
    return _categories_from_pairs(df, cols, long_values(df, cols).distinct(), max_categories)


def _categories_from_pairs(df: DataFrame, cols: Sequence[str], pairs: DataFrame,
                           max_categories: int) -> dict[str, list]:
    """Typed, sorted category lists from distinct ``(column, value)`` text
    pairs; ``max_categories`` is the limit of each column."""
    most = max_categories * max(len(cols), 1)
    rows = pairs.select("column", "value").limit(most + 1).collect()
    per_column = Counter(r["column"] for r in rows)
    over = sorted(c for c, n in per_column.items() if n > max_categories)
    if over:
        raise TooManyCategories(f"more than {max_categories} categories in {over}")
    cats: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        cats[r["column"]].append(r["value"])
    out = {}
    for c in cols:
        dtype = df.schema[c].dataType
        typed = [None if v is None else _from_text(v, dtype) for v in cats[c]]
        out[c] = sorted(typed, key=_typed_sort_key(dtype))
    return out


def _fit_literals_and_tables(df: DataFrame, cols: Sequence[str], max_categories: int | None,
                             literals: int) -> tuple[dict[str, list], dict[str, Dictionary]]:
    """Category lists of the columns of at most ``literals`` values, dictionaries
    of the others; more than ``max_categories``, where given, are an error."""
    try:
        return fit_categories(df, cols, literals if max_categories is None else max_categories), {}
    except TooManyCategories:
        if max_categories is not None:
            raise
        fitted = fit_dictionaries(df, cols)
    small = {c: [r["value"] for r in d.table.orderBy("code").collect()]
             for c, d in fitted.items() if d.size <= literals}
    return small, {c: d for c, d in fitted.items() if c not in small}


def _from_text(v: str, dtype: T.DataType):
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return int(v)
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return float(v)
    return v


@dataclass
class OneHotModel:
    """0/1 columns for each category; a column of ``tables`` (more categories
    than literals may hold) becomes one sparse vector column ``<column>_onehot``."""
    categories: dict[str, list]
    drop_first: bool = False
    handle_unknown: str = "ignore"
    tables: dict[str, Dictionary] = field(default_factory=dict)

    def _names(self) -> dict[str, list[tuple[Any, str]]]:
        """(category, output name) per column. A name that is taken (the text
        "nan" beside null, or ``a_b`` + ``c`` beside ``a`` + ``b_c``) gets a number."""
        taken: set[str] = set()
        out: dict[str, list[tuple[Any, str]]] = {}
        for c, cats in self.categories.items():
            out[c] = []
            for v in cats[1:] if self.drop_first else cats:
                base = name = f"{c}_{_render(v)}"
                n = 1
                while name in taken:
                    n += 1
                    name = f"{base}__{n}"
                taken.add(name)
                out[c].append((v, name))
        return out

    def output_columns(self) -> list[str]:
        return [name for pairs in self._names().values() for _, name in pairs]

    def columns(self) -> list[Column]:
        exprs = []
        names = self._names()
        for c, cats in self.categories.items():
            col = F.col(c)
            known = [v for v in cats if v is not None]
            bad = col.isNull() if None not in cats else F.lit(False)
            bad = bad | (col.isNotNull() & ~col.isin(*known) if known else col.isNotNull())
            for v, name in names[c]:
                hit = col.isNull() if v is None else (col == F.lit(v))
                flag = F.when(hit, 1.0)
                if self.handle_unknown == "error":
                    # part of the value itself: a separate check would be pruned
                    flag = flag.when(bad, F.raise_error(F.concat(
                        F.lit(f"unknown category in {c}: "), F.coalesce(col.cast("string"), F.lit("null"))))
                        .cast("double"))
                exprs.append(flag.otherwise(0.0).alias(name))
        return exprs

    def transform(self, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
        """Replace the encoded columns by 0/1 doubles named ``column_value``."""
        enc = {*self.categories, *self.tables}
        keep = [c for c in df.columns if c not in enc] if keep is None else list(keep)
        vectors = []
        for c, d in self.tables.items():
            vectors.append(f"{c}_onehot")
            df = d.one_hot(df, vectors[-1], self.drop_first, self.handle_unknown)
        return df.select(*[F.col(c) for c in keep], *self.columns(), *vectors)


@dataclass
class OneHotEncoder:
    """F4 (``handle_unknown='ignore'``: unseen -> all zeros) and F5 (``drop_first``).

    A column of more than ``literals`` values is encoded by a dictionary table,
    as one sparse vector column; ``max_categories``, where given, is a limit.
    """
    cols: Sequence[str]
    drop_first: bool = False
    handle_unknown: str = "ignore"
    max_categories: int | None = None
    literals: int = MAX_CATEGORIES

    def fit(self, df: DataFrame) -> OneHotModel:
        lists, tables = _fit_literals_and_tables(df, self.cols, self.max_categories, self.literals)
        return OneHotModel(lists, self.drop_first, self.handle_unknown, tables)


def one_hot_vector_stages(col: str, out: str, drop_first: bool = False):
    """F4/F5 as ``pyspark.ml`` stages for sparse model features.

    The null token sorts last, the indexer keeps unseen values in an extra
    index and the encoder drops exactly that slot, so an unseen value is
    an all-zero vector and a training null is a category of its own.
    """
    from pyspark.ml.feature import OneHotEncoder as MLOneHot
    from pyspark.ml.feature import SQLTransformer, StringIndexer
    filled = f"{col}__filled"
    fill = SQLTransformer(statement=(
        f"SELECT *, coalesce(CAST(`{col}` AS STRING), '~null') AS `{filled}` FROM __THIS__"))
    idx = StringIndexer(inputCol=filled, outputCol=f"{col}__idx",
                        stringOrderType="alphabetDesc" if drop_first else "alphabetAsc",
                        handleInvalid="error" if drop_first else "keep")
    enc = MLOneHot(inputCols=[f"{col}__idx"], outputCols=[out], dropLast=True,
                   handleInvalid="error")
    return [fill, idx, enc]


# ------------------------------------------------------------ ordinal

def ordinal_expr(col: str, order: Sequence[Any]) -> Column:
    """position in an explicit order; unseen or missing -> -1.

    ``array_position`` is 1-based and returns 0 when absent (null on a null
    input), hence ``nullif(..., 0) - 1`` and the outer ``coalesce``.
    """
    arr = F.array(*[F.lit(v) for v in order])
    pos = F.array_position(arr, F.col(col))
    return F.coalesce(F.nullif(pos, F.lit(0)) - 1, F.lit(-1)).cast("double")


@dataclass
class OrdinalModel:
    """Codes from literals, and from a join for the columns of ``tables``."""
    orders: Mapping[str, Sequence[Any]]
    tables: Mapping[str, Dictionary] = field(default_factory=dict)

    def columns(self) -> list[Column]:
        if self.tables:
            raise ValueError(f"{sorted(self.tables)} are encoded by a join: use transform")
        return [ordinal_expr(c, o).alias(c) for c, o in self.orders.items()]

    def transform(self, df: DataFrame) -> DataFrame:
        for c, d in self.tables.items():
            df = d.with_code(df, c).withColumn(c, F.col(c).cast("double"))
        return df.withColumns({c: ordinal_expr(c, o) for c, o in self.orders.items()}) if self.orders else df


@dataclass
class OrdinalEncoder:
    """F6 with explicit orders keyed by column name (never by position).

    With ``orders=None`` per column it becomes F7, label encoding by the
    sorted distinct values fitted on the training frame: literals for at most
    ``literals`` values, else a dictionary table. ``max_categories``, where
    given, is a limit.
    """
    orders: Mapping[str, Sequence[Any] | None]
    max_categories: int | None = None
    literals: int = MAX_CATEGORIES

    def fit(self, df: DataFrame) -> OrdinalModel:
        auto = [c for c, o in self.orders.items() if o is None]
        fitted, tables = _fit_literals_and_tables(df, auto, self.max_categories, self.literals) if auto else ({}, {})
        return OrdinalModel({c: (list(o) if o is not None
                                 else [v for v in fitted[c] if v is not None])
                             for c, o in self.orders.items() if c not in tables}, tables)


def label_encoder(cols: Sequence[str]) -> OrdinalEncoder:
    """codes 0..n-1 in sorted order of the training values; unseen -> -1."""
    return OrdinalEncoder({c: None for c in cols})


# ------------------------------------------------------------ scalers

@dataclass
class StandardScalerModel:
    stats: dict[str, tuple[float | None, float | None]]  # mean, population std

    def expr(self, c: str) -> Column:
        mean, std = self.stats[c]
        scale = std if std not in (None, 0.0) else 1.0
        if mean is None:
            return F.col(c).cast("double")
        return (F.col(c).cast("double") - F.lit(mean)) / F.lit(scale)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.expr(c) for c in self.stats})


@dataclass
class StandardScaler:
    """F8: ``(x - mean) / std`` with population std (ddof 0); zero std -> 1.

    ``pyspark.ml.feature.StandardScaler`` uses the sample std, hence our own.
    One aggregate fits all columns.
    """
    cols: Sequence[str]

    def fit(self, df: DataFrame) -> StandardScalerModel:
        aggs = []
        for c in self.cols:
            v = _nan_to_null(df, c).cast("double")
            aggs += [F.avg(v).alias(f"m_{c}"), F.stddev_pop(v).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        return StandardScalerModel({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in self.cols})


def standard_scale_refit(df: DataFrame, cols: Sequence[str],
                         fit_on: DataFrame | None = None) -> DataFrame:
    """scale with statistics of ``fit_on`` (default: ``df`` itself).

    ``fit_on=None`` reproduces the reference's re-fit of the scaler on the
    test set; pass the training frame for the clean behaviour (= F8).
    """
    return StandardScaler(cols).fit(fit_on if fit_on is not None else df).transform(df)


@dataclass
class MinMaxScalerModel:
    stats: dict[str, tuple[float | None, float | None]]

    def expr(self, c: str) -> Column:
        lo, hi = self.stats[c]
        if lo is None:
            return F.col(c).cast("double")
        rng = (hi - lo) if hi != lo else 1.0
        return (F.col(c).cast("double") - F.lit(lo)) / F.lit(rng)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.expr(c) for c in self.stats})


@dataclass
class MinMaxScaler:
    """``(x - min) / (max - min)``; a constant column maps to 0."""
    cols: Sequence[str]

    def fit(self, df: DataFrame) -> MinMaxScalerModel:
        aggs = []
        for c in self.cols:
            v = _nan_to_null(df, c).cast("double")
            aggs += [F.min(v).alias(f"lo_{c}"), F.max(v).alias(f"hi_{c}")]
        row = df.agg(*aggs).first()
        return MinMaxScalerModel({c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in self.cols})


# ------------------------------------------------------------ imputation

@dataclass
class ImputerModel:
    fill: dict[str, Any]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(_nan_to_null(df, c), F.lit(v))
                               for c, v in self.fill.items() if v is not None})


@dataclass
class Imputer:
    """fill missing values with the training mean, median or mode.

    * mean: ``avg``; median: exact discrete median (rank ``ceil(n/2)``,
      distributed selection) or the ``percentile_approx`` sketch; mode: most
      frequent value, ties to the smallest, from a grouped count.
    """
    cols: Sequence[str]
    strategy: str = "mean"
    method: str = "exact"
    accuracy: int = QUANTILE_ACCURACY

    def fit(self, df: DataFrame) -> ImputerModel:
        if self.strategy == "mean":
            row = df.agg(*[F.avg(_nan_to_null(df, c).cast("double")).alias(c)
                           for c in self.cols]).first()
            return ImputerModel({c: row[c] for c in self.cols})
        if self.strategy == "median":
            # all columns in one unpivoted, per-column grouped selection
            from tabreg.operators.profile import quantiles
            cols = list(self.cols)
            long = df.select(*[_nan_to_null(df, c).cast("double").alias(c) for c in cols]) \
                .unpivot([], cols, "column", "x")
            med = quantiles(long, "x", [0.5], ["column"], method=self.method,
                            accuracy=self.accuracy).collect()  # one row per column
            found = {r["column"]: r["q0"] for r in med}
            return ImputerModel({c: found.get(c) for c in cols})
        if self.strategy == "mode":
            return ImputerModel(mode_values(df, self.cols))
        raise ValueError(f"unknown strategy {self.strategy}")


def mode_frame(df: DataFrame, col: str) -> DataFrame:
    """Most frequent non-null value (ties -> smallest) as a one-row frame."""
    counts = df.select(_nan_to_null(df, col).alias("v")).filter(F.col("v").isNotNull()) \
        .groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"))


def mode_value(df: DataFrame, col: str):
    return mode_frame(df, col).first()["mode"]


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict[str, Any]:
    """Mode of many columns: one ``groupBy(column, value)`` per data type
    (columns of one type share an unpivot, so ties still go to the smallest
    value in the column's own order). Partial aggregation collapses a hot
    value before the shuffle; one row per column reaches the driver."""
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out: dict[str, Any] = {c: None for c in cols}
    for group in by_type.values():
        long = df.select(*[_nan_to_null(df, c).alias(c) for c in group]) \
            .unpivot([], group, "column", "v").filter(F.col("v").isNotNull())
        counts = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("column").agg(
            F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mode"))
        out.update({r["column"]: r["mode"] for r in best.collect()})  # one row per column
    return out


# ------------------------------------------------------------ outliers

def outlier_flags(df: DataFrame, col: str, method: str = "iqr", k: float = 1.5,
                  z: float = 3.0, out: str = "is_outlier", quantile_method: str = "exact",
                  accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """flag rows outside the IQR fences (or beyond ``z`` std devs).

    Fences are two numbers from one aggregate; the flag is then a plain
    projection. A null value is never an outlier.
    """
    x = _nan_to_null(df, col).cast("double")
    if method == "iqr":
        from tabreg.operators.profile import quantiles
        r = quantiles(df, col, [0.25, 0.75], method=quantile_method, accuracy=accuracy).first()
        q1, q3 = r["q0"], r["q1"]
        lo = q1 - k * (q3 - q1) if q1 is not None else None
        hi = q3 + k * (q3 - q1) if q1 is not None else None
    elif method == "zscore":
        r = df.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).first()
        lo = r["m"] - z * r["s"] if r["m"] is not None else None
        hi = r["m"] + z * r["s"] if r["m"] is not None else None
    else:
        raise ValueError(method)
    lo, hi = F.lit(lo).cast("double"), F.lit(hi).cast("double")
    return df.withColumn(out, F.coalesce((x < lo) | (x > hi), F.lit(False)))


def remove_outliers(df: DataFrame, col: str, **kw) -> DataFrame:
    """the frame without the flagged rows."""
    flagged = outlier_flags(df, col, out="__outlier", **kw)
    return flagged.filter(~F.col("__outlier")).drop("__outlier")


# ------------------------------------------------------------ assembly, pipeline

def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """feature vector; nulls are an error (nothing is silently dropped)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid="error").transform(df)


@dataclass(frozen=True)
class FeatureSpec:
    """Measurement levels by column name; a column may sit in two groups."""
    numerical: tuple[str, ...] = ()
    nominal: tuple[str, ...] = ()
    ordinal: Mapping[str, Sequence[Any] | None] = field(default_factory=dict)


@dataclass
class FeaturePipelineModel:
    key: Sequence[str]
    label: str | None
    numerical: list[str]
    scaler: StandardScalerModel | None
    one_hot: OneHotModel | None
    ordinal: OrdinalModel | None
    dropped: list[str]
    derive: Mapping[str, Column] = field(default_factory=dict)

    @property
    def feature_columns(self) -> list[str]:
        cols = list(self.numerical)
        if self.one_hot:
            cols += self.one_hot.output_columns()
        if self.ordinal:
            cols += [f"ord_{c}" for c in self.ordinal.orders]
        return cols

    def transform(self, df: DataFrame, assemble_vector: bool = False) -> DataFrame:
        """One projection: key, label, scaled numerics, one-hot, ordinal codes
        (of derived columns too)."""
        df = _with_derived(df, self.derive)
        exprs: list[Column] = [F.col(k) for k in self.key]
        if self.label and self.label in df.columns:
            exprs.append(F.col(self.label).cast("double").alias("label"))
        for c in self.numerical:
            e = self.scaler.expr(c) if self.scaler else F.col(c).cast("double")
            exprs.append(e.alias(c))
        if self.one_hot:
            exprs += [e for e in self.one_hot.columns()]
        if self.ordinal:
            exprs += [ordinal_expr(c, o).alias(f"ord_{c}")
                      for c, o in self.ordinal.orders.items()]
        out = df.select(*exprs)
        if assemble_vector:
            out = assemble(out, self.feature_columns)
        return out


def _profile_aggregate(df: DataFrame, cat: Sequence[str], num: Sequence[str]) -> DataFrame:
    """``kind, column, value, cnt, nx, mean, std`` in one grouped aggregate.

    Categorical columns (kind ``c``) give one row per distinct value (text,
    null kept as a value); numeric columns (kind ``n``) give one row each,
    with the count of rows, of non-null values, their mean and population
    std - the same expressions as ``StandardScaler``/``null_ratio``.
    """
    fields = []
    for c in cat:
        fields.append(F.struct(F.lit("c").alias("kind"), F.lit(c).alias("column"),
                               _as_text(df, c).alias("value"),
                               F.lit(None).cast("double").alias("x")))
    for c in num:
        fields.append(F.struct(F.lit("n").alias("kind"), F.lit(c).alias("column"),
                               F.lit(None).cast("string").alias("value"),
                               _nan_to_null(df, c).cast("double").alias("x")))
    if not fields:
        return df.sparkSession.createDataFrame(
            [], "kind string, column string, value string, cnt long, nx long, "
                "mean double, std double")
    names = [f"__p{i}" for i in range(len(fields))]
    long = df.select(*[f.alias(n) for f, n in zip(fields, names)]) \
        .unpivot([], names, "__slot", "r").select("r.*")
    return long.groupBy("kind", "column", "value").agg(
        F.count(F.lit(1)).alias("cnt"), F.count("x").alias("nx"),
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))


def _with_derived(df: DataFrame, derive: Mapping[str, Column]) -> DataFrame:
    """One column after the other, so that one may use those before it."""
    for name, expr in derive.items():
        df = df.withColumn(name, expr)
    return df


@dataclass
class FeaturePipeline:
    """fit once on training rows, apply the same state to any frame.

    Steps (reference order): derived columns (``derive``: name -> expression,
    which the groups of ``spec`` may name) and columns that give way to them
    (``drop``: taken out of the groups), optional profile-driven drops (dominance
    ``>=`` and null share ``>`` thresholds, A3/A4), standard scaling of
    numerics, one-hot of nominals, explicit-order ordinal codes.
    ``refit_scaler_on_transform`` is not offered: re-fitting on the test
    set (F14) is available as ``standard_scale_refit(test, cols)``.
    """
    spec: FeatureSpec
    key: Sequence[str] = ()
    label: str | None = None
    scale: bool = True
    drop_first: bool = False
    dominance_threshold: float | None = None
    null_threshold: float | None = None
    derive: Mapping[str, Column] = field(default_factory=dict)
    drop: Sequence[str] = ()

    def fit(self, df: DataFrame) -> FeaturePipelineModel:
        """One pass over the training rows.

        A single ``groupBy(kind, column, value)`` over one unpivot holds
        the count of every categorical value (null counted as a value) and,
        for every numeric column, one group with its count, non-null count,
        mean and population std. Partial aggregation collapses hot values
        before the shuffle. Dominance, null shares, scaler moments and
        category lists are all read from that small result (cached while
        fitting); the training rows themselves are never cached.
        """
        df = _with_derived(df, self.derive)
        gone = set(self.drop)
        numerical = [c for c in self.spec.numerical if c not in gone]
        nominal = [c for c in self.spec.nominal if c not in gone]
        ordinal = {c: o for c, o in self.spec.ordinal.items() if c not in gone}
        cat = sorted(set(nominal) | set(ordinal))
        num = numerical if (self.scale or self.null_threshold is not None) else []
        profile = _profile_aggregate(df, cat, num).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._fit_from(df, profile, numerical, nominal, ordinal, cat, num)
        finally:
            profile.unpersist()

    def _fit_from(self, df, profile, numerical, nominal, ordinal, cat, num):
        per_col = {(r["kind"], r["column"]): r for r in profile.groupBy("kind", "column").agg(
            (F.max("cnt") / F.sum("cnt")).alias("top_freq"),
            (F.coalesce(F.sum(F.when(F.col("kind") == "c",
                                     F.when(F.col("value").isNull(), F.col("cnt")))
                              .otherwise(F.col("cnt") - F.col("nx"))), F.lit(0))
             / F.sum("cnt")).alias("nan_ratio"),
            F.max("mean").alias("mean"), F.max("std").alias("std")).collect()}  # one row per column
        drop = set()
        if self.dominance_threshold is not None:
            drop |= {c for c in cat if per_col.get(("c", c)) is not None
                     and per_col[("c", c)]["top_freq"] >= self.dominance_threshold}
        if self.null_threshold is not None:
            drop |= {c for c in cat if per_col.get(("c", c)) is not None
                     and per_col[("c", c)]["nan_ratio"] > self.null_threshold}
            drop |= {c for c in numerical if per_col.get(("n", c)) is not None
                     and per_col[("n", c)]["nan_ratio"] > self.null_threshold}
        dropped = sorted(drop)
        numerical = [c for c in numerical if c not in drop]
        nominal = [c for c in nominal if c not in drop]
        ordinal = {c: o for c, o in ordinal.items() if c not in drop}
        scaler = None
        if self.scale and numerical:
            scaler = StandardScalerModel({c: (per_col[("n", c)]["mean"], per_col[("n", c)]["std"])
                                          if ("n", c) in per_col else (None, None)
                                          for c in numerical})

        def categories(cols):
            pairs = profile.filter((F.col("kind") == "c") & F.col("column").isin(*cols))
            return _categories_from_pairs(df, cols, pairs, MAX_CATEGORIES)
        one_hot = OneHotModel(categories(nominal), self.drop_first) if nominal else None
        auto = [c for c, o in ordinal.items() if o is None]
        fitted = categories(auto) if auto else {}
        ordm = OrdinalModel({c: (list(o) if o is not None
                                 else [v for v in fitted[c] if v is not None])
                             for c, o in ordinal.items()}) if ordinal else None
        return FeaturePipelineModel(list(self.key), self.label, numerical, scaler,
                                    one_hot, ordm, dropped, dict(self.derive))
