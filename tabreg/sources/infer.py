"""Column types of delimited text, inferred from every row (IO1-IO3).

Missing tokens come first; each other value then has a set of types: boolean,
long (also a double), double, date (also a timestamp), timestamp, and string
always. A column's type is the first of these that all its values have. The
counts of values for each type merge, so one grouped aggregate over all rows
decides all columns, whatever the order or the number of partitions; no value
beyond a sample can turn up later that doesn't fit. The counts stay in the
result, beside the smallest value that keeps a column from the type that most
of its values have.

A column of missing values alone is double, as in pandas. Whole numbers with
missing values stay long: Spark's columns hold nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.sources.text import NULL_TOKENS, normalise_null_tokens, read_csv

# fixed values: candidate types, narrow ones first, and the forms of their values
FORMS = {
    "boolean": r"(?i)^(true|false)$",
    "long": r"^\s*[+-]?[0-9]+\s*$",
    "double": r"^\s*[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$",
}
TYPES = {"boolean": T.BooleanType(), "long": T.LongType(), "double": T.DoubleType(), "date": T.DateType(),
         "timestamp": T.TimestampType(), "string": T.StringType()}


def has_type(value: Column, kind: str) -> Column:
    """Whether the text has the form of the type and its value is one."""
    form = value.rlike(FORMS[kind])
    return form & value.try_cast(TYPES[kind]).isNotNull() if kind != "boolean" else form


def type_profile(text: DataFrame, columns: list[str] | None = None,
                 null_tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """(column, n_rows, n_null, n_boolean .. n_timestamp, inferred, n_conflicts, conflict)
    of text columns. ``n_conflicts`` values lack the type that most values have
    (none if no value has any), ``conflict`` is the smallest of them."""
    columns = columns or text.columns
    long = normalise_null_tokens(text.select(*[F.col(f"`{c}`") for c in columns]), columns, null_tokens).unpivot(
        [], [F.col(f"`{c}`") for c in columns], "column", "value")
    flags = long.select("column", "value", *[has_type(F.col("value"), k).alias(k) for k in FORMS])
    counts = flags.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_null"),
        *[F.count_if(F.col(k)).alias(f"n_{k}") for k in FORMS],
        *[F.min(F.when(~F.col(k), F.col("value"))).alias(f"not_{k}") for k in FORMS])
    values = F.col("n_rows") - F.col("n_null")
    inferred = F.when(values == 0, F.lit("double"))
    most = F.greatest(*[F.col(f"n_{k}") for k in FORMS])
    conflict = F.lit(None).cast("string")
    for k in reversed(FORMS):
        conflict = F.when(F.col(f"n_{k}") == most, F.col(f"not_{k}")).otherwise(conflict)
    for k in FORMS:
        inferred = inferred.when(F.col(f"n_{k}") == values, F.lit(k))
    some = most > 0
    return counts.select(
        "column", "n_rows", "n_null", *[f"n_{k}" for k in FORMS], inferred.otherwise("string").alias("inferred"),
        F.when(some, values - most).otherwise(F.lit(0)).alias("n_conflicts"), F.when(some, conflict).alias("conflict"))


def schema_of(profile: DataFrame, columns: list[str]) -> T.StructType:
    """The inferred schema: one row for each column reaches the driver."""
    found = {r["column"]: r["inferred"] for r in profile.select("column", "inferred").collect()}
    return T.StructType([T.StructField(c, TYPES[found.get(c, "string")]) for c in columns])


def csv_type_profile(spark: SparkSession, path: str, sep: str = ",", header: bool = True, multi_line: bool = False,
                     null_tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """``type_profile`` of a delimited file, its columns by the header."""
    return type_profile(_as_text(spark, path, sep, header, multi_line), null_tokens=null_tokens)


def infer_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True, multi_line: bool = False,
              null_tokens: tuple[str, ...] = NULL_TOKENS, **options) -> DataFrame:
    """``read_csv`` with the inferred schema: one pass to infer, one to read.

    A file without data rows gives string columns.
    """
    text = _as_text(spark, path, sep, header, multi_line)
    schema = schema_of(type_profile(text, null_tokens=null_tokens), text.columns) if text.columns else T.StructType([])
    return read_csv(spark, path, schema, header=header, sep=sep, null_tokens=null_tokens, multi_line=multi_line, **options)


def _as_text(spark: SparkSession, path: str, sep: str, header: bool, multi_line: bool) -> DataFrame:
    # without a schema and without inference Spark reads the names alone, all columns as text
    return (spark.read.option("header", header).option("sep", sep).option("inferSchema", False)
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .option("emptyValue", "").csv(path))
