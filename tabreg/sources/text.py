"""Delimited-text sources and sinks (IO1-IO5).

The reference reads CSV with an inferred schema, which silently turns an
integer column with one missing value into floats. Here the caller always
passes a ``StructType``; every field is first read as text, the missing
tokens are mapped to null, and only then is the value cast to its declared
type. Quoted fields may hold separators and doubled quotes, and with
``multi_line`` line breaks. A record with too many or too few fields, or with
an unparsable value, either fails the job (``malformed="fail"``), or is
reported: its text goes to the column that ``corrupt_column`` names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default missing-value tokens of pandas.read_csv
# (public pandas documentation), which the reference relies on implicitly.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

TRAINING_LOG_SCHEMA = T.StructType([
    T.StructField("iter", T.IntegerType()),
    T.StructField("RMSE", T.DoubleType()),
])

TIME_LOG_SCHEMA = T.StructType([
    T.StructField("iter", T.IntegerType()),
    T.StructField("Passed", T.LongType()),
    T.StructField("Remaining", T.LongType()),
])


def normalise_null_tokens(df: DataFrame, columns: list[str] | None = None,
                          tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Map missing tokens to null in string columns (IO4)."""
    cols = columns or [f.name for f in df.schema.fields
                       if isinstance(f.dataType, T.StringType)]
    token_list = [F.lit(t) for t in tokens]
    return df.withColumns({
        c: F.when(F.col(f"`{c}`").isin(*token_list), F.lit(None).cast("string"))
            .otherwise(F.col(f"`{c}`"))
        for c in cols
    })


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             header: bool = True, sep: str = ",",
             null_tokens: tuple[str, ...] = NULL_TOKENS, multi_line: bool = False,
             malformed: str = "null", corrupt_column: str | None = None) -> DataFrame:
    """CSV/TSV scan with an explicit schema and pandas-like missing tokens.

    Splittable unless ``multi_line``, so large files are read in parallel by
    ``maxPartitionBytes`` chunks; no schema-inference pass over the data.
    ``malformed``: ``null`` (missing fields and unparsable values are null;
    ``corrupt_column`` then names the records) or ``fail``.
    """
    if malformed not in ("null", "fail"):
        raise ValueError(malformed)
    raw_record = "__record"
    text_schema = T.StructType([T.StructField(f.name, T.StringType())
                                for f in schema.fields])
    if corrupt_column:
        text_schema = text_schema.add(raw_record, "string")
    raw = (spark.read.schema(text_schema)
           .option("header", header).option("sep", sep)
           .option("mode", "FAILFAST" if malformed == "fail" else "PERMISSIVE").option("nullValue", None)
           .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
           .option("columnNameOfCorruptRecord", raw_record)
           .option("emptyValue", "")
           .csv(path))
    raw = normalise_null_tokens(raw, [f.name for f in schema.fields], null_tokens)

    def typed(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            return c.alias(f.name)
        return (c.cast(f.dataType) if malformed == "fail" else c.try_cast(f.dataType)).alias(f.name)

    out = [typed(f) for f in schema.fields]
    if corrupt_column:
        unparsed = [F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
                           F.concat(F.lit(f"{f.name}="), F.col(f"`{f.name}`")))
                    for f in schema.fields if not isinstance(f.dataType, T.StringType)]
        out.append(F.coalesce(F.col(raw_record), *unparsed, F.lit(None).cast("string")).alias(corrupt_column))
    return raw.select(*out)


def read_training_log(spark: SparkSession, path: str,
                      schema: T.StructType = TRAINING_LOG_SCHEMA) -> DataFrame:
    """Boosting training log (tab separated, header ``iter<TAB>RMSE``)."""
    return read_csv(spark, path, schema, header=True, sep="\t")


def write_training_log(curve: DataFrame, path: str, metric: str = "RMSE") -> None:
    """Write a ``round, rmse`` curve as the training-log TSV layout (IO5)."""
    out = curve.select(F.col("round").cast("int").alias("iter"),
                       F.col("rmse").alias(metric))
    out.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
