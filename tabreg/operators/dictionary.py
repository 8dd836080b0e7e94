"""Dictionary encoding of columns of any number of values.

Fitted lists of a few thousand values become literals (``prep``); beyond that
the dictionary is a table. Its codes are dense and in the values' own order,
null last, without any task or the driver holding all values:

1. one grouped aggregate counts each distinct value (combined map-side),
2. the distinct values are range-partitioned and sorted, so a value's code is
   its position in its partition plus the number of values before it,
3. positions come from the row numbers that partitions give out by themselves;
   the driver adds up one count for each partition.

Encoding is a join on the value. Values that hold more than one row in
``HEAVY`` (so there are at most ``HEAVY`` of them), and null, get their code
from literals instead, and their rows go through the join dealt over all
tasks; so a value with a third of the rows lands in no single task.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabreg.operators.profile import _nan_to_null
from tabreg.session import written

HEAVY = 200
_ROW_BITS = 33  # of monotonically_increasing_id: the row's number in its partition
_SALTS = 100_000


def _value(df: DataFrame, col: str) -> Column:
    v = _nan_to_null(df, col)
    return v + F.lit(0.0).cast(df.schema[col].dataType) if df.schema[col].dataType.simpleString() in ("float", "double") else v


@dataclass
class Dictionary:
    """``table``: (value, code, n), one row for each value, null last."""
    column: str
    table: DataFrame
    size: int
    heavy: list[tuple[Any, int]]
    null_code: int | None

    @property
    def n_values(self) -> int:
        """Number of values other than null; their codes are 0 to this less one."""
        return self.size - (self.null_code is not None)

    def with_code(self, df: DataFrame, out: str, null: str = "unseen", unseen: int = -1) -> DataFrame:
        """``df`` with the code of ``column`` as ``out`` (long).

        A null gets the code after all values (``null="own"``, if the fit saw
        a null) or counts as unseen.
        """
        if null not in ("unseen", "own"):
            raise ValueError(null)
        own = self.null_code if null == "own" and self.null_code is not None else unseen
        value, names = _value(df, self.column), df.columns
        key, salt, known = (_free(names, x) for x in ("_dict_value", "_dict_salt", "_dict_code"))
        literal = F.when(value.isNull(), F.lit(own))
        for v, code in self.heavy:
            literal = literal.when(value == F.lit(v), F.lit(code))
        literal = literal.cast("long")
        # rows that need no lookup match nothing and are dealt by their hash
        dealt = df.withColumn(key, value).withColumn(known, literal).withColumn(
            salt, F.when(F.col(known).isNotNull(), 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.lit(_SALTS)))
            .otherwise(F.lit(0)))
        found = _free([*names, key, salt, known], "_dict_found")
        # no code is negative, but a constant salt would be planned away, and with it the dealing
        table = self.table.filter(F.col("value").isNotNull()).select(
            F.col("value").alias(key), F.when(F.col("code") < 0, 1).otherwise(0).cast("long").alias(salt),
            F.col("code").alias(found))
        # nulls of the key never meet a value: a plain equality is enough
        joined = dealt.join(table, [key, salt], "left")
        code = F.coalesce(F.col(known), F.col(found), F.lit(unseen).cast("long"))
        return joined.select(*[code.alias(c) if c == out else F.col(f"`{c}`") for c in names],
                             *([] if out in names else [code.alias(out)]))

    def one_hot_names(self, drop_first: bool = False) -> DataFrame:
        """(slot, name): the slots' names ``column_value``, as a table."""
        text = F.concat(F.lit(f"{self.column}_"), F.coalesce(F.col("value").cast("string"), F.lit("nan")))
        first = int(drop_first)
        return self.table.filter(F.col("code") >= first).select((F.col("code") - first).alias("slot"), text.alias("name"))

    def one_hot(self, df: DataFrame, out: str, drop_first: bool = False, handle_unknown: str = "ignore") -> DataFrame:
        """``df`` with sparse 0/1 vectors ``out``; null is a category of its own
        if the fit saw one, an unseen value is all zeros (or an error)."""
        from pyspark.ml.feature import OneHotEncoder
        index = _free(df.columns, "_dict_index")
        first = int(drop_first)
        width = self.size - first
        if width < 1:
            raise ValueError(f"{self.column} has no category to encode")
        coded = self.with_code(df, index, null="own")
        code = F.col(index)
        if handle_unknown == "error":
            code = F.when(code < 0, F.raise_error(F.lit(f"unknown category in {self.column}")).cast("long")).otherwise(code)
        # the slot after the last is the one that the encoder drops: all zeros.
        # Its number of slots is in the column's metadata, so nothing is fitted.
        slot = F.when(code >= first, code - first).otherwise(F.lit(width)).cast("double")
        coded = coded.withColumn(index, slot.alias(index, metadata={
            "ml_attr": {"type": "nominal", "name": index, "num_vals": width + 1}}))
        encoder = OneHotEncoder(inputCols=[index], outputCols=[out], dropLast=True, handleInvalid="error")
        return encoder.fit(coded).transform(coded).drop(index)


def _free(taken: Sequence[str], name: str) -> str:
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def fit_dictionary(df: DataFrame, col: str) -> Dictionary:
    """The dictionary of one column: distinct values, dense codes in their order."""
    spark = df.sparkSession
    counts = df.select(_value(df, col).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("value").isNull(), F.col("value")]
    placed = written(counts.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("at", F.monotonically_increasing_id()), "dictionary")
    part = F.shiftright("at", _ROW_BITS)
    sums = placed.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"), F.max(F.col("value").isNull()).alias("null")).collect()
    sums.sort(key=lambda r: r["part"])  # one row for each partition
    before, at = [], 0
    for r in sums:
        before.append((r["part"], at))
        at += r["values"]
    # written, so that the planner knows how small it is
    offsets = written(spark.createDataFrame(before, "part long, before long").coalesce(1), "dictionary-offsets")
    table = placed.withColumn("part", part).join(offsets, "part").select(
        "value", (F.col("before") + F.col("at") - F.shiftleft(F.col("part"), _ROW_BITS)).alias("code"), "n")
    rows = sum(r["rows"] for r in sums)
    # by the pigeonhole principle fewer than HEAVY values
    heavy = [(r["value"], r["code"]) for r in table.filter(
        F.col("value").isNotNull() & (F.col("n") * HEAVY > rows)).select("value", "code").collect()]
    has_null = any(r["null"] for r in sums)
    return Dictionary(col, table, at, heavy, at - 1 if has_null else None)


def fit_dictionaries(df: DataFrame, cols: Sequence[str]) -> dict[str, Dictionary]:
    return {c: fit_dictionary(df, c) for c in cols}


def category_table(dictionaries: dict[str, Dictionary]) -> DataFrame:
    """A10 as a table: (column, value text, code, n), null last in each column."""
    out = None
    for c, d in dictionaries.items():
        one = d.table.select(F.lit(c).alias("column"), F.col("value").cast("string").alias("value"), "code", "n")
        out = one if out is None else out.unionByName(one)
    return out
