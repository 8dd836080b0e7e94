"""Data dictionaries kept as text: columns, their codes and meanings.

    Zoning: Identifies the general zoning of the sale.

           A    Agriculture
           RL   Residential, low
                density

A line that begins at the margin and has a colon describes a column; an
indented line with a tab after its first part is a code and its meaning; any
other line that isn't blank goes on with the line above. A line belongs to the
last column before it, wherever files are split: columns are carried forward
over range partitions (``scan.running_last``), not by one task that reads all
lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabreg.functions.scan import running_last

# fixed values: the three forms of a line
_COLUMN = r"^(\S[^:\t]*?)[\x20\t]*:(.*)$"
_CODE = r"^[\x20\t]+(\S[^\t]*?)[\x20]*\t[\x20\t]*(.*)$"
_MARGIN = r"^[\x20\t\r]+|[\x20\t\r]+$"


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(column, code, meaning); a row with a null code describes its column.

    Lines before the first column have a null column. Repeated codes are kept.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path).select("value", *place).withColumn("line", F.monotonically_increasing_id())
    lines = lines.filter(F.regexp_replace("value", _MARGIN, "") != "")
    value = F.col("value")
    trimmed = lambda c: F.regexp_replace(c, _MARGIN, "")
    is_column, is_code = value.rlike(_COLUMN), value.rlike(_CODE)
    parsed = lines.select(
        "file", "block", "line",
        F.when(is_column, F.regexp_extract(value, _COLUMN, 1)).alias("head"),
        F.when(~is_column & is_code, F.regexp_extract(value, _CODE, 1)).alias("own_code"),
        trimmed(F.when(is_column, F.regexp_extract(value, _COLUMN, 2)).when(is_code, F.regexp_extract(value, _CODE, 2))
                .otherwise(value)).alias("text"))
    # the entry that a line belongs to, and with it the column and the code
    opens = F.when(F.col("head").isNotNull() | F.col("own_code").isNotNull(), F.col("line"))
    order = ["file", "block", "line"]
    carried = running_last(parsed.withColumn("entry_line", opens), order, "head", "column")
    carried = running_last(carried, order, "entry_line", "entry")
    meaning = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "line", "text"))), lambda x: x["text"]), " ")
    return carried.groupBy("file", "column", "entry").agg(
        F.max("own_code").alias("code"), F.trim(meaning).alias("meaning")).select("column", "code", "meaning")
