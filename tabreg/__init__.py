"""tabreg: Spark-native tabular regression and feature analytics.

Every operator takes and returns Spark DataFrames (or ``pyspark.ml``
models). Row-level work stays on the executors; the driver only sees
column names, fitted statistics, category lists behind a size check,
coefficients and trial records.
"""

from tabreg.session import get_spark, checkpoint_dir, shared_scratch

__all__ = ["get_spark", "checkpoint_dir", "shared_scratch"]
