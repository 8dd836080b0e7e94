"""Column-level building blocks (pure Spark SQL expressions)."""

from tabreg.functions.rowwise import (
    abs_error, feature_name, least_of, linear_combination, mean_of,
    ratio, round_to, sqrt_of, sum_skipnull, whole_number_text,
    whole_number_to_long,
)
from tabreg.functions.hashing import hash_bucket, hash_bucket_sql, row_key

__all__ = [
    "abs_error", "feature_name", "least_of", "linear_combination", "mean_of",
    "ratio", "round_to", "sqrt_of", "sum_skipnull", "whole_number_text",
    "whole_number_to_long", "hash_bucket", "hash_bucket_sql", "row_key",
]
