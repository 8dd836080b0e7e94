"""Sources and sinks (IO1-IO6)."""

from tabreg.sources.dictionary_file import read_dictionary
from tabreg.sources.infer import csv_type_profile, infer_csv, type_profile
from tabreg.sources.tables import TABLES, read_table
from tabreg.sources.text import (
    NULL_TOKENS, normalise_null_tokens, read_csv, read_training_log,
    write_training_log, TRAINING_LOG_SCHEMA, TIME_LOG_SCHEMA,
)

__all__ = [
    "TABLES", "read_table", "NULL_TOKENS", "normalise_null_tokens", "read_csv",
    "read_training_log", "write_training_log", "TRAINING_LOG_SCHEMA",
    "TIME_LOG_SCHEMA", "csv_type_profile", "infer_csv", "type_profile", "read_dictionary",
]
