"""Column expressions; all of them stay inside Spark SQL."""

from .dates import epoch_to_timestamp, parse_epoch
from .nested import first_element, join_array_text, leaf_name, path_column, path_exists
from .numbers import safe_ratio, sentinel_to_number

__all__ = [
    "epoch_to_timestamp",
    "first_element",
    "join_array_text",
    "leaf_name",
    "parse_epoch",
    "path_column",
    "path_exists",
    "safe_ratio",
    "sentinel_to_number",
]
