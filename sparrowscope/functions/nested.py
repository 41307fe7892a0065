"""Expressions on arrays, structs and key paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_name(path: str) -> str:
    return path.split(".")[-1]


def path_exists(schema: T.StructType, path: str) -> bool:
    """Whether a dotted path of struct fields exists in the schema."""
    node: T.DataType = schema
    for key in path.split("."):
        if not isinstance(node, T.StructType) or key not in node.names:
            return False
        node = node[key].dataType
    return True


def path_column(path: str) -> Column:
    return F.col(".".join(f"`{key}`" for key in path.split(".")))


def first_element(array: Column) -> Column:
    """First element; null for an empty or null array."""
    return F.get(array, F.lit(0))


def join_array_text(array: Column, field: str = "text", separator: str = ", ") -> Column:
    """Join one text field of an array of structs. Null array gives null, empty
    array gives the empty string."""
    return F.array_join(array.getField(field), separator)
