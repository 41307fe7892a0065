"""Projections, null handling and unions of similar tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import leaf_name, path_column, path_exists


def _named(columns: Iterable[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in columns]


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns by name; names the frame does not have are ignored."""
    return df.drop(*columns)


def prefix_columns(
    df: DataFrame, columns: Sequence[str] | None = None, prefix: str = "user_"
) -> DataFrame:
    """Select columns under a prefix; slashes in names become underscores."""
    return df.select(
        *[
            F.col(f"`{name}`").alias(prefix + name.replace("/", "_"))
            for name in (columns or df.columns)
        ]
    )


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    present = set(right.columns)
    return [name for name in left.columns if name in present]


def union_common_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both frames, on the columns they share, in left order."""
    shared = _named(common_columns(left, right))
    return left.select(*shared).unionByName(right.select(*shared))


def skip_first_rows(df: DataFrame, order_by: Sequence[str] | str, n: int = 1) -> DataFrame:
    """Leave out the first ``n`` rows in the order of a unique key.

    The first keys come from a top-n, not from a sort of the table. They are n
    rows, so whether they are broadcast is left to their measured size.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    first = df.select(*_named(keys)).orderBy(*_named(keys)).limit(n)
    first = first.select(*[F.col(f"`{k}`").alias(f"_first_{i}") for i, k in enumerate(keys)])
    matches = [F.col(f"`{k}`").eqNullSafe(F.col(f"_first_{i}")) for i, k in enumerate(keys)]
    return df.join(first, matches, "left_anti")


def filter_segment(
    accounts: DataFrame, segments: Sequence[str] = ("project",), column: str = "verified_type"
) -> DataFrame:
    """Keep accounts of the given classes."""
    return accounts.filter(F.col(column).isin(*segments))


def fill_null_label(
    df: DataFrame, columns: Sequence[str] = ("verified_type",), value: str = "none"
) -> DataFrame:
    """Replace null text in the given columns."""
    return df.na.fill(value, list(columns))


def fill_null_strings(df: DataFrame, value: str = "none") -> DataFrame:
    """Replace null in every text column; other types keep their nulls."""
    return df.na.fill(value)


def extract_paths(
    df: DataFrame,
    paths: Sequence[str],
    *,
    keep: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Project dotted key paths; the last key names the column.

    A path the schema does not have gives a null column. With ``strict`` it is
    an error, and so is a row in which the path is null (found when the row is
    read, without a pass of its own).
    """
    columns = []
    for path in paths:
        name = leaf_name(path)
        if not path_exists(df.schema, path):
            if strict:
                raise ValueError(f"no such path: {path}")
            columns.append(F.lit(None).cast("string").alias(name))
            continue
        value = path_column(path)
        if strict:
            missing = F.raise_error(F.lit(f"no value at path: {path}"))
            value = F.when(value.isNull(), missing).otherwise(value)
        columns.append(value.alias(name))
    return df.select(*_named(keep), *columns)


def optional_field(path: str, schema: T.StructType, default=None) -> Column:
    """Value at a path, or the default where path or value is absent."""
    value = path_column(path) if path_exists(schema, path) else F.lit(None).cast("string")
    value = value if default is None else F.coalesce(value, F.lit(default))
    return value.alias(leaf_name(path))


def _nested_schema(paths: Sequence[str]) -> T.StructType:
    """Struct that holds every dotted path, with text leaves."""
    tree: dict = {}
    for path in paths:
        node = tree
        for key in path.split("."):
            node = node.setdefault(key, {})

    def build(node: Mapping) -> T.StructType:
        return T.StructType(
            [T.StructField(k, build(v) if v else T.StringType()) for k, v in node.items()]
        )

    return build(tree)


def extract_json_paths(
    df: DataFrame, column: str, paths: Sequence[str], *, keep: Sequence[str] = ()
) -> DataFrame:
    """Project key paths out of a column of JSON text, parsing each text once.
    Leaves are text; an absent path gives null."""
    parsed = F.from_json(F.col(f"`{column}`"), _nested_schema(paths))
    return extract_paths(
        df.select(*_named(keep), parsed.alias("_json")).select(*_named(keep), "_json.*"),
        paths,
        keep=keep,
    )
