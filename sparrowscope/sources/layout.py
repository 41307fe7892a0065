"""Tables laid out by account, so that work per account needs no shuffle.

Rows of one account lie in one bucket, and tables with the same key and number of buckets
have theirs in the same ones. Spark then joins, groups and windows them by account where
they lie; only the write shuffles, once. The price is that a bucket is read by one task: an
account with a third of all posts makes one long task of every query, which more executors
do not shorten (a map-side combine keeps its memory small). Such posts are written by many
tasks, as adaptive execution splits their part of the shuffle; to read them by many as
well, open the files as a plain folder (``read_table``), which ignores the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# For 100 TB of posts this is too few: choose buckets of one to a few GB.
BUCKETS = 64


def write_layout(
    df: DataFrame,
    name: str,
    path: str,
    key: str = "screen_name",
    *,
    buckets: int = BUCKETS,
    sort_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> DataFrame:
    """Write the frame below ``path`` in buckets by key, sorted by key and ``sort_by``
    inside a file, as table ``name`` of the session's catalog; returns that table. Rows
    without a key share a bucket."""
    dealt = df.hint("rebalance", buckets, F.col(f"`{key}`"))
    writer = dealt.write.bucketBy(buckets, key).sortBy(key, *sort_by)
    writer.format("parquet").option("path", path).mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def open_layout(
    spark: SparkSession,
    name: str,
    path: str,
    schema,
    key: str = "screen_name",
    *,
    buckets: int = BUCKETS,
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Table ``name`` over a layout that an earlier session wrote; key, buckets and sort
    columns have to be those it was written with."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    order = ", ".join(f"`{column}`" for column in (key, *sort_by))
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
        f"SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name)


def forget_layout(spark: SparkSession, name: str) -> None:
    """Take the table out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
