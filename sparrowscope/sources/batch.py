"""Batch readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RECORD

# Columns that order records: file, block of the file, row (rising in a block).
CORRUPT = "_corrupt"
POSITION = ("source_file", "source_block", "source_row")


def read_table(
    spark: SparkSession, *paths: str, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet table: a folder, or several folders or files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = RECORD,
    *,
    array_files: bool = True,
    position: bool = False,
    on_error: str = "fail",
) -> DataFrame:
    """JSON records of all files below the paths, control characters tolerated.

    A record that is no JSON, or a file that is no JSON array, fails the query. With
    ``on_error="mark"`` it becomes a row with its text in ``_corrupt`` (null for good
    records), to be written apart; of an array file that is broken the text is the file's.

    ``array_files`` reads files that hold one JSON array each, which Spark
    cannot split; for JSON Lines (what ``write_json`` writes) pass False.
    ``position`` adds the columns of ``POSITION``, which put all records in the
    order of file names and of records within a file.
    """
    if on_error not in ("fail", "mark"):
        raise ValueError(f"on_error is fail or mark, not {on_error}")
    mark = on_error == "mark"
    if mark:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.schema(schema)
        .option("multiLine", array_files)
        .option("allowUnquotedControlChars", True)
        .option("mode", "PERMISSIVE" if mark else "FAILFAST")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    records = reader.json(paths if isinstance(paths, str) else list(paths))
    if not position:
        return records
    file, block, row = POSITION
    return records.select(
        "*",
        F.col("_metadata.file_path").alias(file),
        F.col("_metadata.file_block_start").alias(block),
        F.monotonically_increasing_id().alias(row),
    )


def _by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of one partition value side by side, so that not every task writes
    every value. Adaptive execution splits a frequent value over several tasks."""
    if not partition_by:
        return df
    return df.hint("rebalance", *[F.col(f"`{name}`") for name in partition_by])


def write_table(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> None:
    """Parquet table; by default an existing one is an error."""
    _by_partition(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_json(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> None:
    """JSON Lines, one folder per value of the partition columns. Null fields
    are kept."""
    writer = _by_partition(df, partition_by).write.mode(mode).partitionBy(*partition_by)
    writer.option("ignoreNullFields", False).json(path)


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A single text column as text files, such as bulk-request lines."""
    df.write.mode(mode).text(path)


def write_connector(
    df: DataFrame, format: str, options: Mapping[str, str], mode: str = "append"
) -> None:
    """Hand rows to a connector (message broker, search index). Host, login and
    every other option come from the caller."""
    df.write.format(format).options(**options).mode(mode).save()
