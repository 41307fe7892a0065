"""Helpers that several operators share: word splitting, Arrow batches, scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparrowscope.sources.shared import fresh_path

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Whole texts travel in Arrow batches; a batch has to fit beside the heap.
BATCH_ROWS = 256


def limit_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to the given number of rows."""
    now = int(spark.conf.get(BATCH_SETTING))
    if now <= 0 or now > rows:
        spark.conf.set(BATCH_SETTING, str(rows))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application: send this package to the Python workers, so that they can
    import it wherever they and the driver were started."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for file in sorted(package.rglob("*.py")):
            target.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def map_texts(
    df: DataFrame,
    make: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    rows: int = BATCH_ROWS,
) -> DataFrame:
    """mapInArrow over batches small enough for whole texts."""
    ship_package(df.sparkSession)
    limit_batches(df.sparkSession, rows)
    return df.mapInArrow(make, schema)


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


# Shuffle files of a finished write are of no more use: the table holds the rows.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, name: str) -> str:
    """Write the frame below the shared folder; returns the path."""
    spark = df.sparkSession
    path, before = fresh_path(spark, name), spark.conf.get(CLEANUP_SETTING)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP_SETTING, before)
    return path


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def store(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table of the shared folder: cuts lineage and survives
    lost executors."""
    return read_table(df.sparkSession, write_table(df, name), df.schema)


class Tables:
    """Tables that one job writes; `drop` removes those it has read for the last time."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, str] = {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = write_table(df, name)
        table = read_table(self.spark, path, df.schema)
        self._paths[id(table)] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self._paths.pop(id(table), None)
            if path is not None:
                drop_path(self.spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table that this job wrote and has read for the last time."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def crc_mod(column: Column, divisor: int) -> Column:
    """crc32 of the value as text, modulo the divisor; null for null."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(divisor))


def mix64(values: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser on unsigned integers."""
    with np.errstate(over="ignore"):
        v = values ^ (values >> np.uint64(33))
        v = v * np.uint64(0xFF51AFD7ED558CCD)
        v ^= v >> np.uint64(33)
        v = v * np.uint64(0xC4CEB9FE1A85EC53)
        return v ^ (v >> np.uint64(33))
