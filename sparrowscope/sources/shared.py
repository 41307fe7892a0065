"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Temporary folder per local application, where the session names none.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the session; a fresh temporary one in local mode only."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="sparrowscope-")
    return _local_folders[application]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that is not in use."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application: send this package to the Python workers of the executors."""
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


class Scratch:
    """Tables that a job stores and removes when it ends."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def stored(self, df: DataFrame) -> DataFrame:
        path = fresh_path(self._spark, "scratch")
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *error) -> None:
        files = self._spark._jvm.org.apache.hadoop.fs
        for path in self._paths:
            target = files.Path(path)
            target.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame) -> DataFrame:
    """The frame as a written table: reading it again repeats no earlier work,
    and a lost executor costs no more than a re-read."""
    path = fresh_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
