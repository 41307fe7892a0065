"""Versions of a table, published as a whole.

A version is written to a folder of its own, which no reader knows. Then a manifest that
names it is written beside the others and put in its place by a rename, the one step that
readers see: before it they read the last version, after it the new one, and never a part.
Manifests are named by batch, so a batch that is repeated finds its own and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MANIFESTS, _VERSIONS = "_manifests", "_versions"


class _Files:
    """The folder's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.root = path.rstrip("/")
        self.system = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        target = self.path(folder)
        if not self.system.exists(target):
            return []
        return sorted(status.getPath().getName() for status in self.system.listStatus(target))

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def write(self, name: str, content: str) -> None:
        stream = self.system.create(self.path(name), True)
        try:
            stream.write(bytearray(content.encode()))
        finally:
            stream.close()

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, name: str, target: str) -> bool:
        return self.system.rename(self.path(name), self.path(target))

    def remove(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def _name(batch: int) -> str:
    return f"{batch:020d}.json"


def _published(files: _Files) -> list[dict]:
    """Manifests, oldest first; temporary ones begin with a dot."""
    return [json.loads(files.read(f"{_MANIFESTS}/{name}")) for name in files.names(_MANIFESTS) if name[0] != "."]


def publish(
    df: DataFrame, path: str, batch: int, *, format: str = "parquet", keep: int | None = 3,
    write: Callable[[DataFrame, str], None] | None = None,
) -> bool:
    """Publish the frame as the version of a batch; False if that batch has one already,
    which stays. The version of the highest batch is the current one, so an older batch
    that comes late does not replace a newer.

    ``keep`` versions stay for readers that still use them, and older ones are removed with
    their manifests; a batch older than those is taken for published. ``write`` puts rows
    into a folder another way.
    """
    files = _Files(df.sparkSession, path)
    known = [name for name in files.names(_MANIFESTS) if name[0] != "."]
    if _name(batch) in known or (keep is not None and len(known) >= keep and _name(batch) < known[0]):
        return False
    folder = f"{_VERSIONS}/{batch}-{uuid.uuid4().hex}"
    target = f"{files.root}/{folder}"
    if write is None:
        df.write.format(format).save(target)
    else:
        write(df, target)
    manifest = {"batch": batch, "folder": folder, "format": format, "schema": df.schema.json()}
    draft = f"{_MANIFESTS}/.{uuid.uuid4().hex}"
    files.write(draft, json.dumps(manifest))
    # A second attempt at the same batch that was faster has won.
    won = not files.exists(f"{_MANIFESTS}/{_name(batch)}") and files.rename(draft, f"{_MANIFESTS}/{_name(batch)}")
    if not won:
        files.remove(draft)
        files.remove(folder)
        return False
    if keep is not None:
        _forget(files, keep)
    return True


def _forget(files: _Files, keep: int) -> None:
    """Remove all but the last versions: the manifest first, so that none names a folder
    that is gone, then folders without one that are older than the oldest kept."""
    manifests = _published(files)
    for old in manifests[:-keep]:
        files.remove(f"{_MANIFESTS}/{_name(old['batch'])}")
    kept = manifests[-keep:]
    folders = {manifest["folder"].split("/")[1] for manifest in kept}
    for name in files.names(_VERSIONS):
        if name not in folders and int(name.split("-")[0]) < kept[0]["batch"]:
            files.remove(f"{_VERSIONS}/{name}")


def published_batches(spark: SparkSession, path: str) -> list[int]:
    """Batches that have a version, oldest first."""
    return [manifest["batch"] for manifest in _published(_Files(spark, path))]


def read_published(
    spark: SparkSession, path: str, batch: int | None = None, *, schema: T.StructType | None = None
) -> DataFrame:
    """The current version, or that of a batch. Where nothing is published yet, no rows of
    ``schema``."""
    files = _Files(spark, path)
    found = [m for m in _published(files) if batch is None or m["batch"] == batch]
    if not found:
        if schema is None:
            raise ValueError(f"nothing published at {path}" + ("" if batch is None else f" for batch {batch}"))
        return spark.createDataFrame([], schema)
    manifest = found[-1]
    own = T.StructType.fromJson(json.loads(manifest["schema"]))
    return spark.read.schema(schema or own).format(manifest["format"]).load(f"{files.root}/{manifest['folder']}")
