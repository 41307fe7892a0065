"""Keys of all crawls so far, to be asked without reading them.

Every crawl leaves its distinct keys in files by bucket of their hash, and a Bloom filter
per bucket. A new crawl's keys meet the filters of their bucket only; those that no filter
knows are new for certain. The few others (repeats, and about one in a hundred by chance)
are compared with the stored keys of exactly the crawls and buckets whose filters said so.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ship_package, stored

# A filter of this many bits a key and this many probes errs in about 1 % of the cases.
BITS_PER_KEY = 10
PROBES = 7
# A bucket's keys of one crawl are gathered in one task: choose buckets so that they are
# some millions at most. All crawls of a store need the same number.
BUCKETS = 64

_FILTERS = "bucket int, keys bigint, bits binary, crawl string"
_MAYBE = "key string, bucket int, crawl string"


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """PROBES places in a filter of `size` bits for every 64-bit hash."""
    with np.errstate(over="ignore"):
        low = hashes.view(np.uint64) & np.uint64(0xFFFFFFFF)
        high = hashes.view(np.uint64) >> np.uint64(32) | np.uint64(1)
        steps = np.arange(PROBES, dtype=np.uint64)[:, None]
        return ((low + steps * high) % np.uint64(size)).astype(np.int64)


def _filter(hashes: np.ndarray) -> bytes:
    bits = np.zeros(-(-max(len(hashes), 1) * BITS_PER_KEY // 8) * 8, np.uint8)
    bits[_places(hashes, len(bits)).ravel()] = 1
    return np.packbits(bits).tobytes()


def _known(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may have seen."""
    packed = np.frombuffer(bits, np.uint8)
    places = _places(hashes, len(packed) * 8)
    return ((packed[places >> 3] >> (7 - (places & 7))) & 1).all(axis=0)


def _build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    hashes = rows.column("hash").to_numpy()
    return pa.table(
        {"bucket": pa.array([key[0].as_py()], pa.int32()), "keys": [len(hashes)], "bits": pa.array([_filter(hashes)], pa.binary())}
    )


def _ask(asked: pa.Table, filters: pa.Table) -> pa.Table:
    hashes = asked.column("hash").to_numpy()
    found = []
    for row in filters.select(["crawl", "bits"]).to_pylist():
        hit = asked.filter(pa.array(_known(row["bits"], hashes), pa.bool_())).select(["key", "bucket"])
        found.append(hit.append_column("crawl", pa.array([row["crawl"]] * len(hit), pa.string())))
    return pa.concat_tables(found) if found else pa.table(
        {"key": pa.array([], pa.string()), "bucket": pa.array([], pa.int32()), "crawl": pa.array([], pa.string())}
    )


class KeyStore:
    """Keys below ``path``: ``keys/crawl=C/bucket=B`` and ``filters/crawl=C``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def _bucketed(self, keys: DataFrame, key: str | Column) -> DataFrame:
        """Distinct keys as text (null is none), with hash and bucket."""
        column = F.col(key) if isinstance(key, str) else key
        rows = keys.select(column.cast("string").alias("key")).filter("key IS NOT NULL").distinct()
        rows = rows.withColumn("hash", F.xxhash64("key"))
        return rows.withColumn("bucket", F.pmod("hash", F.lit(self.buckets)).cast("int"))

    def filters(self, but: str | None = None) -> DataFrame:
        """Filters of all crawls, or of all but one."""
        folder = f"{self.path}/filters"
        if not self._exists(folder):
            return self.spark.createDataFrame([], _FILTERS)
        found = self.spark.read.schema(_FILTERS).parquet(folder)
        return found if but is None else found.filter(F.col("crawl") != but)

    def maybe_seen(self, keys: DataFrame, key: str | Column = "key", but: str | None = None) -> DataFrame:
        """key, bucket, crawl: the crawls whose filter knows a key. No stored key is read."""
        ship_package(self.spark)
        asked = self._bucketed(keys, key).groupBy("bucket")
        return asked.cogroup(self.filters(but).groupBy("bucket")).applyInArrow(_ask, _MAYBE)

    def seen(self, keys: DataFrame, key: str | Column = "key", but: str | None = None) -> DataFrame:
        """Distinct ``key`` of those that crawls (other than ``but``) have recorded, exactly.
        The numbers of crawls and buckets, not keys, pass through the driver."""
        maybe = stored(self.maybe_seen(keys, key, but))
        places = maybe.select("crawl", "bucket").distinct().collect()
        if not places:
            return maybe.select("key")
        here = self.spark.read.schema("key string, crawl string, bucket int").parquet(f"{self.path}/keys")
        here = here.filter(
            F.col("crawl").isin(sorted({p["crawl"] for p in places})) & F.col("bucket").isin(sorted({p["bucket"] for p in places}))
        )
        return maybe.join(here, ["key", "crawl", "bucket"], "left_semi").select("key").distinct()

    def record(self, keys: DataFrame, crawl: str, key: str | Column = "key") -> None:
        """Store a crawl's keys and filters; recording a crawl again replaces it. The
        filters come last, so a crawl that was interrupted is unknown as yet."""
        ship_package(self.spark)
        rows = stored(self._bucketed(keys, key))
        rows.hint("rebalance", F.col("bucket")).select("key", "bucket").write.mode("overwrite").partitionBy(
            "bucket"
        ).parquet(f"{self.path}/keys/crawl={crawl}")
        built = rows.select("hash", "bucket").groupBy("bucket").applyInArrow(_build, "bucket int, keys bigint, bits binary")
        built.write.mode("overwrite").parquet(f"{self.path}/filters/crawl={crawl}")
