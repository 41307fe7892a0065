"""Account metrics kept current by deltas, without reading earlier posts.

Every batch of posts leaves one partial aggregate per account and day, of the posts that
are new: repeated ones are known by id. Every batch of accounts leaves the first version it
has of each. Metrics are sums of the partial rows, joined to the first of the versions. An
account whose earlier version arrives later changes in all of its values: that is a
retraction of the old row and the addition of a new one, and so is every change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ACCOUNT_MEANS, POST_TOTALS
from ..sources.keystore import BUCKETS, KeyStore
from ..sources.shared import stored
from .dedup import first_per_key

TOTALS = ("tweet_count", *(f"total_{name}" for name in POST_TOTALS))


class MaintainedMetrics:
    """Partial aggregates, account versions and post ids below ``path``.

    Batches have a number; giving one again replaces what it left, so a batch that was
    interrupted is run once more under its number. ``order_by`` are the account columns
    that put the versions of an account in order, the first of them counts.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        order_by: Sequence[str],
        order_types: Sequence[str],
        *,
        key: str = "screen_name",
        account_key: str = "user_screen_name",
        buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.key, self.account_key = spark, path.rstrip("/"), key, account_key
        self.order_by = list(order_by)
        self.ids = KeyStore(spark, f"{self.path}/ids", buckets)
        self._partial = T._parse_datatype_string(
            f"{key} string, day bigint, " + ", ".join(f"{name} bigint" for name in TOTALS) + ", batch bigint"
        )
        self._version = T._parse_datatype_string(
            f"{account_key} string, " + ", ".join(f"{name} double" for name in ACCOUNT_MEANS)
            + "".join(f", {name} {kind}" for name, kind in zip(self._order_names(), order_types)) + ", batch bigint"
        )

    def _order_names(self) -> list[str]:
        return [f"_order{i}" for i in range(len(self.order_by))]

    def _read(self, kind: str, schema: T.StructType, upto: int | None) -> DataFrame:
        folder = f"{self.path}/{kind}"
        if not self.ids._exists(folder):
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).parquet(folder)
        return found if upto is None else found.filter(F.col("batch") <= upto)

    def add_posts(self, batch: int, posts: DataFrame, *, id: str = "id", time: str = "created_at") -> None:
        """Add counted posts (``view_inflation``); those whose id an earlier batch had, or
        that stand twice in this one, count once. Posts without an id count each; posts
        without a time share one day."""
        ids = F.col(id).cast("string")
        rows = posts.select(
            ids.alias("_id"), F.col(self.key).cast("string").alias(self.key),
            F.floor(F.col(time).cast("long") / 86_400).alias("day"),
            *[F.col(name).cast("bigint").alias(name) for name in POST_TOTALS],
        )
        named = stored(first_per_key(rows.filter("_id IS NOT NULL"), "_id", [self.key, "day", *POST_TOTALS]))
        seen = self.ids.seen(named, "_id", but=str(batch)).withColumnRenamed("key", "_id")
        new = stored(named.join(seen, "_id", "left_anti"))
        counted = new.unionByName(rows.filter("_id IS NULL"))
        counted.groupBy(self.key, "day").agg(
            F.count("_id").alias("tweet_count"),
            *[F.sum(name).alias(f"total_{name}") for name in POST_TOTALS],
        ).write.mode("overwrite").parquet(f"{self.path}/partials/batch={batch}")
        self.ids.record(new, str(batch), "_id")

    def add_accounts(self, batch: int, accounts: DataFrame) -> None:
        """Add (prefixed) account rows."""
        rows = accounts.select(
            F.col(self.account_key).cast("string").alias(self.account_key),
            *[F.col(name).cast("double").alias(name) for name in ACCOUNT_MEANS],
            *[F.col(f"`{name}`").alias(order) for name, order in zip(self.order_by, self._order_names())],
        )
        first = first_per_key(rows, self.account_key, self._order_names())
        first.write.mode("overwrite").parquet(f"{self.path}/versions/batch={batch}")

    def current(self, upto: int | None = None) -> DataFrame:
        """What ``account_metrics`` gives for all posts and accounts (of batches up to a
        number)."""
        return self._metrics(self._read("partials", self._partial, upto), self._read("versions", self._version, upto))

    def _metrics(self, partials: DataFrame, versions: DataFrame) -> DataFrame:
        totals = partials.groupBy(self.key).agg(*[F.sum(name).alias(name) for name in TOTALS])
        first = first_per_key(versions, self.account_key, [*self._order_names(), "batch"])
        values = first.select(self.account_key, *ACCOUNT_MEANS)
        return totals.join(values, totals[self.key] == values[self.account_key], "inner").drop(self.account_key)

    def changes(self, batch: int) -> DataFrame:
        """What a batch changed: ``op`` -1 with the metrics that no longer hold, 1 with
        those that do now. Only rows of accounts that the batch touched are computed."""
        partials, versions = self._read("partials", self._partial, batch), self._read("versions", self._version, batch)
        touched = stored(
            partials.filter(F.col("batch") == batch).select(F.col(self.key).alias("_touched"))
            .union(versions.filter(F.col("batch") == batch).select(self.account_key))
            .distinct()
        )

        def metrics(before: bool) -> DataFrame:
            p = partials.join(touched, F.col(self.key) == F.col("_touched"), "left_semi")
            v = versions.join(touched, F.col(self.account_key) == F.col("_touched"), "left_semi")
            limit = F.col("batch") < batch if before else F.lit(True)
            return self._metrics(p.filter(limit), v.filter(limit))

        old, new = stored(metrics(True)), stored(metrics(False))
        # Rows that are equal before and after cancel out.
        gone, come = old.exceptAll(new), new.exceptAll(old)
        return gone.withColumn("op", F.lit(-1)).union(come.withColumn("op", F.lit(1)))

    def days(self, upto: int | None = None) -> DataFrame:
        """Totals per account and day."""
        partials = self._read("partials", self._partial, upto)
        return partials.groupBy(self.key, "day").agg(*[F.sum(name).alias(name) for name in TOTALS])
