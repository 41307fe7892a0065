"""Message streams: decode, de-duplicate, land, rescore."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import conversation_key
from ..operators.messages import decode_messages
from ..operators.signals import account_signals, posting_gaps, view_inflation
from ..schemas import RECORD, struct
from ..sources.publish import publish

# Folders that landed posts are dealt to by account.
BUCKETS = 64

# Columns of a message as a broker source delivers them.
MESSAGE = struct(key=T.BinaryType(), value=T.BinaryType(), timestamp=T.TimestampType())


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Kafka topic; servers, topic and offsets come from the caller."""
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select("key", "value", "timestamp")


def read_message_files(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Parquet files of Kafka-shaped rows as a stream."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def decode_stream(messages: DataFrame, record: T.StructType = RECORD) -> DataFrame:
    """One row per record, with the message time."""
    return decode_messages(messages, record, "timestamp")


def dedup_stream(
    records: DataFrame, *, watermark: str = "1 day", time: str = "timestamp", **columns
) -> DataFrame:
    """One record per conversation, as long as copies arrive within the watermark.

    State is one key per conversation, dropped after the watermark. Which copy
    of one micro-batch stays is up to its order of arrival; for the exact
    first-wins rule use the batch operator on landed records. Records without a
    conversation go by their whole content.
    """
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{name}`") for name in records.columns if name != time])), 256)
    keyed = records.withColumn("conversation_key", conversation_key(**columns))
    keyed = keyed.withColumn("_copy", F.coalesce("conversation_key", content))
    return keyed.withWatermark(time, watermark).dropDuplicatesWithinWatermark(["_copy"]).drop("_copy")


def land(
    stream: DataFrame, path: str, checkpoint: str, *, format: str = "parquet", **trigger
) -> StreamingQuery:
    """Append a stream to files, exactly once. The default trigger takes what is
    there and stops."""
    return (
        stream.writeStream.format(format)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def land_latest(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the latest micro-batch: every batch is published as a whole in place of the one
    before, for ``read_published``. A repeated batch changes nothing."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        publish(batch, path, batch_id, format="json")

    return (
        stream.writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def account_bucket(key: str, buckets: int):
    """Number of the folder that holds an account's posts."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched_history(
    spark: SparkSession, posts_path: str, schema: T.StructType, batch_id: int, key: str
) -> DataFrame:
    """Landed posts, up to a batch, of the accounts in that batch. Only folders of buckets
    that the batch wrote are read; their numbers, at most one per bucket, pass through the
    driver."""
    full = T.StructType(
        [*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.LongType())]
    )
    landed = spark.read.schema(full).parquet(posts_path).filter(F.col("batch_id") <= batch_id)
    new = landed.filter(F.col("batch_id") == batch_id)
    numbers = [row["bucket"] for row in new.select("bucket").distinct().collect()]
    near = landed.filter(F.col("bucket").isin(numbers)) if numbers else new
    touched = new.select(key).distinct()
    return near.drop("bucket", "batch_id").join(touched, key, "left_semi")


def rescore_accounts(
    stream: DataFrame,
    posts_path: str,
    signals_path: str,
    checkpoint: str,
    *,
    key: str = "screen_name",
    buckets: int = BUCKETS,
    **trigger,
) -> StreamingQuery:
    """Land flat posts and recompute the signals of the accounts they touch.

    The regularity flag of every post depends on the account's mean gap, so a
    new post can change all of them: the history of touched accounts is read
    again. Posts are landed in ``buckets`` folders by hash of the account, and a
    batch reads only the folders it touches. Below a bucket there is one folder
    per batch, replaced if the batch is repeated; so is the batch's folder of
    signals. The newest ``batch_id`` of an account is its current state.
    """

    def rescore(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marked = batch.withColumns({"bucket": account_bucket(key, buckets), "batch_id": F.lit(batch_id).cast("long")})
        marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "bucket", "batch_id"
        ).parquet(posts_path)
        history = touched_history(spark, posts_path, batch.schema, batch_id, key)
        signals = account_signals(view_inflation(posting_gaps(history, key=key)), key=key)
        signals.write.mode("overwrite").parquet(f"{signals_path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(rescore)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_signals(
    spark: SparkSession, signals_path: str, *, key: str = "screen_name"
) -> DataFrame:
    """Newest signals per account from the output of ``rescore_accounts``."""
    rows = spark.read.parquet(signals_path)
    newest = F.max_by(F.struct("time_bot_count", "views_score"), "batch_id").alias("_state")
    return rows.groupBy(key).agg(newest).select(key, "_state.*")


def compact_signals(
    spark: SparkSession, signals_path: str, target: str, *, key: str = "screen_name"
) -> None:
    """Write the newest state of every account as one folder of the same layout, to go on
    from in place of the many small ones."""
    rows = spark.read.parquet(signals_path)
    newest = F.max_by(F.struct("time_bot_count", "views_score", "batch_id"), "batch_id").alias("_state")
    current = rows.groupBy(key).agg(newest).select(key, "_state.*")
    current.hint("rebalance", F.col("batch_id")).write.partitionBy("batch_id").parquet(target)
