"""Search documents and stream messages, apart from any connector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Length of the time slot whose posts of one account make a message.
SLOT_SECONDS = 86_400
# Messages that the posts of an account without a time are dealt to.
UNDATED_PARTS = 64

JSON_OPTIONS = {"ignoreNullFields": "false"}


def index_documents(df: DataFrame, fields: Sequence[str], key: str) -> DataFrame:
    """One JSON document per row from allow-listed fields, null fields included,
    next to its key."""
    source = F.to_json(F.struct(*[F.col(f"`{name}`") for name in fields]), JSON_OPTIONS)
    return df.select(F.col(f"`{key}`").cast("string").alias("key"), source.alias("document"))


def decode_documents(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of documents again."""
    return documents.select("key", F.from_json("document", schema).alias("_doc")).select(
        "key", "_doc.*"
    )


def bulk_lines(documents: DataFrame, index: str, *, with_id: bool = False) -> DataFrame:
    """Bulk-request text: per document an action line and a source line. With ``with_id``
    the document's key is its id in the index, so that sending it again replaces it."""
    target = [F.lit(index).alias("_index")] + ([F.col("key").alias("_id")] if with_id else [])
    action = F.to_json(F.struct(F.struct(*target).alias("index")))
    return documents.select(F.concat_ws("\n", action, F.col("document")).alias("value"))


def account_messages(
    posts: DataFrame,
    *,
    key: str = "screen_name",
    time: str = "created_at",
    tie: str = "id",
    slot_seconds: int = SLOT_SECONDS,
) -> DataFrame:
    """Kafka-shaped rows (``key``, ``part``, ``value``): JSON arrays of an account's posts.

    A message holds the posts of one account in one slot of time (``part``, the number of
    slots since the epoch), in order of time. Posts without a time have the null part, in up
    to UNDATED_PARTS messages by hash of ``tie``. The cut depends on nothing but the posts,
    so messages are the same for every layout of the input, and a consumer puts an account
    together by key and part.
    """
    post = F.struct(*[F.col(f"`{name}`") for name in posts.columns])
    slotted = posts.select(
        F.col(key),
        F.floor(F.col(time).cast("long") / slot_seconds).alias("part"),
        F.struct(F.col(time).alias("_time"), F.col(tie).alias("_tie"), post.alias("_post")).alias("_record"),
    )
    piece = F.when(F.col("part").isNull(), F.pmod(F.xxhash64("_record._tie"), F.lit(UNDATED_PARTS)))
    grouped = slotted.groupBy(key, "part", piece.alias("_piece")).agg(F.sort_array(F.collect_list("_record")).alias("_records"))
    value = F.to_json(F.col("_records").getField("_post"), JSON_OPTIONS)
    return grouped.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        "part",
        F.encode(value, "UTF-8").alias("value"),
    )


def decode_value(value: Column, record: T.StructType) -> Column:
    """Records of a message: UTF-8 text of a JSON array."""
    return F.from_json(F.decode(value, "UTF-8"), T.ArrayType(record))


CORRUPT = "_corrupt"


def _decoded(messages: DataFrame, record: T.StructType, keep: Sequence[str]) -> DataFrame:
    """Records next to the text of what could not be read: of a record with a field of the
    wrong kind, or of a message that is no array of records."""
    text = F.decode(F.col("value"), "UTF-8")
    items = F.from_json(text, T.ArrayType(T.StringType()))
    listed = messages.select(*keep, text.alias("_text"), items.alias("_items"))
    rows = listed.select(*keep, "_text", F.col("_items").isNull().alias("_bad"), F.explode_outer("_items").alias("_item"))
    parsed = F.from_json("_item", T.StructType([*record.fields, T.StructField(CORRUPT, T.StringType())]), {"columnNameOfCorruptRecord": CORRUPT})
    rows = rows.select(*keep, "_text", "_bad", "_item", parsed.alias("_record"))
    broken = F.when(F.col("_bad"), F.coalesce("_text", F.lit(""))).otherwise(F.col(f"_record.{CORRUPT}"))
    return rows.filter(F.col("_bad") | F.col("_item").isNotNull()).select(
        *keep, *[F.col(f"_record.`{name}`") for name in record.names if name != CORRUPT], broken.alias(CORRUPT)
    )


def decode_messages(
    messages: DataFrame, record: T.StructType, *keep: str, on_error: str = "fail"
) -> DataFrame:
    """One row per record of Kafka-shaped messages, batch or stream.

    A message that is no JSON array, or a record with a field of the wrong kind, fails the
    query; with ``on_error="mark"`` it is a row of its own with its text in ``_corrupt``
    (null for good records), which ``reject_messages`` picks out.
    """
    record = T.StructType(list(record.fields))
    rows = _decoded(messages, record, keep)
    if on_error == "mark":
        return rows
    if on_error != "fail":
        raise ValueError(f"on_error is fail or mark, not {on_error}")
    failure = F.raise_error(F.concat(F.lit("unreadable message: "), F.col(CORRUPT)))
    checked = F.when(F.col(CORRUPT).isNotNull(), failure.cast("boolean")).otherwise(F.lit(True))
    return rows.filter(checked).drop(CORRUPT)


def reject_messages(messages: DataFrame, record: T.StructType, *keep: str) -> DataFrame:
    """What ``decode_messages`` cannot read: a row per broken message or record."""
    marked = decode_messages(messages, record, *keep, on_error="mark")
    return marked.filter(F.col(CORRUPT).isNotNull()).select(*keep, CORRUPT)


def json_roundtrip(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Serialise rows to JSON text and parse them again."""
    columns = list(columns or df.columns)
    schema = df.select(*columns).schema
    text = df.select(F.to_json(F.struct(*columns), JSON_OPTIONS).alias("json"))
    return text.select(F.from_json("json", schema).alias("_row")).select("_row.*")
