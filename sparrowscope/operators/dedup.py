"""De-duplication of rows, accounts and conversations.

First-wins rules are written as ``row_number() <= n``: Spark then keeps the n
first rows per key in every map task before the shuffle, so copies of one key
never meet in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import first_element, path_column
from ..schemas import CONVERSATION_PATH, THREAD_IDS, THREAD_POSTS


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct whole rows, or distinct combinations of the given columns."""
    return (df.select(*columns) if columns else df).dropDuplicates()


def first_per_key(df: DataFrame, key: str | Column, order_by: Sequence[str | Column]) -> DataFrame:
    """First row of every key in the given order (null is a key of its own)."""
    first = Window.partitionBy(key).orderBy(*order_by)
    ranked = df.withColumn("_rank", F.row_number().over(first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def conversation_key(
    thread_ids: str = THREAD_IDS,
    thread_posts: str = THREAD_POSTS,
    conversation: str = CONVERSATION_PATH,
) -> Column:
    """Key under which a record competes: a thread goes by its first post id, a
    single post by its conversation."""
    return F.when(F.col(thread_posts).isNotNull(), first_element(F.col(thread_ids))).otherwise(
        path_column(conversation)
    )


# Place of a post in its record.
PLACE = "post_place"


def _as_posts(records: DataFrame, thread_posts: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per post: the posts of threads, and single posts as they are."""
    element = records.schema[thread_posts].dataType.elementType
    single = F.array(F.struct(*[F.col(f"`{name}`") for name in element.names]))
    posts = F.when(F.col(thread_posts).isNotNull(), F.col(thread_posts)).otherwise(single)
    if not keep:
        return records.select(F.explode(posts).alias("post")).select("post.*")
    return records.select(*keep, F.posexplode(posts).alias(PLACE, "post")).select(*keep, PLACE, "post.*")


def record_posts(records: DataFrame, *, thread_posts: str = THREAD_POSTS) -> DataFrame:
    """Posts of all records, those of threads and single ones, batch or stream."""
    return _as_posts(records, thread_posts)


def dedup_conversations(
    records: DataFrame,
    order_by: Sequence[str],
    *,
    thread_ids: str = THREAD_IDS,
    thread_posts: str = THREAD_POSTS,
    conversation: str = CONVERSATION_PATH,
    keep_order: bool = False,
) -> DataFrame:
    """Keep the first record of every conversation and flatten it to posts.

    Threads and single posts compete under one key, so of a conversation either
    the earliest single post or the earliest thread survives. Posts inside a
    kept thread are not compared with each other. Records without a key compete
    with none and all stay. ``keep_order`` keeps the order columns and adds the
    place of a post in its record.
    """
    key = conversation_key(thread_ids, thread_posts, conversation)
    kept = first_per_key(records.filter(key.isNotNull()), key, order_by)
    kept = kept.unionByName(records.filter(key.isNull()))
    return _as_posts(kept, thread_posts, list(order_by) if keep_order else ())


def flatten_threads(records: DataFrame, *, thread_posts: str = THREAD_POSTS) -> DataFrame:
    """Posts of thread records, one row each; single posts are left out."""
    return records.select(F.explode(thread_posts).alias("post")).select("post.*")


def dedup_audit(
    records: DataFrame,
    order_by: Sequence[str],
    *,
    thread_ids: str = THREAD_IDS,
    thread_posts: str = THREAD_POSTS,
    conversation: str = CONVERSATION_PATH,
) -> DataFrame:
    """One row: records before, posts after conversation de-duplication, records
    without a key (all of which stay).

    Only keys, order columns and thread sizes are shuffled, not the posts.
    """
    key = conversation_key(thread_ids, thread_posts, conversation)
    size = F.when(F.col(thread_posts).isNotNull(), F.size(thread_posts)).otherwise(1)
    narrow = records.select(key.alias("_key"), size.alias("_size"), *order_by)
    kept = first_per_key(narrow.filter("_key IS NOT NULL"), "_key", order_by).select("_size")
    kept = kept.union(narrow.filter("_key IS NULL").select("_size"))
    posts_out = kept.agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("posts_out"))
    return narrow.agg(
        F.count(F.lit(1)).alias("records_in"), F.count_if(F.col("_key").isNull()).alias("without_key")
    ).select("records_in", posts_out.scalar().alias("posts_out"), "without_key")
