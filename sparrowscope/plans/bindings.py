"""The test tables as posts, accounts, records and search texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import join_array_text
from ..schemas import POST_RECORD, THREAD_IDS, THREAD_POSTS, USER_RECORD
from ..sources.batch import read_table

RECORD_ORDER = ("conv_id", "phase", "turn")
RAW_DATE = "EEE MMM dd HH:mm:ss Z yyyy"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def posts_with_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts from ``events``, hashtags as an array of structs."""
    events = table(spark, sf_dir, "events").selectExpr(
        "*", "from_json(props, 'k bigint').k AS k"
    )
    return events.selectExpr(
        "event_id AS id",
        "CAST(user_id AS STRING) AS screen_name",
        "CAST(user_id AS STRING) AS user_id_str",
        """CASE WHEN event_type = 'error' THEN CAST(array() AS ARRAY<STRUCT<text: STRING>>)
           ELSE array(named_struct('text', event_type),
                      named_struct('text', concat('k', CAST(k AS STRING)))) END AS hashtags""",
        "unix_seconds(CAST(ts AS TIMESTAMP)) AS created_at",
        """CASE WHEN event_type = 'error' THEN 'Unavailable'
           ELSE CAST(k * 200 AS STRING) END AS views""",
        "CAST(floor(value) AS BIGINT) AS favorite_count",
        "k AS retweet_count",
        "event_id % 7 AS reply_count",
        "event_id % 5 AS quote_count",
        "event_id % 3 AS bookmark_count",
        "event_type = 'view' AS is_retweet",
        "event_type = 'click' AS is_reply",
        "event_type = 'signup' AS is_quoted",
        "event_type = 'signup' AS is_quote_status",
        "concat('https://example.com/status/', CAST(event_id AS STRING)) AS url",
        """CASE event_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr'
                             WHEN 2 THEN 'de' ELSE 'es' END AS lang""",
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = posts_with_tags(spark, sf_dir)
    return tagged.withColumn("hashtags", join_array_text(F.col("hashtags")))


def post_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two parts of the posts; the second has no ``lang`` but a column more."""
    whole = posts(spark, sf_dir)
    second = whole.filter(F.col("id") % 2 == 1).drop("lang")
    return whole.filter(F.col("id") % 2 == 0), second.withColumn("part", F.lit(2))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts from ``customer``, located by ``nation``."""
    located = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return located.selectExpr(
        "CAST(c_custkey AS STRING) AS screen_name",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Business' END AS verified_type",
        "c_acctbal > 0 AS verified",
        "c_custkey % 2 = 0 AS can_dm",
        "c_custkey % 3 = 0 AS can_media_tag",
        "c_custkey % 5 = 0 AS default_profile",
        "c_custkey % 11 = 0 AS has_custom_timelines",
        "1500000000 + c_custkey * 3600 AS created_at",
        "c_name AS description",
        "n_name AS location",
        "concat('https://example.com/', CAST(c_custkey AS STRING)) AS profile_url",
        "c_custkey % 1000 AS favourites_count",
        "(c_custkey % 7) * 500 AS followers_count",
        "CAST(abs(c_acctbal) AS BIGINT) AS friends_count",
        "CAST(c_nationkey AS BIGINT) AS listed_count",
        "c_custkey % 50 AS media_count",
        "c_custkey % 5000 AS statuses_count",
        "CAST(0 AS BIGINT) AS fast_followers_count",
        "false AS is_translator",
        "'none' AS translator_type",
        "false AS want_retweets",
        "false AS protected",
    )


def _struct_of(schema: T.StructType, values: dict[str, Column]) -> Column:
    """Struct of a schema; fields without a value are null."""
    return F.struct(
        *[
            values.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema.fields
        ]
    )


def raw_date(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), RAW_DATE)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts and threads from ``conversations``, with order columns.

    Odd conversations give single posts, even ones a thread; of the even ones,
    multiples of 4 give their turns as single posts too, multiples of 8 before
    the thread and the others after it.
    """
    conv, turn = F.col("conv_id"), F.col("turn")
    name = F.concat(conv.cast("string"), F.lit("-"), turn.cast("string"))
    post_struct = POST_RECORD["original_tweet"].dataType
    author = _struct_of(
        USER_RECORD,
        {
            "screen_name": F.concat(F.lit("author"), (conv % 20).cast("string")),
            "verified_type": F.when(conv % 3 == 0, "Business"),
            "statuses_count": conv * 10 + turn,
            "created_at": raw_date(1500000000 + conv),
        },
    )
    detail = _struct_of(
        post_struct,
        {
            "conversation_id_str": F.concat(conv.cast("string"), F.lit("-0")),
            "lang": F.when(conv % 5 != 0, "en").otherwise("fr"),
            "created_at": raw_date(1700000000 + conv * 1000 + turn),
            "reply_count": turn,
        },
    )
    post = _struct_of(
        POST_RECORD,
        {
            "id": name,
            "text": F.col("text"),
            "original_tweet": detail,
            "author": F.struct(author.alias("original_user")),
            "hashtags": F.array(F.struct(F.col("role").alias("text"))),
        },
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", post.alias("post"))

    no_ids = F.lit(None).cast(T.ArrayType(T.StringType()))
    no_posts = F.lit(None).cast(T.ArrayType(POST_RECORD))
    single = turns.filter((conv % 2 == 1) | (conv % 4 == 0)).select(
        "conv_id",
        F.when(conv % 2 == 1, 1).when(conv % 8 == 0, 0).otherwise(2).alias("phase"),
        "turn",
        "post.*",
        no_ids.alias(THREAD_IDS),
        no_posts.alias(THREAD_POSTS),
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "post"))).getField("post")
    threads = (
        turns.filter(conv % 2 == 0)
        .groupBy("conv_id")
        .agg(ordered.alias(THREAD_POSTS))
        .select(
            "conv_id",
            F.lit(1).alias("phase"),
            F.lit(0).cast("bigint").alias("turn"),
            F.col(THREAD_POSTS).getField("id").alias(THREAD_IDS),
            THREAD_POSTS,
        )
    )
    return single.unionByName(threads, allowMissingColumns=True)


def search_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with text from ``documents``."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        "text",
        "lang",
        (F.col("n_chars") % 500).alias("favorite_count"),
        (F.col("doc_id") % 40).alias("retweet_count"),
    )


def raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as raw date text and as ISO text."""
    moment = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.date_format(moment, RAW_DATE).alias("raw_date"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("iso_date"),
    )
