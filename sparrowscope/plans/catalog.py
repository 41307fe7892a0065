"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    epoch_to_timestamp,
    join_array_text,
    parse_epoch,
    safe_ratio,
    sentinel_to_number,
)
from ..operators import (
    clustering,
    columns,
    crawls,
    dedup,
    flatten,
    maintained,
    messages,
    metrics,
    search,
    signals,
)
from ..schemas import FEATURES, POST_DOCUMENT, RECORD, UNSCORED_USER_COLUMNS, USER_DOCUMENT
from ..sources import arrays, batch, keystore, layout, publish
from ..sources.shared import fresh_path, stored
from ..streaming import ingest, regularity
from . import bindings

# Parameters of the search queries, repeated in their SQL.
KEYWORDS = ("near", "Thing", "other")
TOP_N = 20
ACCOUNTS = ("1", "5", "7", "11", "13")
SEGMENTS = ("project",)
MESSAGE_TIME = 1704067200
FILE_RECORDS = 200

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function name (``_query`` at the end is for
    names that a function of the package has already)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__.removesuffix("_query")] = run
    return function


def _plain_dates(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the SQL side has them."""
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("timestamp_ntz") for name in stamps})


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.account_scores(bindings.users(spark, sf_dir), bindings.posts(spark, sf_dir))


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.classify_accounts(stored(_scored(spark, sf_dir)))


def _scored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.scored_posts(bindings.posts(spark, sf_dir))


def _counted_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.view_inflation(bindings.posts(spark, sf_dir))


def _segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = _classified(spark, sf_dir)
    return metrics.account_columns(columns.filter_segment(classified, SEGMENTS))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.account_metrics(_counted_posts(spark, sf_dir), _segment(spark, sf_dir))


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.scaled_features(
        clustering.feature_vectors(stored(_metrics(spark, sf_dir)))
    )


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.engagement_search(bindings.search_texts(spark, sf_dir), KEYWORDS)


# -- Scoring -----------------------------------------------------------------


@query
def classify_accounts(spark, sf_dir):
    return _plain_dates(_classified(spark, sf_dir))


@query
def account_scores(spark, sf_dir):
    return _plain_dates(_scored(spark, sf_dir))


@query
def account_signals(spark, sf_dir):
    flags = signals.view_inflation(signals.posting_gaps(bindings.posts(spark, sf_dir)))
    return signals.account_signals(flags)


@query
def posting_gaps(spark, sf_dir):
    return signals.posting_gaps(bindings.posts(spark, sf_dir)).select(
        "id",
        "screen_name",
        "created_at",
        "time_diff",
        "average_time_diff",
        "time_diff_seconds",
        "average_time_diff_seconds",
        "time_bot",
    )


@query
def regularity_count(spark, sf_dir):
    return signals.regularity_count(bindings.posts(spark, sf_dir))


@query
def view_inflation(spark, sf_dir):
    return _counted_posts(spark, sf_dir).select(
        "id", "screen_name", "views", F.col("`views/like`").alias("views_per_like"), "views_score"
    )


@query
def account_view_flags(spark, sf_dir):
    flags = _counted_posts(spark, sf_dir)
    return flags.groupBy("screen_name").agg(F.sum("views_score").alias("views_score"))


@query
def follow_imbalance(spark, sf_dir):
    return signals.follow_imbalance(bindings.users(spark, sf_dir)).select(
        "screen_name", F.col("`following/follower`").alias("following_follower"), "friend_score"
    )


@query
def score_threshold(spark, sf_dir):
    return signals.score_threshold(_scored(spark, sf_dir))


@query
def sketched_threshold(spark, sf_dir):
    """The threshold from sketches of ten groups of accounts, and whether its rank is
    within the error that is stated for it."""
    scored = stored(_scored(spark, sf_dir))
    day = F.pmod(F.xxhash64("screen_name"), F.lit(10))
    sketches = stored(signals.score_sketches(scored.withColumn("day", day), by="day"))
    found = signals.sketched_threshold(sketches).scalar()
    score, error = F.col("bot_score"), signals.SKETCH_ERROR
    return scored.filter(score.isNotNull()).agg(
        F.count(F.lit(1)).alias("scores"),
        ((F.count_if(score < found) / F.count(F.lit(1)) <= signals.SCORE_QUANTILE + error)
         & (F.count_if(score <= found) / F.count(F.lit(1)) >= signals.SCORE_QUANTILE - error)).alias("within"),
    )


@query
def summary_stats(spark, sf_dir):
    names = ["followers_count", "friends_count", "time_bot_count", "views_score", "bot_score"]
    stats = signals.summary_stats(_scored(spark, sf_dir).select(*names))
    return stats.select("summary", *[F.round(F.col(n).cast("double"), 6).alias(n) for n in names])


@query
def class_counts(spark, sf_dir):
    classified = _classified(spark, sf_dir)
    return classified.groupBy("verified_type").agg(F.count(F.lit(1)).alias("accounts"))


# -- Expressions -------------------------------------------------------------


@query
def safe_ratio_query(spark, sf_dir):
    return bindings.users(spark, sf_dir).select(
        "screen_name",
        safe_ratio(F.col("friends_count"), F.col("followers_count")).alias("ratio"),
    )


@query
def sentinel_to_number_query(spark, sf_dir):
    return bindings.posts(spark, sf_dir).select(
        "id", sentinel_to_number(F.col("views")).alias("views")
    )


@query
def parse_epoch_query(spark, sf_dir):
    return bindings.raw_dates(spark, sf_dir).select(
        "id",
        parse_epoch(F.col("raw_date")).alias("raw_seconds"),
        parse_epoch(F.col("iso_date")).alias("iso_seconds"),
    )


@query
def epoch_to_timestamp_query(spark, sf_dir):
    moments = bindings.posts(spark, sf_dir).select(
        "id", epoch_to_timestamp(F.col("created_at")).alias("created_at")
    )
    return _plain_dates(moments)


@query
def join_array_text_query(spark, sf_dir):
    return bindings.posts_with_tags(spark, sf_dir).select(
        "id", join_array_text(F.col("hashtags")).alias("hashtags")
    )


# -- Sources and sinks -------------------------------------------------------


@query
def scan_parquet(spark, sf_dir):
    return batch.read_table(spark, f"{sf_dir}/events.parquet")


def _array_files(spark: SparkSession, sf_dir: str, records_per_file: int) -> str:
    """Records written as files of one JSON array each."""
    path = fresh_path(spark, "records")
    block = F.floor(F.monotonically_increasing_id() / records_per_file)
    records = bindings.records(spark, sf_dir).select(
        F.struct(*RECORD.names).alias("record"), block.alias("block")
    )
    array = F.to_json(F.collect_list("record"), {"pretty": "true"})
    arrays = records.groupBy("block").agg(array.alias("value")).select("value")
    arrays.write.option("maxRecordsPerFile", 1).text(path)
    return path


def _record_fields(records: DataFrame) -> DataFrame:
    return records.select(
        "id",
        "text",
        F.col("original_tweet.conversation_id_str").alias("conversation"),
        F.array_join("all_tweets_id", ",").alias("thread_ids"),
        F.size("tweets").alias("thread_size"),
    )


@query
def scan_json_array(spark, sf_dir):
    """Records written as files of one JSON array each and read again."""
    path = _array_files(spark, sf_dir, FILE_RECORDS)
    return _record_fields(batch.read_records(spark, path, position=True))


@query
def scan_json_array_ranges(spark, sf_dir):
    """The same from larger files, read by ranges and chunks."""
    path = _array_files(spark, sf_dir, 50 * FILE_RECORDS)
    return _record_fields(arrays.read_array_records(spark, path, position=True, chunk_bytes=1 << 16))


@query
def sink_parquet(spark, sf_dir):
    path = fresh_path(spark, "scored-posts")
    batch.write_table(_scored_posts(spark, sf_dir), path)
    return _plain_dates(batch.read_table(spark, path))


@query
def sink_published(spark, sf_dir):
    """Scored posts published in three batches, the last one twice and an old one late."""
    path = fresh_path(spark, "published")
    posts = stored(_scored_posts(spark, sf_dir))
    for number in (1, 3, 3, 2):
        part = posts if number == 3 else posts.filter(F.col("id") % 3 == number)
        publish.publish(part, path, number)
    return _plain_dates(publish.read_published(spark, path))


@query
def sink_json_by_keyword(spark, sf_dir):
    path = fresh_path(spark, "hits")
    hits = _hits(spark, sf_dir)
    batch.write_json(hits, path, partition_by=["keyword"])
    return spark.read.schema(hits.schema).json(path)


@query
def index_documents_users(spark, sf_dir):
    classified = _classified(spark, sf_dir)
    documents = messages.index_documents(classified, USER_DOCUMENT, "screen_name")
    return _plain_dates(messages.decode_documents(documents, classified.schema))


@query
def index_documents_posts(spark, sf_dir):
    scored = _scored_posts(spark, sf_dir)
    documents = messages.index_documents(scored, POST_DOCUMENT, "id")
    return _plain_dates(messages.decode_documents(documents, scored.schema))


@query
def bulk_request_lines(spark, sf_dir):
    """Bulk-request text written, read by line and taken apart again: a row per line,
    actions with index and document id, documents with their fields."""
    path = fresh_path(spark, "bulk")
    documents = messages.index_documents(_scored_posts(spark, sf_dir), POST_DOCUMENT, "id")
    batch.write_lines(messages.bulk_lines(documents, "posts", with_id=True), path)
    return spark.read.text(path).select(
        F.get_json_object("value", "$.index._index").alias("target"),
        F.get_json_object("value", "$.index._id").alias("target_id"),
        F.get_json_object("value", "$.id").cast("bigint").alias("id"),
        F.get_json_object("value", "$.screen_name").alias("screen_name"),
        F.get_json_object("value", "$.views").cast("bigint").alias("views"),
    )


@query
def kafka_messages(spark, sf_dir):
    """Every message: account, part and the posts it carries, in their order."""
    posts = bindings.posts(spark, sf_dir)
    sent = messages.account_messages(posts)
    records = messages.decode_value(F.col("value"), posts.schema)
    ids = F.array_join(F.transform(records, lambda r: r["id"].cast("string")), ",")
    return sent.select(F.decode("key", "UTF-8").alias("screen_name"), "part", ids.alias("ids"))


@query
def reject_messages(spark, sf_dir):
    """What is left over of messages of which some are cut off."""
    posts = bindings.posts(spark, sf_dir)
    text = F.to_json(F.array(F.struct("id", "screen_name")))
    cut = F.when(F.col("id") % 10 == 0, F.substring(text, 1, 12)).otherwise(text)
    sent = posts.select("id", F.encode(cut, "UTF-8").alias("value")).withColumnRenamed("id", "message")
    record = T.StructType().add("id", "long").add("screen_name", "string")
    return messages.reject_messages(sent, record, "message").withColumnRenamed(messages.CORRUPT, "rejected")


@query
def json_roundtrip(spark, sf_dir):
    return messages.json_roundtrip(
        bindings.posts(spark, sf_dir), ["id", "screen_name", "hashtags", "views", "is_reply"]
    )


# -- Projections, null handling, unions --------------------------------------


@query
def drop_columns(spark, sf_dir):
    return columns.drop_columns(bindings.users(spark, sf_dir), UNSCORED_USER_COLUMNS)


@query
def prefix_columns(spark, sf_dir):
    return _plain_dates(metrics.account_columns(_scored(spark, sf_dir)))


@query
def fill_null_label(spark, sf_dir):
    return columns.fill_null_label(bindings.users(spark, sf_dir)).select(
        "screen_name", "verified_type", "location"
    )


@query
def fill_null_strings(spark, sf_dir):
    users = bindings.users(spark, sf_dir).select(
        "screen_name",
        "verified_type",
        F.nullif("location", F.lit("NATION_3")).alias("location"),
        F.nullif("media_count", F.lit(7)).alias("media_count"),
    )
    return columns.fill_null_strings(users)


@query
def extract_paths(spark, sf_dir):
    records = bindings.records(spark, sf_dir)
    paths = [
        "original_tweet.conversation_id_str",
        "original_tweet.reply_count",
        "author.original_user.screen_name",
        "author.original_user.nickname",
    ]
    return columns.extract_paths(records, paths, keep=["id", "phase"])


@query
def extract_json_paths(spark, sf_dir):
    events = bindings.table(spark, sf_dir, "events")
    leaves = columns.extract_json_paths(events, "props", ["k", "a.absent"], keep=["event_id"])
    return leaves.withColumn("k", F.col("k").cast("bigint"))


@query
def optional_field(spark, sf_dir):
    records = bindings.records(spark, sf_dir)
    path = "author.original_user.verified_type"
    return records.select(
        "id",
        "phase",
        columns.optional_field(path, records.schema),
        columns.optional_field(f"{path}_class", records.schema, "none"),
    )


@query
def filter_segment(spark, sf_dir):
    return columns.filter_segment(_classified(spark, sf_dir), SEGMENTS).select(
        "screen_name", "verified_type", "bot_score"
    )


@query
def filter_lang(spark, sf_dir):
    return search.filter_lang(bindings.search_texts(spark, sf_dir), "en")


@query
def skip_first_rows(spark, sf_dir):
    return columns.skip_first_rows(bindings.posts(spark, sf_dir), "id").select("id", "screen_name")


@query
def union_common_columns(spark, sf_dir):
    first, second = bindings.post_parts(spark, sf_dir)
    return columns.union_common_columns(first, columns.skip_first_rows(second, "id"))


# -- De-duplication ----------------------------------------------------------


@query
def distinct_rows(spark, sf_dir):
    return dedup.distinct_rows(bindings.table(spark, sf_dir, "documents"), ["text", "lang"])


@query
def first_per_key(spark, sf_dir):
    posts = bindings.posts(spark, sf_dir)
    return dedup.first_per_key(posts, "screen_name", ["created_at", "id"]).select(
        "screen_name", "id", "created_at", "url"
    )


@query
def dedup_conversations(spark, sf_dir):
    records = bindings.records(spark, sf_dir)
    kept = dedup.dedup_conversations(records, bindings.RECORD_ORDER)
    return kept.select(
        "id", "text", F.col("original_tweet.conversation_id_str").alias("conversation")
    )


@query
def crawl_conversations(spark, sf_dir):
    """The same from three crawls, one after the other, over a store of keys."""
    records = bindings.records(spark, sf_dir)
    store = keystore.KeyStore(spark, fresh_path(spark, "keys"), buckets=8)
    found = None
    for phase in range(3):
        crawl = records.filter(F.col("phase") == phase)
        new = crawls.new_conversations(crawl, store, f"crawl{phase}", bindings.RECORD_ORDER)
        found = new if found is None else found.unionByName(new)
    return found.select(
        "id", "text", F.col("original_tweet.conversation_id_str").alias("conversation")
    )


@query
def flatten_threads(spark, sf_dir):
    return dedup.flatten_threads(bindings.records(spark, sf_dir)).select("id", "text")


@query
def dedup_audit(spark, sf_dir):
    return dedup.dedup_audit(bindings.records(spark, sf_dir), bindings.RECORD_ORDER)


@query
def flat_posts(spark, sf_dir):
    records = bindings.records(spark, sf_dir)
    posts = dedup.dedup_conversations(records, bindings.RECORD_ORDER)
    return flatten.flat_posts(posts)


@query
def flat_users(spark, sf_dir):
    records = bindings.records(spark, sf_dir)
    posts = dedup.dedup_conversations(records, bindings.RECORD_ORDER, keep_order=True)
    return flatten.flat_users(posts, order_by=[*bindings.RECORD_ORDER, dedup.PLACE])


# -- Search ------------------------------------------------------------------


@query
def indexed_search(spark, sf_dir):
    """The same from an index of grams, among 2,000 keywords that no post has."""
    absent = [f"absent-{i}" for i in range(2000)]
    return search.indexed_search(bindings.search_texts(spark, sf_dir), [*KEYWORDS, *absent])


@query
def engagement_search(spark, sf_dir):
    return _hits(spark, sf_dir)


@query
def top_posts_per_keyword(spark, sf_dir):
    return search.top_posts_per_keyword(_hits(spark, sf_dir), TOP_N).select(
        "keyword", "rank", "id", "favorite_count"
    )


@query
def account_timeline(spark, sf_dir):
    return search.account_timeline(bindings.posts(spark, sf_dir), ACCOUNTS)


# -- Metrics and clustering --------------------------------------------------


@query
def join_posts_accounts(spark, sf_dir):
    joined = metrics.join_posts_accounts(_counted_posts(spark, sf_dir), _segment(spark, sf_dir))
    return joined.select(
        "id", "screen_name", "favorite_count", "views", "user_verified_type", "user_bot_score",
        "user_following_follower",
    )


@query
def account_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


def _laid_out(spark: SparkSession, df: DataFrame, kind: str, key: str) -> DataFrame:
    path = fresh_path(spark, kind)
    return layout.write_layout(df, path.rsplit("/", 1)[1].replace("-", "_"), path, key, buckets=8)


@query
def colocated_metrics(spark, sf_dir):
    """Account metrics from posts and accounts in buckets by account: without a shuffle."""
    posts = _laid_out(spark, _scored_posts(spark, sf_dir), "scored-posts", "screen_name")
    accounts = _laid_out(spark, _segment(spark, sf_dir), "accounts", "user_screen_name")
    return metrics.account_metrics(posts, accounts)


@query
def maintained_metrics(spark, sf_dir):
    """Account metrics from partial aggregates of three batches, each repeating posts and
    accounts of the one before."""
    posts, accounts = _counted_posts(spark, sf_dir), stored(_segment(spark, sf_dir))
    store = maintained.MaintainedMetrics(
        spark, fresh_path(spark, "metrics"), ["user_created_at"], ["timestamp"], buckets=8
    )
    for batch in range(3):
        store.add_posts(batch, posts.filter(F.col("id") % 3 <= batch))
        store.add_accounts(batch, accounts)
    return store.current()


def _two_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every account twice, the later crawl with more followers."""
    accounts = metrics.account_columns(_scored(spark, sf_dir))
    later = accounts.withColumn("user_followers_count", F.col("user_followers_count") + 1000)
    return accounts.withColumn("crawl", F.lit(1)).union(later.withColumn("crawl", F.lit(2)))


@query
def join_first_versions(spark, sf_dir):
    """Posts joined to accounts that were crawled twice: the first crawl counts."""
    accounts = _two_versions(spark, sf_dir)
    joined = metrics.join_posts_accounts(_counted_posts(spark, sf_dir), accounts, order_by=["crawl"])
    return joined.select("id", "screen_name", "user_followers_count", "crawl")


@query
def metrics_first_versions(spark, sf_dir):
    accounts = _two_versions(spark, sf_dir)
    found = metrics.account_metrics(_counted_posts(spark, sf_dir), accounts, order_by=["crawl"])
    return found.select("screen_name", "tweet_count", "user_followers_count")


@query
def feature_vectors(spark, sf_dir):
    vectors = clustering.feature_vectors(_metrics(spark, sf_dir))
    return clustering.unpack_vector(vectors, "features")


@query
def scaled_features(spark, sf_dir):
    scaled = clustering.unpack_vector(_scaled(spark, sf_dir).drop("features"), "scaled_features")
    return scaled.select("screen_name", *[F.round(name, 6).alias(name) for name in FEATURES])


@query
def account_clusters(spark, sf_dir):
    clustered = clustering.assign_clusters(_scaled(spark, sf_dir))
    return clustering.account_clusters(clustered)


@query
def cluster_sizes(spark, sf_dir):
    return clustering.cluster_sizes(clustering.assign_clusters(_scaled(spark, sf_dir)))


@query
def cluster_silhouette(spark, sf_dir):
    clustered = clustering.assign_clusters(_scaled(spark, sf_dir))
    return clustering.cluster_silhouette(clustered)


@query
def k_sweep(spark, sf_dir):
    return clustering.k_sweep(_scaled(spark, sf_dir), seed=clustering.SEED)


# -- Streams -----------------------------------------------------------------


def _message_files(spark: SparkSession, sent: DataFrame, name: str) -> str:
    """Messages written as the files a stream then reads."""
    path = fresh_path(spark, name)
    stamp = F.timestamp_seconds(F.lit(MESSAGE_TIME)).alias("timestamp")
    sent.select("key", "value", stamp).write.parquet(path)
    return path


@query
def stream_decode(spark, sf_dir):
    """Posts sent as messages, decoded from a stream and landed as files."""
    posts = bindings.posts(spark, sf_dir)
    sent = _message_files(spark, messages.account_messages(posts), "messages")
    landed = fresh_path(spark, "landed")
    decoded = ingest.decode_stream(ingest.read_message_files(spark, sent), posts.schema)
    ingest.land(decoded.drop("timestamp"), landed, fresh_path(spark, "state")).awaitTermination()
    return batch.read_table(spark, landed, schema=posts.schema)


@query
def stream_dedup(spark, sf_dir):
    """Conversations left of a stream of records."""
    record = F.to_json(F.array(F.struct(*RECORD.names)))
    sent = bindings.records(spark, sf_dir).select(
        F.lit(None).cast("binary").alias("key"), F.encode(record, "UTF-8").alias("value")
    )
    stream = ingest.read_message_files(spark, _message_files(spark, sent, "records"))
    kept = ingest.dedup_stream(ingest.decode_stream(stream)).select("conversation_key")
    landed = fresh_path(spark, "conversations")
    ingest.land(kept, landed, fresh_path(spark, "state")).awaitTermination()
    return batch.read_table(spark, landed)


@query
def stream_rescore(spark, sf_dir):
    """Account signals kept current over a stream of posts in several batches."""
    posts = bindings.posts(spark, sf_dir)
    sent = messages.account_messages(posts, slot_seconds=7 * 86_400).repartition(6, "value")
    stream = ingest.read_message_files(
        spark, _message_files(spark, sent, "messages"), max_files=2
    )
    signals_path = fresh_path(spark, "signals")
    ingest.rescore_accounts(
        ingest.decode_stream(stream, posts.schema).drop("timestamp"),
        fresh_path(spark, "posts"),
        signals_path,
        fresh_path(spark, "state"),
    ).awaitTermination()
    return ingest.current_signals(spark, signals_path)


@query
def stream_regularity(spark, sf_dir):
    """Account signals from state per account, over a stream of posts in four batches that
    overlap, so that posts come late and repeatedly."""
    posts = _counted_posts(spark, sf_dir).withColumn("arrival", F.col("id") % 3)
    span = posts.agg(F.min("created_at").alias("low"), F.max("created_at").alias("high")).first()
    sent = fresh_path(spark, "posts")
    width = (span["high"] - span["low"]) // 4 + 1
    for batch in range(4):
        start = span["low"] + batch * width
        here = F.col("created_at").between(start, start + width - 1)
        before = F.col("created_at").between(start - width, start - 1)
        # A third comes a batch late, another third twice.
        arrived = (here & (F.col("arrival") != 0)) | (before & (F.col("arrival") != 1))
        if batch == 3:
            arrived = arrived | here
        posts.filter(arrived).coalesce(2).write.mode("append").parquet(sent)
    stream = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 2).parquet(sent)
    states = fresh_path(spark, "states")
    delay = f"{2 * width} seconds"
    regularity.land_states(
        regularity.account_states(stream, delay=delay), states, fresh_path(spark, "state")
    ).awaitTermination()
    return regularity.newest_states(spark, states).select("screen_name", "time_bot_count", "views_score")
