"""The batch jobs a user runs, from files to files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clustering import (
    account_clusters,
    assign_clusters,
    cluster_silhouette,
    cluster_sizes,
    feature_vectors,
    scaled_features,
)
from ..operators.columns import filter_segment, union_common_columns
from ..operators.dedup import PLACE, dedup_conversations, record_posts
from ..operators.flatten import flat_posts, flat_users
from ..operators.messages import bulk_lines, index_documents
from ..operators.metrics import account_columns, account_metrics
from ..operators.signals import (
    account_signals,
    classify_accounts,
    prepare_users,
    score_accounts,
    scored_posts,
)
from ..schemas import POST_DOCUMENT, USER_DOCUMENT
from ..sources.batch import POSITION, read_records, read_table, write_lines, write_table
from ..sources.shared import Scratch
from ..streaming.ingest import decode_stream, dedup_stream, land


def ingest_job(
    spark: SparkSession,
    records_path: str | Sequence[str],
    users_path: str,
    posts_path: str,
    *,
    lang: str = "en",
    array_files: bool = True,
) -> None:
    """Crawl files to flat accounts and posts, one record per conversation."""
    records = read_records(spark, records_path, array_files=array_files, position=True)
    with Scratch(spark) as scratch:
        posts = scratch.stored(dedup_conversations(records, POSITION, keep_order=True))
        # The first profile of an account in the order of the files counts.
        write_table(flat_users(posts, lang=lang, order_by=[*POSITION, PLACE]), users_path)
        write_table(flat_posts(posts, lang=lang), posts_path)


def stream_job(
    messages: DataFrame, posts_path: str, checkpoint: str, *, lang: str = "en", watermark: str = "1 day", **trigger
) -> StreamingQuery:
    """A stream of messages to flat posts: one record per conversation within the
    watermark, threads flattened."""
    kept = dedup_stream(decode_stream(messages), watermark=watermark)
    return land(flat_posts(record_posts(kept), lang=lang), posts_path, checkpoint, **trigger)


def scoring_job(
    spark: SparkSession,
    users_path: str,
    posts_path: str,
    scored_users_path: str,
    scored_posts_path: str,
    *,
    fill_missing_scores: bool = False,
) -> None:
    """Flat tables to scored posts and classified accounts.

    Accounts are scored from the written posts, so gaps are computed once, and
    classified from stored scores, so the threshold does not repeat the joins.
    """
    write_table(scored_posts(read_table(spark, posts_path)), scored_posts_path)
    signals = account_signals(read_table(spark, scored_posts_path))
    users = prepare_users(read_table(spark, users_path))
    with Scratch(spark) as scratch:
        scored = scratch.stored(score_accounts(users, signals, fill_missing_scores=fill_missing_scores))
        write_table(classify_accounts(scored), scored_users_path)


def clustering_job(
    spark: SparkSession,
    scored_users_path: str,
    scored_posts_paths: Sequence[str],
    predictions_path: str,
    *,
    segments: Sequence[str] = ("project",),
) -> tuple[DataFrame, DataFrame]:
    """Scored tables to clustered accounts; returns silhouette and sizes."""
    posts, *more = [read_table(spark, path) for path in scored_posts_paths]
    for part in more:
        posts = union_common_columns(posts, part)
    accounts = filter_segment(read_table(spark, scored_users_path), segments)
    metrics = account_metrics(posts, account_columns(accounts))
    with Scratch(spark) as scratch:
        scaled = scaled_features(feature_vectors(scratch.stored(metrics)))
        clustered = scratch.stored(assign_clusters(scaled))
        write_table(account_clusters(clustered), predictions_path)
        silhouette = cluster_silhouette(clustered)
    return silhouette, cluster_sizes(read_table(spark, predictions_path))


def index_job(
    spark: SparkSession,
    scored_users_path: str,
    scored_posts_paths: str | Sequence[str],
    users_lines_path: str,
    posts_lines_path: str,
    *,
    users_index: str,
    posts_index: str,
) -> None:
    """Scored tables to bulk-request files of both search indexes. Posts may come in
    several parts with the same columns."""
    paths = [scored_posts_paths] if isinstance(scored_posts_paths, str) else scored_posts_paths
    users = index_documents(read_table(spark, scored_users_path), USER_DOCUMENT, "screen_name")
    posts = index_documents(read_table(spark, *paths), POST_DOCUMENT, "id")
    write_lines(bulk_lines(users, users_index), users_lines_path)
    write_lines(bulk_lines(posts, posts_index), posts_lines_path)
