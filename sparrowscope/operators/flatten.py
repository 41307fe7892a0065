"""Nested post records to the flat account and post tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import join_array_text, parse_epoch, path_column
from ..schemas import POST_PATHS, USER_PATHS
from .columns import extract_paths, fill_null_strings
from .dedup import first_per_key
from .search import filter_lang

LANG_PATH = "original_tweet.lang"
AUTHOR_PATH = "author.original_user.screen_name"
POST_DATE_PATH = "original_tweet.created_at"


def post_order() -> list[Column]:
    """Posts by date, then id."""
    return [parse_epoch(path_column(POST_DATE_PATH)), F.col("id")]


def flat_users(
    posts: DataFrame,
    *,
    paths: Sequence[str] = USER_PATHS,
    lang: str = "en",
    order_by: Sequence[str | Column] | None = None,
    strict: bool = False,
) -> DataFrame:
    """One row per author of a post in the language, from the author's first such post in
    ``order_by``: give the order in which records came in (``dedup_conversations`` with
    ``keep_order``), as the first profile seen counts. Without it posts go by date and id.
    Null text becomes ``none``; the date becomes epoch seconds."""
    order = {f"_order{i}": F.col(c) if isinstance(c, str) else c
             for i, c in enumerate(order_by or post_order())}
    keyed = filter_lang(posts, lang, LANG_PATH).withColumns(
        {"_author": path_column(AUTHOR_PATH), **order}
    )
    # Account columns only from here on; posts are wide.
    authors = extract_paths(keyed, paths, keep=["_author", *order], strict=strict)
    users = first_per_key(authors, "_author", list(order)).drop("_author", *order)
    return fill_null_strings(users.withColumn("created_at", parse_epoch(F.col("created_at"))))


def flat_posts(
    posts: DataFrame,
    *,
    paths: Sequence[str] = POST_PATHS,
    lang: str = "en",
    strict: bool = False,
) -> DataFrame:
    """One row per post in the language, hashtag texts joined, the date as epoch
    seconds."""
    spoken = filter_lang(posts, lang, LANG_PATH)
    tagged = spoken.withColumn("hashtags", join_array_text(F.col("hashtags")))
    flat = extract_paths(tagged, paths, keep=["hashtags"], strict=strict)
    return flat.withColumn("created_at", parse_epoch(F.col("created_at")))
