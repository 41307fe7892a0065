"""Hand-made posts and accounts, and comparison of frames."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession

POST = (
    "screen_name string, id bigint, created_at bigint, views string, favorite_count bigint, "
    "retweet_count bigint, reply_count bigint, quote_count bigint, bookmark_count bigint, "
    "is_quote_status boolean, is_retweet boolean, is_quoted boolean, is_reply boolean, "
    "hashtags string, url string, user_id_str string, lang string"
)
USER = (
    "screen_name string, verified_type string, verified boolean, can_dm boolean, "
    "can_media_tag boolean, default_profile boolean, has_custom_timelines boolean, "
    "created_at bigint, description string, location string, profile_url string, "
    "favourites_count bigint, followers_count bigint, friends_count bigint, "
    "listed_count bigint, media_count bigint, statuses_count bigint, "
    "fast_followers_count bigint, is_translator boolean, translator_type string, "
    "want_retweets boolean, protected boolean"
)


def _frame(spark: SparkSession, ddl: str, defaults: dict, rows: list[dict]) -> DataFrame:
    names = [part.split()[0] for part in ddl.split(", ")]
    data = [tuple({**defaults, **row}.get(name) for name in names) for row in rows]
    return spark.createDataFrame(data, ddl)


def make_posts(spark: SparkSession, rows: list[dict]) -> DataFrame:
    defaults = {
        "views": "0", "favorite_count": 1, "retweet_count": 0, "reply_count": 0,
        "quote_count": 0, "bookmark_count": 0, "is_quote_status": False, "is_retweet": False,
        "is_quoted": False, "is_reply": False, "hashtags": "", "lang": "en",
    }
    return _frame(spark, POST, defaults, rows)


def make_users(spark: SparkSession, rows: list[dict]) -> DataFrame:
    defaults = {
        "verified": False, "can_dm": True, "can_media_tag": True, "default_profile": False,
        "has_custom_timelines": False, "created_at": 1500000000, "favourites_count": 1,
        "followers_count": 100, "friends_count": 10, "listed_count": 2, "media_count": 3,
        "statuses_count": 4, "fast_followers_count": 0, "is_translator": False,
        "translator_type": "none", "want_retweets": False, "protected": False,
    }
    return _frame(spark, USER, defaults, rows)


def rows_of(df: DataFrame, *names: str) -> Counter:
    """Rows as a multiset, columns in name order."""
    names = names or tuple(sorted(df.columns))
    picked = df.select(*[f"`{name}`" for name in names])
    return Counter(tuple(row) for row in picked.collect())


def by_key(df: DataFrame, key: str, *names: str) -> dict:
    """Values of the named columns per key; a single name gives bare values."""
    out = {}
    for row in df.collect():
        values = tuple(row[name] for name in names)
        out[row[key]] = values[0] if len(names) == 1 else values
    return out


def logical_plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().analyzed().toString()


def executed_plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
