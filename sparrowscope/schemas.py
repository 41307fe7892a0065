"""Record layouts and fixed column lists."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, BOOLEAN = T.StringType(), T.LongType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    """Struct of nullable fields."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# ---------------------------------------------------------------------------
# Raw records: a post, or a thread that carries posts.
# ---------------------------------------------------------------------------

USER_RECORD = struct(
    screen_name=STRING,
    verified_type=STRING,
    verified=BOOLEAN,
    can_dm=BOOLEAN,
    can_media_tag=BOOLEAN,
    default_profile=BOOLEAN,
    has_custom_timelines=BOOLEAN,
    created_at=STRING,
    description=STRING,
    location=STRING,
    profile_url=STRING,
    favourites_count=LONG,
    followers_count=LONG,
    friends_count=LONG,
    listed_count=LONG,
    media_count=LONG,
    statuses_count=LONG,
    fast_followers_count=LONG,
    is_translator=BOOLEAN,
    translator_type=STRING,
    want_retweets=BOOLEAN,
    protected=BOOLEAN,
)

POST_DETAIL = struct(
    conversation_id_str=STRING,
    lang=STRING,
    created_at=STRING,
    bookmark_count=LONG,
    favorite_count=LONG,
    is_quote_status=BOOLEAN,
    quote_count=LONG,
    reply_count=LONG,
    retweet_count=LONG,
    user_id_str=STRING,
)

POST_RECORD = struct(
    id=STRING,
    text=STRING,
    url=STRING,
    views=STRING,
    is_retweet=BOOLEAN,
    is_quoted=BOOLEAN,
    is_reply=BOOLEAN,
    hashtags=T.ArrayType(struct(text=STRING)),
    original_tweet=POST_DETAIL,
    author=struct(original_user=USER_RECORD),
)

THREAD_IDS = "all_tweets_id"
THREAD_POSTS = "tweets"
CONVERSATION_PATH = "original_tweet.conversation_id_str"

RECORD = T.StructType(
    list(POST_RECORD.fields)
    + struct(**{THREAD_IDS: T.ArrayType(STRING), THREAD_POSTS: T.ArrayType(POST_RECORD)}).fields
)

# Key paths from a post record to the flat tables; the last key is the column
# name. Callers with another record layout pass their own lists.
POST_PATHS = (
    "author.original_user.screen_name",
    "original_tweet.bookmark_count",
    "original_tweet.created_at",
    "original_tweet.favorite_count",
    "original_tweet.is_quote_status",
    "original_tweet.lang",
    "original_tweet.quote_count",
    "original_tweet.reply_count",
    "original_tweet.retweet_count",
    "original_tweet.user_id_str",
    "id",
    "is_retweet",
    "is_quoted",
    "is_reply",
    "views",
    "url",
)
USER_PATHS = tuple(f"author.original_user.{name}" for name in USER_RECORD.names)

# ---------------------------------------------------------------------------
# Column lists that have to match for results to match.
# ---------------------------------------------------------------------------

# Account columns dropped before scoring.
UNSCORED_USER_COLUMNS = (
    "fast_followers_count",
    "is_translator",
    "translator_type",
    "want_retweets",
    "protected",
)

# Scored account table, which is also the account search document.
USER_DOCUMENT = (
    "verified_type",
    "can_dm",
    "can_media_tag",
    "created_at",
    "default_profile",
    "description",
    "favourites_count",
    "followers_count",
    "friends_count",
    "has_custom_timelines",
    "listed_count",
    "location",
    "media_count",
    "screen_name",
    "statuses_count",
    "verified",
    "profile_url",
    "time_bot_count",
    "views_score",
    "following/follower",
    "friend_score",
    "bot_score",
)

# Scored post table, which is also the post search document.
POST_DOCUMENT = (
    "screen_name",
    "hashtags",
    "bookmark_count",
    "created_at",
    "favorite_count",
    "is_quote_status",
    "quote_count",
    "reply_count",
    "retweet_count",
    "user_id_str",
    "id",
    "is_retweet",
    "is_quoted",
    "is_reply",
    "views",
    "url",
    "time_diff",
    "average_time_diff",
    "time_diff_seconds",
    "average_time_diff_seconds",
    "time_bot",
    "views/like",
    "views_score",
)

# Post columns summed per account; each becomes "total_<column>".
POST_TOTALS = (
    "favorite_count",
    "retweet_count",
    "reply_count",
    "quote_count",
    "views",
    "bookmark_count",
)

# Account columns averaged per account, already prefixed.
ACCOUNT_MEANS = (
    "user_favourites_count",
    "user_statuses_count",
    "user_followers_count",
    "user_friends_count",
    "user_media_count",
    "user_time_bot_count",
    "user_friend_score",
    "user_bot_score",
    "user_listed_count",
)

# Feature order of the clustering vector.
FEATURES = ("tweet_count", *(f"total_{c}" for c in POST_TOTALS), *ACCOUNT_MEANS)
