"""Suspicion signals per post and per account, bot score and account classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import epoch_to_timestamp, safe_ratio, sentinel_to_number
from ..schemas import POST_DOCUMENT, UNSCORED_USER_COLUMNS, USER_DOCUMENT

# Thresholds of the signals.
REGULAR_GAP_SECONDS = 300
VIEWS_PER_LIKE_LIMIT = 50
VIEWS_LIMIT = 7000
FOLLOW_RATIO_LIMIT = 1
FRIENDS_LIMIT = 500
SCORE_QUANTILE = 0.75
UNLABELLED = "none"

# Entries of a quantile sketch and the share of ranks by which it may be off.
SKETCH_SIZE = 2000
SKETCH_ERROR = 0.003

# The history of an account is cut into slots of this many seconds, and its posts without
# a time into so many parts.
SLOT_SECONDS = 86_400
UNDATED_PARTS = 64


# ---------------------------------------------------------------------------
# Posting regularity
# ---------------------------------------------------------------------------


def posting_gaps(
    posts: DataFrame,
    *,
    key: str = "screen_name",
    time: str = "created_at",
    tie: str = "id",
    slot_seconds: int | None = SLOT_SECONDS,
) -> DataFrame:
    """Add the gap to the account's previous post, the account's mean gap and
    the regularity flag.

    ``time_diff`` is null on an account's first post. ``time_bot`` is 1 where
    the gap is less than five minutes from the account mean. ``tie`` orders
    posts of the same second. Posts without an account have a gap but no mean.

    The history of every account is cut into time slots, so that no task holds a
    whole account however large it is. ``slot_seconds=None`` takes accounts whole,
    which needs one exchange instead of three (two of them narrow) where no
    account is too large for a task. Rows are the same for every choice.
    """
    if slot_seconds is None:
        gaps = _gaps_by_account(posts, key, time, tie)
    else:
        gaps = _gaps_by_slot(posts, key, time, tie, slot_seconds)
    seconds = F.col("time_diff").cast("double")
    mean_seconds = F.col("average_time_diff").cast("double")
    return gaps.select(
        "*",
        seconds.alias("time_diff_seconds"),
        mean_seconds.alias("average_time_diff_seconds"),
        (F.abs(seconds - mean_seconds) < REGULAR_GAP_SECONDS).cast("int").alias("time_bot"),
    )


def _gaps_by_account(posts: DataFrame, key: str, time: str, tie: str) -> DataFrame:
    account = Window.partitionBy(key)
    previous = F.lag(F.col(time).cast("long")).over(account.orderBy(time, tie))
    gaps = posts.withColumn("time_diff", F.col(time).cast("long") - previous)
    mean = F.when(F.col(key).isNotNull(), F.avg("time_diff").over(account))
    return gaps.withColumn("average_time_diff", mean)


def _gaps_by_slot(
    posts: DataFrame, key: str, time: str, tie: str, slot_seconds: int
) -> DataFrame:
    """Same rows as ``_gaps_by_account``, from one narrow row per account and slot: its
    first and last time and its posts. They give the last time before every slot, and, as
    the gaps of an account add up to its time span, the mean gap. Posts meet them by
    account and slot, where the window that finds the previous post runs as well. Posts
    without a time need the mean alone; those of an account go to UNDATED_PARTS places."""
    seconds = F.col(time).cast("long")
    slot = F.floor(seconds / slot_seconds)
    cells = posts.groupBy(F.col(key).alias("_key"), slot.alias("_cell")).agg(
        F.min(seconds).alias("_low"), F.max(seconds).alias("_last"), F.count(time).alias("_posts")
    )
    account = Window.partitionBy("_key")
    span = F.max("_last").over(account) - F.min("_low").over(account)
    cells = cells.select(
        "_key",
        "_cell",
        F.lag("_last").over(account.orderBy("_cell")).alias("_before"),
        F.when(F.col("_key").isNotNull(), F.try_divide(span, F.sum("_posts").over(account) - 1)).alias("average_time_diff"),
    )
    everywhere = F.when(F.col("_cell").isNull(), F.sequence(F.lit(0), F.lit(UNDATED_PARTS - 1)))
    cells = cells.withColumn("_place", F.explode(F.coalesce(everywhere, F.array(F.lit(0)))))
    undated = F.col(time).isNull()
    part = F.when(undated, F.pmod(F.xxhash64(tie), F.lit(UNDATED_PARTS)).cast("int")).otherwise(0)
    slotted = posts.withColumns({"_slot": slot, "_part": part})
    joined = slotted.join(
        cells,
        F.col(key).eqNullSafe(F.col("_key")) & F.col("_slot").eqNullSafe(F.col("_cell")) & (F.col("_part") == F.col("_place")),
        "left",
    )
    cell = Window.partitionBy(key, "_slot", "_part").orderBy(time, tie)
    previous = F.coalesce(F.lag(seconds).over(cell), F.col("_before"))
    return joined.withColumn("time_diff", F.when(~undated, seconds - previous)).select(
        *posts.columns, "time_diff", "average_time_diff"
    )


def regularity_count(posts: DataFrame, *, key: str = "screen_name", **options) -> DataFrame:
    """Number of regular gaps per account (null for a single-post account)."""
    gaps = posting_gaps(posts, key=key, **options)
    return gaps.groupBy(key).agg(F.sum("time_bot").alias("time_bot_count"))


# ---------------------------------------------------------------------------
# View inflation and follow imbalance
# ---------------------------------------------------------------------------


def view_inflation(
    posts: DataFrame, *, views: str = "views", likes: str = "favorite_count"
) -> DataFrame:
    """Turn ``views`` into a number and add the views-per-like ratio and flag.

    The tests run on single-precision values, which decides cases right above
    a limit.
    """
    number = sentinel_to_number(F.col(views))
    ratio = safe_ratio(number, F.col(likes))
    inflated = (ratio.cast("float") > VIEWS_PER_LIKE_LIMIT) & (
        number.cast("float") > VIEWS_LIMIT
    )
    flag = F.when(inflated, 1).otherwise(0)
    return posts.withColumns({views: number, "views/like": ratio, "views_score": flag})


def follow_imbalance(
    users: DataFrame, *, following: str = "friends_count", followers: str = "followers_count"
) -> DataFrame:
    """Add the following-to-follower ratio and its 0/1 flag."""
    ratio = safe_ratio(F.col(following), F.col(followers))
    imbalanced = (ratio.cast("float") > FOLLOW_RATIO_LIMIT) & (F.col(following) > FRIENDS_LIMIT)
    flag = F.when(imbalanced, 1).otherwise(0)
    return users.withColumns({"following/follower": ratio, "friend_score": flag})


# ---------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------


def scored_posts(posts: DataFrame, *, key: str = "screen_name", **options) -> DataFrame:
    """The scored post table: all post-level signals, dates as timestamps."""
    scored = view_inflation(posting_gaps(posts.drop("lang"), key=key, **options))
    return _document(scored, POST_DOCUMENT)


def _document(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns, with the date as a timestamp."""
    date = epoch_to_timestamp(F.col("created_at")).alias("created_at")
    return df.select(*[date if name == "created_at" else F.col(f"`{name}`") for name in names])


def account_signals(post_flags: DataFrame, *, key: str = "screen_name") -> DataFrame:
    """Regular gaps and flagged views per account, in one aggregation.

    ``post_flags`` carries ``time_bot`` and ``views_score`` per post.
    """
    return post_flags.groupBy(key).agg(
        F.sum("time_bot").alias("time_bot_count"), F.sum("views_score").alias("views_score")
    )


def prepare_users(users: DataFrame) -> DataFrame:
    """Label unlabelled accounts, drop repeated rows and columns not scored."""
    return (
        users.na.fill(UNLABELLED, ["verified_type"])
        .dropDuplicates()
        .drop(*UNSCORED_USER_COLUMNS)
    )


def score_accounts(
    users: DataFrame,
    signals: DataFrame,
    *,
    key: str = "screen_name",
    fill_missing_scores: bool = False,
) -> DataFrame:
    """Join prepared accounts to their signals and add the bot score.

    Accounts without posts count 0 regular gaps but keep a null
    ``views_score``, so their ``bot_score`` is null as well;
    ``fill_missing_scores`` counts 0 for both instead.
    """
    filled = ["time_bot_count", "views_score"] if fill_missing_scores else ["time_bot_count"]
    joined = follow_imbalance(users).join(signals, key, "left").na.fill(0, filled)
    score = F.col("friend_score") + F.col("views_score") + F.col("time_bot_count")
    return _document(joined.withColumn("bot_score", score), USER_DOCUMENT)


def account_scores(
    users: DataFrame, posts: DataFrame, *, key: str = "screen_name", **options
) -> DataFrame:
    """Scored account table from raw accounts and raw posts."""
    fill = options.pop("fill_missing_scores", False)
    flags = view_inflation(posting_gaps(posts, key=key, **options))
    return score_accounts(
        prepare_users(users), account_signals(flags, key=key), key=key, fill_missing_scores=fill
    )


# ---------------------------------------------------------------------------
# Threshold and classes
# ---------------------------------------------------------------------------


def score_threshold(
    scored: DataFrame, *, score: str = "bot_score", quantile: float = SCORE_QUANTILE
) -> DataFrame:
    """One row: the nearest-rank quantile of a whole-number score.

    Counts per score value combine before the shuffle, so only distinct scores
    are ordered. A score counts posts, so n posts allow at most about
    2 * sqrt(n) distinct values; that is what the one-partition window holds.
    """
    counts = (
        scored.filter(F.col(score).isNotNull()).groupBy(score).agg(F.count(F.lit(1)).alias("n"))
    )
    everything = Window.partitionBy()
    ranked = counts.select(
        score,
        F.sum("n").over(everything.orderBy(score)).alias("rank"),
        F.sum("n").over(everything).alias("total"),
    )
    reached = F.col("rank") >= F.ceil(F.col("total") * F.lit(quantile))
    return ranked.filter(reached).agg(F.min(score).alias("threshold"))


def score_sketches(
    scored: DataFrame, *, score: str = "bot_score", by: str | None = None, size: int = SKETCH_SIZE
) -> DataFrame:
    """Quantile sketches of a whole-number score: one row (``sketch``, ``n``), or one per
    value of ``by``, such as the day of a crawl. They can be stored and merged later."""
    known = scored.filter(F.col(score).isNotNull())
    sketch = F.kll_sketch_agg_bigint(F.col(score).cast("bigint"), F.lit(size)).alias("sketch")
    return known.groupBy(*([by] if by else [])).agg(sketch, F.count(F.lit(1)).alias("n"))


def sketched_threshold(sketches: DataFrame, *, quantile: float = SCORE_QUANTILE) -> DataFrame:
    """One row: the quantile from merged sketches, of a rank within ``SKETCH_ERROR`` of the
    wanted one (99 % of the time, for sketches of ``SKETCH_SIZE``; exact for so few scores
    that the sketch keeps them all). Null without scores. Only sketches are read, so the
    cost does not grow with the accounts; ``score_threshold`` is the exact one."""
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("n").alias("n"))
    found = F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(quantile)))
    return merged.select(F.when(F.col("n") > 0, found).alias("threshold"))


def classify_accounts(
    scored: DataFrame,
    *,
    score: str = "bot_score",
    quantile: float = SCORE_QUANTILE,
    threshold: DataFrame | None = None,
) -> DataFrame:
    """Give unlabelled accounts a class from score and verification.

    At or above the quantile: ``bot`` (unverified) or ``project`` (verified);
    below it: ``default_user`` or ``KOL``. Labelled accounts, and accounts
    with a null score or verification, stay as they are. The threshold is a
    scalar subquery of the same plan. It reads ``scored`` a second time, so pass
    a stored frame where scores take long to compute.
    """
    if threshold is None:
        threshold = score_threshold(scored, score=score, quantile=quantile)
    high = F.col(score) >= threshold.scalar()
    verified, label = F.col("verified"), F.col("verified_type")
    found = F.when(high, F.when(verified, "project").otherwise("bot")).when(
        ~high, F.when(verified, "KOL").otherwise("default_user")
    )
    open_case = (label == UNLABELLED) & verified.isNotNull()
    return scored.withColumn(
        "verified_type", F.when(open_case, F.coalesce(found, label)).otherwise(label)
    )


def summary_stats(df: DataFrame, *statistics: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of every numeric and text
    column, one row per statistic, as text."""
    return df.summary(*statistics)
