"""Posts joined to accounts, and metrics per account."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ACCOUNT_MEANS, POST_TOTALS, USER_DOCUMENT
from .columns import prefix_columns
from .dedup import first_per_key


def account_columns(accounts: DataFrame) -> DataFrame:
    """The scored account columns under the ``user_`` prefix."""
    return prefix_columns(accounts, USER_DOCUMENT)


def one_version(
    accounts: DataFrame, key: str = "user_screen_name", order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per account: the first in the given order, by default that of all columns.
    Accounts that were crawled more than once would multiply their posts otherwise."""
    order = order_by or [name for name in accounts.columns if name != key]
    return first_per_key(accounts, key, [F.col(f"`{name}`") for name in order])


def join_posts_accounts(
    posts: DataFrame,
    accounts: DataFrame,
    *,
    key: str = "screen_name",
    account_key: str = "user_screen_name",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Posts of the given (prefixed) accounts, with the columns of the account's first
    version. Whether the accounts are broadcast is left to their measured size; in a
    sort-merge join adaptive execution splits the posts of a hot account."""
    accounts = one_version(accounts, account_key, order_by)
    matched = posts.join(accounts, posts[key] == accounts[account_key], "inner")
    return matched.drop(account_key)


def account_metrics(
    posts: DataFrame,
    accounts: DataFrame,
    *,
    key: str = "screen_name",
    account_key: str = "user_screen_name",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per account with posts: post count, six totals, nine account values.

    Posts are summed per account before the join, so what is shuffled is one partial row
    per account and map task, however many posts an account has. Every post of an account
    carries the values of its first version, so their mean is that value.
    """
    totals = posts.groupBy(key).agg(
        F.count("id").alias("tweet_count"),
        *[F.sum(name).alias(f"total_{name}") for name in POST_TOTALS],
    )
    values = one_version(accounts, account_key, order_by).select(
        account_key, *[F.col(n).cast("double").alias(n) for n in ACCOUNT_MEANS]
    )
    return totals.join(values, totals[key] == values[account_key], "inner").drop(account_key)
