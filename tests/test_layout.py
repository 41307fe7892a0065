"""Work per account over tables in buckets: no shuffle, same rows."""

from __future__ import annotations

import uuid

import pytest

from sparrowscope.operators import metrics, signals
from sparrowscope.sources.layout import forget_layout, open_layout, write_layout
from sparrowscope.sources.shared import fresh_path

from helpers import executed_plan_of, make_posts, make_users, rows_of


@pytest.fixture
def scored(spark):
    """Posts and accounts; one account has a third of all posts, some posts no account."""
    rows = [
        {"screen_name": None if i % 11 == 0 else "hot" if i % 3 == 0 else f"a{i % 40}", "id": i, "created_at": i * 977 % 100_000}
        for i in range(600)
    ]
    posts = make_posts(spark, rows)
    users = make_users(spark, [{"screen_name": n, "followers_count": len(n)} for n in ["hot", "silent", *(f"a{i}" for i in range(40))]])
    return signals.scored_posts(posts), metrics.account_columns(signals.account_scores(users, posts))


@pytest.fixture
def laid_out(spark, scored):
    names = [f"t_{uuid.uuid4().hex}" for _ in range(2)]
    paths = [fresh_path(spark, "layout") for _ in range(2)]
    tables = [
        write_layout(df, name, path, key, buckets=4)
        for df, name, path, key in zip(scored, names, paths, ("screen_name", "user_screen_name"))
    ]
    yield tables, names, paths
    for name in names:
        forget_layout(spark, name)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_metrics_without_an_exchange(spark, scored, laid_out, no_broadcast):
    (posts, accounts), _, _ = laid_out
    found = metrics.account_metrics(posts, accounts)
    assert "Exchange" in executed_plan_of(metrics.account_metrics(*scored))
    assert "Exchange" not in executed_plan_of(found)
    assert rows_of(found) == rows_of(metrics.account_metrics(*scored))
    found.collect()
    assert "Exchange" not in executed_plan_of(found)


def test_joins_and_windows_without_an_exchange(spark, scored, laid_out, no_broadcast):
    (posts, accounts), _, _ = laid_out
    joined = metrics.join_posts_accounts(posts, accounts)
    assert "Exchange" not in executed_plan_of(joined)
    assert rows_of(joined) == rows_of(metrics.join_posts_accounts(*scored))
    times = posts.selectExpr("screen_name", "id", "unix_seconds(created_at) AS created_at")
    gaps = signals.regularity_count(times, slot_seconds=None)
    assert "Exchange" not in executed_plan_of(gaps)
    plain = scored[0].selectExpr("screen_name", "id", "unix_seconds(created_at) AS created_at")
    assert rows_of(gaps) == rows_of(signals.regularity_count(plain))


def test_a_later_session_opens_the_layout(spark, laid_out, no_broadcast):
    (posts, accounts), names, paths = laid_out
    expected = rows_of(metrics.account_metrics(posts, accounts))
    schemas = posts.schema, accounts.schema
    keys = ("screen_name", "user_screen_name")
    for name in names:
        forget_layout(spark, name)
    again = [open_layout(spark, n, p, s, k, buckets=4) for n, p, s, k in zip(names, paths, schemas, keys)]
    found = metrics.account_metrics(*again)
    assert "Exchange" not in executed_plan_of(found)
    assert rows_of(found) == expected


def test_plain_folder_and_modes(spark, scored, laid_out):
    _, names, paths = laid_out
    assert rows_of(spark.read.parquet(paths[0])) == rows_of(scored[0])
    with pytest.raises(Exception, match="already exists"):
        write_layout(scored[0], names[0], paths[0], buckets=4)
    empty = write_layout(scored[0].limit(0), f"t_{uuid.uuid4().hex}", fresh_path(spark, "layout"), buckets=4)
    assert empty.count() == 0
