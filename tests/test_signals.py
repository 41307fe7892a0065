from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from sparrowscope.operators import signals
from sparrowscope.schemas import POST_DOCUMENT, USER_DOCUMENT

from helpers import by_key, executed_plan_of, make_posts, make_users, rows_of


def gaps(spark, rows, *names):
    return by_key(signals.posting_gaps(make_posts(spark, rows)), "id", *names)


def posts_at(account, *times, first_id=1):
    return [
        {"screen_name": account, "id": first_id + i, "created_at": t} for i, t in enumerate(times)
    ]


def test_first_post_has_no_gap(spark):
    found = gaps(spark, posts_at("a", 100, 160, 280), "time_diff", "average_time_diff", "time_bot")
    assert found == {1: (None, 90.0, None), 2: (60, 90.0, 1), 3: (120, 90.0, 1)}


def test_single_post_account(spark):
    assert gaps(spark, posts_at("a", 5), "time_diff", "average_time_diff", "time_bot") == {
        1: (None, None, None)
    }


def test_two_post_account_is_always_regular(spark):
    assert gaps(spark, posts_at("a", 0, 10**6), "time_bot") == {1: None, 2: 1}


def test_gap_exactly_at_the_limit_is_not_regular(spark):
    # gaps 300 and 900: mean 600, both off by exactly 300
    assert gaps(spark, posts_at("a", 0, 300, 1200), "time_bot") == {1: None, 2: 0, 3: 0}
    # gaps 301 and 899: off by 299
    assert gaps(spark, posts_at("a", 0, 301, 1200), "time_bot") == {1: None, 2: 1, 3: 1}


def test_posts_of_the_same_second_are_ordered_by_id(spark):
    rows = posts_at("a", 100, 100, 50)
    assert gaps(spark, rows, "time_diff") == {3: None, 1: 50, 2: 0}


def test_accounts_do_not_mix_and_missing_accounts_have_no_mean(spark):
    rows = posts_at("a", 0, 10) + posts_at(None, 3, 8, first_id=10)
    found = gaps(spark, rows, "time_diff", "average_time_diff", "time_bot")
    assert found == {
        1: (None, 10.0, None),
        2: (10, 10.0, 1),
        10: (None, None, None),
        11: (5, None, None),
    }


def test_regularity_count(spark):
    rows = posts_at("a", 0, 60, 120) + posts_at("b", 7, first_id=10)
    counts = by_key(
        signals.regularity_count(make_posts(spark, rows)), "screen_name", "time_bot_count"
    )
    assert counts == {"a": 2, "b": None}


def test_exchanges_of_gaps(spark):
    posts = make_posts(spark, posts_at("a", 0, 60))
    whole = signals.posting_gaps(posts, slot_seconds=None)
    assert executed_plan_of(whole).count("Exchange hashpartitioning") == 1
    # The posts themselves are exchanged once; the rest are rows per account and slot.
    slots = executed_plan_of(signals.posting_gaps(posts))
    assert slots.count("Exchange hashpartitioning") <= 5 and "NestedLoop" not in slots


@pytest.mark.parametrize(
    "views, likes, number, ratio, flag",
    [
        ("8000", 10, 8000, 800.0, 1),
        ("Unavailable", 10, 0, 0.0, 0),
        ("8000", 0, 8000, 0.0, 0),
        ("50000", 1000, 50000, 50.0, 0),  # exactly 50 views per like
        ("7000", 1, 7000, 7000.0, 0),  # exactly 7000 views
        ("7001", 1, 7001, 7001.0, 1),
        ("many", 1, None, None, 0),
        ("99999999999999999999", 1, None, None, 0),  # beyond 64 bits
        ("3000000000", 1, 3000000000, 3e9, 1),  # beyond 32 bits
        (None, 1, None, None, 0),
        ("500000001", 10000000, 500000001, 50.0000001, 0),  # 50 in single precision
    ],
)
def test_view_inflation(spark, views, likes, number, ratio, flag):
    posts = make_posts(
        spark, [{"screen_name": "a", "id": 1, "views": views, "favorite_count": likes}]
    )
    row = signals.view_inflation(posts).first()
    assert (row["views"], row["views/like"], row["views_score"]) == (number, ratio, flag)


@pytest.mark.parametrize(
    "friends, followers, ratio, flag",
    [
        (501, 500, 1.002, 1),
        (500, 100, 5.0, 0),  # exactly 500 friends
        (600, 600, 1.0, 0),  # ratio exactly 1
        (900, 0, 0.0, 0),
        (None, 10, None, 0),
        (900, None, 0.0, 0),
    ],
)
def test_follow_imbalance(spark, friends, followers, ratio, flag):
    users = make_users(
        spark, [{"screen_name": "a", "friends_count": friends, "followers_count": followers}]
    )
    row = signals.follow_imbalance(users).first()
    assert (row["following/follower"], row["friend_score"]) == (ratio, flag)


def test_scores_add_up_and_missing_posts_leave_null(spark):
    users = make_users(
        spark,
        [
            {"screen_name": "a", "friends_count": 900},
            {"screen_name": "a", "friends_count": 900},
            {"screen_name": "silent", "verified_type": "Business"},
        ],
    )
    posts = make_posts(
        spark,
        [
            {"screen_name": "a", "id": 1, "created_at": 0, "views": "9000"},
            {"screen_name": "a", "id": 2, "created_at": 60, "views": "9000"},
        ],
    )
    scored = signals.account_scores(users, posts)
    assert tuple(scored.columns) == USER_DOCUMENT
    names = ("verified_type", "friend_score", "views_score", "time_bot_count", "bot_score")
    assert by_key(scored, "screen_name", *names) == {
        "a": ("none", 1, 2, 1, 4),
        "silent": ("Business", 0, None, 0, None),
    }
    assert scored.count() == 2
    filled = signals.account_scores(users, posts, fill_missing_scores=True)
    assert by_key(filled, "screen_name", "bot_score") == {"a": 4, "silent": 0}


def test_scored_posts_have_the_document_columns(spark):
    posts = make_posts(spark, posts_at("a", 1699165800, 1699165900))
    scored = signals.scored_posts(posts)
    assert tuple(scored.columns) == POST_DOCUMENT
    stamp = datetime.datetime(2023, 11, 5, 6, 30)
    assert scored.filter("id = 1").select(
        F.col("created_at").cast("timestamp_ntz").alias("t")
    ).first()["t"] == stamp


def scored_frame(spark, rows):
    return spark.createDataFrame(
        rows, "screen_name string, verified_type string, verified boolean, bot_score bigint"
    )


def test_threshold_is_the_nearest_rank(spark):
    scores = scored_frame(spark, [(str(i), "none", True, i) for i in range(1, 11)])
    assert signals.score_threshold(scores).collect() == [(8,)]
    assert signals.score_threshold(scores, quantile=0.5).collect() == [(5,)]
    skewed = scored_frame(spark, [(str(i), "none", True, 7) for i in range(10)])
    assert signals.score_threshold(skewed).collect() == [(7,)]


def test_threshold_agrees_with_the_summary(spark):
    scores = spark.range(997).select((F.col("id") * F.col("id") % 83).alias("bot_score"))
    summary = scores.summary("75%").first()["bot_score"]
    assert str(signals.score_threshold(scores).first()["threshold"]) == summary


def test_classes(spark):
    scored = scored_frame(
        spark,
        [
            ("bot", "none", False, 8),  # equal to the threshold
            ("project", "none", True, 8),
            ("user", "none", False, 7),
            ("kol", "none", True, 1),
            ("labelled", "Business", False, 8),
            ("silent", "none", False, None),
            ("unknown", "none", None, 8),
        ],
    )
    threshold = spark.createDataFrame([(8,)], "threshold bigint")
    classified = signals.classify_accounts(scored, threshold=threshold)
    assert by_key(classified, "screen_name", "verified_type") == {
        "bot": "bot",
        "project": "project",
        "user": "default_user",
        "kol": "KOL",
        "labelled": "Business",
        "silent": "none",
        "unknown": "none",
    }


def test_classes_cover_all_accounts(spark):
    scored = scored_frame(
        spark, [(str(i), "none" if i % 3 else "Business", i % 2 == 0, i % 17) for i in range(300)]
    )
    counts = signals.classify_accounts(scored).groupBy("verified_type").count()
    assert sum(row["count"] for row in counts.collect()) == 300


def test_no_scores_leave_all_labels(spark):
    scored = scored_frame(spark, [("a", "none", True, None)])
    assert signals.classify_accounts(scored).first()["verified_type"] == "none"


def test_partitioning_does_not_change_scores(spark):
    rows = []
    for i in range(20):
        rows += posts_at(f"u{i}", *range(i, 5000, 91 + i), first_id=i * 1000)
    posts = make_posts(spark, rows)
    users = make_users(spark, [{"screen_name": f"u{i}"} for i in range(25)])
    one = signals.account_scores(users.coalesce(1), posts.coalesce(1))
    many = signals.account_scores(users.repartition(5), posts.repartition(7))
    assert rows_of(one) == rows_of(many)


def test_threshold_from_sketches(spark):
    import random

    choose = random.Random(3)
    scores = [int(choose.paretovariate(0.6)) for _ in range(30_000)]
    rows = [(i % 7, s) for i, s in enumerate(scores)] + [(1, None)]
    df = spark.createDataFrame(rows, "day int, bot_score bigint").repartition(5)
    sketches = signals.score_sketches(df, by="day")
    assert {r["day"]: r["n"] for r in sketches.collect()} == {d: scores[d::7].__len__() for d in range(7)}
    for quantile in (0.1, 0.75, 0.99):
        found = signals.sketched_threshold(sketches, quantile=quantile).first()["threshold"]
        below, upto = sum(s < found for s in scores), sum(s <= found for s in scores)
        assert below / len(scores) <= quantile + signals.SKETCH_ERROR
        assert upto / len(scores) >= quantile - signals.SKETCH_ERROR
    few = df.limit(500).cache()
    exact = signals.score_threshold(few).first()["threshold"]
    assert signals.sketched_threshold(signals.score_sketches(few)).first()["threshold"] == exact
    few.unpersist()
    assert signals.sketched_threshold(signals.score_sketches(df.limit(0))).first()["threshold"] is None
