from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparrowscope.operators import clustering, metrics, signals
from sparrowscope.schemas import FEATURES, POST_TOTALS

from helpers import by_key, executed_plan_of, logical_plan_of, make_posts, make_users, rows_of


def scored(spark):
    posts = make_posts(
        spark,
        [
            {"screen_name": "a", "id": 1, "created_at": 0, "views": "10", "favorite_count": 5},
            {"screen_name": "a", "id": 2, "created_at": 9, "views": "20", "favorite_count": 6},
            {"screen_name": "b", "id": 3, "created_at": 0, "views": "30", "favorite_count": 7},
            {"screen_name": "c", "id": 4, "created_at": 0},
        ],
    )
    users = make_users(
        spark,
        [
            {"screen_name": "a", "followers_count": 11},
            {"screen_name": "b", "followers_count": 12},
            {"screen_name": "silent"},
        ],
    )
    return signals.scored_posts(posts), metrics.account_columns(
        signals.account_scores(users, posts)
    )


def test_metrics(spark):
    posts, accounts = scored(spark)
    found = metrics.account_metrics(posts, accounts)
    assert found.columns == ["screen_name", *FEATURES]
    names = ("tweet_count", "total_views", "total_favorite_count", "user_followers_count")
    assert by_key(found, "screen_name", *names) == {"a": (2, 30, 11, 11.0), "b": (1, 30, 7, 12.0)}


def test_metrics_equal_aggregates_over_the_join(spark):
    posts, accounts = scored(spark)
    joined = metrics.join_posts_accounts(posts, accounts)
    means = [name for name in FEATURES if name.startswith("user_")]
    direct = joined.groupBy("screen_name").agg(
        F.count("id").alias("tweet_count"),
        *[F.sum(name).alias(f"total_{name}") for name in POST_TOTALS],
        *[F.avg(name).alias(name) for name in means],
    )
    assert "user_screen_name" not in joined.columns
    assert rows_of(direct) == rows_of(metrics.account_metrics(posts, accounts))


def test_repeated_account_rows_do_not_inflate_totals(spark):
    posts, accounts = scored(spark)
    assert rows_of(metrics.account_metrics(posts, accounts.union(accounts))) == rows_of(
        metrics.account_metrics(posts, accounts)
    )


def test_joins_go_by_measured_size(spark):
    posts, accounts = scored(spark)
    for operator in (metrics.account_metrics, metrics.join_posts_accounts):
        assert "ResolvedHint" not in logical_plan_of(operator(posts, accounts))


def test_first_version_of_an_account_counts(spark):
    posts, accounts = scored(spark)
    later = accounts.withColumn("user_followers_count", F.col("user_followers_count") + 1000)
    twice = accounts.withColumn("crawl", F.lit(1)).union(later.withColumn("crawl", F.lit(2)))
    for operator in (metrics.account_metrics, metrics.join_posts_accounts):
        found = operator(posts, twice, order_by=["crawl"]).drop("crawl")
        assert rows_of(found) == rows_of(operator(posts, accounts))


def test_posts_are_summed_before_the_join(spark):
    plan = executed_plan_of(metrics.account_metrics(*scored(spark)))
    join = plan.index("Join")
    assert plan.index("partial_count") > join and "NestedLoop" not in plan


@pytest.fixture(scope="module")
def metrics_table(spark):
    """Three well separated groups of accounts."""
    centre = (F.col("id") % 3).cast("double")
    columns = [
        ((centre + 1) * (i + 1) * 100 * F.when(centre == i % 3, 9).otherwise(1) + F.col("id") % 5)
        .cast("double").alias(name)
        for i, name in enumerate(FEATURES)
    ]
    path_free = spark.range(0, 60, 1, 3)
    return path_free.select(F.col("id").cast("string").alias("screen_name"), *columns)


def test_vectors_follow_the_feature_order(spark, metrics_table):
    vectors = clustering.feature_vectors(metrics_table)
    row = vectors.filter("screen_name = '4'").first()
    assert list(row["features"]) == [row[name] for name in FEATURES]


def test_null_features(spark, metrics_table):
    gap = metrics_table.withColumn("user_bot_score", F.when(F.col("screen_name") != "1", 1.0))
    assert clustering.feature_vectors(gap, handle_invalid="skip").count() == 59
    with pytest.raises(Exception):
        clustering.feature_vectors(gap).collect()


def test_scaling_gives_unit_deviation_without_centring(spark, metrics_table):
    flat = metrics_table.withColumn("user_listed_count", F.lit(4.0))
    scaled = clustering.scaled_features(clustering.feature_vectors(flat))
    unpacked = clustering.unpack_vector(scaled.drop("features"), "scaled_features")
    deviations = unpacked.agg(*[F.stddev_samp(name).alias(name) for name in FEATURES]).first()
    assert all(deviations[name] == pytest.approx(1) for name in FEATURES[:-1])
    assert deviations["user_listed_count"] == 0
    assert unpacked.agg(F.min("tweet_count")).first()[0] > 0


def test_clusters_find_the_groups(spark, metrics_table):
    scaled = clustering.scaled_features(clustering.feature_vectors(metrics_table)).cache()
    clustered = clustering.assign_clusters(scaled)
    groups = clustered.groupBy("cluster").agg(F.collect_set(F.col("screen_name").cast("int") % 3))
    assert sorted(row[1] for row in groups.collect()) == [[0], [1], [2]]
    sizes = clustering.cluster_sizes(clustered)
    assert sorted(row["count"] for row in sizes.collect()) == [20, 20, 20]
    assert clustering.cluster_silhouette(clustered).first()["silhouette"] > 0.9
    assert clustering.account_clusters(clustered).columns == ["screen_name", *FEATURES, "cluster"]
    sweep = clustering.k_sweep(scaled, ks=(2, 3, 4), seed=1)
    best = max(sweep.collect(), key=lambda row: row["silhouette"])
    assert best["k"] == 3


def test_layout_of_the_input_does_not_change_clusters(spark):
    numbers = spark.range(400).select(
        F.col("id").cast("string").alias("screen_name"),
        *[
            (F.xxhash64("id", F.lit(i)) % 100).cast("double").alias(name)
            for i, name in enumerate(FEATURES)
        ],
    )
    found = []
    for layout in (numbers.coalesce(1), numbers.orderBy(F.desc("tweet_count")).repartition(7)):
        scaled = clustering.scaled_features(clustering.feature_vectors(layout))
        found.append(by_key(clustering.assign_clusters(scaled), "screen_name", "cluster"))
    assert found[0] == found[1]
    assert clustering.in_order(numbers, partitions=3).rdd.getNumPartitions() == 3


def test_fewer_accounts_than_clusters(spark, metrics_table):
    two = clustering.scaled_features(
        clustering.feature_vectors(metrics_table.filter("screen_name in ('0', '1')"))
    )
    assert clustering.cluster_sizes(clustering.assign_clusters(two)).count() == 2
    alike = two.filter("screen_name = '0'")
    single = clustering.assign_clusters(alike.union(alike))
    assert clustering.cluster_sizes(single).collect() == [(0, 2)]
    assert clustering.cluster_silhouette(single).first()["silhouette"] is None
