from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowscope.operators import dedup, flatten
from sparrowscope.schemas import POST_RECORD, RECORD

from helpers import executed_plan_of, rows_of


def post(name, conversation, **fields):
    author = fields.pop("author", {"screen_name": "a"})
    detail = {"conversation_id_str": conversation, "lang": "en", **fields.pop("detail", {})}
    return {"id": name, "original_tweet": detail, "author": {"original_user": author}, **fields}


def thread(*posts):
    return {"all_tweets_id": [p["id"] for p in posts], "tweets": list(posts)}


def frame_of(spark, items):
    schema = T.StructType([*RECORD.fields, T.StructField("position", T.IntegerType())])
    return spark.createDataFrame([{**r, "position": i} for i, r in enumerate(items)], schema)


def kept_ids(spark, *items):
    frame = frame_of(spark, items).repartition(3)
    return sorted(r["id"] for r in dedup.dedup_conversations(frame, ["position"]).collect())


def test_single_post_before_thread(spark):
    t = thread(post("1", "1"), post("2", "1"))
    assert kept_ids(spark, post("1", "1"), t) == ["1"]


def test_thread_before_single_post(spark):
    t = thread(post("1", "1"), post("2", "1"))
    assert kept_ids(spark, t, post("1", "1")) == ["1", "2"]


def test_replies_of_a_conversation_compete(spark):
    assert kept_ids(spark, post("5", "1"), post("6", "1"), post("7", "2")) == ["5", "7"]


def test_posts_inside_a_thread_are_not_compared(spark):
    t = thread(post("1", "1"), post("1", "1"))
    assert kept_ids(spark, t) == ["1", "1"]


def test_empty_thread(spark):
    assert kept_ids(spark, {"all_tweets_id": [], "tweets": []}, post("1", "1")) == ["1"]


ITEMS = [
    post("1", "1"),
    thread(post("1", "1"), post("2", "1")),
    thread(post("3", "3"), post("4", "3"), post("5", "3")),
    post("3", "3"),
    post("9", "9"),
]


def test_audit_and_flatten(spark):
    frame = frame_of(spark, ITEMS)
    assert dedup.dedup_audit(frame, ["position"]).collect() == [(5, 5, 0)]
    assert dedup.dedup_audit(frame.limit(0), ["position"]).collect() == [(0, 0, 0)]
    flat = dedup.flatten_threads(frame)
    assert rows_of(flat, "id") == Counter({("1",): 1, ("2",): 1, ("3",): 1, ("4",): 1, ("5",): 1})


def test_keeping_one_record_is_idempotent(spark):
    frame = frame_of(spark, ITEMS)
    once = dedup.first_per_key(frame, dedup.conversation_key(), ["position"])
    twice = dedup.first_per_key(once, dedup.conversation_key(), ["position"])
    assert rows_of(once, "position") == rows_of(twice, "position")


def test_first_per_key(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), (None, 5, "z"), (None, 4, "w"), ("b", 1, "v")],
        "k string, t int, v string",
    )
    assert rows_of(dedup.first_per_key(df, "k", ["t", "v"]), "k", "v") == Counter(
        {("a", "y"): 1, (None, "w"): 1, ("b", "v"): 1}
    )


def test_first_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = executed_plan_of(dedup.first_per_key(df, "k", ["id"]))
    assert plan.index("Exchange") < plan.index("Partial")


def test_distinct_rows(spark):
    data = [(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")]
    df = spark.createDataFrame(data, "n int, s string")
    assert rows_of(dedup.distinct_rows(df)) == Counter({(1, "a"): 1, (1, None): 1, (2, "a"): 1})
    assert dedup.distinct_rows(df, ["n"]).count() == 2


DATE = "Mon Jan 01 00:00:0{} +0000 2024"


@pytest.fixture()
def posts(spark):
    def one(name, second, author, lang="en", **fields):
        detail = {"created_at": DATE.format(second), "lang": lang, "reply_count": second}
        return post(name, name, author=author, detail=detail, **fields)

    late = {"screen_name": "a", "verified_type": "Business", "created_at": DATE.format(9)}
    early = {"screen_name": "a", "statuses_count": 4, "created_at": DATE.format(8)}
    other = {"screen_name": "b", "description": "hi", "created_at": DATE.format(7)}
    items = [
        one("1", 5, late, hashtags=[{"text": "x"}, {"text": "y"}]),
        one("2", 3, early, hashtags=[]),
        one("3", 1, early, lang="fr"),
        one("4", 2, other, lang=None),
        one("5", 6, other),
    ]
    return frame_of(spark, items).drop("position", "tweets", "all_tweets_id")


def test_flat_users(posts):
    users = flatten.flat_users(posts)
    names = ("screen_name", "verified_type", "description", "created_at", "statuses_count")
    assert rows_of(users, *names) == Counter(
        {("a", "none", "none", 1704067208, 4): 1, ("b", "none", "hi", 1704067207, None): 1}
    )


def test_flat_posts(posts):
    flat = flatten.flat_posts(posts)
    assert rows_of(flat, "id", "screen_name", "hashtags", "created_at", "reply_count") == Counter(
        {
            ("1", "a", "x, y", 1704067205, 5): 1,
            ("2", "a", "", 1704067203, 3): 1,
            ("5", "b", None, 1704067206, 6): 1,
        }
    )


def test_records_without_a_key_all_stay(spark):
    frame = frame_of(spark, ITEMS)
    nobody = frame.withColumns({
        "all_tweets_id": F.lit(None).cast(frame.schema["all_tweets_id"].dataType),
        "tweets": F.lit(None).cast(frame.schema["tweets"].dataType),
        "original_tweet": F.lit(None).cast(frame.schema["original_tweet"].dataType),
    })
    kept = dedup.dedup_conversations(nobody, ["position"])
    assert kept.count() == nobody.count()
    audit = dedup.dedup_audit(nobody, ["position"]).first()
    assert audit["without_key"] == audit["records_in"] == audit["posts_out"]


def test_first_profile_goes_by_input_order(spark):
    """The newer post comes first in the input, and its profile counts."""
    schema = T.StructType([*POST_RECORD.fields, T.StructField("place", T.LongType())])
    def post(id, place, date, followers):
        user = {"screen_name": "a", "followers_count": followers, "created_at": "Mon Jan 01 00:00:00 +0000 2018"}
        return {"id": id, "place": place, "original_tweet": {"lang": "en", "created_at": date},
                "author": {"original_user": user}}
    rows = [post("2", 0, "Tue Jan 02 00:00:00 +0000 2024", 900), post("1", 1, "Mon Jan 01 00:00:00 +0000 2024", 100)]
    frame = spark.createDataFrame(rows, schema)
    by_input = flatten.flat_users(frame, order_by=["place"]).first()["followers_count"]
    assert (by_input, flatten.flat_users(frame).first()["followers_count"]) == (900, 100)
