from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparrowscope.plans import jobs
from sparrowscope.schemas import FEATURES, POST_DOCUMENT, USER_DOCUMENT
from sparrowscope.sources import batch
from sparrowscope.sources.shared import fresh_path, shared_folder, stored

from helpers import rows_of


def record(name, conversation, author="a", second=0, **fields):
    return {
        "id": name,
        "views": fields.pop("views", "9000"),
        "hashtags": [{"text": "t"}],
        "original_tweet": {
            "conversation_id_str": conversation,
            "lang": fields.pop("lang", "en"),
            "created_at": f"Mon Jan 01 00:{second // 60:02d}:{second % 60:02d} +0000 2024",
            "favorite_count": 3,
            "retweet_count": 1,
            "reply_count": 1,
            "quote_count": 1,
            "bookmark_count": 1,
        },
        "author": {
            "original_user": {
                "screen_name": author,
                "verified": fields.pop("verified", True),
                "created_at": "Sun Nov 05 02:30:00 -0400 2023",
                "friends_count": 5,
                "followers_count": 5,
                "favourites_count": 1,
                "statuses_count": 2,
                "media_count": 3,
                "listed_count": 4,
            }
        },
        **fields,
    }


def thread(*posts):
    return {"all_tweets_id": [p["id"] for p in posts], "tweets": list(posts)}


def write_array(folder, name, items, pretty=True):
    text = json.dumps(items, indent=2 if pretty else None, ensure_ascii=False)
    (folder / name).write_text(text, encoding="utf-8")


def test_json_arrays_with_control_characters_keep_their_order(spark, tmp_path):
    write_array(tmp_path, "b.json", [record("3", "3"), record("4", "4")], pretty=False)
    (tmp_path / "a.json").write_text('[{"id": "1", "text": "tab\there"},\n {"id": "2"}]')
    records = batch.read_records(spark, str(tmp_path), position=True)
    ordered = records.orderBy(*batch.POSITION).select("id", "text").collect()
    assert [tuple(row) for row in ordered] == [
        ("1", "tab\there"), ("2", None), ("3", None), ("4", None)
    ]
    both = [str(tmp_path / "a.json"), str(tmp_path / "b.json")]
    assert batch.read_records(spark, both).count() == 4


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5)], "a int, `views/like` double")
    path = str(tmp_path / "t")
    batch.write_table(df, path)
    with pytest.raises(Exception, match="already exists"):
        batch.write_table(df, path)
    batch.write_table(df, path, mode="append")
    assert rows_of(batch.read_table(spark, path)) == Counter({(1, 0.5): 2})
    assert batch.read_table(spark, path, schema=df.schema).count() == 2


def test_json_by_keyword(spark, tmp_path):
    data = [("k1", 1, "é"), ("k2", 2, None)]
    df = spark.createDataFrame(data, "keyword string, id int, t string")
    path = str(tmp_path / "hits")
    batch.write_json(df, path, partition_by=["keyword"])
    assert rows_of(spark.read.schema(df.schema).json(path), *df.columns) == rows_of(df, *df.columns)
    assert rows_of(spark.read.json(f"{path}/keyword=k1")) == Counter({(1, "é"): 1})
    lines = spark.read.text(f"{path}/keyword=k2").collect()
    assert lines[0][0] == '{"id":2,"t":null}'


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_stored_frames_are_read_back(spark):
    df = spark.range(10).select("id", F.array("id").alias("a"))
    copy = stored(df)
    assert rows_of(copy, "id") == rows_of(df, "id")
    assert "Range" not in copy._jdf.queryExecution().optimizedPlan().toString()


def test_jobs_from_crawl_files_to_clusters(spark, tmp_path):
    crawl = tmp_path / "crawl"
    crawl.mkdir()
    write_array(
        crawl,
        "a.json",
        [
            thread(record("1", "1", "a", 0), record("2", "1", "a", 60)),
            record("1", "1", "a", 0),
            record("5", "5", "b", 5),
            record("6", "5", "b", 90),
        ],
    )
    write_array(
        crawl,
        "b.json",
        [
            record("5", "5", "b", 5),
            record("7", "7", "c", 7, lang="fr"),
            record("8", "8", "d", 8, views="Unavailable"),
            record("9", "9", "a", 600),
        ],
    )
    out = {name: str(tmp_path / name) for name in
           ("users", "posts", "scored_users", "scored_posts", "clusters", "u_lines", "p_lines")}
    jobs.ingest_job(spark, str(crawl), out["users"], out["posts"])
    posts = spark.read.parquet(out["posts"])
    assert rows_of(posts, "id", "screen_name") == Counter(
        {("1", "a"): 1, ("2", "a"): 1, ("5", "b"): 1, ("8", "d"): 1, ("9", "a"): 1}
    )
    users = spark.read.parquet(out["users"])
    assert rows_of(users, "screen_name", "created_at") == Counter(
        {("a", 1699165800): 1, ("b", 1699165800): 1, ("d", 1699165800): 1}
    )

    jobs.scoring_job(
        spark, out["users"], out["posts"], out["scored_users"], out["scored_posts"]
    )
    accounts = spark.read.parquet(out["scored_users"])
    assert tuple(accounts.columns) == USER_DOCUMENT
    # a: three inflated posts, gaps 60 and 540 around a mean of 300 are regular
    assert rows_of(accounts, "screen_name", "bot_score", "verified_type") == Counter(
        {("a", 5, "project"): 1, ("b", 1, "KOL"): 1, ("d", 0, "KOL"): 1}
    )
    scored_posts = spark.read.parquet(out["scored_posts"])
    assert tuple(scored_posts.columns) == POST_DOCUMENT

    score, sizes = jobs.clustering_job(
        spark, out["scored_users"], [out["scored_posts"]], out["clusters"],
        segments=("project", "KOL"),
    )
    clusters = spark.read.parquet(out["clusters"])
    assert clusters.columns == ["screen_name", *FEATURES, "cluster"]
    assert clusters.count() == 3
    assert sum(row["count"] for row in sizes.collect()) == 3
    assert score.columns == ["silhouette"]

    jobs.index_job(
        spark, out["scored_users"], out["scored_posts"], out["u_lines"], out["p_lines"],
        users_index="accounts", posts_index="posts",
    )
    lines = [json.loads(row[0]) for row in spark.read.text(out["u_lines"]).collect()]
    assert [line for line in lines if "index" in line] == [{"index": {"_index": "accounts"}}] * 3
    assert all(set(line) == set(USER_DOCUMENT) for line in lines if "index" not in line)
    assert spark.read.text(out["p_lines"]).count() == 10


def test_broken_files_fail_or_are_marked(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"id": "1"}, {"id": "2"}]')
    (tmp_path / "bad.json").write_text('[{"id": "3"}, {"id": ')
    with pytest.raises(Exception):
        batch.read_records(spark, str(tmp_path)).collect()
    marked = batch.read_records(spark, str(tmp_path), on_error="mark").select("id", batch.CORRUPT).collect()
    good = sorted(row["id"] for row in marked if row[batch.CORRUPT] is None and row["id"])
    assert good == ["1", "2"]
    assert any("3" in row[batch.CORRUPT] for row in marked if row[batch.CORRUPT])
    assert batch.read_records(spark, str(tmp_path / "good.json")).count() == 2
