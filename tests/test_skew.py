from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparrowscope.operators import messages, search, signals

from helpers import make_posts, rows_of


def expected_gaps(rows):
    """Gaps, means and flags by plain loops."""
    accounts = defaultdict(list)
    for row in rows:
        accounts[row["screen_name"]].append(row)
    found = Counter()
    for account, history in accounts.items():
        history.sort(key=lambda r: (r["created_at"] is not None, r["created_at"] or 0, r["id"]))
        gaps, last = [], None
        for row in history:
            now = row["created_at"]
            gaps.append(None if now is None or last is None else now - last)
            last = now
        known = [gap for gap in gaps if gap is not None]
        mean = sum(known) / len(known) if known and account is not None else None
        for row, gap in zip(history, gaps):
            flag = None if gap is None or mean is None else int(abs(gap - mean) < 300)
            found[(row["id"], account, row["created_at"], gap, mean, flag)] += 1
    return found


def random_rows(seed, accounts, n, span):
    chance = random.Random(seed)
    rows = []
    for i in range(n):
        undated = chance.random() < 0.05
        rows.append(
            {
                "screen_name": chance.choice(accounts),
                "id": i,
                "created_at": None if undated else chance.randrange(span),
            }
        )
    return rows


NAMES = ("id", "screen_name", "created_at", "time_diff", "average_time_diff", "time_bot")


@pytest.mark.parametrize("slot_seconds", [1, 7, 60, 10**6, None])
def test_slots_change_nothing(spark, slot_seconds):
    rows = random_rows(7, ["a", "a", "a", "b", "c", None], 900, 2000)
    posts = make_posts(spark, rows)
    found = signals.posting_gaps(posts, slot_seconds=slot_seconds)
    assert rows_of(found, *NAMES) == expected_gaps(rows)
    assert set(found.columns) == set(signals.posting_gaps(posts).columns)


@pytest.mark.parametrize("slot_seconds", [10, None])
def test_repeated_posts_and_busy_seconds(spark, slot_seconds):
    chance = random.Random(5)
    rows = [
        {"screen_name": "a", "id": chance.randrange(40), "created_at": chance.choice([7, 9, 80])}
        for _ in range(600)
    ] + random_rows(5, ["b", "a"], 50, 200)
    posts = make_posts(spark, rows + rows).repartition(5)
    found = signals.posting_gaps(posts, slot_seconds=slot_seconds)
    assert rows_of(found, *NAMES) == expected_gaps(rows + rows)


def test_account_of_one_post_or_no_date(spark):
    posts = make_posts(
        spark,
        [
            {"screen_name": "a", "id": 1, "created_at": 50},
            {"screen_name": "b", "id": 2, "created_at": None},
        ],
    )
    found = signals.posting_gaps(posts)
    assert rows_of(found, "id", "time_diff", "average_time_diff") == Counter(
        {(1, None, None): 1, (2, None, None): 1}
    )


def test_building_runs_no_job(spark):
    posts = make_posts(spark, random_rows(3, ["a", "b"], 50, 100))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    signals.posting_gaps(posts)
    messages.account_messages(posts)
    assert list(tracker.getJobIdsForGroup("building")) == []


def test_messages_do_not_depend_on_the_layout(spark):
    rows = random_rows(11, ["a"] * 40 + ["b", "c", None], 600, 500_000)
    expected = {}
    for row in rows:
        part = None if row["created_at"] is None else row["created_at"] // 86_400
        expected.setdefault((row["screen_name"], part), []).append(row)
    order = lambda r: (r["created_at"] is not None, r["created_at"] or 0, r["id"])
    plain = Counter(
        (account, part, tuple(r["id"] for r in sorted(found, key=order)))
        for (account, part), found in expected.items()
    )
    seen = []
    for splits in (1, 7):
        posts = make_posts(spark, rows).repartition(splits)
        sent = messages.account_messages(posts)
        ids = F.transform(messages.decode_value(F.col("value"), posts.schema), lambda r: r["id"])
        found = sent.select(F.decode("key", "UTF-8").alias("k"), "part", ids.alias("ids")).collect()
        seen.append(Counter((r["k"], r["part"], tuple(r["ids"])) for r in found))
        # Undated posts of an account come in several messages, each in order of id.
        together = defaultdict(list)
        for r in found:
            assert r["part"] is not None or r["ids"] == sorted(r["ids"])
            together[r["k"], r["part"]] += r["ids"]
        whole = Counter((k, part, tuple(sorted(i) if part is None else i)) for (k, part), i in together.items())
        assert whole == plain
        assert rows_of(messages.decode_messages(sent, posts.schema)) == rows_of(posts)
    assert seen[0] == seen[1]


def test_broken_messages_fail_or_are_marked(spark):
    texts = ['[{"id":1,"name":"a"},{"id":2,"name":"b"}]', '[{"id":"x","name":"c"},{"id":4}]', '[{"id":5', "[]", None]
    sent = spark.createDataFrame([(i, None if t is None else t.encode()) for i, t in enumerate(texts)], "n int, value binary")
    record = spark.createDataFrame([], "id bigint, name string").schema
    marked = messages.decode_messages(sent, record, "n", on_error="mark")
    good = Counter(tuple(r[:3]) for r in marked.collect() if r["_corrupt"] is None)
    assert good == Counter({(0, 1, "a"): 1, (0, 2, "b"): 1, (1, 4, None): 1})
    rejected = Counter(map(tuple, messages.reject_messages(sent, record, "n").collect()))
    assert rejected == Counter({(1, '{"id":"x","name":"c"}'): 1, (2, '[{"id":5'): 1, (4, ""): 1})
    with pytest.raises(Exception, match="unreadable message"):
        messages.decode_messages(sent, record, "n").collect()
    assert messages.decode_messages(sent.where("n = 0"), record).count() == 2


@pytest.mark.parametrize("groups", [1, 3, 512])
def test_ranking_in_groups_gives_the_top(spark, groups):
    hits = spark.range(500).repartition(6).select(
        F.concat(F.lit("k"), (F.col("id") % 2).cast("string")).alias("keyword"),
        "id",
        (F.col("id") * 37 % 101).alias("favorite_count"),
    )
    top = search.top_posts_per_keyword(hits, 7, groups=groups)
    expected = Counter()
    for keyword in (0, 1):
        ranked = sorted((-(i * 37 % 101), i) for i in range(keyword, 500, 2))[:7]
        expected.update((f"k{keyword}", r + 1, i) for r, (_, i) in enumerate(ranked))
    assert rows_of(top, "keyword", "rank", "id") == expected


def test_a_third_of_all_posts_undated(spark):
    """Undated posts of one account are dealt to many places, with the rows as ever."""
    rows = [{"screen_name": "hot", "id": i, "created_at": None if i % 3 == 0 else i * 50_000} for i in range(600)]
    rows += [{"screen_name": None if i % 2 else "b", "id": 1000 + i, "created_at": None if i % 3 else i} for i in range(20)]
    posts = make_posts(spark, rows).repartition(3)
    names = ("id", "screen_name", "created_at", "time_diff", "average_time_diff", "time_bot")
    found = signals.posting_gaps(posts)
    assert rows_of(found, *names) == rows_of(signals.posting_gaps(posts, slot_seconds=None), *names)
    undated = found.filter("created_at IS NULL AND screen_name = 'hot'")
    assert undated.count() == 200
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        tasks = signals.posting_gaps(posts).filter("created_at IS NULL AND screen_name = 'hot'")
        places = tasks.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(places) > 20 and max(r["count"] for r in places) < 30
    sent = messages.account_messages(posts)
    sizes = messages.decode_messages(sent, posts.schema).groupBy("screen_name").count()
    assert {r["screen_name"]: r["count"] for r in sizes.collect()} == {"hot": 600, "b": 10, None: 10}
    largest = sent.filter("part IS NULL").select(F.octet_length("value").alias("n")).agg(F.max("n")).first()[0]
    whole = sent.filter("part IS NULL").select(F.octet_length("value").alias("n")).agg(F.sum("n")).first()[0]
    assert largest < whole / 10
