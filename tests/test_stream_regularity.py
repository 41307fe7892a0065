"""Account states of a stream against the batch operators over all its posts."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparrowscope.operators import signals
from sparrowscope.sources.shared import fresh_path
from sparrowscope.streaming import regularity
from sparrowscope.streaming.regularity import GapHistory, account_states, land_states, newest_states

from helpers import make_posts, rows_of

FLAGGED = "screen_name string, id bigint, created_at bigint, views_score int"


class Stream:
    """A folder of post files and the query that follows them, one batch per call."""

    def __init__(self, spark, delay="1 day"):
        self.spark, self.delay, self.seen, self.batches = spark, delay, [], 0
        self.sent, self.found, self.state = (fresh_path(spark, n) for n in ("sent", "found", "state"))
        self.progress = []

    def send(self, rows):
        self.seen += rows
        self.spark.createDataFrame(rows, FLAGGED).coalesce(1).write.mode("append").parquet(self.sent)
        posts = self.spark.readStream.schema(FLAGGED).parquet(self.sent)
        query = land_states(account_states(posts, delay=self.delay), self.found, self.state)
        query.awaitTermination()
        self.progress += [json.loads(p.json) for p in query.recentProgress]
        return newest_states(self.spark, self.found)

    def expected(self):
        distinct = self.spark.createDataFrame(sorted(set(self.seen), key=str), FLAGGED)
        flags = signals.posting_gaps(distinct.filter("screen_name IS NOT NULL"))
        return signals.account_signals(flags)


def columns(df):
    return rows_of(df, "screen_name", "time_bot_count", "views_score")


def test_shuffled_late_and_repeated(spark):
    choose = random.Random(1)
    rows = []
    for account, count in (("a", 40), ("b", 25), ("c", 2), ("d", 1)):
        time = 1_700_000_000
        for i in range(count):
            time += choose.choice([3600, 3600, 3700, 60, 0, 20_000])
            rows.append((account, len(rows), time, choose.choice([0, 0, 1])))
    rows.sort(key=lambda r: r[2])
    # Batches overlap: each repeats posts of the one before and brings some of it late.
    late = [r for r in rows if r[1] % 7 == 0]
    stream, size = Stream(spark, "2 days"), 17
    for start in range(0, len(rows), size):
        batch = [r for r in rows[start : start + size] if r not in late]
        batch += [r for r in rows[max(0, start - size) : start] if r in late or r[1] % 5 == 0]
        choose.shuffle(batch)
        found = stream.send(batch)
        assert columns(found) == columns(stream.expected())
    found = stream.send([r for r in rows[-size:] if r in late] + [("z", 999, rows[-1][2] + 10**6, 1)])
    assert columns(found) == columns(stream.expected())
    assert all(int(s["numRowsDroppedByWatermark"]) == 0 for p in stream.progress for s in p["stateOperators"])


def test_settled_posts_are_forgotten_and_still_count(spark):
    day, stream = 86_400, Stream(spark, "1 hour")
    for i in range(5):
        found = stream.send([("a", i, (i + 1) * day, 1), ("b", 100 + i, (i + 1) * day + i * 400, 0)])
        assert columns(found) == columns(stream.expected())
    repeat = stream.send([("a", 0, day, 1), ("a", 5, 6 * day, 0)])
    assert columns(repeat) == columns(stream.expected())
    dropped = sum(int(s["numRowsDroppedByWatermark"]) for p in stream.progress for s in p["stateOperators"])
    assert dropped == 1
    state = repeat.filter("screen_name = 'a'").select("posts", "first_time", "last_time").first()
    assert tuple(state) == (6, day, 6 * day)


def test_nulls(spark):
    stream = Stream(spark)
    found = stream.send([
        ("a", 1, None, 1), ("a", 2, 1000, 0), (None, 3, 1000, 1), ("b", 4, None, 0),
        ("c", None, 1000, 1), ("c", None, 1000, 1), ("c", 9, 1000, None),
    ])
    rows = {r["screen_name"]: (r["time_bot_count"], r["views_score"], r["posts"]) for r in found.collect()}
    assert rows == {"a": (None, 1, 1), "b": (None, 0, 0), "c": (2, 2, 3)}


def test_a_batch_reads_no_earlier_post(spark):
    """The plan of a batch has one scan, of the batch's own files."""
    stream = Stream(spark)
    for i in range(3):
        stream.send([("a", 10 * i + k, 10_000 * i + k, 0) for k in range(4)])
    assert [p["numInputRows"] for p in stream.progress if p["numInputRows"]] == [4, 4, 4]


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class _Handle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, name, schema):
        return _Value()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_state_stays_small():
    """A hundred thousand posts leave their different gaps behind, and the waiting ones."""
    from pyspark.sql import Row

    handle, processor, time = _Handle(), GapHistory(), 0
    processor.init(handle)
    for batch in range(100):
        rows = []
        for i in range(1000):
            time += (i * 37 + batch) % 90
            rows.append(Row(id=f"{batch}-{i}", time=time, flag=0))
        result, = processor.handleInputRows(("a",), iter(rows), _Watermark((time - 3600) * 1000))
        posts, first, last, flagged, gaps, counts = processor.history.get()
        times, ids, timer = processor.waiting.get()
        assert len(gaps) <= 90 and len(times) <= 200 and handle.timers == {timer}
        assert sum(counts) == posts - 1 and result.posts == posts + len(times)
    handle.timers.clear()  # Spark removes a timer that went off
    processor.handleExpiredTimer(("a",), _Watermark(time * 1000), None)
    assert not processor.waiting.exists() and not handle.timers
    assert processor.history.get()[0] == 100_000
