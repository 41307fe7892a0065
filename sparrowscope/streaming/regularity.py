"""Posting regularity kept current over a stream, from state per account.

The regularity flag of a post depends on the account's mean gap, which every new post
moves. But the flags need the gaps alone, not the posts: how often each gap occurred, and
the account's first time, last time and number of posts, which give the mean. That is the
state of an account, so a batch reads no post that came before it.

Posts come late and repeatedly. Those that the watermark has not passed wait, by id and
time; so a repeated one is seen, and a late one finds its place. Once the watermark has
passed a post, its gap is counted and its time forgotten; a timer does so for accounts
that post no more.

Size of an account's state: different gaps add up to the account's time span, so in s
seconds there are at most sqrt(2 s) + 1 of them (20 years: 35,500, two longs each, and as
a rule far fewer); of waiting posts there are as many as the account made within `delay`.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.signals import REGULAR_GAP_SECONDS
from ..sources.shared import ship_package

PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

HISTORY = "posts bigint, first bigint, last bigint, flagged bigint, gaps array<bigint>, counts array<bigint>"
WAITING = "times array<bigint>, ids array<string>, timer bigint"


class GapHistory(StatefulProcessor):
    """Rows (id, time, flag) of one account to its regular gaps and flagged posts."""

    def __init__(self, tolerance: int = REGULAR_GAP_SECONDS):
        self.tolerance = tolerance

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.history = handle.getValueState("history", HISTORY)
        self.waiting = handle.getValueState("waiting", WAITING)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        settled, gaps = self._settled()
        posts, timer = self._posts_waiting()
        ids = {id for _, id in posts if id is not None}
        flagged = 0
        for row in rows:
            if row.id is not None and row.time is not None:
                if row.id in ids:
                    continue
                ids.add(row.id)
            flagged += row.flag or 0
            if row.time is not None:
                posts.append((row.time, row.id))
        settled["flagged"] += flagged
        posts.sort(key=lambda post: post[0])
        posts = self._settle(settled, gaps, posts, timerValues.getCurrentWatermarkInMs())
        self._store(settled, gaps, posts, timer)
        yield self._result(key, settled, gaps, posts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        settled, gaps = self._settled()
        posts, _ = self._posts_waiting()
        posts = self._settle(settled, gaps, posts, timerValues.getCurrentWatermarkInMs())
        self._store(settled, gaps, posts, None)
        return iter([])

    def close(self) -> None:
        pass

    def _settled(self) -> tuple[dict, dict[int, int]]:
        state = self.history.get() if self.history.exists() else (0, None, None, 0, [], [])
        posts, first, last, flagged, gaps, counts = state
        return {"posts": posts, "first": first, "last": last, "flagged": flagged}, dict(zip(gaps, counts))

    def _posts_waiting(self) -> tuple[list[tuple[int, str | None]], int | None]:
        if not self.waiting.exists():
            return [], None
        times, ids, timer = self.waiting.get()
        return list(zip(times, ids)), timer

    @staticmethod
    def _settle(settled: dict, gaps: dict[int, int], posts: list, watermark_ms: int) -> list:
        """Count the gaps of the posts, in order of time, that the watermark has passed;
        returns the others. Spark lets no post that old pass from now on."""
        passed = 0
        for time, _ in posts:
            if time * 1000 > watermark_ms:
                break
            if settled["last"] is None:
                settled["first"] = time
            else:
                gap = time - settled["last"]
                gaps[gap] = gaps.get(gap, 0) + 1
            settled["last"] = time
            settled["posts"] += 1
            passed += 1
        return posts[passed:]

    def _store(self, settled: dict, gaps: dict[int, int], posts: list, timer: int | None) -> None:
        self.history.update((
            settled["posts"], settled["first"], settled["last"], settled["flagged"], list(gaps), list(gaps.values()),
        ))
        due = posts[-1][0] * 1000 if posts else None
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is None:
            self.waiting.clear()
            return
        if timer != due:
            self.handle.registerTimer(due)
        self.waiting.update(([time for time, _ in posts], [id for _, id in posts], due))

    def _result(self, key, settled: dict, gaps: dict[int, int], posts: list) -> Row:
        """Regular gaps as of now, waiting posts included."""
        times = [time for time, _ in posts]
        first = settled["first"] if settled["first"] is not None else (times[0] if times else None)
        last = times[-1] if times else settled["last"]
        count = settled["posts"] + len(times)
        regular = None
        if count > 1:
            mean = (last - first) / (count - 1)
            regular = sum(n for gap, n in gaps.items() if abs(gap - mean) < self.tolerance)
            before = [settled["last"]] if settled["last"] is not None else []
            chain = before + times
            regular += sum(abs(b - a - mean) < self.tolerance for a, b in zip(chain, chain[1:]))
        return Row(
            account=key[0], time_bot_count=regular, views_score=settled["flagged"], posts=count,
            first_time=first, last_time=last,
        )


def account_states(
    posts: DataFrame,
    *,
    delay: str = "7 days",
    key: str = "screen_name",
    id: str = "id",
    time: str = "created_at",
    flag: str = "views_score",
) -> DataFrame:
    """Stream of posts (with the view flag) to a stream of account states: ``key``,
    ``time_bot_count``, ``views_score``, ``posts``, ``first_time``, ``last_time``.

    Each batch gives one row for every account it touches; the newest is the account's
    current state, with the numbers that the batch operators give for all its posts. A post
    later than ``delay`` behind the newest post of an earlier batch is dropped by Spark and
    counted in the query's progress. Repeats are known by id within the delay; posts
    without an id are never repeats. Posts without a time count for the view flag alone,
    again if repeated. Posts without an account have no state and no row.
    """
    ship_package(posts.sparkSession)
    rows = posts.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("account"),
        F.col(id).cast("string").alias("id"),
        F.col(time).cast("long").alias("time"),
        F.col(flag).cast("int").alias("flag"),
        F.timestamp_seconds(F.col(time).cast("long")).alias("event_time"),
    )
    kind = posts.schema[key].dataType.simpleString()
    states = rows.withWatermark("event_time", delay).groupBy("account").transformWithState(
        GapHistory(),
        f"account {kind}, time_bot_count bigint, views_score bigint, posts bigint, first_time bigint, last_time bigint",
        "Update",
        "EventTime",
    )
    return states.withColumnRenamed("account", key)


def land_states(states: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write each batch of account states to a folder of its own, replaced if the batch is
    repeated. Python processors need the RocksDB state store, which is set for this query."""
    spark = states.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    before = spark.conf.get(PROVIDER_SETTING, None)
    spark.conf.set(PROVIDER_SETTING, ROCKS)
    try:
        return (
            states.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_SETTING)
        else:
            spark.conf.set(PROVIDER_SETTING, before)


def newest_states(spark: SparkSession, path: str, *, key: str = "screen_name") -> DataFrame:
    """Current state of every account from the output of ``land_states``."""
    rows = spark.read.parquet(path)
    values = [name for name in rows.columns if name not in (key, "batch_id")]
    newest = F.max_by(F.struct(*values), "batch_id").alias("_state")
    return rows.groupBy(key).agg(newest).select(key, "_state.*")
