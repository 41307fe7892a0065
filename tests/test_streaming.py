from __future__ import annotations

import datetime
from collections import Counter

from pyspark.sql import functions as F

from sparrowscope.operators import messages, signals
from sparrowscope.plans import jobs
from sparrowscope.schemas import RECORD
from sparrowscope.sources.publish import read_published
from sparrowscope.sources.shared import fresh_path
from sparrowscope.streaming import ingest

from helpers import make_posts, rows_of

START = datetime.datetime(2024, 1, 1)


def send(spark, df, path, hours=0):
    stamp = F.lit(START + datetime.timedelta(hours=hours))
    df.select("key", "value", stamp.alias("timestamp")).write.mode("append").parquet(path)


def history(spark, ids, account="a"):
    return make_posts(
        spark, [{"screen_name": account, "id": i, "created_at": i * 100} for i in ids]
    )


def test_decoded_stream_equals_the_batch_and_resumes(spark):
    sent, landed, state = (fresh_path(spark, n) for n in ("sent", "landed", "state"))
    first, second = history(spark, range(5)), history(spark, range(5, 9), "b")
    schema = first.schema

    def run():
        stream = ingest.decode_stream(ingest.read_message_files(spark, sent), schema)
        ingest.land(stream.drop("timestamp"), landed, state).awaitTermination()
        return spark.read.schema(schema).parquet(landed)

    send(spark, messages.account_messages(first), sent)
    assert rows_of(run()) == rows_of(first)
    send(spark, messages.account_messages(second), sent, hours=1)
    assert rows_of(run()) == rows_of(first.union(second))
    assert run().count() == 9


def test_malformed_messages_are_not_lost(spark):
    df = spark.createDataFrame([(None, bytearray(b"not json"))], "key binary, value binary")
    rejected = messages.reject_messages(df, RECORD).collect()
    assert [row["_corrupt"] for row in rejected] == ["not json"]


def test_rescoring_reads_touched_buckets_only(spark):
    landed, signals_at, state, sent = (fresh_path(spark, n) for n in ("landed", "signals", "state", "sent"))
    for part, account in enumerate("abcdefgh"):
        send(spark, messages.account_messages(history(spark, range(part * 10, part * 10 + 4), account)), sent, hours=part)
        stream = ingest.decode_stream(ingest.read_message_files(spark, sent), history(spark, []).schema)
        ingest.rescore_accounts(stream.drop("timestamp"), landed, signals_at, state).awaitTermination()
    last = ingest.touched_history(spark, landed, history(spark, []).schema, 7, "screen_name")
    assert {row["screen_name"] for row in last.collect()} == {"h"}
    plan = last._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line or "bucket" in line]
    assert any("bucket" in line for line in filters)
    compact = fresh_path(spark, "compact")
    ingest.compact_signals(spark, signals_at, compact)
    assert rows_of(ingest.current_signals(spark, compact)) == rows_of(ingest.current_signals(spark, signals_at))


def test_stream_dedup_within_the_watermark(spark):
    sent, landed, state = (fresh_path(spark, n) for n in ("sent", "landed", "state"))

    def batch(*conversations):
        rows = [
            {"id": c, "original_tweet": {"conversation_id_str": c}} for c in conversations
        ]
        record = F.to_json(F.array(F.struct(*RECORD.names)))
        return spark.createDataFrame(rows, RECORD).select(
            F.lit(None).cast("binary").alias("key"), F.encode(record, "UTF-8").alias("value")
        )

    def run():
        stream = ingest.decode_stream(ingest.read_message_files(spark, sent))
        kept = ingest.dedup_stream(stream, watermark="2 hours").select("conversation_key", "id")
        ingest.land(kept, landed, state).awaitTermination()
        return rows_of(spark.read.parquet(landed), "conversation_key")

    send(spark, batch("1", "1", "2"), sent)
    assert run() == Counter({("1",): 1, ("2",): 1})
    send(spark, batch("2", "3"), sent, hours=1)
    assert run() == Counter({("1",): 1, ("2",): 1, ("3",): 1})


def test_latest_batch_only(spark):
    sent, latest, state = (fresh_path(spark, n) for n in ("sent", "latest", "state"))

    def run():
        schema = history(spark, [1]).schema
        stream = ingest.decode_stream(ingest.read_message_files(spark, sent), schema)
        ingest.land_latest(stream.select("id"), latest, state).awaitTermination()
        return rows_of(read_published(spark, latest))

    send(spark, messages.account_messages(history(spark, [1, 2])), sent)
    assert run() == Counter({(1,): 1, (2,): 1})
    send(spark, messages.account_messages(history(spark, [3])), sent)
    assert run() == Counter({(3,): 1})


def test_rescoring_follows_the_whole_history(spark):
    sent, posts, found, state = (fresh_path(spark, n) for n in ("sent", "posts", "found", "state"))
    batches = [
        history(spark, [1, 2]).union(history(spark, [50], "b")),
        history(spark, [3, 40]),
        history(spark, [90], "c"),
    ]
    schema, seen = batches[0].schema, None
    for batch in batches:
        send(spark, messages.account_messages(batch), sent)
        stream = ingest.decode_stream(ingest.read_message_files(spark, sent), schema)
        ingest.rescore_accounts(
            stream.drop("timestamp"), posts, found, state
        ).awaitTermination()
        seen = batch if seen is None else seen.union(batch)
        direct = signals.account_signals(signals.view_inflation(signals.posting_gaps(seen)))
        assert rows_of(ingest.current_signals(spark, found)) == rows_of(direct)


def test_stream_job_flattens_kept_records(spark):
    sent, landed, state = (fresh_path(spark, n) for n in ("sent", "landed", "state"))

    def single(id, conversation):
        return {"id": id, "original_tweet": {"conversation_id_str": conversation, "lang": "en"}}

    rows = [
        single("1", "c1"), {"all_tweets_id": ["5", "6"], "tweets": [single("5", "c5"), single("6", "c5")]},
        single("9", None), single("8", None), single("8", None),
    ]
    record = F.to_json(F.array(F.struct(*RECORD.names)))
    df = spark.createDataFrame(rows, RECORD).select(F.lit(None).cast("binary").alias("key"), F.encode(record, "UTF-8").alias("value"))
    send(spark, df, sent)
    jobs.stream_job(ingest.read_message_files(spark, sent), landed, state).awaitTermination()
    assert Counter(row["id"] for row in spark.read.parquet(landed).collect()) == Counter(["1", "5", "6", "8", "9"])
