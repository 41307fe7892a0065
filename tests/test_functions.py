from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from sparrowscope.functions import (
    epoch_to_timestamp,
    first_element,
    join_array_text,
    parse_epoch,
    safe_ratio,
    sentinel_to_number,
)


def values(spark, ddl, data, column):
    return [row[0] for row in spark.createDataFrame(data, ddl).select(column).collect()]


def test_safe_ratio(spark):
    data = [(1, 2), (1, 0), (None, 2), (1, None)]
    ratio = safe_ratio(F.col("a"), F.col("b"))
    assert values(spark, "a bigint, b bigint", data, ratio) == [0.5, 0.0, None, 0.0]


def test_sentinel_to_number(spark):
    data = [("12",), ("Unavailable",), ("x",), ("9223372036854775808",), (None,), ("-3",)]
    found = values(spark, "v string", data, sentinel_to_number(F.col("v")))
    assert found == [12, 0, None, None, None, -3]
    assert values(spark, "v bigint", [(7,)], sentinel_to_number(F.col("v"))) == [7]


def test_parse_epoch(spark):
    data = [
        ("Mon Jan 01 00:00:07 +0000 2024",),
        ("Sun Nov 05 02:30:00 -0400 2023",),
        ("2024-01-01T00:00:07.900Z",),
        ("2024-01-01 02:00:07+02:00",),
        ("1969-12-31T23:59:59.500Z",),
        ("yesterday",),
        (None,),
    ]
    found = values(spark, "v string", data, parse_epoch(F.col("v")))
    assert found == [1704067207, 1699165800, 1704067207, 1704067207, -1, None, None]


def test_epoch_to_timestamp_in_a_repeated_hour(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moment = epoch_to_timestamp(F.col("v"))
        back = values(spark, "v bigint", [(1699165800,), (1699162200,)], F.unix_seconds(moment))
        assert back == [1699165800, 1699162200]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    plain = epoch_to_timestamp(F.col("v")).cast("timestamp_ntz")
    assert values(spark, "v bigint", [(0,)], plain) == [datetime.datetime(1970, 1, 1)]


def test_join_array_text(spark):
    data = [([("a",), ("b",)],), ([],), (None,), ([("x",)],)]
    found = values(
        spark, "tags array<struct<text: string>>", data, join_array_text(F.col("tags"))
    )
    assert found == ["a, b", "", None, "x"]


def test_first_element(spark):
    data = [(["p", "q"],), ([],), (None,)]
    assert values(spark, "a array<string>", data, first_element(F.col("a"))) == ["p", None, None]
