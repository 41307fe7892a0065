from __future__ import annotations

from collections import Counter

import pytest

from sparrowscope.operators import columns, messages
from sparrowscope.schemas import UNSCORED_USER_COLUMNS

from helpers import executed_plan_of, make_users, rows_of


def test_drop_columns_ignores_unknown_names(spark):
    users = make_users(spark, [{"screen_name": "a"}])
    kept = columns.drop_columns(users, [*UNSCORED_USER_COLUMNS, "no_such"])
    assert len(kept.columns) == len(users.columns) - 5


def test_prefix_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "`a` int, `following/follower` double")
    assert columns.prefix_columns(df).columns == ["user_a", "user_following_follower"]
    assert columns.prefix_columns(df, ["a"], "x_").columns == ["x_a"]


def test_union_common_columns_keeps_left_order_and_repeats(spark):
    left = spark.createDataFrame([(1, "x", 1.0)], "a int, b string, c double")
    right = spark.createDataFrame([("x", 9, 1), ("y", 9, 2)], "b string, d int, a int")
    both = columns.union_common_columns(left, right)
    assert both.columns == ["a", "b"]
    assert rows_of(both) == Counter({(1, "x"): 2, (2, "y"): 1})


@pytest.mark.parametrize("n, expected", [(0, 5), (1, 4), (2, 3), (9, 0)])
def test_skip_first_rows(spark, n, expected):
    df = spark.createDataFrame([(5,), (3,), (None,), (9,), (1,)], "id int").repartition(3)
    left = columns.skip_first_rows(df, "id", n)
    order = [None, 1, 3, 5, 9]
    assert rows_of(left) == Counter((v,) for v in order[n:])
    assert left.count() == expected


def test_skip_first_rows_takes_a_top_n(spark):
    df = columns.skip_first_rows(spark.range(100), "id", 3)
    assert "TakeOrderedAndProject" in executed_plan_of(df)


def test_filter_segment(spark):
    df = spark.createDataFrame([("project",), ("KOL",), (None,)], "verified_type string")
    assert columns.filter_segment(df).count() == 1
    assert columns.filter_segment(df, ("project", "KOL")).count() == 2


def test_fill_nulls(spark):
    df = spark.createDataFrame([(None, None, None)], "verified_type string, b string, c int")
    assert columns.fill_null_label(df).first()[:] == ("none", None, None)
    assert columns.fill_null_strings(df).first()[:] == ("none", "none", None)


NESTED = "id int, a struct<b: struct<c: string, d: bigint>>"


def test_extract_paths(spark):
    df = spark.createDataFrame([(1, (("x", 5),)), (2, (None,)), (3, None)], NESTED)
    flat = columns.extract_paths(df, ["a.b.c", "a.b.d", "a.nowhere.e"], keep=["id"])
    assert flat.columns == ["id", "c", "d", "e"]
    assert rows_of(flat, "id", "c", "d", "e") == Counter(
        {(1, "x", 5, None): 1, (2, None, None, None): 1, (3, None, None, None): 1}
    )


def test_extract_paths_strict(spark):
    df = spark.createDataFrame([(1, (("x", 5),)), (2, (None,))], NESTED)
    with pytest.raises(ValueError):
        columns.extract_paths(df, ["a.z"], strict=True)
    strict = columns.extract_paths(df, ["a.b.c"], keep=["id"], strict=True)
    assert strict.filter("id = 1").first()["c"] == "x"
    with pytest.raises(Exception, match="no value at path: a.b.c"):
        strict.collect()


def test_optional_field(spark):
    df = spark.createDataFrame([(1, (("x", 5),)), (2, (None,))], NESTED)
    found = df.select(
        columns.optional_field("a.b.c", df.schema, "none"),
        columns.optional_field("a.b.gone", df.schema),
    )
    assert rows_of(found, "c", "gone") == Counter({("x", None): 1, ("none", None): 1})


def test_extract_json_paths(spark):
    data = [(1, '{"a": {"b": "x", "n": 3}, "k": 7}'), (2, '{"k": null}'), (3, "not json")]
    df = spark.createDataFrame(data, "id int, props string")
    flat = columns.extract_json_paths(df, "props", ["a.b", "a.n", "k"], keep=["id"])
    assert rows_of(flat, "id", "b", "n", "k") == Counter(
        {(1, "x", "3", "7"): 1, (2, None, None, None): 1, (3, None, None, None): 1}
    )


def test_json_roundtrip_keeps_nulls_and_nesting(spark):
    df = spark.createDataFrame(
        [(1, None, [("a",)]), (None, "é", [])], "n int, s string, t array<struct<text: string>>"
    )
    assert messages.json_roundtrip(df).collect() == df.collect()


def test_documents_keep_null_fields(spark):
    df = spark.createDataFrame([("a", None, 0.5)], "id string, x int, `v/l` double")
    documents = messages.index_documents(df, ["x", "v/l"], "id")
    assert documents.first()[:] == ("a", '{"x":null,"v/l":0.5}')
    assert messages.bulk_lines(documents, "posts").first()["value"] == (
        '{"index":{"_index":"posts"}}\n{"x":null,"v/l":0.5}'
    )
    assert messages.decode_documents(documents, df.drop("id").schema).first()[:] == ("a", None, 0.5)
