"""Array files in ranges against the reader that takes them whole."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowscope.schemas import struct
from sparrowscope.sources.arrays import read_array_records
from sparrowscope.sources.batch import POSITION, read_records

from helpers import executed_plan_of

INNER = struct(b=T.StringType(), c=T.ArrayType(T.LongType()))
SCHEMA = struct(id=T.LongType(), text=T.StringType(), a=INNER)

TEXTS = [
    "plain", "}", "{[", '"', '\\"', "\\", "\\\\", '\\\\"}', "]},{", "é日本語\U0001f600", "", None, "\t\n", "},{\"id\": 7}",
    "a" * 300, "\\u0022", "[]{}" * 50,
]


@pytest.fixture
def ranges(spark):
    """Ranges of the given number of bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def cut(size):
        for name, value in zip(names, (size, 0)):
            spark.conf.set(name, str(value))

    yield cut
    for name, value in before.items():
        spark.conf.set(name, value)


def rows_of(df):
    return Counter(repr(tuple(row)) for row in df.select("id", "text", "a").collect())


def documents(count, seed=1):
    choose = random.Random(seed)
    return [
        {"id": i, "text": choose.choice(TEXTS), "a": choose.choice([None, {"b": choose.choice(TEXTS), "c": [1, i]}, {"b": "x", "c": []}])}
        for i in range(count)
    ]


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


FORMS = {
    "one line": lambda d: json.dumps(d),
    "indented": lambda d: json.dumps(d, indent=2, ensure_ascii=False),
    "dense": lambda d: json.dumps(d, separators=(",", ":"), ensure_ascii=False),
    "crlf and mark": lambda d: "﻿" + json.dumps(d, indent=1).replace("\n", "\r\n") + "\r\n",
    "control characters": lambda d: json.dumps(d, ensure_ascii=False).replace("\\t", "\t").replace("\\n", "\n").replace("plain", "pl\x01ain"),
}


@pytest.mark.parametrize("form", FORMS)
def test_equals_the_whole_file_reader(spark, tmp_path, ranges, form):
    path = write(tmp_path / "data", "a.json", FORMS[form](documents(120)))
    write(tmp_path / "data", "b.json", FORMS[form](documents(7, 2)))
    write(tmp_path / "data", "empty.json", FORMS[form]([]))
    expected = rows_of(read_records(spark, path, SCHEMA))
    assert sum(expected.values()) == 127
    for size, chunk in ((1 << 20, 1 << 20), (997, 1 << 20), (64, 10), (1 << 20, 1), (300, 100)):
        ranges(size)
        assert rows_of(read_array_records(spark, path, SCHEMA, chunk_bytes=chunk)) == expected, (size, chunk)


def test_one_file_gives_many_tasks(spark, tmp_path, ranges):
    path = write(tmp_path / "data", "a.json", json.dumps(documents(400)))
    ranges(4096)
    size = (tmp_path / "data" / "a.json").stat().st_size
    found = read_array_records(spark, path, SCHEMA, position=True)
    blocks = {row[0] for row in found.select(POSITION[1]).distinct().collect()}
    assert len(blocks) >= size // 4096 > 5
    assert found.rdd.getNumPartitions() >= size // 4096
    ordered = [row["id"] for row in found.orderBy(*POSITION).collect()]
    assert ordered == list(range(400))


def test_objects_without_an_array(spark, tmp_path, ranges):
    rows = documents(20)
    path = write(tmp_path / "data", "a.json", "\n".join(json.dumps(r) for r in rows) + "\n")
    ranges(200)
    assert rows_of(read_array_records(spark, path, SCHEMA)) == rows_of(read_records(spark, path, SCHEMA, array_files=False))


def test_large_record_over_many_ranges(spark, tmp_path, ranges):
    rows = [{"id": 1, "text": "x}{" * 5000, "a": None}, {"id": 2, "text": "y", "a": {"b": "\"" * 4000, "c": list(range(500))}}]
    path = write(tmp_path / "data", "a.json", json.dumps(rows))
    ranges(512)
    assert rows_of(read_array_records(spark, path, SCHEMA, chunk_bytes=64)) == rows_of(read_records(spark, path, SCHEMA))


WHOLE = json.dumps(documents(30))
BROKEN = {
    "cut in a string": WHOLE[: WHOLE.index('"id": 20') + 30],
    "cut after a record": WHOLE[: WHOLE.index(', {"id": 20')],
    "cut in a record": WHOLE[: WHOLE.index('{"id": 20') + 9],
    "bracket too many": WHOLE + "]",
    "no end": WHOLE[:-1],
    "open string": WHOLE.replace('{"id": 20,', '{"id": 20, "z": "q,', 1),
}
WRONG = {
    "text between": WHOLE.replace(', {"id": 20', ', oops {"id": 20', 1),
    "number": WHOLE.replace(', {"id": 20', ', 5, {"id": 20', 1),
    "no comma": WHOLE.replace(', {"id": 20', ' {"id": 20', 1),
    "last comma": WHOLE[:-1] + ",]",
    "no JSON": WHOLE.replace('"id": 20', '"id": oops', 1),
    "scalars": "[1, 2]",
}


@pytest.mark.parametrize("case", [*BROKEN, *WRONG])
def test_errors_fail(spark, tmp_path, ranges, case):
    path = write(tmp_path / "data", "a.json", (BROKEN | WRONG)[case])
    ranges(256)
    with pytest.raises((ValueError, PySparkException, Py4JJavaError)):
        read_array_records(spark, path, SCHEMA, chunk_bytes=50).collect()


@pytest.mark.parametrize("case", ["cut in a string", "cut after a record", "cut in a record", *WRONG])
def test_errors_are_marked(spark, tmp_path, ranges, case):
    path = write(tmp_path / "data", "a.json", (BROKEN | WRONG)[case])
    ranges(256)
    rows = read_array_records(spark, path, SCHEMA, on_error="mark", chunk_bytes=50).collect()
    bad = [r["_corrupt"] for r in rows if r["_corrupt"] is not None]
    good = {r["id"]: r["text"] for r in rows if r["_corrupt"] is None}
    assert len(bad) == 1
    expected = {r["id"]: r["text"] for r in documents(30)}
    assert all(expected[i] == text for i, text in good.items())
    assert len(good) >= (0 if case == "scalars" else 19)


def test_no_text_is_brought_together_but_edges(spark, tmp_path, ranges):
    """Records inside a chunk come straight from its task."""
    path = write(tmp_path / "data", "a.json", json.dumps(documents(50)))
    ranges(1024)
    found = read_array_records(spark, path, SCHEMA).select(F.col("id"))
    plan = executed_plan_of(found)
    assert "Union" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
