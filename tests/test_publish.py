"""Published versions: readers between any two steps, repeats, failures."""

from __future__ import annotations

import pytest

from sparrowscope.sources import publish as module
from sparrowscope.sources.publish import publish, published_batches, read_published
from sparrowscope.sources.shared import fresh_path


@pytest.fixture
def path(spark):
    return fresh_path(spark, "published")


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int").repartition(2)


def read(spark, path, batch=None):
    return sorted(r["n"] for r in read_published(spark, path, batch).collect())


def test_a_reader_sees_whole_versions_between_all_steps(spark, path, monkeypatch):
    publish(numbers(spark, 1, 2), path, 0)
    seen = []
    for step in ("write", "exists", "rename", "remove"):
        original = getattr(module._Files, step)

        def watched(self, *args, original=original):
            seen.append(read(spark, path))
            out = original(self, *args)
            seen.append(read(spark, path))
            return out

        monkeypatch.setattr(module._Files, step, watched)

    def write(df, target):
        for part in (df.filter("n < 4"), df.filter("n >= 4")):
            part.write.mode("append").parquet(target)
            seen.append(read(spark, path))

    assert publish(numbers(spark, 3, 4, 5), path, 1, write=write)
    assert {tuple(s) for s in seen} == {(1, 2), (3, 4, 5)}
    assert seen.index([3, 4, 5]) == len(seen) - seen[::-1].index([1, 2])
    assert read(spark, path) == [3, 4, 5]


def test_a_repeated_batch_changes_nothing(spark, path):
    assert publish(numbers(spark, 1), path, 7)
    files = module._Files(spark, path)
    before = files.names("_versions"), files.names("_manifests")
    assert not publish(numbers(spark, 2), path, 7)
    assert (files.names("_versions"), files.names("_manifests")) == before
    assert read(spark, path) == [1]


@pytest.mark.parametrize("step", ["write", "rename"])
def test_a_failure_leaves_the_last_version_and_a_repeat_mends_it(spark, path, monkeypatch, step):
    publish(numbers(spark, 1), path, 1)
    with monkeypatch.context() as broken:
        broken.setattr(module._Files, step, lambda self, *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish(numbers(spark, 2), path, 2)
        assert read(spark, path) == [1]
    assert publish(numbers(spark, 2), path, 2)
    assert read(spark, path) == [2]


def test_a_slower_attempt_loses(spark, path):
    """Another writer publishes the batch while this one writes its rows."""

    def write(df, target):
        df.write.parquet(target)
        publish(numbers(spark, 1), path, 1)

    assert not publish(numbers(spark, 2), path, 1, write=write)
    assert read(spark, path) == [1]
    assert len(module._Files(spark, path).names("_versions")) == 1


def test_late_batches_and_old_versions(spark, path):
    for number in (1, 2, 5, 4, 9):
        assert publish(numbers(spark, number), path, number, keep=3)
    assert published_batches(spark, path) == [4, 5, 9]
    assert read(spark, path) == [9] and read(spark, path, 4) == [4]
    assert not publish(numbers(spark, 1), path, 1, keep=3)
    assert len(module._Files(spark, path).names("_versions")) == 3
    with pytest.raises(ValueError):
        read_published(spark, path, 1)


def test_nothing_published_and_empty_versions(spark, path):
    with pytest.raises(ValueError):
        read_published(spark, path)
    schema = numbers(spark).schema
    assert read_published(spark, path, schema=schema).collect() == []
    publish(numbers(spark), path, 0)
    assert read(spark, path) == []
