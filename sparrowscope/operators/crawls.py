"""First-wins de-duplication over crawls that arrive one after the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.keystore import KeyStore
from ..sources.shared import stored
from .dedup import conversation_key, first_per_key, record_posts


def _new(records: DataFrame, store: KeyStore, crawl: str, key, order_by: Sequence[str]) -> DataFrame:
    """First record of every key that no other crawl has; and the store knows them. Null
    is no key here."""
    keyed = records.withColumn("_key", key.cast("string")).filter("_key IS NOT NULL")
    first = stored(first_per_key(keyed, "_key", order_by))
    seen = store.seen(first, "_key", but=crawl).withColumnRenamed("key", "_key")
    kept = stored(first.join(seen, "_key", "left_anti"))
    store.record(kept, crawl, "_key")
    return kept.drop("_key")


def new_per_key(
    records: DataFrame, store: KeyStore, crawl: str, key: str, order_by: Sequence[str]
) -> DataFrame:
    """Records of a crawl that bring a key for the first time, the first of each in the
    given order. Over successive crawls this keeps what ``first_per_key`` keeps of their
    union ordered by crawl; earlier records are not read again. Rows without a key are
    left out. A crawl that is run again under its name gives the same rows, under another
    name none."""
    return _new(records, store, crawl, F.col(key), order_by)


def new_conversations(
    records: DataFrame, store: KeyStore, crawl: str, order_by: Sequence[str], **columns: str
) -> DataFrame:
    """Posts of the conversations that a crawl brings for the first time, by the rule of
    ``dedup_conversations``: the first record of each, threads flattened. Records without
    a key all stay."""
    key = conversation_key(**columns)
    kept = _new(records, store, crawl, key, order_by)
    kept = kept.unionByName(records.filter(key.isNull()))
    return record_posts(kept)
