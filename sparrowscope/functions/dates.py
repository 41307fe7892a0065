"""Date expressions; the session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: date shape of raw records, after the weekday has been cut off
# (Spark formats weekdays but does not parse them).
RAW_DATE_FORMAT = "MMM dd HH:mm:ss Z yyyy"
WEEKDAY_LENGTH = 4


def parse_epoch(text: Column) -> Column:
    """Whole epoch seconds, floored, from ``EEE MMM dd HH:mm:ss Z yyyy`` or an
    ISO date. Text in neither shape gives null."""
    raw = F.try_to_timestamp(
        F.substring(text, WEEKDAY_LENGTH + 1, 64), F.lit(RAW_DATE_FORMAT)
    )
    return F.unix_seconds(F.coalesce(raw, text.try_cast("timestamp")))


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to timestamp, without a detour over local date strings."""
    return F.timestamp_seconds(seconds)
