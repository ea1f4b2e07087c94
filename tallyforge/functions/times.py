"""Minute and ten-minute buckets, written as digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the format of a minute bucket.
MINUTE_FORMAT = "yyyyMMddHHmm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _floor_to_ten(digits: Column) -> Column:
    return (F.floor(digits.cast("bigint") / 10) * 10).cast("string")


def ten_minute_bucket(text: Column | str) -> Column:
    """``2024-01-01 10:17:30`` becomes ``202401011010``; NULL where there are fewer than 12 digits."""
    digits = F.substring(F.regexp_replace(_col(text), r"[\s:-]", ""), 1, 12)
    return F.when(digits.rlike(r"^[0-9]{12}$"), _floor_to_ten(digits))


def minute_before(ts: Column | str | None = None) -> Column:
    """The minute of the moment 60 seconds before ``ts`` (default: now)."""
    ts = F.current_timestamp() if ts is None else _col(ts)
    return F.date_format(ts - F.expr("INTERVAL 60 SECONDS"), MINUTE_FORMAT)


def ten_minutes_before(ts: Column | str | None = None) -> Column:
    return _floor_to_ten(minute_before(ts))


def is_zero_point(ts: Column | str | None = None) -> Column:
    """Whether the minute before is 00:00."""
    return F.substring(minute_before(ts), 9, 4) == "0000"
