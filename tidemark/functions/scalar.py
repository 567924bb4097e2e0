"""Time, calendar and hashing expressions. All of them stay inside codegen.

Zone-less timestamps are read as UTC; ``session.prepare`` pins the session to it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
CALENDAR_PARTS = ("hour", "dayofweek", "dayofmonth", "month", "year")


def ts_lit(moment: datetime) -> Column:
    """A zone-less timestamp literal (constant-folded, so it reaches the scan)."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def millis(col: Column) -> Column:
    """Timestamp -> epoch milliseconds."""
    return F.unix_millis(col.cast("timestamp"))


def epoch_ms(text: Column, strict: bool = False) -> Column:
    """``2024-01-31T00:00:00Z`` -> epoch milliseconds, in UTC.

    Text of another form gives NULL, or fails the query when ``strict``.
    """
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return F.unix_millis(parse(text, F.lit(ISO_SECONDS) if not strict else ISO_SECONDS))


def epoch_to_timestamp(col: Column, per_second: int = 1000) -> Column:
    """Epoch number -> timestamp; ``per_second`` is the unit (1000 = milliseconds)."""
    if per_second == 1000:
        return F.timestamp_millis(col.cast("bigint"))
    if per_second == 1_000_000:
        return F.timestamp_micros(col.cast("bigint"))
    return F.timestamp_seconds(col.cast("double") / F.lit(float(per_second)))


def calendar(ts: Column) -> dict[str, Column]:
    """hour, dayofweek (1 = Sunday), dayofmonth, month and year of a timestamp."""
    return {
        "hour": F.hour(ts),
        "dayofweek": F.dayofweek(ts),
        "dayofmonth": F.dayofmonth(ts),
        "month": F.month(ts),
        "year": F.year(ts),
    }


def duration_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two timestamps, halves to the even minute."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.bround(micros / F.lit(6e7), 0).cast("bigint")


def hash_share(key: Column, percent: float) -> Column:
    """True for ``percent`` of all keys, chosen by a hash of the key's text.

    The same on every run and partitioning. Hex digests sort like the numbers they
    spell, so one comparison of text decides.
    """
    limit = round(percent / 100 * 2**32)
    if limit >= 2**32:
        return F.lit(True)
    return F.md5(key.cast("string")) < F.lit(f"{limit:08x}")
