"""Incremental extraction: watermarks, windows, filtered reads, resampling."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalar import ts_lit

LOOK_BACK_DAYS = 3
# The units of interval codes.
_UNITS = {"m": "minutes", "h": "hours", "d": "days"}


def watermark(df: DataFrame, column: str) -> Any:
    """The highest value of a column; the only value that comes to the driver."""
    return df.agg(F.max(column).alias("value")).first()["value"]


def watermarks(df: DataFrame, keys: Sequence[str], column: Column | str) -> DataFrame:
    """The highest value per key (combined before the shuffle)."""
    return df.groupBy(*keys).agg(F.max(column).alias("value"))


def record_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("value"))


def window_plan(plan: DataFrame, as_of: datetime, look_back_days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Start and end of the next pull for every row of a load plan.

    Needs ``action`` (of ``load.load_plan``) and ``watermark``. A new, empty or fully
    refreshed table starts ``look_back_days`` ago, any other at its watermark.
    """
    now = ts_lit(as_of)
    back = now - F.make_dt_interval(days=F.lit(look_back_days))
    start = F.when(F.col("action") == "merge", F.coalesce("watermark", back)).otherwise(back)
    return plan.withColumns({"window_start": start, "window_end": now})


def incremental(
    df: DataFrame, column: Column | str, start: Any, end: Any = None, keep_null: bool = False
) -> DataFrame:
    """Rows with ``start <= column < end``; bounds on a plain column reach the Parquet scan.

    ``keep_null`` keeps rows whose value is missing or cannot be read.
    """
    value = F.col(column) if isinstance(column, str) else column

    def bound(value: Any) -> Column:
        return ts_lit(value) if isinstance(value, datetime) else F.lit(value)

    inside = value >= bound(start)
    if end is not None:
        inside &= value < bound(end)
    return df.filter(value.isNull() | inside if keep_null else inside)


def interval_width(code: str | None) -> str:
    """``h1`` -> ``1 hours``: the interval codes of the configuration are a unit and a number."""
    found = re.fullmatch(r"([mhd])([1-9]\d*)", (code or "").strip().lower())
    if found is None:
        raise ValueError(f"unknown interval {code!r}: one of m, h, d and a number")
    return f"{found.group(2)} {_UNITS[found.group(1)]}"


def observed(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, tie_break: str, width: str = "1 hour"
) -> DataFrame:
    """The state of every ``width`` bucket: its last observation (``observed_at``,
    ``observed_id``, the value) and how many there were.

    States of parts of a bucket can be joined (:func:`joined_states`) to that of the whole.
    Rows without a time belong to no bucket. A key that is NULL is an error, as a merge
    would not find it again.
    """
    last = F.struct(ts, tie_break)
    named = [F.when(F.col(k).isNotNull(), F.col(k)).otherwise(F.raise_error(F.lit(f"NULL in the series key {k}")).cast(df.schema[k].dataType)).alias(k) for k in keys]
    rest = [c for c in dict.fromkeys((ts, value, tie_break)) if c not in keys]
    return (
        df.filter(F.col(ts).isNotNull())
        .select(*named, *rest)
        .groupBy(*keys, F.window(ts, width).alias("w"))
        .agg(F.max_by(value, last).alias(value), F.max(last).alias("_last"), F.count(F.lit(1)).alias("observations"))
        .select(
            *keys, F.col("w.start").alias("bucket"), F.col(f"_last.{ts}").alias("observed_at"),
            F.col(f"_last.{tie_break}").alias("observed_id"), value, "observations",
        )
    )


def joined_states(held: DataFrame, new: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The states of :func:`observed` over the observations of both frames."""
    last = F.struct("observed_at", "observed_id")
    both = new.unionByName(held.select(*new.columns))
    return (
        both.groupBy(*keys, "bucket")
        .agg(F.max_by(value, last).alias(value), F.max(last).alias("_last"), F.sum("observations").alias("observations"))
        .select(
            *keys, "bucket", F.col("_last.observed_at").alias("observed_at"),
            F.col("_last.observed_id").alias("observed_id"), value, "observations",
        )
    )


def resample(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, tie_break: str, width: str = "1 hour"
) -> DataFrame:
    """The last value of every ``width`` bucket; ``tie_break`` decides equal times.

    The buffer is one value per group and map task, so a busy key is reduced
    before it is shuffled.
    """
    return (
        df.groupBy(*keys, F.window(ts, width).alias("w"))
        .agg(
            F.max_by(value, F.struct(ts, tie_break)).alias(value),
            F.count(F.lit(1)).alias("observations"),
        )
        .select(*keys, F.col("w.start").alias("bucket"), value, "observations")
    )
