"""Load strategies: routing, full refresh and key-based upsert."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalar import ts_lit
from tidemark.functions.sizes import BROADCAST_BYTES, row_bytes
from tidemark.operators.staging import AUDIT_COLUMNS, stamp


class DuplicateSourceKey(ValueError):
    """Several source rows would update one target row."""


def load_plan(
    configs: DataFrame,
    state: DataFrame,
    keys: Sequence[str] = ("database_schema", "table_name"),
) -> DataFrame:
    """One row per table with the ``action`` its next load takes.

    ``configs`` holds ``load_type``, ``primary_key_column`` and optionally
    ``load_type_override``; ``state`` holds ``table_exists`` and whatever else is
    known about the existing tables (watermark, record count). An incremental load
    without a key and an unknown load type are rejected, also for a new table.
    """
    plan = configs.join(state, list(keys), "left")
    chosen = F.upper("load_type")
    if "load_type_override" in configs.columns:
        chosen = F.coalesce(F.upper("load_type_override"), chosen)
    exists = F.coalesce(F.col("table_exists"), F.lit(0)) > 0
    full = F.when(exists, "full_refresh").otherwise("create")
    merge = F.when(exists, "merge").otherwise("create")
    has_key = F.coalesce(F.col("primary_key_column"), F.lit("")) != ""
    action = F.when(chosen == "FULL", full).when((chosen == "INCR") & has_key, merge).otherwise("reject")
    return plan.withColumns(
        {
            "table_exists": exists.cast("int"),
            "effective_load_type": chosen,
            "action": action,
        }
    )


def route(exists: bool, load_type: str, primary_key: str | None, override: str | None = None) -> str:
    """The same decision for a single table."""
    chosen = (override or load_type).upper()
    if chosen not in ("FULL", "INCR"):
        raise ValueError(f"unknown load type {chosen!r}")
    if chosen == "INCR" and not primary_key:
        raise ValueError("an incremental load needs a primary key column")
    if not exists:
        return "create"
    return "full_refresh" if chosen == "FULL" else "merge"


def full_refresh(staged: DataFrame, load_ts: datetime) -> DataFrame:
    """The new content of a table that is created or replaced."""
    mapped = [c for c in staged.columns if c not in AUDIT_COLUMNS]
    return stamp(staged.select(*mapped), load_ts)


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, then by the other columns.

    A maximum, not a ranked window: every map task keeps one row per key, so a key
    with a third of all rows never gathers in one place.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    best = F.max(F.struct(*latest_by, *rest)).alias("_best")
    return (
        df.groupBy(*keys)
        .agg(best)
        .select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])
    )


def _check_columns(target: DataFrame, source: DataFrame) -> None:
    """A source of another shape must not be cut or widened to fit in silence."""
    have, come = (
        {c: t for c, t in df.dtypes if c not in AUDIT_COLUMNS} for df in (target, source)
    )
    if have != come:
        differ = sorted(c for c in have.keys() | come.keys() if have.get(c) != come.get(c))
        raise ValueError(f"source and target differ in {', '.join(differ)}; a full refresh changes columns")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str], load_ts: datetime, **options: Any
) -> DataFrame:
    """All rows of the target after :func:`merge_parts`."""
    kept, inserted = merge_parts(target, source, keys, load_ts, **options)
    return kept.unionByName(inserted)


def merge_parts(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    load_ts: datetime,
    on_duplicate: str = "error",
    latest_by: Sequence[str] = (),
    touch_load_ts: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    matched: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``MERGE`` as ``(rows of the target, inserted rows)``: matched target rows take the
    source's mapped columns and keep their audit columns, unmatched source rows are
    inserted with fresh ones, all other target rows stay.

    A NULL key matches nothing. Several source rows for one *matched* key are an
    error, or with ``on_duplicate="latest"`` are reduced to the newest by
    ``latest_by``.

    A source that measures at most ``broadcast_bytes`` is broadcast and the target
    never moves. A larger one is joined by shuffle; the target is then the left
    side of a left join, which adaptive execution can split at a hot key, and rows
    with a NULL key go round the join.

    ``matched`` holds, once each, the source's keys that the whole target has. With it
    ``target`` may be the part of the whole that holds them, and is not searched for keys.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    mapped = [c for c in target.columns if c not in AUDIT_COLUMNS]
    _check_columns(target, source)
    source = source.select(*mapped)
    has_key = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])

    keyed = source.filter(has_key)
    # One pass over the source: how large it is, and whether a key occurs twice.
    per_key = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(row_bytes(source)).alias("_bytes")
    )
    profile = per_key.agg(
        F.coalesce(F.max(F.when(has_key, F.col("_n"))), F.lit(0)).alias("most"),
        F.coalesce(F.sum(F.when(~has_key, F.col("_n"))), F.lit(0)).alias("keyless"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"),
    ).first()
    repeated, small = profile["most"] > 1, profile["bytes"] <= broadcast_bytes
    keyless = source.filter(~has_key) if profile["keyless"] else None
    if keyless is None:
        source = keyed
    if on_duplicate == "latest":
        if not latest_by:
            raise ValueError("on_duplicate='latest' needs latest_by")
        if repeated:
            keyed = latest_per_key(keyed, keys, latest_by)
            source = keyed if keyless is None else keyed.unionByName(keyless)
    elif on_duplicate == "error":
        if repeated:
            twice = per_key.filter(has_key & (F.col("_n") > 1)).select(*keys)
            if not twice.join(target if matched is None else matched, keys, "left_semi").isEmpty():
                raise DuplicateSourceKey(f"several source rows match one target row on {keys}")
    else:
        raise ValueError(f"unknown duplicate policy {on_duplicate!r}")

    hint = F.broadcast if small else (lambda df: df)
    update = hint(keyed.select(*[F.col(c).alias(f"_s_{c}") for c in mapped], F.lit(True).alias("_hit")))
    on = reduce(Column.__and__, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    known = target.select(*keys)

    if small:
        updated = target.join(update, on, "left")
        # Target keys that the source holds: never more than the source has.
        if matched is None:
            matched = known.join(hint(keyed.select(*keys)), keys, "left_semi").distinct()
        inserted = source.join(hint(matched), keys, "left_anti")
        rest = None
    else:
        # Hinted, as files that compress well look small enough to broadcast.
        updated = target.filter(has_key).join(update.hint("merge"), on, "left")
        held = known.filter(has_key).distinct() if matched is None else matched
        inserted = keyed.join(held.hint("merge"), keys, "left_anti").select(*mapped)
        if keyless is not None:
            inserted = inserted.unionByName(keyless)
        rest = target.filter(~has_key)

    hit = F.col("_hit").isNotNull()
    columns = {c: F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)) for c in mapped}
    if touch_load_ts:
        columns["dw_load_datetime"] = F.when(hit, ts_lit(load_ts)).otherwise(F.col("dw_load_datetime"))
    kept = updated.select(*[columns.get(c, F.col(c)).alias(c) for c in target.columns])
    if rest is not None:
        kept = kept.unionByName(rest)
    return kept, stamp(inserted.select(*mapped), load_ts)
