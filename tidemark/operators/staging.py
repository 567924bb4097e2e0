"""Staging: one projection that renames, casts safely and stamps audit columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalar import ts_lit
from tidemark.functions.types import safe_cast
from tidemark.operators.metadata import ColumnSpec, check_specs

# The audit columns of every staging and reference table.
AUDIT_COLUMNS = ("is_deleted", "is_hard_delete", "dw_create_datetime", "dw_load_datetime")


def audit_values(load_ts: datetime) -> dict[str, Column]:
    """The audit columns of a row written at ``load_ts``."""
    at = ts_lit(load_ts)
    return dict(zip(AUDIT_COLUMNS, (F.lit(False), F.lit(False), at, at)))


def stamp(df: DataFrame, load_ts: datetime) -> DataFrame:
    """Append the audit columns, or renew them."""
    return df.withColumns(audit_values(load_ts))


def projection(df: DataFrame, specs: Sequence[ColumnSpec]) -> list[Column]:
    """The cast-and-rename expressions; source names are matched without case."""
    fields: dict[str, list] = {}
    for field in df.schema.fields:
        fields.setdefault(field.name.lower(), []).append(field)
    out = []
    for spec in check_specs(specs):
        found = fields.get(spec.source.lower(), [])
        if len(found) != 1:
            problem = "missing" if not found else "ambiguous"
            raise ValueError(f"{problem} source column {spec.source!r}")
        field = found[0]
        out.append(safe_cast(F.col(f"`{field.name}`"), field.dataType, spec.type).alias(spec.target))
    return out


def stage(df: DataFrame, specs: Sequence[ColumnSpec], load_ts: datetime) -> DataFrame:
    """Rows of the source under the declared schema; unlisted columns are dropped."""
    return stamp(df.select(*projection(df, specs)), load_ts)
