"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 64


def _value_bytes(df: DataFrame, field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(field.dataType, (T.StructType, T.MapType, T.ArrayType)):
        # JSON text spells out names and digits, so it bounds the binary form.
        as_json = F.octet_length(F.to_json(F.struct(col)))
        return F.lit(32) + 8 * F.coalesce(as_json, F.lit(0))
    return F.lit(16)


def row_bytes(df: DataFrame) -> Column:
    """Upper bound of what a row of ``df`` takes in memory."""
    return sum((_value_bytes(df, f).cast("bigint") for f in df.schema.fields), F.lit(_ROW_OVERHEAD))


def measured_bytes(df: DataFrame) -> int:
    """Upper bound of the in-memory size: noted when the table was written, else from one
    aggregate over the rows."""
    noted = getattr(df, "_tidemark_bytes", None)
    if noted is not None:
        return noted
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("n")).first()["n"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``(df with a broadcast hint, True)`` when it measures at most ``limit`` bytes.

    Otherwise the frame comes back as it was, and the join shuffles.
    """
    small = measured_bytes(df) <= limit
    return (F.broadcast(df) if small else df), small
