"""The datatype vocabulary of the column metadata and its safe casts."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

# Metadata datatype names and the Spark types they stand for.
DATATYPES: dict[str, T.DataType] = {
    "INT64": T.LongType(),
    "BIGINT": T.LongType(),
    "SERIAL": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT8": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "STRING": T.StringType(),
    "VARCHAR": T.StringType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "DATE": T.DateType(),
}

_PLAIN = {
    t.simpleString(): t
    for t in (T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampNTZType(), T.DateType())
}

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
#: A decimal number, with an exponent if any, or one of the words for infinity and no number.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"
#: A whole date, a time of day if any, and no zone.
_MOMENT = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ Tt]\d{1,2}(:\d{1,2}(:\d{1,2}(\.\d+)?)?)?)?\s*$"
_NESTED = (T.StructType, T.MapType, T.ArrayType)


def spark_type(datatype: str) -> T.DataType:
    """``"VARCHAR(50)"`` -> ``StringType()``; unknown names are an error."""
    name = re.sub(r"\(.*\)$", "", datatype.strip()).strip().upper()
    if name not in DATATYPES:
        raise ValueError(f"unknown datatype in column metadata: {datatype!r}")
    return DATATYPES[name]


def struct_of(columns: str) -> T.StructType:
    """``"a bigint, b string"`` -> a schema; unlike Spark's parser it needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _PLAIN[kind]) for name, kind in pairs])


def safe_cast(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that turns a value it cannot convert into NULL and keeps the row.

    Follows the warehouse's ``SAFE_CAST`` where Spark's ``try_cast`` differs:
    fractions round half away from zero on their way to an integer, ``0x`` text is
    an integer, only the words true and false are booleans, a fraction is a decimal number
    (``1d`` and ``0x1p3`` are none), a time needs a whole date and has no zone, and a nested
    value becomes its JSON text.
    """
    if source == target:
        return col
    if isinstance(target, T.StringType) and isinstance(source, _NESTED):
        return F.to_json(col)
    if isinstance(target, _INTEGRAL):
        if isinstance(source, _FRACTIONAL):
            return F.round(col).try_cast(target)
        if isinstance(source, T.StringType):
            return F.when(col.rlike(r"^[+-]?0[xX][0-9a-fA-F]{1,16}$"), _hex_to_long(col)).otherwise(
                col.try_cast(target)
            )
    if isinstance(target, T.BooleanType) and isinstance(source, T.StringType):
        word = F.lower(col)
        return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))
    if isinstance(source, T.StringType):
        if isinstance(target, _FRACTIONAL):
            return F.when(col.rlike(_NUMBER), col.try_cast(target))
        if isinstance(target, (T.DateType, T.TimestampNTZType)):
            return F.when(col.rlike(_MOMENT), col.try_cast(target))
    return col.try_cast(target)


def _hex_to_long(col: Column) -> Column:
    digits = F.regexp_extract(col, r"0[xX]([0-9a-fA-F]+)$", 1)
    value = F.conv(digits, 16, 10).try_cast("decimal(20,0)")
    return F.when(col.startswith("-"), -value).otherwise(value).try_cast("bigint")
