"""Casts by registry type name.

Every cast gives null for a value it cannot read, whether or not the session is
in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Registry type names (matched exactly) and the slash-date format.
CAST_TYPES: dict[str, T.DataType] = {
    "String": T.StringType(),
    "Int": T.IntegerType(),
    "Bigint": T.LongType(),
    "Double": T.DoubleType(),
    "Timestamp": T.TimestampType(),
    "Timestamp_2": T.TimestampType(),
}
EXTENDED_CAST_TYPES: dict[str, T.DataType] = {
    "Integer": T.IntegerType(),
    "Date": T.DateType(),
}
SLASH_FORMAT = "yyyy/MM/dd HH:mm:ss"

# One-digit months, days or hours and any text after the seconds are accepted.
_LOOSE_SLASH_FORMAT = "yyyy/M/d H:m:s"
_SLASH_HEAD = r"^\s*([0-9]{4}/[0-9]{1,2}/[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})"
_FRACTION = r"^\s*([+-]?)([0-9]*)\.[0-9]*\s*$"


def target_type(type_name: str | None, extended: bool = False) -> T.DataType | None:
    """Spark type a registry type name casts to; ``None`` means leave as it is."""
    if type_name in CAST_TYPES:
        return CAST_TYPES[type_name]
    return EXTENDED_CAST_TYPES.get(type_name or "") if extended else None


def cast_column(
    column: Column, source: T.DataType, type_name: str | None, extended: bool = False
) -> Column:
    """Cast a column of type ``source`` by registry type name."""
    target = target_type(type_name, extended)
    if target is None or isinstance(source, T.NullType):
        return column if target is None else column.cast(target)
    if type_name == "Timestamp_2":
        return slash_timestamp(column, source)
    if type(source) is type(target):
        return column
    if isinstance(target, T.StringType):
        return column.cast(target)
    if isinstance(target, (T.IntegerType, T.LongType)) and isinstance(source, T.StringType):
        return whole_number(column, target)
    if isinstance(target, (T.TimestampType, T.DateType)) and isinstance(source, T.BooleanType):
        column = column.cast("string")
    return column.try_cast(target)


def whole_number(column: Column, target: T.DataType) -> Column:
    """Text to a whole number; a decimal fraction is cut off, not rounded."""
    without_fraction = F.when(
        column.contains("."), F.regexp_replace(column, _FRACTION, "$10$2").try_cast(target)
    )
    return F.coalesce(column.try_cast(target), without_fraction)


def slash_timestamp(column: Column, source: T.DataType) -> Column:
    """``2020/05/06 07:08:09`` text to a timestamp, cut to whole seconds."""
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.date_trunc("second", column).cast("timestamp")
    text = column.cast("string")
    strict = F.try_to_timestamp(F.substring(text, 1, 19), F.lit(SLASH_FORMAT))
    loose = F.try_to_timestamp(F.regexp_extract(text, _SLASH_HEAD, 1), F.lit(_LOOSE_SLASH_FORMAT))
    return F.coalesce(strict, loose)
