"""Time scalars: day keys, zone shifts and ISO text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the ISO text clean-up.
ISO_OFFSET = "-[0-9]+:[0-9]+"
ISO_SEPARATOR = "T"


def day_key(column: Column) -> Column:
    """``yyyymmdd`` as an int, in the session time zone."""
    return F.date_format(column, "yyyyMMdd").cast("int")


def shift_zone(column: Column, time_zone: str) -> Column:
    """Wall clock of ``time_zone`` for a UTC timestamp."""
    return F.from_utc_timestamp(column, time_zone)


def normalise_iso_text(column: Column) -> Column:
    """Drop a negative zone offset and replace the ``T`` by a blank."""
    return F.regexp_replace(F.regexp_replace(column, ISO_OFFSET, ""), ISO_SEPARATOR, " ")
