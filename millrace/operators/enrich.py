"""Ingest time, day key and zone shifts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.config import EVENT_TIME_COLUMN, INGEST_COLUMN, PERIOD_COLUMN
from millrace.functions.paths import has_path, path_type, quote
from millrace.functions.times import day_key, shift_zone


def enrich(
    df: DataFrame,
    time_zone: str | None = None,
    clock: Column | None = None,
    ingest_column: str = INGEST_COLUMN,
    period_column: str = PERIOD_COLUMN,
    event_time_column: str = EVENT_TIME_COLUMN,
    period_source: str | None = None,
) -> DataFrame:
    """Add ingest time and day key, then shift ingest and event time.

    The day key comes from the time before the shift. ``clock`` is the ingest
    time, by default the time of the query; ``period_source`` names another
    column to take the day key from. A missing event time column is fine.
    """
    ingest = F.current_timestamp() if clock is None else clock
    day_of = ingest if period_source is None else _timestamp(df, period_source)
    added = {ingest_column: ingest, period_column: day_key(day_of)}
    if time_zone is not None:
        added[ingest_column] = shift_zone(ingest, time_zone)
        if has_path(df.schema, quote(event_time_column)):
            added[event_time_column] = shift_zone(_timestamp(df, event_time_column), time_zone)
    return df.withColumns(added)


def _timestamp(df: DataFrame, name: str) -> Column:
    """A time column; text that is no timestamp is null."""
    column, kind = F.col(quote(name)), path_type(df.schema, quote(name))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return column
    return column.try_cast("timestamp")
