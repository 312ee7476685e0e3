"""Latest row per key, for targets that keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` values of every key.

    An aggregate rather than a window: each task keeps one row per key before
    the shuffle, so a hot key costs no more than any other. Make ``order_by``
    unique within a key; rows that tie are otherwise chosen freely.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in order_by])
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*keys, "_row.*").select(*df.columns)
