"""Split of one over-wide text column into fixed-width columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import REST
from millrace.functions.paths import quote


def split_wide(
    df: DataFrame,
    column: str,
    capacity: int,
    names: Sequence[str],
    layout: str = "contiguous",
    rest: str | None = REST,
) -> DataFrame:
    """Replace a text column by chunks of ``capacity - 1`` characters.

    ``contiguous`` chunks join up to the text again. ``strided`` starts chunk
    ``s >= 1`` at character ``capacity * s``, which skips one character at every
    boundary after the second chunk; tables written that way need it. Text past
    the last chunk goes to the column ``rest``; only ``rest=None`` drops it, for
    tables that were written so. Chunks past the end are empty text, chunks of
    null are null.
    """
    if capacity < 2:
        raise ValueError("a capacity below 2 leaves no room for text")
    new = [*names] if rest is None else [*names, rest.format(column=column)]
    if column in new or len(set(new)) < len(new):
        raise ValueError(f"chunks must have names of their own: {new}")
    width, text = capacity - 1, F.col(quote(column))
    if layout == "strided":
        starts = [max(1, capacity * s) for s in range(len(names))]
    else:
        starts = [1 + width * s for s in range(len(names))]
    chunks = [
        F.substring(text, start, width).alias(name) for start, name in zip(starts, names)
    ]
    if rest is not None:
        chunks.append(F.substring(text, starts[-1] + width, 2**31 - 1).alias(new[-1]))
    return df.select("*", *chunks).drop(column)
