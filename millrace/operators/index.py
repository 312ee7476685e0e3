"""Dense row numbers 0, 1, 2, ... without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.storage import reliable_copy

_IN_PARTITION = (1 << 33) - 1


def row_index(
    df: DataFrame, order_by: Sequence[str | Column] = (), name: str = "index"
) -> DataFrame:
    """Append a dense row number as the last column.

    Without ``order_by`` rows are numbered in partition order. With it they are
    range-partitioned and sorted by the keys; the incoming position breaks ties
    and so also splits one hot key over many partitions.

    The rows are written once to reliable storage first, because counting and
    numbering must see the same partitions even if an executor is lost. What
    reaches the driver is one count per partition.
    """
    if order_by:
        arrival = F.monotonically_increasing_id()
        df = df.withColumn("_arrival", arrival)
        df = df.repartitionByRange(*order_by, "_arrival").sortWithinPartitions(*order_by, "_arrival")
        df = df.drop("_arrival")
    fixed = reliable_copy(df)
    position = F.monotonically_increasing_id()
    numbered = fixed.select(
        "*",
        F.shiftright(position, 33).cast("int").alias("_part"),
        position.bitwiseAND(F.lit(_IN_PARTITION)).alias("_position"),
    )
    counts = sorted((r["_part"], r["count"]) for r in numbered.groupBy("_part").count().collect())
    before = [0, *accumulate(rows for _, rows in counts)]
    offsets = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(counts, before)], "_part int not null, _offset long not null"
    )
    return (
        numbered.join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_position"))
        .drop("_part", "_position", "_offset")
    )
