"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import word_count, written

#: Weights of the sources in code point order, repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: A document is taken this many times at most.
EPOCHS = 3


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``weight`` and ``target`` to (source, source_size), one row per source.

    The budget, all sizes together, is shared by weight; no target exceeds
    ``epochs`` times its source's size and the excess goes to the others by
    weight. The sources that end at their limit are those whose limit per
    weight lies below the water level, so one pass over the sources in that
    order finds the level. This table has one row per source and is sorted in
    one task.
    """
    ranked = sizes.withColumn(
        "rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int")))
    limit = F.col("source_size") * epochs
    order = W.orderBy((limit / F.col("weight")).asc(), "rank")
    before, onwards = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    level = (
        F.sum("source_size").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        - F.coalesce(F.sum(limit).over(before), F.lit(0))
    ) / F.sum("weight").over(onwards)
    filled = ranked.withColumn("level", level).withColumn(
        "open", F.when(F.col("level") <= limit / F.col("weight"), F.col("level"))
    )
    # the first source in that order whose limit is not below the level sets it for all after it
    water = F.first("open", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return filled.select(
        "source", "source_size", "rank", "weight", F.least(limit.cast("double"), F.coalesce(water * F.col("weight"), limit)).alias("target")
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = "0",
) -> DataFrame:
    """How many words of each document a mix takes, one row per row of ``docs``.

    Each source queues its documents in an order shuffled by the md5 of seed
    and id, over and over up to ``epochs`` times. The entry of a document has
    the virtual finish time (words its source has queued up to its end) /
    (target of its source). Entries of all sources are taken in the order of
    their finish times until the next would exceed the budget, the number of
    words in all documents; documents are taken whole.

    Running sums never pass through one task: a source's queue is cut into
    about as many buckets as the square root of the number of documents, each
    summed by itself and moved by the sums of the buckets before it. The global
    order is cut into as many ranges of finish times, which hold about equal
    numbers of words whatever the sources; only the range in which the budget
    ends is sorted.

    Returns ``doc_id, source, size, source_size, target, taken``. Null text has
    size 0 and is never taken; a null source is a source of its own, the last
    one; null ids and repeated rows queue like others, equal rows being
    interchangeable. An empty table gives no rows. The result depends on the
    rows alone, not on their order or partitions.
    """
    sized = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("shuffled"),
        ),
        "sizes",
    )
    count, budget = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(1, round(count**0.5))
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(by_source, weights, epochs), "targets")

    # running sum of each source's words, in shuffled order
    bucket = F.floor(F.conv(F.substring("shuffled", 1, 8), 16, 10).cast("long") * parts / (1 << 32))
    queued = sized.withColumn("bucket", bucket.cast("long"))
    inner = W.partitionBy("source", "bucket").orderBy("shuffled", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    queued = queued.withColumn("within", F.sum("size").over(inner))
    sums = queued.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    outer = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = written(
        sums.select("source", "bucket", F.coalesce(F.sum("words").over(outer), F.lit(0)).alias("earlier")), "buckets"
    )
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    queued = queued.join(sums, same(queued, sums) & (queued["bucket"] == sums["bucket"])).select(
        queued["doc_id"], queued["source"], "shuffled", "size", (F.col("earlier") + F.col("within")).alias("upto")
    )
    queued = written(
        queued.join(targets, same(queued, targets)).select(
            "doc_id", queued["source"], "shuffled", "size", "source_size", "rank", "target", "upto"
        ),
        "queue",
    )

    # finish times of every pass, and the place in their order where the budget ends
    passes = queued.where("size > 0 and target > 0").select(
        "*", F.explode_outer(F.array(*[F.lit(n).cast("long") for n in range(epochs)])).alias("epoch")
    ).withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("upto")) / F.col("target"))
    ranges = passes.withColumn("range", F.floor(F.col("finish") * parts))
    running = W.orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    crossed = (
        ranges.groupBy("range").agg(F.sum("size").alias("words"))
        .withColumn("total", F.sum("words").over(running))
        .where(F.col("total") > budget).orderBy("range").select("range", F.col("total") - F.col("words")).first()
    )
    place = ["finish", "rank", "shuffled", "doc_id", "size", "epoch"]
    end = None
    if crossed:
        last, before = crossed
        order = W.orderBy(*[F.col(c).asc_nulls_first() for c in place])
        end = (
            ranges.where(F.col("range") == last)
            .withColumn("total", F.lit(before) + F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)))
            .where(F.col("total") > budget).orderBy(*[F.col(c).asc_nulls_first() for c in place]).select(*place).first()
        )

    def taken_in(epoch: int):
        """Whether the document's entry of this pass comes before the first one left out."""
        if end is None:
            return F.lit(True)
        finish = (F.lit(epoch).cast("long") * F.col("source_size") + F.col("upto")) / F.col("target")
        values = {"finish": finish, "epoch": F.lit(epoch)}
        taken, tie = F.lit(False), F.lit(True)
        for c in place:
            mine, theirs = values.get(c, F.col(c)), F.lit(end[c])
            less = mine.isNull() & theirs.isNotNull() if end[c] is None else mine.isNull() | (mine < theirs)
            taken, tie = taken | (tie & less), tie & mine.eqNullSafe(theirs)
        return taken

    copies = sum((taken_in(n).cast("long") for n in range(epochs)), F.lit(0).cast("long"))
    return queued.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.expr("size > 0 and target > 0"), F.col("size") * copies).otherwise(0).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns as they are.

    Decisions join to rows by id, source and size. Of rows that are alike in these, those
    taken more often are the ones whose text, then hash of the other columns, comes first,
    so reruns take the same ones.
    """
    numbered = docs.toDF(*[f"col{i}" for i in range(len(docs.columns))])
    names = dict(zip(docs.columns, numbered.columns))
    key = F.struct(
        F.col(names[id_col]).alias("doc_id"),
        F.col(names[source_col]).alias("source"),
        word_count(F.col(names[text_col])).alias("size"),
    )
    # maps and variants have no hash
    plain = [f.name for f in numbered.schema if not re.search("map<|variant", f.dataType.simpleString())]
    others = F.xxhash64(F.lit(0), *[c for c in plain if c != names[text_col]])
    numbered = numbered.withColumn("key", key).withColumn(
        "n", F.row_number().over(W.partitionBy("key").orderBy(names[text_col], others))
    )
    # of each key only a few counts: how many rows are taken once or more, twice or more, ...
    times = F.col("taken") / F.col("size")
    mix = mix_sources(docs, id_col, text_col, source_col).where("taken > 0")
    taken = mix.groupBy(F.struct("doc_id", "source", "size").alias("key")).agg(
        F.array(*[F.count(F.when(times >= n, 1)) for n in range(1, EPOCHS + 1)]).alias("taken")
    )
    return (
        numbered.join(taken, "key")
        .withColumn("times", F.size(F.filter("taken", lambda count: F.col("n") <= count)))
        .where("times > 0")
        .withColumn("time", F.explode_outer(F.sequence(F.lit(1), F.col("times"))))
        .select(*[F.col(names[c]).alias(c) for c in docs.columns])
    )
