"""Exact dedup by content-defined chunk recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import lower_ascii, written

#: A chunk has 512 to 4096 characters and ends at the first place after the
#: 512th where the last three characters are a to f, m to z and a space; the
#: last chunk of a text takes what is left.
CHUNK = r"(?s).{512}.{0,3581}?[a-f][m-z]\s|.{4096}|.+"


def _chunk_hash(chunk: Column, bits: int) -> Column:
    return F.shiftright(F.xxhash64(chunk), 64 - bits)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64
) -> DataFrame:
    """Rows with equal texts, as one row per row of ``docs``.

    Texts are equal if identical after lower-casing A to Z. Each text is cut
    into content-defined chunks and becomes a recipe, the ordered list of its
    chunks' identifiers; equal recipes are equal texts. An identifier is the
    hash of a chunk, verified by comparing bytes: distinct chunks are gathered
    by hash *and* bytes, and if a hash stands for several chunks anywhere in
    the table, those chunks are numbered and the number joins the identifier.
    So chunks cross the network once, without repeats from one task, and
    after that only lists of identifiers do.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``: the largest id
    of the group, its rows, whether this row's id is the largest, and the
    digest of the normalised text. Null text counts as empty; empty texts are
    equal; rows that repeat an id and a text are kept or dropped together; null
    ids never win over others. An empty table gives no rows. ``hash_bits`` is
    lowered by tests only, to make hashes collide.
    """
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    chunked = docs.select(F.col(id_col).alias("doc_id"), text.alias("t")).select(
        "doc_id",
        F.regexp_extract_all("t", F.lit(CHUNK), F.lit(0)).alias("chunks"),
        F.sha2(F.col("t"), 256).alias("text_sha256"),
    )
    hashed = lambda c: _chunk_hash(c, hash_bits)
    distinct = (
        chunked.select(F.explode_outer("chunks").alias("chunk"))
        .where("chunk is not null")
        .select(hashed(F.col("chunk")).alias("h"), "chunk")
        .distinct()
    )
    shared = written(
        distinct.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "shared"
    )
    if shared.isEmpty():
        recipes = chunked.withColumn("recipe", F.transform("chunks", hashed))
    else:
        numbered = distinct.join(shared, "h", "left_semi").withColumn(
            "number", F.row_number().over(W.partitionBy("h").orderBy("chunk"))
        )
        pieces = (
            chunked.withColumn("row", F.monotonically_increasing_id())
            .select("row", "doc_id", "text_sha256", F.posexplode_outer("chunks").alias("at", "chunk"))
            .withColumn("h", hashed(F.col("chunk")))
            .join(numbered, ["h", "chunk"], "left")
        )
        item = F.struct("at", "h", F.coalesce("number", F.lit(1)).alias("number"))
        recipes = pieces.groupBy("row", "doc_id", "text_sha256").agg(
            F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), item))).alias("recipe")
        )
    recipes = written(recipes.select("doc_id", "recipe", "text_sha256"), "recipes")
    groups = written(
        recipes.groupBy("recipe").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        ),
        "groups",
    )
    return recipes.join(groups, "recipe").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
