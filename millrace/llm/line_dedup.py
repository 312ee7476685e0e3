"""Removal of repeated content-defined chunks of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import word_count, written

#: Factor and modulus of the rolling hash over line hashes.
FACTOR, MODULUS = 1_000_003, 1 << 32
#: A hash divisible by this ends a chunk, so chunks have two lines on average.
DIVISOR = 2
#: A line of this many words is a passage, and a chunk of its own.
LONG_LINE = 50


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _is_long(line: Column, words: int) -> Column:
    # so many words need so many characters; most lines are told apart by length
    return F.when(F.length(line) >= 2 * words - 1, word_count(line) >= words).otherwise(False)


def _signatures(texts: DataFrame, divisor: int, long_line: int, bits: int, passages: bool) -> DataFrame:
    """``id, row, ends, units`` of every different text of an id; ``row`` is a hash of the text.

    ``ends`` has the number of lines up to the end of each chunk. ``units`` are what may
    be repeated: chunks that may be removed and, with ``passages``, each line with
    the next (``pair``), by place and hash.
    """
    rows = texts.withColumn("row", F.xxhash64("text")).withColumn("lines", F.split("text", "\n", -1))
    rows = rows.withColumn(
        "marks",
        F.transform("lines", lambda x: F.struct(_line_hash(x).alias("h"), _is_long(x, long_line).alias("long"))),
    )

    def end(mark: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get("marks", i - 1)["h"]).otherwise(0)
        after = F.get("marks", i + 1)
        roll = (before * FACTOR + mark["h"]) % MODULUS
        return F.when((roll % divisor == 0) | mark["long"] | after.isNull() | after["long"], i + 1)

    rows = rows.withColumn("ends", F.array_compact(F.transform("marks", end)))

    def unit(pair: bool, at: Column, h: Column) -> Column:
        return F.struct(F.lit(pair).alias("pair"), at.alias("at"), F.shiftright(h, 64 - bits).alias("h"))

    def chunk(end: Column, k: Column) -> Column:
        begin = F.when(k > 0, F.get("ends", k - 1)).otherwise(0)
        whole = (end - begin > 1) | F.get("marks", begin)["long"]
        return F.struct(whole.alias("whole"), F.when(whole, _chunk_text("lines", begin, end)).alias("text"))

    wordy = lambda c, k: F.when(c["whole"] & c["text"].rlike(r"[^\x20\x09-\x0D]"), unit(False, k, F.xxhash64(c["text"])))
    units = F.array_compact(F.transform(F.transform("ends", chunk), wordy))
    if passages:
        first = F.slice("lines", F.lit(1), F.size("lines") - 1)
        pairs = F.transform(first, lambda x, i: unit(True, i, F.xxhash64(x, F.get("lines", i + 1))))
        units = F.concat(units, pairs)
    return rows.select("id", "row", "ends", units.alias("units")).dropDuplicates(["id", "row"])


def _chunk_text(lines: str, begin: Column, end: Column) -> Column:
    return F.array_join(F.slice(lines, begin + 1, end - begin), "\n")


def _repeated(texts: DataFrame, signatures: DataFrame) -> DataFrame:
    """``id, row, chunks, pairs``: sorted places of the units that stand earlier as well.

    Earlier is in a document with a smaller id, or before in the same text. Hashes choose
    the units to compare, and only texts that hold some are read again; units are equal if
    their bytes are. A hash that stands for different texts leads to a join by text.
    """
    units = signatures.where("id is not null").select("id", "row", F.explode("units").alias("u")).select("id", "row", "u.*")
    often = written(units.groupBy("pair", "h").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "often")
    units = written(units.join(often, ["pair", "h"]), "units")
    places = units.groupBy("id", "row").agg(F.collect_list(F.struct("pair", "at", "h")).alias("units"))
    places = places.join(signatures.select("id", "row", "ends"), ["id", "row"])

    def with_text(u: Column) -> Column:
        pair = F.concat(F.get("lines", u["at"]), F.lit("\n"), F.get("lines", u["at"] + 1))
        begin = F.when(u["at"] > 0, F.get("ends", u["at"] - 1)).otherwise(0)
        chunk = _chunk_text("lines", begin, F.get("ends", u["at"]))
        return F.struct(u["pair"], u["at"], u["h"], F.when(u["pair"], pair).otherwise(chunk).alias("text"))

    found = texts.withColumn("row", F.xxhash64("text")).join(places, ["id", "row"])
    found = found.withColumn("lines", F.split("text", "\n", -1)).select("id", "row", F.transform("units", with_text).alias("units"))
    found = found.select("id", "row", F.explode("units").alias("u")).select("id", "row", "u.*")
    by_text = found.groupBy("pair", "h", "text").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    by_hash = written(
        by_text.groupBy("pair", "h")
        .agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.count("*").alias("texts"))
        .where("n > 1"),
        "repeated",
    )
    none = F.lit(None).cast("string")
    same = units.join(by_hash.where("texts = 1"), ["pair", "h"]).withColumn("text", none)
    clash = by_hash.where("texts > 1").select("pair", "h")
    columns = ["id", "row", "pair", "h", "text", "at", "first"]
    same = same.select(*columns)
    if not clash.isEmpty():
        again = by_text.where("n > 1").join(clash, ["pair", "h"], "left_semi")
        same = same.unionByName(found.join(again, ["pair", "h", "text"]).select(*columns))
    same = same.groupBy("id", "row", "pair", "h", "text", "first").agg(F.sort_array(F.collect_set("at")).alias("at"))
    later = F.when(F.col("id") == F.col("first"), F.slice("at", F.lit(2), F.size("at"))).otherwise(F.col("at"))
    same = same.select("id", "row", "pair", later.alias("at")).where("size(at) > 0")
    gone = lambda of: F.sort_array(F.flatten(F.collect_list(F.when(of, F.col("at")))))
    return written(
        same.groupBy("id", "row").agg(gone(~F.col("pair")).alias("chunks"), gone(F.col("pair")).alias("pairs")), "gone"
    )


def _without(joined: DataFrame, words: int) -> DataFrame:
    """Adds ``kept_lines``, from ``lines``, ``ends``, ``chunks`` and ``pairs``.

    Lines of the listed chunks go. A run of lines whose pairs all stand earlier goes too if
    it has so many words or reaches into a removed chunk.
    """
    ends = lambda k: F.get("ends", k)
    begin = lambda k: F.when(k > 0, ends(k - 1)).otherwise(0)
    places = F.flatten(F.transform("chunks", lambda k: F.sequence(begin(k), ends(k) - 1)))
    joined = joined.withColumns({
        "gone_lines": places,
        "starts": F.filter("pairs", lambda x, k: (k == 0) | (F.get("pairs", k - 1) < x - 1)),
        "stops": F.filter("pairs", lambda x, k: (k == F.size("pairs") - 1) | (F.get("pairs", k + 1) > x + 1)),
    })
    runs = F.zip_with("starts", "stops", lambda a, b: F.sequence(a, b + 1))

    def goes(run: Column) -> Column:
        count = F.aggregate(run, F.lit(0).cast("long"), lambda n, i: n + word_count(F.get("lines", i)))
        return F.arrays_overlap(run, "gone_lines") | (count >= words)

    joined = joined.withColumn("gone_lines", F.concat("gone_lines", F.flatten(F.filter(runs, goes))))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    return joined.withColumn(
        "kept_lines", F.transform(F.array_except(every, "gone_lines"), lambda i: F.get("lines", i))
    )


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    divisor: int = DIVISOR,
    long_line: int = LONG_LINE,
    hash_bits: int = 64,
    passages: bool = True,
) -> DataFrame:
    """``docs`` with repeated chunks of lines removed, and two counts.

    Every line is hashed; a rolling hash over the last two line hashes ends a
    chunk where it is divisible by ``divisor``, so boundaries depend on the
    lines around them only and shift along when lines are added elsewhere. A
    line of ``long_line`` words or more is a chunk of its own, since passages
    often come without line breaks. A chunk is removable if it has two lines or
    more or is such a passage, and holds a word. Of equal removable chunks the
    one in the document with the smallest id, there the first, stays; all
    others go, wherever they are. Hashes choose what to compare and bytes decide:
    what is repeated is gathered by hash and text, and a hash that stands for
    different texts leads to a join by text as well.

    Chunks of one short line stay, and so does the chunk that a passage shares with
    the lines before it. With ``passages``, a run of lines goes as well if each of
    its adjacent pairs stands earlier, by bytes, and it has ``long_line`` words or
    reaches into a removed chunk; of every line one copy stays. Counts are of
    chunks in both cases.

    Adds ``n_chunks`` and ``n_removed`` (long) to the columns of ``docs`` and
    replaces the text. A null text stays null and a document whose chunks all
    go keeps an empty text. Rows that repeat an id are one document, whose copies
    of the same text keep the same. Rows with a null id keep their text. Columns of
    ``docs`` with clashing names are left as they are. An empty table gives no
    rows. ``hash_bits`` is lowered by tests only, to make hashes collide.
    """
    # the columns of docs go by number, so that none clashes with a name used here
    rows = docs.toDF(*[f"col{i}" for i in range(len(docs.columns))])
    number = {c: f"col{i}" for i, c in enumerate(docs.columns)}
    rows = rows.withColumns({"id": F.col(number[id_col]), "text": F.col(number[text_col])})
    texts = rows.where("text is not null").select("id", "text")
    signatures = written(_signatures(texts, divisor, long_line, hash_bits, passages), "signatures")
    gone = _repeated(texts.where("id is not null"), signatures)
    told = signatures.join(gone, ["id", "row"], "left").select(
        F.col("id").alias("of"),
        F.col("row").alias("of_row"),
        F.size("ends").alias("n"),
        F.when(F.col("chunks").isNotNull(), F.col("ends")).alias("ends"),
        "chunks",
        "pairs",
    )
    joined = rows.withColumn("row", F.xxhash64("text"))
    joined = joined.join(told, F.col("id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("of_row")), "left")
    # a text that loses nothing is not taken apart
    joined = joined.withColumn("lines", F.split(F.when(F.col("chunks").isNotNull(), F.col("text")), "\n", -1))
    joined = _without(joined, long_line)
    text = F.when(F.col("chunks").isNotNull(), F.array_join("kept_lines", "\n")).otherwise(F.col("text"))
    kept = [(text if c == text_col else F.col(number[c])).alias(c) for c in docs.columns]
    there = F.col("text").isNotNull()
    counts = {"n_chunks": F.col("n"), "n_removed": F.when(F.col("chunks").isNotNull(), F.size("chunks")).otherwise(0)}
    return joined.select(
        *kept, *[F.when(there, v).otherwise(0).cast("long").alias(c) for c, v in counts.items() if c not in docs.columns]
    )
