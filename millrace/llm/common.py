"""Text rules and storage helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.storage import scratch_path

#: A word: a run of anything but space and the ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def word_count(text: Column) -> Column:
    """Number of words as a long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder, lineage cut."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def label_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text, in order, in lists of about ``size`` bytes of text each.

    ``bytes.split`` cuts at exactly the six bytes that end a word.
    """
    if len(data) <= size:
        yield data.split()
        return
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[at:end].split()
        at = end
