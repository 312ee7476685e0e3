"""SimHash near-duplicates, found by Golay-code fuzzy hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import word_blocks, written
from millrace.llm.components import smallest_reachable

#: Words of a shingle, seed of its hash, and bits by which linked fingerprints may differ.
SHINGLE, SEED, BITS = 3, 42, 3
#: Widths of the segments of a fingerprint, lowest bits first. Each is a word of
#: the binary Golay code of length 23 with zeros above it.
SEGMENTS = (21, 21, 22)
#: Generator polynomial of that code, of degree 11.
GENERATOR = 0b110001110101


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text: a bit is set if over half the shingles' hashes have it."""
    ones, total, tail = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def count(parts: list[bytes]) -> None:
        nonlocal ones, total
        hashes = np.array([digest(p, seed) for p in parts], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(parts)

    for words in word_blocks(text.lower()):
        words = tail + words
        if len(words) >= shingle:
            count([b" ".join(w) for w in zip(*(words[i:] for i in range(shingle)))])
            tail = words[len(words) - shingle + 1 :]
        else:
            tail = words
    if not total and tail:
        count([b" ".join(tail)])
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator; 0 for codewords."""
    rest = words.astype(np.uint32)
    for bit in range(22, 10, -1):
        rest ^= ((rest >> bit) & 1) * np.uint32(GENERATOR << (bit - 11))
    return rest


def error_tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the errors of at most three bits, and the five of four bits (0 if none)."""
    near, far = np.zeros(2048, np.uint32), np.zeros((2048, 5), np.uint32)
    for weight in range(4):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.uint32)
        near[syndrome(errors)] = errors
    found = np.zeros(2048, np.int64)
    errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), 4)], np.uint32)
    for s, e in zip(syndrome(errors), errors):
        far[s, found[s]] = e
        found[s] += 1
    return near, far


def codewords(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Six indices of codewords near each 23-bit word, -1 where there are fewer.

    The nearest codeword is at distance three at most, as the code is perfect.
    A word at distance three has five more at distance four. Words that differ
    by two bits or fewer always have an index in common.
    """
    near, far = tables
    s = syndrome(words)
    first = ((words ^ near[s]) >> 11).astype(np.int64)
    more = np.where(far[s] > 0, ((words[:, None] ^ far[s]) >> 11).astype(np.int64), -1)
    return np.concatenate([first[:, None], more], axis=1)


def fuzzy_keys(prints: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) such that any two prints that differ by three bits or fewer share a key.

    Three wrong bits over three segments: either each segment has two at most,
    and the segments share a codeword index each, 36 bits together; or one
    segment has all three, and the other two are equal.
    """
    parts, shift = [], 0
    for width in SEGMENTS:
        parts.append(((prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.uint32))
        shift += width
    rows = np.arange(len(prints))
    combined = np.zeros(len(prints), np.int64)
    for part in parts:
        every = codewords(part, tables)[rows]
        there = every >= 0
        combined = (combined[:, None] << 12 | every)[there]
        rows = np.repeat(rows, there.sum(1))
    keys = [combined]
    at = [rows]
    for tag, (i, j) in enumerate(((0, 1), (0, 2), (1, 2)), 1):
        keys.append(np.int64(tag) << 60 | parts[i].astype(np.int64) << 22 | parts[j].astype(np.int64))
        at.append(np.arange(len(prints)))
    return np.concatenate(at), np.concatenate(keys)


def spanning_links(prints: np.ndarray, bits: int) -> tuple[list, list]:
    """Links that join all prints which chains of near prints join, at most one per print.

    From one print all unvisited near ones are taken out at once, so a dense
    group of any size needs few steps, and no list of all its pairs is made.
    """
    a, b, rest = [], [], prints
    while len(rest) > 1:
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            at = waiting.pop()
            near = np.bitwise_count(rest ^ at) <= bits
            if near.any():
                hits = rest[near]
                a += [at] * len(hits)
                b += list(hits)
                waiting += list(hits)
                rest = rest[~near]
    return a, b


def links_of_runs(keys: np.ndarray, prints: np.ndarray, bits: int, small: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys (sorted): all of a small run, spanning ones of a large."""
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    lengths = np.diff(edges)
    a, b = [], []
    inside = np.repeat(lengths <= small, lengths)
    for step in range(1, small):
        i = np.flatnonzero(inside[:-step] & (keys[step:] == keys[:-step]))
        if not len(i):
            break
        i = i[np.bitwise_count(prints[i] ^ prints[i + step]) <= bits]
        a.append(prints[i])
        b.append(prints[i + step])
    for start, length in zip(edges[:-1][lengths > small], lengths[lengths > small]):
        x, y = spanning_links(prints[start : start + length], bits)
        a.append(np.array(x, np.uint64))
        b.append(np.array(y, np.uint64))
    if not a:
        return prints[:0], prints[:0]
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    seed: int = SEED,
    bits: int = BITS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Texts whose fingerprints differ by ``bits`` (three at most) or fewer are
    linked; ``component_id`` is the smallest id that links reach, the row's own
    included. Equal fingerprints are one class, so copies are never compared.
    Each class gets about 150 keys (``fuzzy_keys``); classes that share a key
    are compared by bit distance, and the links that hold are contracted to
    components. No link is lost: prints within three bits share a key.

    Null text counts as empty, empty texts have fingerprint zero and are linked
    like others. Rows that repeat an id are placed by their own texts. Null ids
    never become a component's id unless it has no other. An empty table gives
    no rows. Other columns of ``docs`` are not read.
    """
    if not 0 <= bits <= 3:
        raise ValueError("bits must be 0 to 3")
    id_type = docs.schema[id_col].dataType.simpleString()

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            marks = [fingerprint(t.as_py() or b"", shingle, seed) for t in texts]
            marks = pa.array(np.array(marks, "<u8").view("<i8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), marks], names=["doc_id", "id"])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = error_tables()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                prints = batch.column(0).slice(at, 1024).to_numpy(zero_copy_only=False).view("<u8")
                rows, keys = fuzzy_keys(prints, tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(prints[rows].view("<i8"))], names=["key", "id"]
                )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            prints = batch.column(1).to_numpy().view("<u8")
            waiting.append((keys, prints))
            if keys[0] == keys[-1] and waiting[0][0][0] == keys[0]:
                continue  # one key still; it may go on
            keys, prints = (np.concatenate(x) for x in zip(*waiting))
            end = np.searchsorted(keys, keys[-1])
            waiting = [(keys[end:], prints[end:])]
            a, b = links_of_runs(keys[:end], prints[:end], bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view("<i8")), pa.array(b.view("<i8"))], names=["a", "b"])
        if waiting:
            a, b = links_of_runs(*(np.concatenate(x) for x in zip(*waiting)), bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view("<i8")), pa.array(b.view("<i8"))], names=["a", "b"])

    columns = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    prints = written(columns.mapInArrow(printed, f"doc_id {id_type}, id long"), "prints")
    classes = written(prints.groupBy("id").agg(F.min("doc_id").alias("first")), "classes")
    keys = classes.select("id").mapInArrow(keyed, "key long, id long")
    links = keys.repartition("key").sortWithinPartitions("key").mapInArrow(linked, "a long, b long")
    placed = written(smallest_reachable(classes, written(links, "links")), "placed")
    return prints.join(placed, "id").select(
        "doc_id", F.lower(F.lpad(F.hex("id"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is that of their component, all columns as they are.

    Rows that repeat an id are one document and stay or go together.
    """
    placed = simhash_components(docs, id_col, text_col)
    stays = placed.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.join(stays, docs[id_col].eqNullSafe(stays["doc_id"]), "left_semi")
