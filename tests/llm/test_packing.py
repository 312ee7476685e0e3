"""Packing: ids like the library's, gapless sequences, few of them."""

import collections
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from millrace.llm import byte_tokens, packing
from millrace.llm.byte_tokens import ByteEncoder
from millrace.llm.packing import BestFit, pack_documents
from millrace.llm.queries import op13_best_fit_packing

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def encoder():
    with open(packing.VOCABULARY, "rb") as file:
        return ByteEncoder(file.read(), packing.SPECIAL)


def check(rows, texts, library, length):
    """Every document whole, every sequence gapless."""
    sequences = collections.defaultdict(list)
    pieces = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    want = collections.defaultdict(list)
    for i, text in texts:
        want[i].append([*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID])
    assert pieces.keys() == want.keys()
    for i, lists in want.items():
        got = sorted((r["piece"], r["start"], bytes(r["ids"])) for r in pieces[i])
        cut = []
        for ids in lists:
            first = len(ids) % length or length
            cuts = [0, *range(first, len(ids), length)] if len(ids) > length else [0]
            ends = [*cuts[1:], len(ids)]
            cut += [(n, a, np.array(ids[a:b], "<u4").tobytes()) for n, (a, b) in enumerate(zip(cuts, ends))]
        assert got == sorted(cut)
    return len(sequences)


def test_documents(spark, library):
    pick = random.Random(3)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "日本", "<|endoftext|>", "'s", "12", "\x1c", "\x85", "!", "\r\n", "\0", "😀", " word"]
    texts = [(i % 70 or None, "".join(pick.choices(parts, k=pick.choice([0, 3, 40, 400])))) for i in range(150)]
    texts += [(1000, None), (1000, None), (1001, ""), (1002, "word " * 500), (1003, "x" * 63), (1004, " word" * 63)]
    rows = [(i, t, 5, "k") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long, bin string").repartition(7)
    for block, fan in ((1 << 24, 16), (300, 2)):
        out = pack_documents(docs, length=64, full=60, block=block, fan=fan).collect()
        tokens = sum(r["length"] for r in out)
        assert check(out, texts, library, 64) <= 1.12 * -(-tokens // 64)
    assert pack_documents(docs.limit(0)).count() == 0


def test_residual_rounds_join_what_tasks_leave(spark, library):
    # one document in each task, that fill sequences by threes
    texts = [(i, " word" * 20) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(30, "doc_id")
    docs = docs.rdd.toDF(docs.schema)
    out = pack_documents(docs, length=64, full=63, fan=4).collect()
    assert check(out, texts, library, 64) <= 14


def test_bins_of_the_wrong_size_stay_open(spark, library):
    texts = [(i, " word" * 40) for i in range(200)] + [(500 + i, " word" * 10) for i in range(5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
    out = pack_documents(docs, length=64, full=60, fan=2).collect()
    assert check(out, texts, library, 64) == 200


def test_best_fit_takes_the_tightest_bin():
    bins = BestFit(10)
    assert [bins.put(x) for x in (6, 7, 3, 2, 2, 10, 5, 5)] == [(0, 0), (1, 0), (1, 7), (0, 6), (0, 8), (2, 0), (3, 0), (3, 5)]
    pick = random.Random(1)
    sizes = sorted((pick.randint(1, 100) for _ in range(3000)), reverse=True)
    bins, rooms = BestFit(100), []
    for size in sizes:
        fitting = [r for r in rooms if r >= size]
        room = min(fitting, default=100)
        if fitting:
            rooms.remove(room)
        rooms.append(room - size)
        bins.put(size)
    assert sorted(100 - x for x in bins.loads) == sorted(rooms)


def test_parts_and_long_runs_encode_alike(library, monkeypatch):
    coder, pick = encoder(), random.Random(8)
    letters = ["a", "the", " ", "  ", "\n\n", "é", "<|endoftext|>", "!", "\x1c", "\x85", "　", "'s", " " * 7, "\n" * 6]
    monkeypatch.setattr(byte_tokens, "LONG_RUN", 5)
    monkeypatch.setattr(byte_tokens, "_RUN", byte_tokens.re.compile(byte_tokens._RUN.pattern.replace("32768", "5")))
    for _ in range(1500):
        text = "".join(pick.choices(letters, k=pick.randint(0, 30)))
        want = library.encode(text, add_special_tokens=False).ids
        assert [int(i) for part in coder.parts(text, 4) for i in part] == want
    monkeypatch.undo()
    assert sum(len(p) for p in coder.parts("x" + " " * 500_000 + "y")) == 500_001


def test_query(spark, sf_dir, library):
    out = op13_best_fit_packing(spark, sf_dir)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "int", "bigint", "bigint", "bigint", "bigint", "bigint"]
    rows = out.collect()
    tokens = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * -(-tokens // 1024)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in rows[::37]:
        ids = [*library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 2]
        part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(part)
    assert out.select(F.countDistinct("doc_id")).first()[0] == len(texts)
