"""Alignment of two tokenizers against a plain version with the libraries."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import alignment
from millrace.llm.alignment import PieceEncoder, Run, align_tokens, merged_runs
from millrace.llm.queries import op11_token_alignment


@pytest.fixture(scope="module")
def libraries():
    side_a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    side_a.encode_special_tokens = True
    return side_a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def expected(rows, libraries):
    a, b = libraries
    plain = [x for lo, hi in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for x in range(ord(lo), ord(hi) + 1)]
    odd = [x for x in range(256) if x not in plain]
    byte_of = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(odd)}
    size_a = lambda i: len(a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    aligned, counts = [], collections.Counter()
    for doc_id, text in rows:
        groups = []
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        data = (" " + (text or "")).encode()
        whole = b"".join(bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a)
        if not text or whole != data or b"".join(map(bytes_b, ids_b)) != data:
            aligned.append((doc_id, [], 0, 0))
            continue
        left, right, at_a, at_b = [], [], 0, 0
        rest = iter(ids_b)
        for i in ids_a:
            left.append(i)
            at_a += size_a(i)
            while at_b < at_a:
                right.append(next(rest))
                at_b += len(bytes_b(right[-1]))
            if at_a == at_b:
                groups.append((left, right))
                left, right = [], []
        counts.update({(x, y) for left, right in groups for x in left for y in right})
        aligned.append((doc_id, groups, len(ids_a), len(ids_b)))
    most = collections.Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = collections.Counter()
    for doc_id, groups, n_a, n_b in aligned:
        links = [(x, y) for left, right in groups for x in left for y in right]
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(shown.encode()).hexdigest() if n_a else ""
        best = sum(counts[p] == most[p[0]] for p in links)
        out[doc_id, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest] += 1
    return out


PARTS = ["a", "b", "the", " the", "  ", " ", "\n", "\n\n", "\t", "é", "日本", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "'s"]
PARTS += ["12", "\x1c", "\x85", "!", "?!", "\r\n", "\0", "😀", "ing", "tion", " of"]


@pytest.mark.parametrize("wide", [1 << 12, 20])
def test_alignment(spark, libraries, monkeypatch, wide):
    monkeypatch.setattr(alignment, "WIDE", wide)
    pick = random.Random(5)
    rows = [(k if k % 9 else None, "".join(pick.choices(PARTS + ["▁"] * (k % 3 == 0), k=pick.randint(0, 60)))) for k in range(300)]
    rows += [(1, None), (2, ""), (3, " "), (4, " \n "), (5, "a" * 4000), (5, "a" * 4000), (6, "éà日" * 900)]
    docs = spark.createDataFrame([(*r, 3, b"z") for r in rows], "doc_id long, text string, task long, records binary").repartition(5)
    want = expected(rows, libraries)
    assert collections.Counter(map(tuple, align_tokens(docs, block_bytes=700, links=500).collect())) == want
    assert collections.Counter(map(tuple, align_tokens(docs.coalesce(1)).collect())) == want
    assert align_tokens(docs.limit(0)).count() == 0


def test_query(spark, sf_dir, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    out = op11_token_alignment(spark, sf_dir)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert collections.Counter(map(tuple, out.collect())) == expected(rows, libraries)


def test_parts_encode_alike(libraries):
    with open(alignment.SIDE_B, "rb") as file:
        coder = PieceEncoder(file.read())
    pick = random.Random(6)
    for _ in range(1500):
        text = "".join(pick.choices(PARTS, k=pick.randint(1, 40)))
        assert [i for part in coder.parts(text, 3) for i in part] == libraries[1].encode(text)


def test_merge_of_runs():
    pick, runs, want = np.random.default_rng(3), [], collections.Counter()
    for size in (0, 1, 5, 700, 2500, 40):
        keys = np.unique(pick.integers(0, 3000, size))
        numbers = pick.integers(1, 9, len(keys))
        runs.append(Run(keys, numbers, chunk=16))
        for k, n in zip(keys.tolist(), numbers.tolist()):
            want[k] += n
    got = [(k, n) for keys, numbers in merged_runs(runs) for k, n in zip(keys.tolist(), numbers.tolist())]
    assert got == sorted(want.items())
