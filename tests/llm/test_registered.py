"""Every registered text query, and edge rows that other tests leave out."""

import collections
import hashlib
import struct

import pytest
import xxhash
from tokenizers import Tokenizer

from millrace.llm.bpe import PIECE, VOCABULARY, bpe_encode
from millrace.llm.embedding_dedup import embedding_components
from millrace.llm.queries import LLM_QUERIES
from millrace.llm.simhash import simhash_components

CONTRACT = {
    "op1_line_dedup": "doc_id bigint, n_chunks bigint, n_removed bigint, text_sha256 string",
    "op2_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op3_embedding_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op4_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op5_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op9_lm_score": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double",
    "op10_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op11_token_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string",
    "op12_conversation_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op13_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "sequence_id bigint, offset bigint",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_rows_and_columns(spark, sf_dir, name):
    out = LLM_QUERIES[name](spark, sf_dir)
    types = {f.name: f.dataType.simpleString() for f in out.schema}
    want = dict(c.split() for c in CONTRACT[name].split(", "))
    assert {c: types[c] for c in want} == want
    key = next(iter(want))
    ids = collections.Counter(r[0] for r in out.select(key).collect())
    table = {"vec_id": "embeddings", "conv_id": "conversations"}.get(key, "documents")
    every = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect()
    assert set(ids) == {r[0] for r in every}
    if name not in ("op12_conversation_repair", "op13_best_fit_packing"):
        assert ids == collections.Counter(r[0] for r in every)


def test_embeddings_with_null_ids_and_clashing_columns(spark):
    near, other = [1.0, 0.5, 0.0, 2.0], [-1.0, 3.0, 0.5, 0.0]
    rows = [(None, near), (1, near), (7, [1.0, 0.5, 0.01, 2.0]), (None, other), (None, None), (3, None)]
    names = ("id", "v", "n_links", "component_id", "copies", "cell")
    df = spark.createDataFrame(
        [(*r, *[9] * len(names)) for r in rows],
        "vec_id long, embedding array<double>, " + ", ".join(f"{c} long" for c in names),
    )
    got = collections.Counter(map(tuple, embedding_components(df).collect()))
    want = [(None, 2, 1, False), (1, 2, 1, True), (7, 2, 1, False), (None, 0, None, True), (None, 0, None, True), (3, 0, 3, True)]
    assert got == collections.Counter(want)


def test_very_long_texts(spark):
    spaced = " ".join(f"Word{i % 977} tail{i % 31}," for i in range(90_000))
    unspaced = "abc9" * (PIECE // 3)
    texts = {1: spaced, 2: unspaced, 3: spaced + " more"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert all(len(t) > PIECE for t in texts.values()) and len(spaced) > 1 << 20
    library = Tokenizer.from_file(VOCABULARY)
    for r in bpe_encode(df).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    for r in simhash_components(df.where("doc_id <> 2")).collect():
        w = texts[r["doc_id"]].lower().encode().split()
        counts = collections.Counter(b" ".join(w[i : i + 3]) for i in range(len(w) - 2))
        bits = [0] * 64
        for shingle, n in counts.items():
            h = xxhash.xxh64_intdigest(shingle, 42)
            for b in range(64):
                bits[b] += n if h >> b & 1 else 0
        total = sum(counts.values())
        assert int(r["fingerprint"], 16) == sum(1 << b for b in range(64) if 2 * bits[b] > total)
