"""Byte-pair encoding and decoding with a public vocabulary file."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Encoded words that a task remembers.
REMEMBERED = 1 << 18
#: Characters of a text that are encoded at a time.
PIECE = 1 << 18

#: Unicode White_Space, which the tokenizer's rules mean by a space.
SPACE = r"\t-\r \x85\xa0  -     　"
OTHER_SPACE = regex.compile("[\x1c-\x1f]")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes for themselves, the others by the letters from 256 on."""
    plain = [b for lo, hi in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(lo), ord(hi) + 1)]
    moved = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(moved)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary with word-end symbols.

    A text is split at special tokens, brought to NFC, lower-cased, and cut
    into words, digits and runs of other symbols. The symbols of a word form a
    doubly linked list; its neighbouring pairs wait in a priority queue by merge
    rank, then position. The best pair merges into its left symbol, which adds
    two new pairs; entries whose symbols have changed meanwhile are skipped.
    Letters that Unicode has gained in its latest versions may count as symbols in
    one library and as letters in another.
    """

    def __init__(self, vocabulary: str):
        data = json.loads(vocabulary)
        model, end = data["model"], data["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        letters = _byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + end] for x in letters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
        self.strings = [names.get(i, "") for i in range(max(names) + 1)]
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.parts = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
        self.known: dict[str, bytes] = {}
        self.known_parts: dict[str, list[int]] = {}

    def encode_part(self, part: str) -> list[int]:
        """Ids of one word, digit or run of symbols."""
        data = part.encode()
        ids = [*map(self.inner.__getitem__, data)]
        ids[-1] = self.last[data[-1]]
        rank_of, n = self.ranks, len(ids)
        before, after = [*range(-1, n - 1)], [*range(1, n + 1)]
        pairs = enumerate(zip(ids, ids[1:]))
        queue = [rank << 32 | i for i, (a, b) in pairs if (rank := rank_of.get(a << 32 | b)) is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            if j >= n or ids[i] < 0 or rank_of.get(ids[i] << 32 | ids[j]) != rank:
                continue  # one of the two has merged since
            whole = ids[i] = self.merged[rank]
            ids[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of.get(whole << 32 | ids[k])) is not None:
                    heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0 and (rank := rank_of.get(ids[h] << 32 | whole)) is not None:
                heappush(queue, rank << 32 | h)
        return [x for x in ids if x >= 0]

    def _encode_word(self, word: str) -> bytes:
        """Ids of the text between two spaces."""
        known, ids = self.known_parts, []
        for part in self.parts.findall(word):
            found = known.get(part)
            if found is None:
                found = self.encode_part(part)
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(part) <= 64:
                    known[part] = found
            ids += found
        return array("I", ids).tobytes()

    def _segment(self, text: str) -> bytes:
        known, out = self.known, []
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # each letter by itself: no final form
            text = text.replace("Σ", "σ")
        text = text.lower()
        # str.split also cuts at these four, which are symbols here
        words = [text] if OTHER_SPACE.search(text) else text.split()
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = self._encode_word(word)
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(word) <= 64:
                    known[word] = ids
            out.append(ids)
        return b"".join(out)

    def pieces(self, text: str) -> Iterator[bytes]:
        """Ids, as little-endian 32-bit integers, of parts of a text cut at ASCII spaces."""
        at = 0
        while at < len(text):
            end = at + PIECE
            while end < len(text) and text[end] not in " \n":
                end += 1
            piece = text[at:end]
            at = end
            if self.specials is None:
                yield self._segment(piece)
                continue
            for part in self.specials.split(piece):
                yield self.special[part] if part in self.special else self._segment(part)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.pieces(text)), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary's strings of the ids, with a space between two, as no
        decoder is named in the file. An id outside the vocabulary is an error."""
        strings = self.strings
        return " ".join(map(strings.__getitem__, ids.tolist()))


def bpe_encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` for every row of ``docs``.

    ``ids`` are the tokens of the whole text; the digests are those of the ids as
    little-endian 32-bit integers and of the text that decoding them gives.
    ``vocabulary`` is the path of a tokenizer file, read once on the driver and
    sent to the tasks. Texts are encoded a piece at a time and a task remembers
    a fixed number of words, so memory does not grow with the table. Null text
    counts as empty and has no tokens; repeated rows and null ids are encoded
    like others; an empty table gives no rows; other columns are not read.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    id_type = docs.schema[id_col].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(content.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids, digests, decoded = [], [], []
                for text in batch.column(1):
                    text_ids, digest, again, first = [], hashlib.sha256(), hashlib.sha256(), True
                    for piece in bpe.pieces(text.as_py() or ""):
                        if piece:
                            digest.update(piece)
                            piece = np.frombuffer(piece, "<u4")
                            string = bpe.decode(piece)
                            again.update((string if first else " " + string).encode())
                            text_ids.append(piece)
                            first = False
                    ids.append(np.concatenate(text_ids) if text_ids else np.zeros(0, "<u4"))
                    digests.append(digest.hexdigest())
                    decoded.append(again.hexdigest())
                lengths = np.array([len(x) for x in ids], np.int64)
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                flat = pa.array(np.concatenate(ids).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(offsets, flat),
                        pa.array(digests, pa.string()),
                        pa.array(decoded, pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
                )

    columns = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return columns.mapInArrow(
        encoded, f"doc_id {id_type}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    )


def bpe_decode(
    tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = VOCABULARY
) -> DataFrame:
    """``doc_id, text`` from lists of token ids; null and empty lists give an empty text."""
    with open(vocabulary, encoding="utf-8") as file:
        content = tokens.sparkSession.sparkContext.broadcast(file.read())
    id_type = tokens.schema[id_col].dataType.simpleString()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(content.value)
        for batch in batches:
            texts = [bpe.decode(np.array(ids.as_py() or [], "<u4")) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col(id_col), F.col(ids_col).cast("array<int>")).mapInArrow(
        decoded, f"doc_id {id_type}, text string"
    )
