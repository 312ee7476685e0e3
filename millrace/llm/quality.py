"""Quality scores by supervised subword embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import label_bucket
from millrace.llm.hashing import byte_class, word_hashes
from millrace.llm.labelled import training_sample

#: Hash buckets, width of an embedding, lengths of character n-grams.
BUCKETS, WIDTH, NGRAMS = 1 << 16, 8, (3, 4)
#: Labelled documents of each class that training reads at most, and its passes over them.
PER_CLASS, EPOCHS, RATE = 1500, 12, 20.0
#: Bytes of a text that are turned into features at a time.
PIECE = 1 << 18
IS_WORD = byte_class(b" \t\n\x0b\x0c\r")


def _pieces(data: bytes) -> Iterator[bytes]:
    """Parts of a text cut at spaces, so that no word is cut."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and IS_WORD[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def features(data: bytes) -> np.ndarray:
    """How often each bucket occurs in a text: words, character n-grams as written,
    and in bucket 0 the pairs of a word and itself, whatever the word. What reaches over the
    end of a part is counted with the next part."""
    counts = np.zeros(BUCKETS, np.int64)
    last, tail = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for piece in _pieces(data):
        array = np.frombuffer(piece, np.uint8)
        words, _ = word_hashes(array, IS_WORD)
        joined = np.concatenate([last, words])
        found = [words >> np.uint64(48), np.zeros(np.count_nonzero(joined[1:] == joined[:-1]), np.uint64)]
        letters = np.frombuffer(piece.decode().encode("utf-32-le"), "<u4").astype(np.uint64)
        for n in NGRAMS:
            before = tail[max(len(tail) - n + 1, 0) :]
            run = np.concatenate([before, letters])
            if len(run) >= n:
                grams = np.full(len(run) - n + 1, n, np.uint64)
                for i in range(n):
                    grams = (grams + run[i : len(run) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                found.append(grams >> np.uint64(48))
        last, tail = joined[-1:], np.concatenate([tail, letters])[-max(NGRAMS) :]
        counts += np.bincount(np.concatenate(found).astype(np.int64), minlength=BUCKETS)
    return counts


@dataclass
class Model:
    """Embeddings of the buckets and a softmax layer over their average in a text."""

    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def bucket_logits(self) -> np.ndarray:
        """What each bucket adds to the difference of the two classes' outputs.

        Averaging and the output layer are both linear, so a text's difference
        is the average of these plus that of the biases.
        """
        return self.embeddings @ (self.weights[:, 1] - self.weights[:, 0])


def train(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 0) -> Model:
    """Stochastic gradient descent on softmax loss, one document at a time.

    ``texts`` has the buckets and their shares of each text. The rate falls to
    zero; classes weigh the same however many documents they have. Without
    documents of both classes the model is neutral.
    """
    random = np.random.default_rng(seed)
    embeddings = random.normal(0, 0.1, (BUCKETS, WIDTH))
    weights, bias = random.normal(0, 1, (WIDTH, 2)), np.zeros(2)
    share = np.bincount(y, minlength=2)
    if not share.all():
        return Model(np.zeros_like(embeddings), weights, bias)
    weigh = len(y) / (2 * share)
    steps = EPOCHS * len(y)
    for step, i in enumerate(np.concatenate([random.permutation(len(y)) for _ in range(EPOCHS)])):
        buckets, shares = texts[i]
        rate = RATE * (1 - step / steps) * weigh[y[i]]
        hidden = shares @ embeddings[buckets]
        z = hidden @ weights + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[y[i]] -= 1
        back = weights @ p
        weights -= 0.02 * rate * np.outer(hidden, p)
        bias -= 0.001 * rate * p
        embeddings[buckets] -= rate * shares[:, None] * back
    return Model(embeddings, weights, bias)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
    per_class: int = PER_CLASS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    A text is the average of the learned vectors of its hashed words and
    character n-grams, counted over the whole text; a softmax layer gives the probability
    of label 1. Training reads at most ``per_class`` documents of each label,
    none of whose crc32 of the id modulo 3 is 1 (those are held out). Tasks count
    their features; the driver trains on the counts, which the sample bounds,
    and sends back one number per bucket. Only texts enter a score.

    Null and empty texts have no features and get the bias alone. Rows with a
    null id are scored and not held out. Repeated rows get equal scores. Without
    documents of both labels every score is 0.5. An empty table gives no rows.
    """
    sample = training_sample(docs, labels, label, 3, 1, per_class, id_col, text_col)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                counts = features(batch.column(1)[i].as_py().encode())
                there = np.flatnonzero(counts)
                shares = (counts[there] / max(counts.sum(), 1)).astype(np.float32)
                packed = [there.astype(np.uint16).tobytes(), shares.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(2).slice(i, 1), *(pa.array([p]) for p in packed)],
                    names=["id", "y", "buckets", "shares"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = sample.mapInArrow(counted, f"id {id_type}, y int, buckets binary, shares binary").collect()
    rows.sort(key=lambda r: (str(r["id"]), bytes(r["buckets"])))
    texts = [
        (np.frombuffer(r["buckets"], np.uint16).astype(np.int64), np.frombuffer(r["shares"], np.float32)) for r in rows
    ]
    model = train(texts, np.array([r["y"] for r in rows], np.int64))
    logits, bias = model.bucket_logits(), float(model.bias[1] - model.bias[0])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text in batch.column(2):
                counts = features((text.as_py() or "").encode())
                z = bias + float(counts @ logits) / max(int(counts.sum()), 1)
                scores.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
            scores = np.array(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    held_out = F.coalesce(label_bucket(F.col(id_col), 3) == 1, F.lit(False))
    columns = docs.select(F.col(id_col), held_out.alias("held_out"), F.col(text_col).cast("string"))
    return columns.mapInArrow(scored, f"doc_id {id_type}, held_out boolean, score double, predicted int")
