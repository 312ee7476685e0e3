"""Toxicity scores by multiple-instance learning over sentences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import label_bucket
from millrace.llm.hashing import word_hashes
from millrace.llm.labelled import training_sample

#: Hash buckets of words and of their beginnings, and the beginnings' lengths in bytes.
BUCKETS, PREFIXES = 1 << 18, (5, 6, 7)
#: Labelled documents of each class that training reads at most.
PER_CLASS = 2000
#: Steps of training, documents of a step, rate, pull of weights towards zero in proportion and as such.
STEPS, STEP, RATE, DECAY, SPARSE = 2000, 64, 0.7, 1e-5, 1e-4
#: Log odds that a sentence is toxic before any word is read. So low that tens of thousands of
#: sentences without a sign of toxicity do not add up to a toxic document.
BIAS = -12.0
#: Bytes of text read at a time.
PIECE = 1 << 18

#: Letters, digits and all bytes of letters outside ASCII form words.
IS_WORD = np.zeros(256, bool)
IS_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789", *range(128, 256)]] = True
#: Bytes that end a sentence.
ENDS_SENTENCE = np.zeros(256, bool)
ENDS_SENTENCE[[*b".!?\n"]] = True


def sentences(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a text: buckets of words and their beginnings, number of the sentence
    each is in, ends of sentences.

    A part ends with a sentence, however long, so none is cut.
    """
    data, at = data.lower(), 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not ENDS_SENTENCE[data[end - 1]]:
            end += 1
        piece = np.frombuffer(data, np.uint8, end - at, at)
        hashes, starts, *begun = word_hashes(piece, IS_WORD, PREFIXES)
        ends = np.flatnonzero(ENDS_SENTENCE[piece])
        buckets = (np.concatenate([hashes, *begun]) >> np.uint64(46)).astype(np.int64)
        yield buckets, np.tile(np.searchsorted(ends, starts), 1 + len(begun)), at + ends
        at = end


def sentence_logits(buckets: np.ndarray, number: np.ndarray, weights: np.ndarray, bias: float) -> tuple:
    """Numbers of the sentences that have words, and their logits."""
    there, at = np.unique(number, return_inverse=True)
    return there, bias + np.bincount(at, weights[buckets], len(there))


def log_none(logits: np.ndarray) -> np.ndarray:
    """Log probability that a sentence is not toxic."""
    return -np.logaddexp(0, logits)


def blame(none: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope of a document's log loss by the log probability that none of its sentences is toxic.

    Times the chance of a sentence, it is the share of a toxic document that this
    sentence explains, however unlikely all of them are.
    """
    return np.where(y == 1, -np.exp(none) / np.maximum(-np.expm1(none), 1e-300), 1.0)


def train(
    texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weigh: np.ndarray, seed: int = 0
) -> tuple[np.ndarray, float]:
    """Weights of words, and the bias, from labels of whole documents and their weights.

    A text is the buckets of its words, sentence by sentence, and how many each
    sentence has. A document is toxic if any sentence is: its probability is the noisy-or
    1 - prod(1 - p) of its sentences'. Gradient descent on the log loss of
    documents, each weight with its own rate; the sentence that explains a toxic
    document best takes most of its gradient. No weight falls below zero: clean
    words in a sentence do not outweigh a toxic one. A constant pull towards zero keeps
    words that stand in one document by chance from explaining it. Without documents of both labels
    all scores are 0.5 for a text of one sentence.
    """
    random, weights = np.random.default_rng(seed), np.zeros(BUCKETS)
    if len(set(y.tolist())) < 2:
        return weights, 0.0
    weigh = weigh / weigh.mean()
    grown = np.full(BUCKETS, 1e-16)
    passes = -(-STEPS * STEP // len(y))
    order = np.concatenate([random.permutation(len(y)) for _ in range(passes)])[: STEPS * STEP]
    for at in range(0, len(order), STEP):
        chosen = order[at : at + STEP]
        sizes = np.array([len(texts[i][1]) for i in chosen])
        first = np.cumsum(sizes) - sizes
        words = np.concatenate([texts[i][0] for i in chosen])
        place = np.concatenate([np.repeat(np.arange(f, f + len(texts[i][1])), texts[i][1]) for i, f in zip(chosen, first)])
        document = np.repeat(np.arange(len(chosen)), sizes)
        logits = BIAS + np.bincount(place, weights[words], sizes.sum())
        none = np.bincount(document, log_none(logits), len(chosen))
        slope = blame(none, y[chosen]) * weigh[chosen]
        back = slope[document] / (1 + np.exp(-logits)) / len(chosen)
        gradient = np.bincount(words, back[place], BUCKETS)
        gradient += DECAY * weights + SPARSE * (weights > 0)
        grown += gradient**2
        weights = np.maximum(weights - RATE * gradient / np.sqrt(grown), 0)
    return weights, BIAS


class Scorer:
    """Scores of texts by learned weights; sent to the tasks."""

    def __init__(self, weights: np.ndarray, bias: float, threshold: float):
        self.weights, self.bias, self.threshold = weights, bias, threshold

    def __call__(self, text: str | None) -> tuple[float, list[dict]]:
        """Noisy-or of a text's sentences, and the sentences at or above the threshold."""
        data = (text or "").encode()
        every, found, before, least = [np.zeros(0)], [], 0, np.log(self.threshold / (1 - self.threshold))
        for buckets, number, ends in sentences(data):
            pairs = np.unique(number << 18 | buckets)
            there, logits = sentence_logits(pairs & (BUCKETS - 1), pairs >> 18, self.weights, self.bias)
            every.append(logits)
            for i in np.flatnonzero(logits >= least):
                n = there[i]
                start = int(ends[n - 1]) + 1 if n else before
                end = int(ends[n]) + 1 if n < len(ends) else len(data)
                found.append((start, end, float(1 / (1 + np.exp(-logits[i])))))
            before = int(ends[-1]) + 1 if len(ends) else before
        places, at, chars = [], 0, 0
        for start, end, p in found:
            chars += len(data[at:start].decode(errors="ignore"))
            size = len(data[start:end].decode(errors="ignore"))
            places.append({"start": chars, "end": chars + size, "score": p})
            at, chars = end, chars + size
        return float(-np.expm1(log_none(np.concatenate(every)).sum())), places


def training_words(sample: DataFrame, id_type: str) -> DataFrame:
    """``id, y, weight, words, sizes`` of the sampled documents that have words.

    ``words`` are 32-bit buckets, each once in a sentence, and ``sizes`` their
    number in each sentence that has any.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, sizes = [], []
                for buckets, number, _ in sentences(batch.column(1)[i].as_py().encode()):
                    pairs = np.unique(number << 18 | buckets)
                    words.append((pairs & (BUCKETS - 1)).astype(np.int32))
                    sizes.append(np.unique(pairs >> 18, return_counts=True)[1].astype(np.int32))
                packed = [b"".join(x.tobytes() for x in parts) for parts in (words, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, 1) for c in (0, 2, 3)), *(pa.array([p], pa.binary()) for p in packed)],
                    names=["id", "y", "weight", "words", "sizes"],
                )

    schema = f"id {id_type}, y int, weight double, words binary, sizes binary"
    return sample.mapInArrow(read, schema).where("length(words) > 0")


def trained_scorer(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    per_class: int = PER_CLASS,
    threshold: float = 0.5,
) -> Scorer:
    """A scorer learned from at most ``per_class`` labelled documents of each label."""
    sample = training_sample(docs, labels, label, 5, 0, per_class, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = training_words(sample, id_type).collect()
    rows.sort(key=lambda r: (str(r["id"]), bytes(r["words"]), bytes(r["sizes"])))
    texts = [(np.frombuffer(r["words"], np.int32), np.frombuffer(r["sizes"], np.int32)) for r in rows]
    weights, bias = train(
        texts, np.array([r["y"] for r in rows], np.int64), np.array([r["weight"] for r in rows], np.float64)
    )
    return Scorer(weights, bias, threshold)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    per_class: int = PER_CLASS,
    threshold: float = 0.5,
) -> DataFrame:
    """``doc_id, held_out, score, predicted, sentences`` for every row of ``docs``.

    Every sentence of the whole text gets the probability that its words make it
    toxic, learned from labels of documents alone, and ``score`` is their
    noisy-or, as in training. ``sentences`` lists start, end (code points, end exclusive) and
    score of the sentences at or above ``threshold``. Training reads at most
    ``per_class`` documents of each label, none whose crc32 of the id modulo 5 is
    0 (those are held out); tasks send the buckets of their words to the driver, which the sample
    bounds. Only texts enter a score.

    Null texts, empty ones and such without words have no sentence, and the
    score 0. Rows with a null id are scored and not held out; repeated rows get
    equal scores; an empty table gives no rows.
    """
    scorer = trained_scorer(docs, labels, id_col, text_col, label, per_class, threshold)
    id_type = docs.schema[id_col].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            results = [scorer(text.as_py()) for text in batch.column(2)]
            scores = np.array([r[0] for r in results], np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores),
                    pa.array((scores >= 0.5).astype(np.int32)),
                    pa.array([r[1] for r in results], kind),
                ],
                names=["doc_id", "held_out", "score", "predicted", "sentences"],
            )

    held_out = F.coalesce(label_bucket(F.col(id_col), 5) == 0, F.lit(False))
    columns = docs.select(F.col(id_col), held_out.alias("held_out"), F.col(text_col).cast("string"))
    return columns.mapInArrow(
        scored,
        f"doc_id {id_type}, held_out boolean, score double, predicted int, "
        "sentences array<struct<start: long, end: long, score: double>>",
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS
) -> DataFrame:
    """The rows of ``docs`` whose texts are not predicted toxic, all columns as they are.

    Rows are judged one by one where they are; nothing is moved but the sample.
    """
    scorer = trained_scorer(docs, labels, id_col, text_col, per_class=per_class)
    text_at = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([scorer(text.as_py())[0] < 0.5 for text in batch.column(text_at)], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
