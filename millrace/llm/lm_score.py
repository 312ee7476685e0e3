"""N-gram language model scores by a weighted backoff automaton."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import label_bucket, written
from millrace.llm.hashing import byte_class, mixed, word_hashes

#: Words of the longest n-gram, and the weight of the shorter context (in tokens).
ORDER, PRIOR = 3, 4.0
#: Bytes of text in a block; blocks are counted and scored one at a time.
BLOCK = 4 << 20
#: Blocks whose n-grams meet in one group of a counting task.
BLOCKS_PER_PART = 4
#: Tokens of a block that are read side by side.
LANES = 4096
#: Stands for the end of a text, and as a context for its beginning.
END = np.uint64(0xE0D0E0D0E0D0E0D1)
IS_WORD = byte_class(b" \t\n\x0b\x0c\r")


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct whole numbers in order, the number of each key among them, a place of each."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = len(keys).bit_length()
    if int(keys.max()).bit_length() + bits < 64:
        # sorting keys and places as one number is faster than sorting places by key
        both = np.sort(keys << bits | np.arange(len(keys)))
        order, keys = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    new = np.diff(keys, prepend=keys[0] - 1) != 0
    ids = np.empty(len(keys), np.int64)
    ids[order] = np.cumsum(new) - 1
    return keys[new], ids, order[new]


class Block:
    """Tokens and n-grams of a block of texts.

    ``tokens`` has, for each text, the end sign, its words, and the end sign
    again. For each order, ``keys`` has the hashes of the distinct n-grams, ``context`` and
    ``suffix`` the numbers of the shorter n-grams that each begins and ends with, and
    ``ids`` the n-gram that ends at each token, -1 where a text is too short.
    The first end sign of a text is a context only and is counted as no token.
    """

    def __init__(self, texts: list[bytes], order: int):
        words = [word_hashes(np.frombuffer(t.lower(), np.uint8), IS_WORD)[0] for t in texts]
        end = np.array([END])
        lengths = np.array([len(w) + 2 for w in words], np.int64)
        self.starts = np.cumsum(lengths) - lengths
        self.lengths = lengths
        self.tokens = np.concatenate([x for w in words for x in (end, w, end)]) if texts else np.zeros(0, np.uint64)
        self.place = np.arange(len(self.tokens)) - np.repeat(self.starts, lengths)
        self.counted = self.place > 0
        keys, ids = np.unique(self.tokens, return_inverse=True)
        self.keys, self.ids, self.context, self.suffix = [keys], [ids], [None], [None]
        for n in range(2, order + 1):
            at = np.flatnonzero(self.place >= n - 1)
            pairs, found, first = _distinct(self.ids[-1][at - 1] * len(keys) + ids[at])
            before, word = pairs // len(keys), pairs % len(keys)
            every = np.full(len(self.tokens), -1)
            every[at] = found
            self.context.append(before)
            self.suffix.append(self.ids[-1][at[first]])
            self.keys.append(mixed(self.keys[-1][before] * np.uint64(3) + keys[word]))
            self.ids.append(every)

    def counts(self, n: int, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each n-gram of order ``n`` in the training texts of the block, as
        tokens, and in all its texts, the first end signs included."""
        ids, size = self.ids[n - 1], len(self.keys[n - 1])
        use = self.counted & np.repeat(train, self.lengths) & (ids >= 0)
        return np.bincount(ids[use], minlength=size), np.bincount(ids[ids >= 0], minlength=size)

    def shared(self, n: int, often: np.ndarray | None) -> np.ndarray:
        """Numbers of the n-grams that may occur elsewhere too, in the order of their hashes.

        ``often`` says of the n-grams one shorter which occur twice or more in all texts. An
        n-gram that occurs twice begins and ends with such; any other is the
        only one of its kind, and its counts are those of this block.
        """
        chosen = np.arange(len(self.keys[n - 1]))
        if often is not None:
            chosen = np.flatnonzero(often[self.context[n - 1]] & often[self.suffix[n - 1]])
        return chosen[np.argsort(self.keys[n - 1][chosen])]


class BackoffAutomaton:
    """States are contexts seen in training; arcs carry log-probabilities.

    The probability of a word after a context of c occurrences is
    (count of both + prior * probability after the shorter context) / (c + prior),
    which adds up to one over the vocabulary and a word outside it. The state of
    a context has an arc for each word seen after it; for any other word, its
    failure arc leads to the state of the context without its first word, at the
    cost of prior / (c + prior). The empty state has an arc for every word. An
    arc leads to the state of the n-gram it reads, or, if that has full order, to the
    state of its words but the first.

    A state is a seen n-gram of less than full order, and an arc a seen n-gram;
    ``arc[n]`` and ``failure[n]`` hold their weights by n-gram number. The state before a
    token is a number of words; with the token's place it names the n-gram.
    """

    def __init__(self, counts: list[np.ndarray], block: Block, total: int, distinct: int, prior: float):
        self.block, self.seen = block, [c > 0 for c in counts]
        chance = (counts[0] + 1) / (total + distinct + 1)
        self.arc, self.failure = [np.log10(chance)], []
        for n in range(1, len(counts)):
            context, shorter = block.context[n], block.suffix[n]
            chance = (counts[n] + prior * chance[shorter]) / (counts[n - 1][context] + prior)
            self.arc.append(np.log10(chance))
            self.failure.append(np.log10(prior / (counts[n - 1] + prior)))

    def read(self, at: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read the tokens at some places, each from its state: their weights and the states after."""
        weight, after = np.zeros(len(at)), np.zeros(len(at), np.int64)
        waiting = np.arange(len(at))
        for n in range(len(self.arc) - 1, -1, -1):
            here = state[waiting] == n
            now = waiting[here]
            if not len(now):
                continue
            ids = self.block.ids[n][at[now]]
            found = self.seen[n][ids]
            if n == 0:  # the empty state has an arc for every word, a seen one leads to its state
                weight[now] += self.arc[0][ids]
                after[now] = found & (len(self.arc) > 1)
                continue
            arcs, fails = now[found], now[~found]
            weight[arcs] += self.arc[n][ids[found]]
            after[arcs] = min(n + 1, len(self.arc) - 1)
            weight[fails] += self.failure[n - 1][self.block.ids[n - 1][at[fails] - 1]]
            state[fails] = n - 1
            waiting = waiting[state[waiting] < n] if n else waiting
        return weight, after

    def weights(self, lanes: int = LANES) -> np.ndarray:
        """Log10 probability of every token of the block, in one traversal from left to right.

        The block is read in ``lanes`` at once, one token of each at a time, and every lane carries
        its state. A lane begins a few tokens before its part, as many as the longest state has
        words; whatever came before these cannot matter to the state after them. A text begins in the empty state.
        """
        block, size = self.block, len(self.block.tokens)
        weights = np.zeros(size)
        if not size:
            return weights
        warm, steps = len(self.arc) - 1, -(-size // min(lanes, size))
        begin = np.arange(0, size, steps)
        state = np.zeros(len(begin), np.int64)
        for step in range(-warm, steps):
            at = begin + step
            there = np.flatnonzero((at >= 0) & (at < size))
            at = at[there]
            state[there[block.place[at] == 0]] = 0
            weight, state[there] = self.read(at, state[there])
            if step >= 0:
                weights[at] = weight
        weights[~block.counted] = 0
        return weights


def _planes(x: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, compressed byte by byte: the first bytes of all, and so on."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _of_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def _blocks(docs: DataFrame, block_bytes: int, id_type: str) -> DataFrame:
    """The texts as a written table of blocks: compressed texts and what is needed beside."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, train, texts, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            blob = zstandard.compress(b"".join(texts), 3)
            columns = {
                "ids": pa.array([ids], pa.list_(id_kind)),
                "train": pa.array([train], pa.list_(pa.bool_())),
                "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                "texts": pa.array([blob], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for doc_id, is_train, text in zip(batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())):
                text = text.as_py() or b""
                if texts and size + len(text) > block_bytes:
                    yield block()
                    ids, train, texts, size = [], [], [], 0
                ids.append(doc_id.as_py())
                train.append(is_train.as_py())
                texts.append(text)
                size += len(text)
        if texts:
            yield block()

    schema = f"ids array<{id_type}>, train array<boolean>, sizes array<long>, texts binary"
    blocks = docs.mapInArrow(packed, schema)
    return written(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _texts(row: dict) -> list[bytes]:
    data = zstandard.decompress(row["texts"]) if sum(row["sizes"]) else b""
    ends = [0, *np.cumsum(row["sizes"]).tolist()]
    return [data[a:b] for a, b in pairwise(ends)]


def lm_scores(
    docs: DataFrame,
    train: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    prior: float = PRIOR,
    block_bytes: int = BLOCK,
) -> DataFrame:
    """Scores of every row of ``docs`` under a model of its training rows.

    Training rows are those whose crc32 of the id as text, modulo 7, is not 2
    (null ids included), or those for which the SQL condition ``train`` holds.
    A token is a word after lower-casing A to Z, or the end of a text.

    Texts are packed once into blocks. Each block lists its distinct n-grams as
    sorted 64-bit hashes with their counts; the lists are cut
    by hash and gathered, so every n-gram of the corpus is counted over all
    blocks, and each block gets the totals of its own n-grams back, in order. From three
    words on, an n-gram is listed only if the n-grams it begins and ends with occur twice
    or more: any other occurs once, and its block knows its count.
    From the totals a block builds the part of the automaton that its texts can reach and
    reads its texts through it from left to right. All that is gathered grows with the corpus and
    is spread by hash; a frequent n-gram comes once per block, not once per use.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``. ``n_known`` counts tokens seen in training, ``base_score`` adds up
    log10((c + 1) / (N + V + 1)) and ``score`` the model's log10 probabilities.
    Null text counts as empty and has one token, its end. Without training rows
    N and V are 0 and all scores are 0. Repeated rows are scored alike; an empty
    table gives no rows; other columns are not read. Memory is bounded by a
    block, or the longest text.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    trains = F.expr(train) if train else label_bucket(F.col(id_col), 7) != 2
    columns = docs.select(
        F.col(id_col).alias("id"), F.coalesce(trains, F.lit(True)).alias("train"), F.col(text_col).cast("string").alias("text")
    )
    blocks = _blocks(columns, block_bytes, id_type)
    parts = max(1, -(-blocks.count() // BLOCKS_PER_PART))
    columns_of = ["block", "train", "sizes", "texts"]

    def known(row: dict, block: Block, upto: int) -> tuple[list[np.ndarray], np.ndarray | None]:
        """Training counts over all blocks for the orders counted so far, and which n-grams of
        the last one occur twice or more."""
        train, often, totals = np.array(row["train"], bool), None, []
        for n in range(1, upto + 1):
            own, _ = block.counts(n, train)
            shared = block.shared(n, often if n > 2 else None)
            lists = sorted((t["part"], t) for t in row["totals"] if t["n"] == n)
            own[shared] = np.concatenate([_of_planes(t["trained"]) for _, t in lists]) if lists else 0
            more = np.zeros(len(own), bool)
            more[shared] = np.concatenate([_of_planes(t["often"]) for _, t in lists]) if lists else False
            often = more
            totals.append(own)
        return totals, often

    def counted(orders: list[int]):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                block = Block(_texts(row), orders[-1])
                _, often = known(row, block, orders[0] - 1) if "totals" in row else ([], None)
                for n in orders:
                    shared = block.shared(n, often if n > 2 else None)
                    keys = block.keys[n - 1][shared]
                    trained, every = (c[shared] for c in block.counts(n, np.array(row["train"], bool)))
                    part = (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
                    cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64)).tolist()
                    lists = [
                        {
                            "n": n,
                            "part": p,
                            "block": row["block"],
                            "keys": _planes(np.diff(keys[i:j], prepend=np.uint64(0))),
                            "trained": _planes(trained[i:j]),
                            "every": _planes(every[i:j]),
                        }
                        for p, (i, j) in enumerate(pairwise(cuts))
                        if i < j
                    ]
                    yield pa.RecordBatch.from_pylist(lists, schema=_LISTS)

        return count

    def summed(table: pa.Table) -> pa.Table:
        lists = [[_of_planes(x) for x in table.column(c).to_pylist()] for c in ("keys", "trained", "every")]
        sizes = [len(x) for x in lists[0]]
        distinct, at = np.unique(np.concatenate([np.cumsum(x) for x in lists[0]]), return_inverse=True)
        trained, every = (
            np.bincount(at, np.concatenate(x).astype(np.int64), len(distinct)).astype(np.int64) for x in lists[1:]
        )
        cuts = list(pairwise(np.cumsum([0, *sizes]).tolist()))
        seen, tokens = np.zeros((2, table.num_rows), np.int64)
        seen[0], tokens[0] = (trained > 0).sum(), trained.sum()
        return pa.table(
            {
                "n": table.column("n"),
                "part": table.column("part"),
                "block": table.column("block"),
                "trained": pa.array([_planes(trained[at[i:j]]) for i, j in cuts], pa.binary()),
                "often": pa.array([_planes(every[at[i:j]] > 1) for i, j in cuts], pa.binary()),
                "seen": pa.array(seen),
                "tokens": pa.array(tokens),
            }
        )

    # The first two orders are counted at once; each longer one ships only what the one before leaves open.
    totals, ready = None, blocks.select(*columns_of)
    for orders in [[1, 2][:order], *[[n] for n in range(3, order + 1)]]:
        lists = ready.mapInArrow(
            counted(orders), "n int, part int, block long, keys binary, trained binary, every binary"
        )
        found = written(
            lists.groupBy("n", "part").applyInArrow(
                summed, "n int, part int, block long, trained binary, often binary, seen long, tokens long"
            ),
            "totals",
        )
        totals = found if totals is None else totals.unionByName(found)
        returned = totals.groupBy("block").agg(
            F.collect_list(F.struct("n", "part", "trained", "often")).alias("totals")
        )
        ready = blocks.join(returned, "block").select("ids", *columns_of, "totals")
    total, distinct = totals.where("n = 1").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("seen"), F.lit(0))
    ).first()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.slice(i, 1).column("ids").flatten()
                (row,) = batch.slice(i, 1).select(["train", "sizes", "texts", "totals"]).to_pylist()
                block = Block(_texts(row), order)
                counts, _ = known(row, block, order)
                weights = BackoffAutomaton(counts, block, total, distinct, prior).weights()
                known_words = (counts[0] > 0)[block.ids[0]] & block.counted
                base = np.log10((counts[0] + 1) / (total + distinct + 1))[block.ids[0]] * block.counted
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(~np.array(row["train"], bool)),
                        pa.array(block.lengths - 1),
                        pa.array(np.add.reduceat(known_words, block.starts, dtype=np.int64)),
                        pa.array(np.full(len(ids), total, np.int64)),
                        pa.array(np.add.reduceat(base, block.starts)),
                        pa.array(np.add.reduceat(weights, block.starts)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return ready.mapInArrow(
        scored,
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield from batch.slice(i, 1).to_pylist()


_LISTS = pa.schema(
    [
        ("n", pa.int32()),
        ("part", pa.int32()),
        ("block", pa.int64()),
        ("keys", pa.binary()),
        ("trained", pa.binary()),
        ("every", pa.binary()),
    ]
)
