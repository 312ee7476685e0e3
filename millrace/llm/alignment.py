"""Alignment of the tokens of two tokenizers, with corpus counts of linked pairs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.byte_tokens import ByteEncoder, text_parts
from millrace.llm.common import written
from millrace.llm.hashing import mixed

#: The two vocabularies: ranks of byte-level tokens, and a piece model with byte fallback.
SIDE_A = public_tokenizers.path("byte_bpe_50k.tiktoken")
SIDE_B = public_tokenizers.path("piece_bpe_32k.model")
#: Bytes of text in a block, links that are sorted at once, and records of a run unpacked at once.
BLOCK, LINKS, CHUNK = 4 << 20, 1 << 22, 1 << 15
#: Tasks whose counts meet in one counting task, and the most counting tasks.
TASKS_PER_PART, MOST_PARTS = 4, 4096
#: Links of a group from which on equal ids are counted before they are paired.
WIDE = 1 << 12


class PieceEncoder:
    """Encoder for a piece model with byte fallback, which puts a space before a text."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.space = pieces.index("▁")
        # a text may be cut before a space or line end if no piece goes over one
        self.can_cut = not any(re.search("[^▁]▁|\n", piece) for piece in pieces)

    def parts(self, text: str, size: int) -> Iterator[list[int]]:
        """Ids of a space and the text, part by part."""
        for at, part in enumerate(text_parts(text, size) if self.can_cut else [text]):
            if at == 0:
                yield self.model.encode(part, num_threads=1)
            elif part == " ":
                yield [self.space]
            elif part[0] == " ":
                yield self.model.encode(part[1:], num_threads=1)
            else:  # a line end, before which the model has put its space
                yield self.model.encode(part, num_threads=1)[1:]


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as one compressed run of bytes."""
    out = [np.array([len(arrays), *[len(x) for x in arrays]], np.int64).tobytes()]
    for x in arrays:
        small = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
        out += [small.str.encode().ljust(8), x.astype(small).tobytes()]
    return zstandard.compress(b"".join(out), 1)


def _unpacked(data: bytes) -> list[np.ndarray]:
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes, at, out = np.frombuffer(data, np.int64, n, 8), 8 + 8 * n, []
    for size in sizes.tolist():
        kind = np.dtype(data[at : at + 8].strip().decode())
        out.append(np.frombuffer(data, kind, size, at + 8).astype(np.int64))
        at += 8 + kind.itemsize * size
    return out


class Run:
    """Sorted keys, each with a number, held as compressed chunks."""

    def __init__(self, keys: np.ndarray, numbers: np.ndarray, chunk: int = CHUNK):
        cuts = range(0, len(keys), chunk)
        self.chunks = [_packed(np.diff(keys[i : i + chunk], prepend=0), numbers[i : i + chunk]) for i in cuts]

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for chunk in self.chunks:
            steps, numbers = _unpacked(chunk)
            yield np.cumsum(steps), numbers


def merged_runs(runs: list[Run]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct keys in order with the sum of their numbers, by a k-way merge.

    A heap holds the last key of each run's current chunk. Up to the least of
    these, all that any run has is at hand: it is summed and given out, and the
    runs whose chunks are used up go on to the next. One chunk of each run is
    unpacked at a time.
    """
    streams = [iter(run) for run in runs]
    now: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []
    for i, stream in enumerate(streams):
        if (chunk := next(stream, None)) is not None:
            now[i] = chunk
            heap.append((int(chunk[0][-1]), i))
    heapify(heap)
    while heap:
        bound = heap[0][0]
        taken = []
        for i, (keys, numbers) in now.items():
            n = int(np.searchsorted(keys, bound, "right"))
            if n:
                taken.append((keys[:n], numbers[:n]))
                now[i] = keys[n:], numbers[n:]
        while heap and heap[0][0] == bound:
            _, i = heappop(heap)
            del now[i]
            if (chunk := next(streams[i], None)) is not None:
                now[i] = chunk
                heappush(heap, (int(chunk[0][-1]), i))
        keys, numbers = (np.concatenate(x) for x in zip(*taken))
        yield _summed(keys, numbers)


def _summed(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their numbers."""
    if not len(keys):
        return keys, numbers
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[first], np.add.reduceat(numbers, first)


def _joined(runs: list[Run]) -> tuple[np.ndarray, np.ndarray]:
    parts = list(merged_runs(runs))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, numbers = zip(*parts)
    return np.concatenate(keys), np.concatenate(numbers)


class Aligner:
    """Tokens of blocks of texts on both sides, and the groups they form."""

    def __init__(self, side_a: bytes, side_b: bytes):
        self.a, self.b = ByteEncoder(side_a, {}), PieceEncoder(side_b)
        self.sizes = [np.array([len(t) for t in side.tokens], np.int64) for side in (self.a, self.b)]
        self.n_b = len(self.b.tokens)
        n_a = len(self.a.tokens)
        # how an id is written within a group and at the end of its side
        self.written = [f"{i},".encode() for i in range(n_a)] + [f"{i}|".encode() for i in range(n_a)]
        self.written += [f"{i},".encode() for i in range(self.n_b)] + [f"{i};".encode() for i in range(self.n_b)]
        self.n_a = n_a

    def ids(self, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids on both sides; none if the bytes of either are not the text's."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        whole = " " + text
        a = np.concatenate([*self.a.parts(whole, size)]).astype(np.int64)
        listed = [i for part in self.b.parts(text, size) for i in part]
        data = whole.encode()
        for tokens, ids in ((self.a.tokens, a.tolist()), (self.b.tokens, listed)):
            if b"".join(map(tokens.__getitem__, ids)) != data:
                return none, none
        return a, np.array(listed, np.int64)


class AlignedBlock:
    """Groups of a block of texts: the bytes between two places where tokens of
    both sides end. Bytes are counted through the whole block, as every text
    ends such a group."""

    def __init__(self, aligner: Aligner, ids: list[tuple[np.ndarray, np.ndarray]]):
        self.aligner = aligner
        self.a, self.b = (np.concatenate(x) for x in zip(*ids))
        self.of_a, self.of_b = (np.array([len(pair[side]) for pair in ids], np.int64) for side in (0, 1))
        ends = [np.cumsum(sizes[x]) for sizes, x in zip(aligner.sizes, (self.a, self.b))]
        self.last_a, self.last_b = np.isin(ends[0], ends[1]), np.isin(ends[1], ends[0])
        self.group_a, self.group_b = (np.cumsum(x) - x for x in (self.last_a, self.last_b))
        groups = int(self.last_a.sum())
        self.in_a, self.in_b = (np.bincount(x, minlength=groups) for x in (self.group_a, self.group_b))
        doc_a = np.repeat(np.arange(len(ids)), self.of_a)
        self.doc = doc_a[self.last_a]  # of each group
        self.groups = np.bincount(self.doc, minlength=len(ids))
        both = self.in_a * self.in_b
        before = np.concatenate([[0], np.cumsum(both)])
        ends = np.cumsum(self.groups)
        self.links = before[ends] - before[ends - self.groups]

    def digests(self) -> list[str]:
        """SHA-256 of the groups of every text, empty for a text without tokens."""
        before_a, before_b = (np.cumsum(x) - x for x in (self.in_a, self.in_b))
        n_a = self.aligner.n_a
        out = np.empty(len(self.a) + len(self.b), np.int64)
        out[np.arange(len(self.a)) + before_b[self.group_a]] = self.a + n_a * self.last_a
        place = np.arange(len(self.b)) + (before_a + self.in_a)[self.group_b]
        out[place] = 2 * n_a + self.b + self.aligner.n_b * self.last_b
        digests, at = [], 0
        for n in (self.of_a + self.of_b).tolist():
            ids = out[at : at + n].tolist()
            at += n
            text = b"".join(map(self.aligner.written.__getitem__, ids))
            digests.append(hashlib.sha256(text[:-1]).hexdigest() if n else "")
        return digests

    def _linked(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair, text and how often, for the groups from ``first`` to before ``last``."""
        begin = [int(np.searchsorted(g, first)) for g in (self.group_a, self.group_b)]
        end = [int(np.searchsorted(g, last)) for g in (self.group_a, self.group_b)]
        group, a = self.group_a[begin[0] : end[0]], self.a[begin[0] : end[0]]
        partners = self.in_b[group]
        start_b = begin[1] + np.cumsum(self.in_b[first:last]) - self.in_b[first:last]
        which = np.repeat(np.arange(len(a)), partners)
        step = np.arange(len(which)) - np.repeat(np.cumsum(partners) - partners, partners)
        b = self.b[start_b[group[which] - first] + step]
        return a[which] * self.aligner.n_b + b, self.doc[group[which]], np.ones(len(which), np.int64)

    def _wide(self, group: int, links: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same for one group of very many links: each distinct id once."""
        (a, often_a), (b, often_b) = (
            np.unique(x[slice(*np.searchsorted(g, [group, group + 1]))], return_counts=True)
            for x, g in ((self.a, self.group_a), (self.b, self.group_b))
        )
        rows = max(1, links // len(b))
        for at in range(0, len(a), rows):
            part, often = a[at : at + rows], often_a[at : at + rows]
            pairs = (part[:, None] * self.aligner.n_b + b).ravel()
            yield pairs, np.full(len(pairs), self.doc[group]), (often[:, None] * often_b).ravel()

    def records(self, links: int = LINKS) -> tuple[np.ndarray, ...]:
        """Linked pairs of the block in order, the number of texts that hold each,
        then those texts and how often each holds it.

        Links are made, sorted and spilled to compressed runs ``links`` at a
        time, and the runs merged.
        """
        texts = max(1, len(self.groups))
        both = self.in_a * self.in_b
        wide = np.flatnonzero(both > WIDE)
        cuts, upto = [0], np.cumsum(np.where(both > WIDE, 0, both))
        while cuts[-1] < len(both):
            done = upto[cuts[-1] - 1] if cuts[-1] else 0
            after = int(np.searchsorted(upto, done + links, "right"))
            cuts.append(max(cuts[-1] + 1, after))
        runs = []

        def spill(pairs, docs, often):
            keys, sums = _summed(pairs * texts + docs, often)
            if len(keys):
                runs.append((keys, sums))

        for first, last in zip(cuts, cuts[1:]):
            at = [first - 1, *wide[(wide >= first) & (wide < last)].tolist(), last]
            spans = [self._linked(a + 1, b) for a, b in zip(at, at[1:]) if a + 1 < b]
            if spans:
                spill(*(np.concatenate(x) for x in zip(*spans)))
        for group in wide.tolist():
            for part in self._wide(group, links):
                spill(*part)
        if len(runs) == 1:
            keys, often = runs[0]
        else:
            keys, often = _joined([Run(*run) for run in runs])
        pairs, docs = keys // texts, keys % texts
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        return pairs[first], np.diff(first, append=len(pairs)), docs, often


_DOC_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")


def align_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    side_a: str = SIDE_A,
    side_b: str = SIDE_B,
    block_bytes: int = BLOCK,
    links: int = LINKS,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    Each text, with a space before it, is encoded by a byte-level vocabulary (A)
    and a piece model (B); strings of special tokens are plain text. Places where
    tokens of both sides end cut the bytes into groups, and every A token is
    linked with every B token of its group. A pair of ids counts the rows that
    hold it linked, over the whole table. ``n_best`` counts links of a pair that
    no pair of the same A id exceeds, ``count_sum`` adds up the counts of all
    links; ``groups_sha256`` is the digest of the groups' ids.

    Tasks encode texts block by block. A block's (pair, row) records are sorted,
    spilled to zstd runs and merged; the records stay with the block, and the
    number of rows per pair goes to the task's runs. At its end a task merges
    these and ships each pair once, in runs cut by a hash of the A id. A counting
    task merges the runs of all tasks through a heap, in the order of A, so that
    the counts of an A id stand together and give its maximum; then it passes
    over each run again and streams the counts back. A block adds them up by row.
    So a frequent pair crosses the network once for each task that has it, and
    nothing that is held grows with the table but the distinct pairs of a part.

    Null and empty texts, and those whose token bytes on either side are not
    their own, have no tokens: zeros and an empty digest. Repeated rows are rows
    of their own and count as such; null ids are kept; other columns are not
    read; an empty table gives no rows.
    """
    context = docs.sparkSession.sparkContext
    content = []
    for path in (side_a, side_b):
        with open(path, "rb") as file:
            content.append(context.broadcast(file.read()))
    id_type = docs.schema[id_col].dataType.simpleString()

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*[c.value for c in content])
        task, number, schema = TaskContext.get().partitionId(), 0, None
        runs: list[Run] = []
        names, ids, size = [], [], 0

        def row(**columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"task": task} | columns], schema=schema)

        def block() -> pa.RecordBatch:
            nonlocal number, names, ids, size
            done = AlignedBlock(aligner, ids)
            pairs, rows, texts, often = done.records(links)
            runs.append(Run(pairs, rows))
            out = row(
                block=number,
                ids=names,
                n_a=done.of_a.tolist(),
                n_b=done.of_b.tolist(),
                n_groups=done.groups.tolist(),
                n_links=done.links.tolist(),
                digests=done.digests(),
                records=_packed(np.diff(pairs, prepend=0), rows, texts, often),
            )
            number, names, ids, size = number + 1, [], [], 0
            return out

        for whole in batches:
            if schema is None:
                schema = pa.schema(
                    [
                        ("task", pa.int64()),
                        ("block", pa.int64()),
                        ("ids", pa.list_(whole.schema.field(0).type)),
                        *[(c, pa.list_(pa.int64())) for c in _DOC_COLUMNS],
                        ("digests", pa.list_(pa.string())),
                        ("records", pa.binary()),
                        ("counts", pa.binary()),
                    ]
                )
            for doc_id, text in zip(whole.column(0), whole.column(1)):
                text = text.as_py() or ""
                names.append(doc_id.as_py())
                ids.append(aligner.ids(text, block_bytes))
                size += len(text) + 64
                if size >= block_bytes:
                    yield block()
        if names:
            yield block()
        if runs:
            keys, counts = _joined(runs)
            yield row(counts=_packed(np.diff(keys, prepend=0), counts))

    columns = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    lists = ", ".join(f"{c} array<long>" for c in _DOC_COLUMNS)
    blocks = written(
        columns.mapInArrow(
            aligned,
            f"task long, block long, ids array<{id_type}>, {lists}, digests array<string>, records binary, counts binary",
        ),
        "aligned",
    )
    shipped = blocks.where("counts is not null").select("task", "counts")
    parts = min(MOST_PARTS, max(1, -(-shipped.count() // TASKS_PER_PART)))
    # the number of B ids tells the sides of a pair apart
    n_b = len(PieceEncoder(content[1].value).tokens)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                steps, counts = _unpacked(row["counts"])
                pairs = np.cumsum(steps)
                part = (mixed((pairs // n_b).astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                ends = np.searchsorted(part[order], np.arange(parts + 1))
                for p in range(parts):
                    own = order[ends[p] : ends[p + 1]]
                    if len(own):
                        run = Run(pairs[own], counts[own])
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([p], pa.int64()),
                                pa.array([row["task"]], pa.int64()),
                                pa.array([run.chunks], pa.list_(pa.binary())),
                            ],
                            names=["part", "task", "run"],
                        )

    def counted(table: pa.Table) -> pa.Table:
        runs = []
        for chunks in table.column("run").to_pylist():
            run = Run.__new__(Run)
            run.chunks = chunks
            runs.append(run)
        pairs, totals = _joined(runs)
        first = np.flatnonzero(np.diff(pairs // n_b, prepend=-1))
        most = np.repeat(np.maximum.reduceat(totals, first), np.diff(first, append=len(pairs)))
        best = totals == most
        back = []
        for run in runs:
            found = []
            for keys, _ in run:
                at = np.searchsorted(pairs, keys)
                found.append((keys, totals[at], best[at]))
            keys, own, top = (np.concatenate(x) for x in zip(*found))
            back.append(_packed(np.diff(keys, prepend=0), own, top.astype(np.uint8)))
        return pa.table({"task": table.column("task"), "part": table.column("part"), "back": pa.array(back, pa.binary())})

    back = (
        shipped.mapInArrow(cut, "part long, task long, run array<binary>")
        .groupBy("part")
        .applyInArrow(counted, "task long, part long, back binary")
    )
    held = blocks.where("records is not null").drop("counts")
    both = held.withColumn("back", F.lit(None).cast("binary")).unionByName(
        back.withColumnRenamed("part", "block"), allowMissingColumns=True
    )
    ordered = both.repartition("task").sortWithinPartitions("task", F.col("back").isNull(), "block")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lists, known = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                task = row.column("task")[0].as_py()
                if task != now:
                    now, lists, known = task, [], None
                data = row.column("back")[0].as_py()
                if data is not None:
                    steps, totals, best = _unpacked(data)
                    lists.append((np.cumsum(steps), totals, best))
                    continue
                if known is None:
                    keys, totals, best = (
                        (np.concatenate(x) for x in zip(*lists)) if lists else (np.zeros(0, np.int64) for _ in range(3))
                    )
                    order = np.argsort(keys)
                    known, lists = (keys[order], totals[order], best[order]), []
                ids = row.column("ids").flatten()
                steps, rows, texts, often = _unpacked(row.column("records")[0].as_py())
                at = np.searchsorted(known[0], np.cumsum(steps))
                totals, best = (np.repeat(x[at], rows) for x in known[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        *[row.column(c).flatten() for c in _DOC_COLUMNS],
                        pa.array(_sums(texts, often * best, len(ids))),
                        pa.array(_sums(texts, often * totals, len(ids))),
                        row.column("digests").flatten(),
                    ],
                    names=["doc_id", *_DOC_COLUMNS, "n_best", "count_sum", "groups_sha256"],
                )

    longs = ", ".join(f"{c} long" for c in (*_DOC_COLUMNS, "n_best", "count_sum"))
    return ordered.mapInArrow(added, f"doc_id {id_type}, {longs}, groups_sha256 string")


def _sums(at: np.ndarray, numbers: np.ndarray, size: int) -> np.ndarray:
    """Whole numbers added up by place."""
    out = np.zeros(size, np.int64)
    np.add.at(out, at, numbers)
    return out
