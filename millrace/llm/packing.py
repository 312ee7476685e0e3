"""Packing documents into token sequences by hierarchical residual best fit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.byte_tokens import ByteEncoder
from millrace.llm.common import written

#: Ranks of the byte-level vocabulary, its special token and the id that ends a document.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
SPECIAL = {"<|endoftext|>": 50256}
END_ID = 2
#: Tokens of a sequence; tokens from which on a bin counts as nearly full.
LENGTH, FULL = 1024, 1020
#: Ids that are packed at once in a task, and nodes that meet in a node of the next round.
BLOCK, FAN = 1 << 24, 16
class BestFit:
    """Bins of one capacity; an item goes to the bin it leaves the least room in.

    Bins stand in a list for each room left; a bit mask of the lists in use finds
    the tightest one that an item fits in.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.used = 0
        self.loads: list[int] = []

    def put(self, size: int) -> tuple[int, int]:
        """The bin that takes an item, and the item's place in it."""
        fitting = self.used >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bins = self.rooms[room]
            number = bins.pop()
            if not bins:
                self.used ^= 1 << room
        else:
            room, number = self.capacity, len(self.loads)
            self.loads.append(0)
        at = self.capacity - room
        self.loads[number] = at + size
        left = room - size
        if left:
            self.rooms[left].append(number)
            self.used |= 1 << left
        return number, at


def _round(opened: DataFrame, fan: int, length: int, full: int, small: int) -> DataFrame:
    """Bins of up to ``fan`` nodes as items of one best fit.

    Returns ``node, bin, load, parent, place, open``: the bin that a bin went
    into (itself, if it stays one) and where, its load now, and whether the next
    round sees it. Of bins that are more than half full and as full as each other
    no more than ``small`` go on, the number of bins that are half full or less: each of
    those can be put into one of them only, and two of the fuller never meet.
    """

    def merge(table: pa.Table) -> pa.Table:
        node = table.column("node")[0].as_py() // fan
        ids, loads = table.column("bin").to_numpy(), table.column("load").to_numpy()
        order = np.lexsort((ids, -loads))
        packed = BestFit(length)
        heads: list[int] = []
        parent, place = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
        for i in order.tolist():
            number, at = packed.put(int(loads[i]))
            if number == len(heads):
                heads.append(int(ids[i]))
            parent[i], place[i] = heads[number], at
        left = dict(zip(heads, packed.loads))
        goes_on, alike = np.zeros(len(ids), bool), np.zeros(length + 1, np.int64)
        now = np.array([left[p] for p in parent.tolist()], np.int64)
        for i in order.tolist():
            load = now[i]
            if parent[i] == ids[i] and load < full:
                goes_on[i] = 2 * load <= length or alike[load] < small
                alike[load] += 1
        return pa.table(
            {
                "node": np.full(len(ids), node),
                "bin": ids,
                "load": now,
                "parent": parent,
                "place": place,
                "open": goes_on,
            }
        )

    return opened.groupBy(F.floor(F.col("node") / fan).alias("group")).applyInArrow(
        merge, "node long, bin long, load long, parent long, place long, open boolean"
    )


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    special: dict[str, int] | None = None,
    end_id: int = END_ID,
    length: int = LENGTH,
    full: int = FULL,
    block: int = BLOCK,
    fan: int = FAN,
) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset`` of every piece of every document.

    A document is its text's ids, as the tokenizers library gives them, and
    ``end_id``. One longer than ``length`` is cut into pieces of that length, of which the
    first may be shorter; ``start`` counts its ids before the piece. ``ids`` are
    little-endian unsigned 32-bit integers. Pieces with one ``sequence_id`` make
    a sequence of ``length`` ids at most; ``offset`` is the piece's place in it,
    without gaps.

    Every task packs its own pieces, longest first, into the bins they fit best, up
    to about ``block`` ids at a time, so each such node leaves one bin at most that is
    half full or less. Nearly full bins (``full`` ids or more) are final. The others become items of the node above,
    which packs the bins of ``fan`` nodes in the same way, and so on to a single
    root; only bins that may still be joined go up, as two numbers each. A join
    takes one of the bins half full or less, so there are fewer joins than
    twice the nodes of the first round, and the table of them is
    broadcast to the pieces. Texts are read once and never shuffled.

    Null text counts as empty and has the end id alone. Repeated rows are packed
    as often as they stand; null ids are kept; other columns are not read; an
    empty table gives no rows. Long texts are encoded a part at a time.
    """
    if not 0 < full <= length:
        raise ValueError("full must be between 1 and length")
    special = SPECIAL if special is None else special
    with open(vocabulary, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    id_type = docs.schema[id_col].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(content.value, special)
        node = TaskContext.get().partitionId() << 20
        number = node << 20
        end = np.array([end_id], "<u4")
        schema, rows, lengths, size = None, [], [], 0

        def block_out() -> Iterator[pa.RecordBatch]:
            nonlocal node, number, rows, lengths, size
            bins = BestFit(length)
            order = np.argsort(-np.array(lengths), kind="stable")
            places = np.empty((len(rows), 2), np.int64)
            for i in order.tolist():
                places[i] = bins.put(lengths[i])
            loads = np.array(bins.loads, np.int64)[places[:, 0]]
            for at in range(0, len(rows), 512):
                part = slice(at, at + 512)
                columns = list(zip(*rows[part]))
                columns += [np.full(len(columns[0]), node), number + places[part, 0], places[part, 1], loads[part]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            node, number, rows, lengths, size = node + 1, number + len(bins.loads), [], [], 0

        for whole in batches:
            if schema is None:
                schema = pa.schema([whole.schema.field(0), *_PIECE_FIELDS])
            for doc_id, text in zip(whole.column(0), whole.column(1)):
                doc_id = doc_id.as_py()
                ids = np.concatenate([*encoder.parts(text.as_py() or ""), end]).astype("<u4")
                first = len(ids) % length or min(length, len(ids))
                cuts = [0, *range(first, len(ids) + 1, length)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, piece, a, b - a, ids[a:b].tobytes()))
                    lengths.append(b - a)
                size += len(ids)
                if size >= block:
                    yield from block_out()
        if rows:
            yield from block_out()

    columns = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    pieces = written(
        columns.mapInArrow(
            packed,
            f"doc_id {id_type}, piece int, start long, length long, ids binary, node long, bin long, place long, load long",
        ),
        "packed",
    )

    # the first piece put into a bin stands for it
    state = written(
        pieces.where((F.col("place") == 0) & (F.col("load") < full)).select("node", "bin", "load"), "open"
    )
    joins = []
    half = F.col("load") * 2 <= length
    nodes, small = state.agg(F.count_distinct("node"), F.count_if(half)).first()
    # nodes as 0, 1, 2, ...: tasks and their blocks in order
    numbers = {n: i for i, n in enumerate(sorted(r[0] for r in state.select("node").distinct().collect()))}
    renumbered = docs.sparkSession.createDataFrame(list(numbers.items()), "node long, number long")
    state = state.join(F.broadcast(renumbered), "node").select(F.col("number").alias("node"), "bin", "load")
    while nodes > 1 and small:
        state = written(_round(state, fan, length, full, small), "round")
        joins.append(state.where("parent <> bin").select("bin", "parent", "place"))
        state = state.where("open").select("node", "bin", "load")
        nodes, small = state.agg(F.count_distinct("node"), F.count_if(half)).first()

    # fewer than two for each node of the first round
    moved: dict[int, tuple[int, int]] = {}
    for table in reversed(joins):
        for bin_id, parent, place in table.collect():
            root, at = moved.get(parent, (parent, 0))
            moved[bin_id] = root, at + place
    moves = docs.sparkSession.createDataFrame(
        [(b, root, at) for b, (root, at) in moved.items()], "bin long, root long, at long"
    )
    return pieces.join(F.broadcast(moves), "bin", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids",
        F.coalesce("root", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("at", F.lit(0))).alias("offset"),
    )


_PIECE_FIELDS = [
    pa.field("piece", pa.int32()),
    pa.field("start", pa.int64()),
    pa.field("length", pa.int64()),
    pa.field("ids", pa.binary()),
    pa.field("node", pa.int64()),
    pa.field("bin", pa.int64()),
    pa.field("place", pa.int64()),
    pa.field("load", pa.int64()),
]
