"""Repair of damaged conversations by a cheapest-edit programme over a grammar."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

#: Rows of a conversation in one piece, and symbols in one grammar.
PIECE, GRAMMAR = 1 << 16, 1 << 20
#: What an edit costs; an undeleted truncated row adds to it.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Faults of a row, by number.
OK, BLANK, DUPLICATE, CUT = range(4)
ROLES, OTHER = "sua", 3
#: States: nothing put out yet, after s, after u, after a; what may follow each.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FOLLOWING = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
#: The state after a user or assistant row that an edit makes, and the rows to add at the end.
MADE = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
CLOSING = {START: 0, AFTER_S: 2, AFTER_U: 1, AFTER_A: 0}
NEVER = 1 << 40

_WORD = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def damage(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Rows ``conv_id, turn, role, text, copies`` after the damage that crc32 of
    ``conv_id:turn`` modulo 20 chooses.

    0 drops the row, 1 empties its text, 2 takes the marks ``. ! ?`` out of it, 3
    repeats it (``copies`` is 2), 4 gives it the role user. A null id or turn
    counts as one space there, a null role or text is one space. Other columns
    are not read; an empty table gives no rows.
    """
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(as_text(id_col), F.lit(":"), as_text(turn_col)).cast("binary")) % 20
    text = as_text(text_col)
    return (
        conversations.select(
            F.col(id_col).alias("conv_id"),
            F.col(turn_col).try_cast("long").alias("turn"),
            F.when(code == 4, F.lit("user")).otherwise(as_text(role_col)).alias("role"),
            F.when(code == 1, F.lit(""))
            .when(code == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            F.when(code == 3, 2).otherwise(1).cast("long").alias("copies"),
            code.alias("_code"),
        )
        .where("_code <> 0")
        .drop("_code")
    )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _marked(rows: DataFrame) -> DataFrame:
    """One small row for each distinct row: its digest, its faults, how often it stands."""
    text = F.col("text")
    light = rows.select(
        "conv_id",
        "turn",
        "role",
        _digest(text).alias("digest"),
        (~text.rlike(_WORD)).alias("blank"),
        (~text.rlike(_ENDED)).alias("cut"),
        "copies",
    )
    counted = light.groupBy("conv_id", "turn", "role", "digest", "blank", "cut").agg(F.sum("copies").alias("copies"))
    counted = written(counted, "turns")
    first = counted.groupBy("conv_id", "role", "digest").agg(
        F.max(F.col("turn").isNull()).alias("null_first"), F.min("turn").alias("first_turn")
    )
    # null-safe, and a sort-merge join, whose hot keys Spark splits
    at = counted.alias("a").join(
        first.alias("b"),
        F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
        & (F.col("a.role") == F.col("b.role"))
        & (F.col("a.digest") == F.col("b.digest")),
    )
    return at.select(
        "a.conv_id",
        "turn",
        "a.role",
        "a.digest",
        F.when(F.col("a.role") == "", OTHER)
        .otherwise((F.instr(F.lit(ROLES), F.substring("a.role", 1, 1)) + 3) % 4)
        .alias("initial"),
        F.when(F.col("blank"), BLANK)
        .when(~F.when(F.col("null_first"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first_turn")), DUPLICATE)
        .when(F.col("cut"), CUT)
        .otherwise(OK)
        .alias("fault"),
        F.when(F.col("blank"), BLANK).otherwise(DUPLICATE).alias("again"),
        "copies",
    )


def _pieces(rows: DataFrame) -> DataFrame:
    """Conversations as strings of symbols, one byte for each row, in a written table.

    Rows are sorted over all tasks by conversation, turn, role and digest, so one
    conversation may reach over many tasks; pieces of such are ``open``.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    keys = ("conv_id", "turn", "role", "digest")
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, schema = TaskContext.get().partitionId() << 33, None
        now, symbols, least, most, turns = None, bytearray(), None, None, 0
        in_first, cut_before, begun = True, False, False
        ready: list[dict] = []

        def end_piece(is_open: bool) -> None:
            nonlocal at, symbols, least, most, turns
            row = {"conv_id": now, "at": at, "open": is_open, "symbols": bytes(symbols)}
            ready.append(row | {"least": least, "most": most, "turns": turns})
            at, symbols, least, most, turns = at + 1, bytearray(), None, None, 0

        for batch in batches:
            if schema is None:
                schema = pa.schema([batch.schema.field(0), *_PIECE_FIELDS])
            for conv_id, turn, initial, fault, again, copies in zip(*map(pa.Array.to_pylist, batch.columns)):
                if begun and conv_id != now:
                    if symbols:
                        end_piece(in_first or cut_before)
                    in_first, cut_before = False, False
                now, begun, role = conv_id, True, initial << 2
                symbols.append(role | fault)
                if turn is not None and turn != most:
                    least, most, turns = turn if least is None else least, turn, turns + 1
                while copies > 1 or len(symbols) >= PIECE:
                    if len(symbols) >= PIECE:
                        end_piece(True)
                        cut_before = True
                        if turn is not None and copies > 1:
                            least, most, turns = turn, turn, 1
                    some = min(copies - 1, PIECE)
                    symbols += bytes([role | again]) * some
                    copies -= some
            if ready:
                yield pa.RecordBatch.from_pylist(ready, schema=schema)
                ready = []
        if symbols:
            end_piece(True)  # the conversation may go on in the next task
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=schema)

    columns = f"conv_id {id_type}, at long, open boolean, symbols binary, least long, most long, turns long"
    return written(ordered.select("conv_id", "turn", "initial", "fault", "again", "copies").mapInArrow(cut, columns), "pieces")


_PIECE_FIELDS = [
    pa.field("at", pa.int64()),
    pa.field("open", pa.bool_()),
    pa.field("symbols", pa.binary()),
    pa.field("least", pa.int64()),
    pa.field("most", pa.int64()),
    pa.field("turns", pa.int64()),
]


class Transfer:
    """Cheapest edits of a string of rows from each state to each state.

    ``cost`` is min-plus; ``rank`` orders, for one state before, the audits that
    lead to the states after by their letters. Two such audits differ and neither
    begins the other, because letters and rows fix the state; so the first part
    of a joined audit decides unless it is the same, and ranks are enough to
    break ties. ``audits`` is a rope: letters for a single row, else the two
    parts and the state between them.
    """

    __slots__ = ("cost", "rank", "between", "parts", "letters")

    def __init__(self, cost, rank, between=None, parts=None, letters=None):
        self.cost, self.rank, self.between, self.parts, self.letters = cost, rank, between, parts, letters

    @classmethod
    def of_row(cls, symbol: int) -> "Transfer":
        """Rows to insert before one row, then what becomes of it."""
        initial, fault = ROLES[symbol >> 2] if symbol >> 2 != OTHER else "", symbol & 3
        best: dict[tuple[int, int], tuple[int, str]] = {}
        for i in range(4):
            state, cost, audit = i, 0, ""
            for _ in range(4):
                ways = [(state, DELETE, "D")]
                if fault in (OK, CUT):
                    extra = TRUNCATED if fault == CUT else 0
                    ways.append((MADE[state], REROLE + extra, "R"))
                    if initial in FOLLOWING[state]:
                        ways.append((FOLLOWING[state][initial], extra, "K"))
                for j, more, letter in ways:
                    way = (cost + more, audit + letter)
                    best[i, j] = min(best.get((i, j), way), way)
                state, cost, audit = MADE[state], cost + INSERT, audit + "I"
        cost = np.full((4, 4), NEVER, np.int64)
        rank = np.zeros((4, 4), np.int64)
        for (i, j), (c, _) in best.items():
            cost[i, j] = c
        for i in range(4):
            order = sorted(range(4), key=lambda j: (0, best[i, j][1]) if (i, j) in best else (1, ""))
            rank[i, order] = np.arange(4)
        return cls(cost, rank, letters={at: audit.encode() for at, (_, audit) in best.items()})

    def then(self, other: "Transfer") -> "Transfer":
        ways = (self.cost[:, :, None] + other.cost[None, :, :]) * 4 + self.rank[:, :, None]
        between = ways.argmin(1)
        cost = np.minimum(ways.min(1) >> 2, NEVER)
        order = np.take_along_axis(self.rank, between, 1) * 4 + other.rank[between, np.arange(4)]
        order[cost >= NEVER] += 16
        rank = order.argsort(1, kind="stable").argsort(1, kind="stable")
        return Transfer(cost, rank, between, (self, other))

    def audit(self, i: int, j: int) -> bytes:
        """The rope from state ``i`` to state ``j``, written out from left to right."""
        out, waiting = [], [(self, i, j)]
        while waiting:
            part, i, j = waiting.pop()
            if part.letters is not None:
                out.append(part.letters[i, j])
                continue
            k = int(part.between[i, j])
            waiting += [(part.parts[1], k, j), (part.parts[0], i, k)]
        return b"".join(out)


def re_pair(sequences: list[list[int]], first_rule: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules and shortened sequences: the most frequent pair of neighbours becomes
    a new symbol, until no pair is left twice. Rule n has the symbol ``first_rule + n``."""
    symbol = [x for s in sequences for x in (*s, -1)]
    size = len(symbol)
    after, before = [*range(1, size + 1)], [*range(-1, size - 1)]
    places: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i in range(size - 1):
        if symbol[i] >= 0 and symbol[i + 1] >= 0:
            places[symbol[i], symbol[i + 1]].add(i)
    queue = [(-len(at), pair) for pair, at in places.items() if len(at) > 1]
    heapify(queue)
    rules: list[tuple[int, int]] = []
    while queue:
        count, pair = heappop(queue)
        at = places[pair]
        if len(at) != -count:
            if len(at) > 1:
                heappush(queue, (-len(at), pair))
            continue
        name, changed = first_rule + len(rules), set()
        rules.append(pair)
        for i in sorted(at):
            j = after[i]
            if symbol[i] != pair[0] or j >= size or symbol[j] != pair[1] or i not in at:
                continue  # the last place took one of the two
            h, k = before[i], after[j]
            if h >= 0 and symbol[h] >= 0:
                places[symbol[h], symbol[i]].discard(h)
                places[symbol[h], name].add(h)
                changed.add((symbol[h], name))
            if symbol[k] >= 0:
                places[symbol[j], symbol[k]].discard(j)
                places[name, symbol[k]].add(i)
                changed.add((name, symbol[k]))
            symbol[i], symbol[j] = name, -2
            after[i], before[k] = k, i
        del places[pair]
        for new in changed:
            if len(places[new]) > 1:
                heappush(queue, (-len(places[new]), new))
    short: list[list[int]] = [[]]
    i = 0
    while i < size:
        if symbol[i] == -1:
            short.append([])
        else:
            short[-1].append(symbol[i])
        i = after[i]
    return rules, short[:-1]


def transfers(pieces: Iterable[bytes]) -> dict[bytes, Transfer]:
    """The transfer of every distinct piece, through one grammar for all of them."""
    distinct = sorted(set(pieces))
    # rows that must go are alike whatever their role
    codes = [[x if x & 3 in (OK, CUT) else 16 for x in piece] for piece in distinct]
    rules, short = re_pair(codes, 17)
    known = [Transfer.of_row(x) for x in range(16)] + [Transfer.of_row(BLANK)]
    for left, right in rules:  # both are known: a rule names earlier symbols only
        known.append(known[left].then(known[right]))
    found = {}
    for piece, symbols in zip(distinct, short):
        parts = [known[x] for x in symbols]
        while len(parts) > 1:
            parts = [a.then(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1 :]
        found[piece] = parts[0]
    return found


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, dict[bytes, Transfer]]]:
    """Tables of pieces that share one grammar of bounded size, and their transfers."""
    waiting, size = [], 0
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            waiting.append(whole.slice(start, 1024))
            size += waiting[-1].column("symbols").nbytes
            if size >= GRAMMAR:
                block = pa.Table.from_batches(waiting)
                yield block, transfers(block.column("symbols").to_pylist())
                waiting, size = [], 0
    if waiting:
        block = pa.Table.from_batches(waiting)
        yield block, transfers(block.column("symbols").to_pylist())


def _with(block: pa.Table, kept: tuple[str, ...], more: list[dict], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Some columns of a block and those of ``more``, row by row."""
    table = block.select(list(kept))
    for name, kind in kinds.items():
        table = table.append_column(name, pa.array([row[name] for row in more], kind))
    yield from table.combine_chunks().to_batches()


def _last_state(cost: np.ndarray, rank: np.ndarray) -> int:
    """The state to end in: cheapest with the rows to add, then by letters."""
    return min(range(4), key=lambda j: (int(cost[START, j]) + INSERT * CLOSING[j], int(rank[START, j])))


def _legal(before: int, after: int) -> bool:
    return (before, after) in ((0, 1), (1, 2), (2, 1))


def _faults(symbols: bytes) -> dict[str, int]:
    """Faulty rows by kind, and neighbours whose roles do not follow each other."""
    codes = np.frombuffer(symbols, np.uint8).astype(np.int64)
    counts = np.bincount(codes & 3, minlength=4).tolist()
    steps = np.bincount((codes[:-1] >> 2) * 4 + (codes[1:] >> 2), minlength=16)
    illegal = sum(int(n) for at, n in enumerate(steps) if not _legal(at >> 2, at & 3))
    return {"blank": counts[BLANK], "duplicate": counts[DUPLICATE], "truncated": counts[CUT], "illegal": illegal}


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_LONGS = dict.fromkeys(_COUNTS, pa.int64())
_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _gaps(least: int | None, most: int | None, turns: int) -> int:
    return 0 if least is None else most - least + 1 - turns


def _whole(pieces: DataFrame, id_type: str) -> DataFrame:
    """Summaries of conversations that one task held in one piece."""
    kinds = {"gaps": pa.int64()} | _LONGS | {"cost": pa.int64(), "audit": pa.string()}

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, by_symbols in _in_blocks(batches):
            solved = {}
            for symbols, t in by_symbols.items():
                end = _last_state(t.cost, t.rank)
                cost = int(t.cost[START, end]) + INSERT * CLOSING[end]
                audit = (t.audit(START, end) + b"I" * CLOSING[end]).decode()
                solved[symbols] = _faults(symbols) | {"cost": cost, "audit": audit}
            rows = block.select(["symbols", "least", "most", "turns"]).to_pylist()
            more = [solved[r["symbols"]] | {"gaps": _gaps(r["least"], r["most"], r["turns"])} for r in rows]
            yield from _with(block, ("conv_id",), more, kinds)

    return pieces.select("conv_id", "symbols", "least", "most", "turns").mapInArrow(solve, f"conv_id {id_type}, {_SUMMARY}")


def _over_tasks(pieces: DataFrame, id_type: str) -> DataFrame:
    """Summaries of conversations in several pieces.

    Each piece gives its transfer without letters, a small row; their product
    over a conversation tells the states between pieces; then each piece writes
    its own part of the audit.
    """
    small = {"cost": pa.list_(pa.int64()), "rank": pa.list_(pa.int64())} | _LONGS | {"head": pa.int64(), "tail": pa.int64()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, by_symbols in _in_blocks(batches):
            more = []
            for symbols in block.column("symbols").to_pylist():
                t = by_symbols[symbols]
                ends = {"head": symbols[0] >> 2, "tail": symbols[-1] >> 2}
                more.append(_faults(symbols) | ends | {"cost": t.cost.ravel().tolist(), "rank": t.rank.ravel().tolist()})
            yield from _with(block, ("conv_id", "at", "least", "most", "turns"), more, small)

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    measured = pieces.select("conv_id", "at", "symbols", "least", "most", "turns").mapInArrow(
        measure,
        f"conv_id {id_type}, at long, least long, most long, turns long, cost array<long>, rank array<long>, "
        f"{counts}, head long, tail long",
    )
    ways = {"at": pa.int64(), "i": pa.int64(), "j": pa.int64(), "closing": pa.int64(), "gaps": pa.int64()} | _LONGS | {"cost": pa.int64()}

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        rows = table.drop_columns(["conv_id"]).to_pylist()
        steps = [Transfer(np.array(r["cost"]).reshape(4, 4), np.array(r["rank"]).reshape(4, 4)) for r in rows]
        upto = [steps[0]]
        for step in steps[1:]:
            upto.append(upto[-1].then(step))
        end = _last_state(upto[-1].cost, upto[-1].rank)
        states = [end]
        for t in upto[:0:-1]:
            states.append(int(t.between[START, states[-1]]))
        states = [START, *states[::-1]]
        totals = {c: sum(r[c] for r in rows) for c in _COUNTS}
        totals["illegal"] += sum(not _legal(a["tail"], b["head"]) for a, b in zip(rows, rows[1:]))
        totals["cost"] = int(upto[-1].cost[START, end]) + INSERT * CLOSING[end]
        known = [r for r in rows if r["least"] is not None]
        turns = sum(r["turns"] for r in known) - sum(a["most"] == b["least"] for a, b in zip(known, known[1:]))
        totals["gaps"] = _gaps(known[0]["least"], known[-1]["most"], turns) if known else 0
        more = [
            totals | {"at": r["at"], "i": states[n], "j": states[n + 1], "closing": CLOSING[end] * (n == len(rows) - 1)}
            for n, r in enumerate(rows)
        ]
        return pa.Table.from_batches(_with(table, ("conv_id",), more, ways))

    path = written(
        measured.groupBy("conv_id").applyInArrow(
            joined, f"conv_id {id_type}, at long, i long, j long, closing long, gaps long, {counts}, cost long"
        ),
        "path",
    )

    def write_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, by_symbols in _in_blocks(batches):
            rows = block.select(["symbols", "i", "j", "closing"]).to_pylist()
            audits = [by_symbols[r["symbols"]].audit(r["i"], r["j"]) + b"I" * r["closing"] for r in rows]
            yield from _with(block, ("at",), [{"audit": a.decode()} for a in audits], {"audit": pa.string()})

    audits = pieces.select("at", "symbols").join(path.select("at", "i", "j", "closing"), "at")
    audits = audits.mapInArrow(write_out, "at long, audit string")
    totals = [F.max(c).alias(c) for c in ("gaps", *_COUNTS, "cost")]
    parts = F.sort_array(F.collect_list(F.struct("at", "audit")))
    return (
        path.drop("i", "j", "closing")
        .join(audits, "at")
        .groupBy("conv_id")
        .agg(*totals, F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"))
    )


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every
    conversation in ``rows`` (``conv_id, turn, role, text, copies``, as ``damage`` gives).

    Rows stand by turn, nulls first, then by role and the SHA-256 digest of their
    text; ``copies`` of a row stand together. A row's first fault counts: blank,
    duplicate (role and text stood before), truncated (the last character that is
    no space is none of ``. ! ?``). ``gaps`` counts whole turns missing between
    the least and the most; ``illegal`` counts neighbours whose initials are not
    su, ua or au. An empty role has no legal initial.

    ``cost`` and ``audit`` are those of the cheapest edits after which the
    initials are ``(s?(ua)+)?``, ties by letters: K keeps a row, R gives it the
    role user or assistant (1), D deletes it (2; a blank or duplicate row must
    go), I inserts an empty row (5); a truncated row that stays costs 5 more.

    A row becomes one symbol of role and fault. Distinct strings of symbols in a
    task are compressed by one grammar (Re-Pair). Every rule has one min-plus
    matrix over the states of the pattern with a rope of letters, made from the
    matrices of its two parts, so what conversations share is worked out once.
    A conversation over several tasks is joined from its pieces' matrices, so no
    task holds it as a whole; identical rows are counted before they are sorted.
    Null ids are one conversation. Rows repeated in the table are duplicates of
    one another. An empty table gives no rows.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    pieces = _pieces(_marked(rows))
    whole = _whole(pieces.where("not open"), id_type)
    return written(whole.unionByName(_over_tasks(pieces.where("open"), id_type)), "summary")


def _edited(rows: DataFrame, summary: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work`` over (conv_id, audit) rows, each followed by its conversation's rows in order."""
    none = F.lit(None)
    audits = summary.select(
        "conv_id",
        F.lit(0).alias("kind"),
        none.cast("long").alias("turn"),
        none.cast("string").alias("role"),
        none.cast("binary").alias("digest"),
        F.col("audit").alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )
    texts = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", _digest(F.col("text")).alias("digest"), "text", "copies")
    both = audits.unionByName(texts).repartition("conv_id")
    ordered = both.sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return ordered.select("conv_id", "kind", "role", "text", "copies").mapInArrow(work, schema)


def _rows_after(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, bool, str, str]]:
    """(conv_id, is_new, role, text) of every row that the audits leave; a conversation
    begins with (conv_id, True, "", ""). One row and one audit are held at a time."""
    audit, at, state, conv_id = "", 0, START, None

    def inserted():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, MADE[state]
            yield conv_id, False, "user" if state == AFTER_U else "assistant", ""

    for batch in batches:
        for new_id, kind, role, text, copies in zip(*map(pa.Array.to_pylist, batch.columns)):
            if kind == 0:
                yield from inserted()
                audit, at, state, conv_id = text, 0, START, new_id
                yield conv_id, True, "", ""
                continue
            for _ in range(copies):
                yield from inserted()
                letter, at = audit[at], at + 1
                if letter == "R":
                    state = MADE[state]
                    yield conv_id, False, "user" if state == AFTER_U else "assistant", text
                elif letter == "K":
                    state = FOLLOWING[state][role[0]]
                    yield conv_id, False, role, text
    yield from inserted()


def repaired_rows(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """``conv_id, position, role, text`` of the conversations after ``repair``'s edits,
    positions from 0. A conversation streams through one task, row by row."""
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, ready, position = None, [], 0

        def seen():
            nonlocal schema
            for batch in batches:
                texts = [pa.field("position", pa.int64()), pa.field("role", pa.string()), pa.field("text", pa.string())]
                schema = pa.schema([batch.schema.field(0), *texts])
                yield batch

        for conv_id, is_new, role, text in _rows_after(seen()):
            if is_new:
                position = 0
                continue
            ready.append({"conv_id": conv_id, "position": position, "role": role, "text": text})
            position += 1
            if len(ready) >= 1024:
                yield pa.RecordBatch.from_pylist(ready, schema=schema)
                ready = []
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=schema)

    return _edited(rows, summary, work, f"conv_id {id_type}, position long, role string, text string")


def repaired_digests(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: the digest of each repaired conversation as
    ``role:text`` lines. A digest runs from a text's beginning to its end, so a
    conversation streams through one task, which holds one row of it at a time."""
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, ready, now, digest, empty = None, [], None, None, True

        def seen():
            nonlocal schema
            for batch in batches:
                schema = pa.schema([batch.schema.field(0), pa.field("repaired_sha256", pa.string())])
                yield batch

        for conv_id, is_new, role, text in _rows_after(seen()):
            if is_new:
                if digest is not None:
                    ready.append({"conv_id": now, "repaired_sha256": digest.hexdigest()})
                now, digest, empty = conv_id, hashlib.sha256(), True
                if len(ready) >= 4096:
                    yield pa.RecordBatch.from_pylist(ready, schema=schema)
                    ready = []
                continue
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
        if digest is not None:
            ready.append({"conv_id": now, "repaired_sha256": digest.hexdigest()})
            yield pa.RecordBatch.from_pylist(ready, schema=schema)

    return _edited(rows, summary, work, f"conv_id {id_type}, repaired_sha256 string")


def repair_report(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Damage, repair and digest of every conversation of a table, those that lose
    all rows included: they have zeros, an empty audit and the digest of no text."""
    rows = damage(conversations, id_col, turn_col, role_col, text_col)
    summary = repair(rows)
    ids = conversations.select(F.col(id_col).alias("conv_id")).distinct().alias("ids")
    same = lambda name: F.col("ids.conv_id").eqNullSafe(F.col(f"{name}.conv_id"))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", *_COUNTS, "cost")]
    return (
        ids.join(summary.alias("s"), same("s"), "left")
        .join(repaired_digests(rows, summary).alias("d"), same("d"), "left")
        .select(
            "ids.conv_id",
            *counts,
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )
