"""Conversation repair against an exhaustive search, in one piece and over many."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from millrace.llm import conversations
from millrace.llm.conversations import damage, re_pair, repair, repair_report, repaired_rows, transfers

SCHEMA = "conv_id long, turn long, role string, text string, digest string, copies long"


def damaged(rows):
    out = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv_id, turn)]
        code = zlib.crc32(":".join(shown).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        out[conv_id]
        if code == 0:
            continue
        role = "user" if code == 4 else role
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        out[conv_id] += [(turn, role, text)] * (2 if code == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return {i: sorted(found, key=order) for i, found in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip("\t\n\x0b\x0c\r ")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, found):
    """All ways to edit, pruned only by cost; (cost, audit, repaired rows)."""
    best = [(1 << 60, "", [])]

    def go(n, shown, cost, audit, kept, inserts):
        if cost > best[0][0]:
            return
        if n == len(rows) and re.fullmatch("(s?(ua)+)?", shown):
            best[0] = min(best[0], (cost, audit, kept))
        follow = "a" if shown.endswith("u") else "u"
        name = {"u": "user", "a": "assistant"}[follow]
        if inserts < 2:
            go(n, shown + follow, cost + 5, audit + "I", [*kept, (name, "")], inserts + 1)
        if n == len(rows):
            return
        _, role, text = rows[n]
        go(n + 1, shown, cost + 2, audit + "D", kept, 0)
        if found[n] in ("", "truncated"):
            extra = 5 * (found[n] == "truncated")
            go(n + 1, shown + follow, cost + 1 + extra, audit + "R", [*kept, (name, text)], 0)
            if role[:1] == follow or role[:1] == "s" and not shown:
                go(n + 1, shown + role[0], cost + extra, audit + "K", [*kept, (role, text)], 0)

    go(0, "", 0, "", [], 0)
    return best[0]


def expected(rows):
    out = {}
    for conv_id, found in damaged(rows).items():
        faulty = faults(found)
        turns = sorted({r[0] for r in found if r[0] is not None})
        gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit, kept = cheapest(found, faulty) if found else (0, "", [])
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = [faulty.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv_id] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def random_rows(seed, conversations_, length):
    pick = random.Random(seed)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None, "User"]
    texts = ["Fine.", "so be it", "Well? ", "\t", "", None, "Ending\n\n", "ok!", "é.", "Ünd \x0b"]
    return [
        (None if c == 1 else c, None if pick.random() < 0.1 else pick.randrange(12), pick.choice(roles), pick.choice(texts) and pick.choice(texts))
        for c in range(conversations_)
        for _ in range(pick.randint(1, length))
    ]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("piece", [1 << 16, 3])
def test_reports(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rows = random_rows(11, 60, 7) + [(77, t, r, x) for t, r, x in [(1, "user", "Hi."), (1, "user", "Hi."), (9, "user", "Hi.")]]
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_report(table(spark, rows)).collect()}
    assert got == expected(rows)


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 16)
    pick = random.Random(2)
    rows = [(5, t, pick.choice(["user", "assistant"]), f"Text {pick.randrange(300)}{pick.choice('..!x')}") for t in range(400)]
    rows += [(5, 7, "user", "Again and again.")] * 50 + [(6, 1, "user", "Hello."), (6, 2, "assistant", "Hello.")]
    monkeypatch.setattr(conversations, "GRAMMAR", 64)
    summary = repair(damage(table(spark, rows)))
    many = {r["conv_id"]: tuple(r) for r in summary.collect()}
    monkeypatch.undo()
    whole = {r["conv_id"]: tuple(r) for r in repair(damage(table(spark, rows).coalesce(1))).collect()}
    assert many == whole
    found = damaged(rows)[5]
    symbols = bytes(
        ("sua".find(r[1][0]) << 2) | ["", "blank", "duplicate", "truncated"].index(f) for r, f in zip(found, faults(found))
    )
    t = transfers([symbols])[symbols]
    end = conversations._last_state(t.cost, t.rank)
    assert many[5][-2:] == (
        int(t.cost[0, end]) + 5 * conversations.CLOSING[end],
        t.audit(0, end).decode() + "I" * conversations.CLOSING[end],
    )
    assert many[5][3] == faults(found).count("duplicate") >= 49
    out = repaired_rows(damage(table(spark, rows)), summary).where("conv_id = 5").orderBy("position").collect()
    assert [r["position"] for r in out] == list(range(len(out))) and len(out) % 2 == 0
    assert {r["role"] for r in out[::2]} == {"user"} and {r["role"] for r in out[1::2]} == {"assistant"}


def test_matrices_against_all_edits():
    pick = random.Random(4)
    pieces = [bytes(pick.choice([0, 4, 8, pick.randrange(16)]) for _ in range(pick.randint(1, 7))) for _ in range(300)]
    found = transfers(pieces)
    for piece in set(pieces):
        rows = [(0, {0: "system", 1: "user", 2: "assistant", 3: "tool"}[x >> 2], "t") for x in piece]
        kinds = [["", "blank", "duplicate", "truncated"][x & 3] for x in piece]
        t = found[piece]
        end = conversations._last_state(t.cost, t.rank)
        closing = conversations.CLOSING[end]
        assert (int(t.cost[0, end]) + 5 * closing, t.audit(0, end).decode() + "I" * closing) == cheapest(rows, kinds)[:2]


def test_grammar_restores_sequences():
    pick = random.Random(9)
    sequences = [[pick.randrange(3) for _ in range(pick.randint(1, 60))] for _ in range(80)] + [[1] * 33, [0, 1] * 20]
    rules, short = re_pair(sequences, 3)

    def spelled(x):
        return [x] if x < 3 else [y for part in rules[x - 3] for y in spelled(part)]

    assert [[y for x in s for y in spelled(x)] for s in short] == sequences
    pairs = collections.Counter()
    for s in short:
        pairs.update(set(zip(s, s[1:])))
    assert sum(map(len, short)) < sum(map(len, sequences)) / 2


def test_empty_and_dropped(spark):
    assert repair_report(table(spark, [])).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    (row,) = repair_report(table(spark, [(gone, 1, "user", "Hi.")])).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
