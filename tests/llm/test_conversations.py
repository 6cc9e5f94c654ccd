"""Conversation repair against a search that goes through every edit of every row."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spanloom.llm import conversation_repair, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
SHOWN = re.compile(r"[^\x20\x09-\x0D]")
CLASHING = ["conv", "id", "copies", "letters", "part", "start", "digest", "seq", "f", "blank"]


def cheapest(rows, faults):
    """Cost, audit and lines of the cheapest edits: the best way into each state, row by row."""
    ways = {0: (0, "", ())}

    def better(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    def with_insertions(table):
        for _ in range(4):
            for state, (cost, letters, lines) in list(table.items()):
                better(table, 3 if state == 2 else 2, (cost + 2, letters + "I", (*lines, "assistant:" if state == 2 else "user:")))
        return table

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, letters, lines) in with_insertions(ways).items():
            better(after, state, (cost + 3, letters + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            cut = fault == "truncated"
            to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], state))
            if to:
                better(after, to, (cost + cut, letters + "K", (*lines, f"{role}:{text}")))
            better(after, 3 if state == 2 else 2, (cost + 2 + cut, letters + "R", (*lines, f"{'assistant' if state == 2 else 'user'}:{text}")))
        ways = after
    return min((w for s, w in with_insertions(ways).items() if s in (0, 3)), key=lambda w: w[:2])


def brute_audit(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        here = found[conv]
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        here += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = {}
    for conv, here in found.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in here:
            shown = SHOWN.findall(text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in here if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(here, here[1:]))
        cost, letters, lines = cheapest(here, faults)
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def rows():
    """Nulls everywhere, ties, repeated rows, other roles, very long texts, and conversations whose chunks forget slowly or never."""
    rng = random.Random(1)
    roles, texts = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"], ["a.", "b", "c!", "hello there?", "", " \t", None, "x\n.", "é…", "w " * 20_000 + "."]
    out = []
    for conv in [None, -5, *range(30)]:
        for t in range(rng.choice([1, 3, 30, 90])):
            out.append((conv, rng.choice([t, t, t, None, rng.randrange(10)]), rng.choice(roles), rng.choice([*texts, f"{t}."])))
    out += [(100, t, "tool", f"{t}.") for t in range(200)] + [(101, t, "user", f"{t}.") for t in range(200)]
    out += [(102, t, "system", f"{t}") for t in range(100)] + [(103, 5, "user", "same.")] * 40 + [(105, None, "assistant", f"{t}?") for t in range(40)]
    out += [(104, t, ["user", "assistant"][t % 2], f"{t}.") for t in range(300)] + [(106, -(2**63), "user", "far."), (106, 2**63 - 1, "assistant", "apart.")]
    return out


@pytest.mark.parametrize("chunk", [4_096, 3, 16])
def test_repair_against_brute_force(spark, rows, chunk, monkeypatch):
    monkeypatch.setattr(conversation_repair, "CHUNK", chunk)
    data = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumns({c: F.lit(c) for c in CLASHING})
    got = {r[0]: tuple(r)[1:] for r in conversation_repair.audit(data).collect()}
    want = brute_audit(rows)
    want[106] = (min(want[106][0], 2**63 - 1), *want[106][1:])
    assert got == want


def test_repaired_rows_are_in_order(spark, rows):
    """The operator's own output: turns that alternate, from the lines of the rows that stay."""
    done = conversation_repair.repair(conversation_repair.damaged(spark.createDataFrame(rows, SCHEMA)))
    lines = defaultdict(list)
    for r in sorted(done.collect(), key=lambda r: (r.conv, r.id)):
        lines[r.conv] += r.lines
    assert all(re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in x)) for x in lines.values())


def test_costs_forget_what_is_behind():
    """Chunks of ordinary turns settle from any speculative vector; chunks of rows of other roles never do."""
    starts = [tuple(conversation_repair.closed([0 if s == j else conversation_repair.BIG for s in range(4)])) for j in range(4)]
    ends = lambda codes: {conversation_repair.level(conversation_repair.exact(codes, v))[0] for v in starts}
    assert len(ends([conversation_repair.USER, conversation_repair.ASSISTANT] * 100)) == 1
    assert len(ends([0] * 200)) > 1


def test_no_conversations(spark):
    assert conversation_repair.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    row = conversation_repair.audit(spark.createDataFrame([(7, gone, "user", "a.")], SCHEMA)).first()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_query_repair(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, SF).collect()} == brute_audit(rows)
