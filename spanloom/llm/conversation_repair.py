"""Repair of damaged conversations by a rank-convergence Viterbi: the cheapest edits that make turns alternate.

A conversation is in order when its role initials are ``(s?(ua)+)?``. Every row is kept (K, free), gets the role user or
assistant (R, 2) or is deleted (D, 3, required for blank and repeated rows); empty turns of user or assistant are inserted (I, 2);
a truncated row that stays costs 1 more. Among the cheapest edits, the audit (their initials) that is least in ASCII order counts.

Required deletions leave the states alone, and D comes before I, so the search runs over the other rows, in chunks of
``CHUNK``. A chunk's costs backwards are a min-plus linear function of the costs behind it. All chunks start from the same
four speculative vectors, of which every vector is a combination; fix-up passes put chunks together, twice as many in each,
until a chunk's four results differ only by constants: then its costs don't depend on what is behind, and only their
differences matter to a choice. With the stitched costs each chunk is traced forwards from its four possible states at once,
which are stitched the same way; then the edits are read off. A conversation of one chunk needs no pass.

Rows are ordered by turn (nulls first), and of equal turns by role and text. Null ids and turns read as one space in the
damage key, null roles and texts as one space; all null ids are one conversation. Equal rows are one row with a count. A role
that is not of s, u or a by its first letter can't be kept. Any other columns are left out of the result; an empty table gives
no rows. Texts are compared by their SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import bind, join_unique, materialize

SPACE = r"\x20\x09-\x0D"
#: Rows of a chunk.
CHUNK = 4_096
#: States of the automaton: nothing yet, after a system turn, after a user turn, after an assistant turn (and initials).
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Costs at the end: whatever is missing of an exchange is inserted.
END = (0, 4, 2, 0)
#: More than costs of two states can differ by: the speculative vectors are 0 at one state and this at the others.
BIG = 64
FIRST_OF_KEY = 256


# ---- damage -----------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv, conv_id, turn, role, text) after damage by the checksum of id and turn; ``conv`` is the id as a text that is never null."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.encode(F.concat(shown("conv_id"), F.lit(":"), shown("turn")), "UTF-8")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select(conv_key().alias("conv"), "turn", F.when(fate == 4, "user").otherwise(role).alias("role"), F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), fate.alias("fate"))
    copies = F.when(F.col("fate") == 0, F.array()).when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).select("conv", "turn", "role", "text")


def conv_key() -> Column:
    """The id as text that tells a null from every id."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


# ---- order and faults -------------------------------------------------------------------------------------------------


def in_order(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``copies``, numbered in order by ``id``: rows of one conversation follow one another, over as many
    partitions as they take. Ranges are cut by the start of the texts, order within them is by whole texts."""
    one = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    by = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role")]
    dealt = one.repartitionByRange(*by, F.substring("text", 1, FIRST_OF_KEY)).sortWithinPartitions(*by, "text")
    return materialize(dealt.withColumn("id", F.monotonically_increasing_id()), "turns")


def faults(turns: DataFrame) -> DataFrame:
    """Per row (id, conv, copies): blank, repeated (an earlier row has this role and text), truncated, initial."""
    last = F.regexp_extract("text", rf"([^{SPACE}])[{SPACE}]*\z", 1)
    told = turns.select("id", "conv", "copies", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), (last == "").alias("blank"), (~last.isin("", ".", "!", "?")).alias("truncated"), F.substring("role", 1, 1).alias("initial"))
    told = materialize(told, "faults")
    firsts = told.groupBy("conv", "role", "digest").agg(F.min("id").alias("first"), F.count("*").alias("turns")).where("turns > 1")
    keys = ["conv", "role", "digest"]
    again = join_unique(told.select("id", *keys), materialize(firsts, "firsts"), keys, "turns").where("id > first").select("id", F.lit(True).alias("again"))
    return told.drop("role", "digest").join(again, "id", "left").withColumn("again", F.coalesce("again", F.lit(False)))


def chunks(marked: DataFrame) -> DataFrame:
    """Runs of at most CHUNK rows that needn't be deleted, in order: conv, start, ids and codes (initial, and 4 if truncated)."""
    code = F.instr(F.lit(INITIALS), F.col("initial"))  # 1 to 3, 0 for others
    code = F.when(F.col("initial") == "", 0).otherwise(code) + F.when(F.col("truncated"), 4).otherwise(0)
    live = marked.where("not blank and not again").select("id", "conv", code.alias("code"), F.shiftright("id", 33).alias("part"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("id")) - 1  # the rows of one file
    rows = live.withColumn("chunk", F.floor(within / CHUNK))
    found = rows.groupBy("conv", "part", "chunk").agg(F.array_sort(F.collect_list(F.struct("id", "code"))).alias("rows"))
    return materialize(found.select("conv", F.col("rows.id").alias("ids"), F.col("rows.code").alias("codes"), F.col("rows")[0]["id"].alias("start")), "chunks")


# ---- the automaton ----------------------------------------------------------------------------------------------------


def inserted(state: int) -> int:
    """State after an inserted turn: only one role is of use."""
    return ASSISTANT if state == USER else USER


def closed(costs: list[int]) -> list[int]:
    """Costs where turns may be inserted first."""
    for _ in range(3):
        costs = [min(c, 2 + costs[inserted(s)]) for s, c in enumerate(costs)]
    return costs


def level(costs: list[int]) -> tuple[tuple[int, ...], int]:
    """Costs less their least, and the least."""
    least = min(costs)
    return tuple(c - least for c in costs), least


def options(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row: initial, cost, next state."""
    initial, cut = code % 4, code // 4
    found = [("D", 3, state)]
    if initial == SYSTEM and state == START:
        found.append(("K", cut, SYSTEM))
    elif initial == USER and state != USER or initial == ASSISTANT and state == USER:
        found.append(("K", cut, initial))
    return [*found, ("R", 2 + cut, inserted(state))]


@lru_cache(maxsize=1 << 16)
def before(code: int, costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs before a row from those after it, levelled, and by how much."""
    return level(closed([min(c + costs[to] for _, c, to in options(code, s)) for s in range(4)]))


@lru_cache(maxsize=1 << 16)
def moves(code: int, costs: tuple[int, ...]) -> tuple[tuple[str, int, int], ...]:
    """For each state before a row: the least letters of a cheapest way over it, what they cost, and the state after."""
    here, lift = before(code, costs)
    found = []
    for state in range(4):
        letters, paid = "", 0
        while not letters or letters[-1] == "I":
            best = here[state] + lift
            ways = [(x, c, to) for x, c, to in options(code, state) if c + costs[to] == best]
            if here[inserted(state)] + lift + 2 == best:
                ways.append(("I", 2, inserted(state)))
            letter, cost, state = min(ways)
            letters, paid = letters + letter, paid + cost
        found.append((letters, paid, state))
    return tuple(found)


def backwards(codes: list[int], costs: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Levelled costs after each row, and before the first, last first."""
    out = [costs]
    for code in reversed(codes):
        out.append(before(code, out[-1])[0])
    return out


# ---- stitching --------------------------------------------------------------------------------------------------------

NUMBERS = "array<bigint>"


def product(a: Column, b: Column) -> Column:
    """Results of two chunks in a row on the four speculative vectors: min-plus products, less the least of all."""
    four = F.array(*(F.lit(i) for i in range(4)))
    entry = lambda j, s: F.array_min(F.transform(four, lambda i: F.get(a, i * 4 + s) + F.get(b, j * 4 + i)))
    whole = F.flatten(F.transform(four, lambda j: F.transform(four, lambda s: entry(j, s))))
    return bind(whole, lambda m: F.transform(m, lambda c: c - F.array_min(m))).cast(NUMBERS)


def vector(m: Column, j: int) -> Column:
    """Result on one speculative vector, less its least cost."""
    return bind(F.slice(m, 4 * j + 1, 4), lambda v: F.transform(v, lambda c: c - F.array_min(v)))


def settled(m: Column) -> Column:
    """Whether the four results differ by constants only."""
    return (vector(m, 0) == vector(m, 1)) & (vector(m, 0) == vector(m, 2)) & (vector(m, 0) == vector(m, 3))


def composed(later: Column, earlier: Column) -> Column:
    """States after two chunks from those before them."""
    return F.transform(earlier, lambda s: F.get(later, s.cast("int"))).cast(NUMBERS)


def one_state(f: Column) -> Column:
    return F.array_max(f) == F.array_min(f)


def doubled(table: DataFrame, join, done, ahead: bool) -> DataFrame:
    """Fix-up passes over rows (conv, seq, f): each takes in as many chunks ahead (or behind) as it spans, till ``done``."""
    span = 1
    while table.where(~done(F.col("f"))).limit(1).count():
        other = table.select("conv", (F.col("seq") + (-span if ahead else span)).alias("seq"), F.col("f").alias("g"))
        open_ = table.where(~done(F.col("f"))).join(other, ["conv", "seq"]).select("conv", "seq", join(F.col("f"), F.col("g")).alias("f"))
        table = materialize(table.where(done(F.col("f"))).unionByName(open_), "passes")
        span *= 2
    return table


def speculate(many: DataFrame) -> DataFrame:
    """(conv, seq, f): each chunk's results on the speculative vectors; the last one's are the same, those on the true end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = [tuple(closed([0 if s == j else BIG for s in range(4)])) for j in range(4)]
        for batch in batches:
            out = []
            for codes, last in zip(batch.column("codes").to_pylist(), batch.column("last").to_pylist()):
                ends = [backwards(codes, END)[-1]] * 4 if last else [exact(codes, v) for v in starts]
                out.append([c for v in ends for c in v])
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("seq"), pa.array(out, pa.list_(pa.int64()))], names=["conv", "seq", "f"])

    return materialize(many.select("conv", "seq", "codes", "last").mapInArrow(run, f"conv string, seq bigint, f {NUMBERS}"), "passes")


def exact(codes: list[int], costs: tuple[int, ...]) -> list[int]:
    """Costs before a chunk, not levelled: the four results of one chunk must keep their distances."""
    lift = 0
    for code in reversed(codes):
        costs, more = before(code, costs)
        lift += more
    return [c + lift for c in costs]


def exits(many: DataFrame) -> DataFrame:
    """(conv, seq, f): the state behind each chunk for each state before it; the first chunk begins at the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for codes, costs, seq in zip(*(batch.column(c).to_pylist() for c in ("codes", "costs", "seq"))):
                ways = backwards(codes, tuple(costs))[-2::-1]
                states = [START] * 4 if seq == 0 else list(range(4))
                for code, after in zip(codes, ways):
                    step = moves(code, after)
                    states = [step[s][2] for s in states]
                out.append(states)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("seq"), pa.array(out, pa.list_(pa.int64()))], names=["conv", "seq", "f"])

    return materialize(many.select("conv", "seq", "codes", "costs").mapInArrow(run, f"conv string, seq bigint, f {NUMBERS}"), "passes")


def stitched(found: DataFrame) -> DataFrame:
    """Chunks with the costs behind them (but for a constant), the state before them, and whether they are the last."""
    order = Window.partitionBy("conv")
    numbered = found.select("conv", "start", (F.row_number().over(order.orderBy("start")) - 1).cast("bigint").alias("seq"), F.count("*").over(order).alias("all")).where("all > 1")
    numbered = materialize(numbered.select("conv", "start", "seq", (F.col("seq") == F.col("all") - 1).alias("last")), "spans")
    whole = found.join(numbered.select("start"), "start", "left_anti").select("conv", "ids", "codes", end_costs().alias("costs"), F.lit(START).cast("bigint").alias("state"), F.lit(True).alias("last"))
    if not numbered.limit(1).count():
        return whole
    many = materialize(found.join(numbered.drop("conv"), "start"), "spans")
    costs = doubled(speculate(many), product, settled, ahead=True).select("conv", (F.col("seq") - 1).alias("seq"), vector(F.col("f"), 0).alias("costs"))
    many = materialize(many.join(costs, ["conv", "seq"], "left").withColumn("costs", F.coalesce("costs", end_costs())), "spans")
    states = doubled(exits(many), composed, one_state, ahead=False).select("conv", (F.col("seq") + 1).alias("seq"), F.get("f", F.lit(0)).alias("state"))
    many = many.join(states, ["conv", "seq"], "left").withColumn("state", F.coalesce("state", F.lit(START).cast("bigint")))
    return whole.unionByName(many.select("conv", "ids", "codes", "costs", "state", "last"))


def end_costs() -> Column:
    return F.array(*(F.lit(c).cast("bigint") for c in END))


# ---- edits ------------------------------------------------------------------------------------------------------------

#: Number of what is inserted behind the last row.
LAST = (1 << 63) - 1
EDITS = "conv string, id bigint, letters string, cost bigint, inserted array<string>, new_role string"


def edits(found: DataFrame) -> DataFrame:
    """Per row that needn't be deleted, its letters (insertions before it, then its own), their cost, the roles inserted and
    its new role if it gets one; under LAST what is inserted at the end of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, ids, codes, costs, state, last in zip(*(batch.column(c).to_pylist() for c in ("conv", "ids", "codes", "costs", "state", "last"))):
                ways = backwards(codes, tuple(costs))[-2::-1]
                for at, code, after in zip(ids, codes, ways):
                    letters, cost, to = moves(code, after)[state]
                    roles = []
                    for _ in letters[:-1]:
                        state = inserted(state)
                        roles.append(ROLE[state])
                    state = to
                    out.append((conv, at, letters, cost, roles, ROLE[state] if letters[-1] == "R" else None))
                if last and END[state]:
                    roles = ["user", "assistant"] if state == SYSTEM else ["assistant"]
                    out.append((conv, LAST, "I" * len(roles), 2 * len(roles), roles, None))
            columns = zip(*out) if out else [[]] * 6
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv", "id", "letters", "cost", "inserted", "new_role"])

    return stitched(found).mapInArrow(run, EDITS)


def repair(rows: DataFrame) -> DataFrame:
    """Edited rows of (conv, turn, role, text), in order by (conv, id): what was there, its fault (blank, duplicate or truncated),
    ``copies`` (rows that are equal to it, of which all but the first are duplicates), ``letters`` (edits, insertions before the row
    included), ``cost``, and ``lines``: the repaired turns that stand for it, as ``role:text``. Rows under LAST are insertions only."""
    turns = in_order(rows)
    marked = materialize(faults(turns), "marked")
    made = edits(chunks(marked))
    gone = F.col("blank") | F.col("again")
    more = F.col("copies") - F.when(gone, 0).otherwise(1)  # rows to delete besides the one that is searched over
    per_row = marked.join(made.where(F.col("id") < LAST).drop("conv"), "id", "left")
    letters = F.concat(F.coalesce("letters", F.lit("")), F.repeat(F.lit("D"), more.cast("int")))
    told = per_row.select("id", "conv", "blank", "again", "truncated", "initial", "copies", letters.alias("letters"), (F.coalesce("cost", F.lit(0)) + 3 * more).alias("cost"), F.coalesce("inserted", F.array().cast("array<string>")).alias("inserted"), "new_role")
    stays = ~F.col("letters").rlike("^I*D")
    own = F.when(stays, F.array(F.concat(F.coalesce("new_role", "role"), F.lit(":"), F.col("text")))).otherwise(F.array().cast("array<string>"))
    empty = lambda roles: F.transform(roles, lambda r: F.concat(r, F.lit(":")))
    fault = F.when(F.col("blank"), "blank").when(F.col("again"), "duplicate").when(F.col("truncated"), "truncated")
    body = told.join(turns.select("id", "turn", "role", "text"), "id").select("conv", "id", "turn", "role", "text", "initial", fault.alias("fault"), "copies", "letters", "cost", F.concat(empty(F.col("inserted")), own).alias("lines"))
    nothing = {c: F.lit(None).cast(body.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "initial", "fault")}
    ends = made.where(F.col("id") == LAST).select("conv", "id", *nothing.values(), F.lit(0).cast("bigint").alias("copies"), "letters", "cost", empty(F.col("inserted")).alias("lines"))
    return body.unionByName(ends)


REPORT = "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Digest:
    """What one conversation comes to, row by row in order; of its rows, only the audit's letters are kept."""

    def __init__(self):
        self.low = self.high = self.turn = self.initial = None
        self.turns, self.letters, self.hash, self.begun = 0, [], hashlib.sha256(), False
        self.counts = dict.fromkeys(COUNTS, 0)

    def add(self, turn, initial, fault, copies, letters, cost, lines) -> None:
        c = self.counts
        if turn is not None and copies and turn != self.turn:  # in order, so a new turn is greater than all before
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
            self.turn = turn
        if copies:
            pairs = [self.initial + initial] if self.initial is not None else []
            c["illegal"] += sum(p not in ("su", "ua", "au") for p in pairs) + copies - 1
            self.initial = initial
            if fault in ("blank", "duplicate"):
                c[fault] += copies
            else:
                c["duplicate"] += copies - 1
                c["truncated"] += fault == "truncated"
        c["cost"] += cost
        self.letters.append(letters)
        for line in lines:
            self.hash.update(b"\n" * self.begun + line.encode())
            self.begun = True

    def row(self) -> list:
        if self.turns:
            self.counts["gaps"] = min(self.high - self.low + 1 - self.turns, LAST)  # turns may be 64 bits apart
        return [*self.counts.values(), "".join(self.letters), self.hash.hexdigest()]


def reports(repaired: DataFrame) -> DataFrame:
    """One row per conversation of repaired rows: REPORT. A conversation's rows pass one task in order, which a hash of all of them
    asks for; the task holds one batch and the audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, out = None, None, []
        names = ["turn", "initial", "fault", "copies", "letters", "cost", "lines"]
        for batch in batches:
            for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv", *names))):
                if conv != now:
                    if digest:
                        out.append([now, *digest.row()])
                    now, digest = conv, Digest()
                digest.add(*row)
            if len(out) > 1_000:
                yield batch_of(out)
                out = []
        if digest:
            out.append([now, *digest.row()])
        yield batch_of(out)

    rows = repaired.select("conv", "id", "turn", "initial", "fault", "copies", "letters", "cost", "lines")
    return rows.repartition("conv").sortWithinPartitions("conv", "id").mapInArrow(run, REPORT)


def batch_of(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.string(), *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv", *COUNTS, "audit", "repaired_sha256"])


def audit(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the table: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256,
    after damage and repair; one of which no row is left has zeros, no edits and the hash of nothing."""
    ids = conversations.select("conv_id", conv_key().alias("conv")).distinct()
    done = ids.join(reports(repair(damaged(conversations))), "conv", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS]
    return done.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
