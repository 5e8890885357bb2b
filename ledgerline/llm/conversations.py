"""Repair of conversation structure by the cheapest edits, found by iterative-deepening A*.

Rows of a conversation, in the order of turns, are kept, given another role or deleted, and empty rows are inserted, until the
initials of the roles read `(s?(ua)+)?`. Four states tell what may come next. The search goes depth first through the edits in
ASCII order (D, I, K, R) under a bound on the cost, remembers with how much of the bound a state has failed, and raises the
bound to the least cost that went beyond it; the first path that is accepted is therefore the cheapest, and of equally cheap
ones the least in ASCII.

A conversation is one sequence with one result, so it is read as a stream: one shuffle by conversation, sorts that spill, and two
passes over sorted rows that hold a few rows each. The pass from the end leaves with every row what the rows behind it cost from
each state; the pass from the front searches blocks of rows, and a block ends where that cost takes over. So memory and the depth of
a search do not grow with the length of a conversation.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import column

# Costs of the edits and of a truncated row that is not deleted.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
BLANKS = " \t\n\x0b\f\r"
# States: 0 nothing yet, 1 behind the system row, 2 behind a user row, 3 behind an assistant row.
FORCED = (2, 2, 3, 2)                                       # state behind the row that may come next
ROLE = {2: "user", 3: "assistant"}
LEGAL = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})    # states behind a kept row, by the initial of its role
END = (0, 2 * INSERT, INSERT, 0)                            # cost of the end of a conversation, from each state
FAULTS = ("blank", "duplicate", "truncated")
BLOCK = 64

Row = tuple[str, str]           # initial of the role, and "d" (to be deleted), "t" (truncated) or ""


def costs_before(row: Row, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Least cost from each state before a row, insertions in front of it included, by the costs behind it."""
    initial, flag = row
    more = TRUNCATED if flag == "t" else 0
    cost = []
    for state in range(4):
        ways = [DELETE + behind[state]]
        if flag != "d":
            ways.append(REROLE + more + behind[FORCED[state]])
            if initial in LEGAL[state]:
                ways.append(more + behind[LEGAL[state][initial]])
        cost.append(min(ways))
    for _ in range(2):
        cost = [min(c, INSERT + cost[FORCED[state]]) for state, c in enumerate(cost)]
    return tuple(cost)


def cheapest_edits(rows: list[Row], state: int, behind: tuple[int, ...]) -> tuple[str, int]:
    """Edits of a block from `state` on, the least in ASCII of the cheapest, and the state behind them.

    `behind` is what follows the block costs from each state. What is inserted behind the last row belongs to the next block.
    """
    n = len(rows)
    least = [min(behind)] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (DELETE if rows[i][1] == "d" else TRUNCATED if rows[i][1] == "t" else 0)
    bound = least[0]
    while True:
        failed: dict[tuple[int, int], int] = {}
        beyond = None
        # A frame: rows taken, state, cost so far, and the edits left to try (each with the state and cost behind it).
        path: list[str] = []
        stack = [(0, state, 0, iter(_edits(rows[0], state)))] if n else []
        if not n:
            return "", state
        while stack:
            i, at, spent, left = stack[-1]
            step = next(left, None)
            if step is None:
                failed[i, at] = max(failed.get((i, at), -1), bound - spent)
                stack.pop()
                if path:
                    path.pop()
                continue
            edit, to, cost = step
            j, total = i + (edit != "I"), spent + cost
            estimate = total + (behind[to] if j == n else least[j])
            if estimate > bound:
                beyond = estimate if beyond is None else min(beyond, estimate)
                continue
            if j == n:
                return "".join(path) + edit, to
            if failed.get((j, to), -1) >= bound - total:
                continue
            path.append(edit)
            stack.append((j, to, total, iter(_edits(rows[j], to))))
        bound = beyond


def _edits(row: Row, state: int) -> list[tuple[str, int, int]]:
    """Edits before or of a row from a state, in ASCII order, with the state and cost behind them."""
    initial, flag = row
    to = FORCED[state]
    out = [("D", state, DELETE), ("I", to, INSERT)]
    if flag != "d":
        more = TRUNCATED if flag == "t" else 0
        if initial in LEGAL[state]:
            out.append(("K", LEGAL[state][initial], more))
        out.append(("R", to, REROLE + more))
    return out


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`conv_id`, `turn`, `role`, `text` with faults put in by crc32(`conv_id:turn`) modulo 20, nulls read as one space.

    0 drops a row, 1 empties its text, 2 takes `.`, `!` and `?` from it, 3 repeats the row, 4 makes its role user.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(column(conv).cast("string"), blank), F.lit(":"), F.coalesce(column(turn).cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    spoken = F.coalesce(column(text).cast("string"), blank)
    return (rows.select(column(conv).cast("long").alias("conv_id"), column(turn).cast("long").alias("turn"), kind.alias("kind"),
                        F.when(kind == 4, "user").otherwise(F.coalesce(column(role).cast("string"), blank)).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spoken, "[.!?]", "")).otherwise(spoken).alias("text"))
            .where("kind <> 0").withColumn("times", F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
            .select("conv_id", "turn", "role", "text"))


REPAIRED = "conv_id long, position int, edit string, cost long, turn long, was string, role string, text string, fault string"


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block: int = BLOCK) -> DataFrame:
    """The edits of every conversation in order: `conv_id`, `position` (from 0), `edit` (D, I, K, R), `cost`, `turn` and `was` (role
    before; both null for inserted rows), `role` and `text` behind the edit, `fault` (blank, duplicate, truncated or null).

    Rows go by turn, nulls first, then role and text. Null roles and texts are read as one space, a null conversation is one
    of its own. Repeated rows of a conversation are duplicates. A conversation of any length is a stream through one task;
    a text of any length is one value. An empty table gives an empty table; other columns are not looked at. The rows of
    a partition come out in order, a conversation is never in two partitions.
    """
    blank = F.lit(" ")
    own = rows.select(column(conv).cast("long").alias("conv_id"), column(turn).cast("long").alias("turn"),
                      F.coalesce(column(role).cast("string"), blank).alias("role"), F.coalesce(column(text).cast("string"), blank).alias("text"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "nth"]
    nth = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    spoken = F.btrim("text", F.lit(BLANKS))
    fault = F.when(spoken == "", "blank").when(F.col("nth") > 1, "duplicate").when(~F.substring(spoken, -1, 1).isin(*".!?"), "truncated")
    faulty = own.repartition("conv_id").withColumn("nth", nth).withColumn("fault", fault)

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, costs = None, END
        for batch in batches:
            convs, roles, faults = (batch.column(c).to_pylist() for c in ("conv_id", "role", "fault"))
            behind = []
            for c, r, f in zip(convs, roles, faults):
                if (c,) != current:
                    current, costs = (c,), END
                behind.append(list(costs))
                costs = costs_before(_row(r, f), costs)
            yield batch.append_column("behind", pa.array(behind, pa.list_(pa.int64())))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current, state, position = None, 0, 0
        out: list[tuple] = []

        def settle(last: bool) -> None:
            """Search the rows at hand and put out their edits, at the end of a conversation also what it lacks."""
            nonlocal state, position, held
            edits, _ = cheapest_edits([_row(h[1], h[3]) for h in held], state, tuple(held[-1][4]))
            taken = iter(held)
            for edit in edits:
                to = FORCED[state]
                if edit == "I":
                    out.append((current[0], position, edit, INSERT, None, None, ROLE[to], "", None))
                    state = to
                else:
                    turn_, was, said, why, _ = next(taken)
                    role_, cost = was, DELETE
                    if edit != "D":
                        cost = (REROLE if edit == "R" else 0) + (TRUNCATED if why == "truncated" else 0)
                        state = to if edit == "R" else LEGAL[state][was[:1]]
                        role_ = ROLE[to] if edit == "R" else was
                    out.append((current[0], position, edit, cost, turn_, was, role_, said, why))
                position += 1
            held = []
            while last and state in (1, 2):
                state = FORCED[state]
                out.append((current[0], position, "I", INSERT, None, None, ROLE[state], "", None))
                position += 1

        for batch in batches:
            columns = [batch.column(c) for c in ("conv_id", "turn", "role", "text", "fault", "behind")]
            for c, *row in zip(*[x.to_pylist() for x in columns]):
                if (c,) != current:
                    if held:
                        settle(True)
                    current, state, position = (c,), 0, 0
                elif len(held) == block:
                    settle(False)
                held.append(tuple(row))
            if out:
                yield _batch(out)
                out.clear()
        if held:
            settle(True)
        if out:
            yield _batch(out)

    last_first = ["conv_id", F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("text"), F.desc("nth")]
    scored = faulty.sortWithinPartitions(*last_first).mapInArrow(
        backward, "conv_id long, turn long, role string, text string, nth int, fault string, behind array<long>")
    return scored.sortWithinPartitions(*order).mapInArrow(forward, REPAIRED)


def _row(role: str, fault: str | None) -> Row:
    return role[:1], "d" if fault in ("blank", "duplicate") else "t" if fault else ""


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    names = ["conv_id", "position", "edit", "cost", "turn", "was", "role", "text", "fault"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class _Report:
    """What a conversation adds up to, row by row."""

    def __init__(self, conv: int | None):
        self.conv, self.faults, self.illegal, self.cost = conv, dict.fromkeys(FAULTS, 0), 0, 0
        self.turns, self.least, self.most, self.audit = 0, None, None, []
        self.before: str | None = None
        self.digest, self.any = hashlib.sha256(), False

    def add(self, edit: str, cost: int, turn: int | None, was: str | None, role: str, text: str, fault: str | None) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = was[:1]
            if turn is not None and turn != self.most:
                self.turns, self.most = self.turns + 1, turn
                self.least = turn if self.least is None else self.least
        if edit != "D":
            self.digest.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def report(repaired: DataFrame) -> DataFrame:
    """One row per conversation from the rows of `repair` as they come: faults, neighbours of roles that must not follow each other
    before the repair, cost, edits, and the digest of the repaired `role:text` lines.

    Rows that come from elsewhere have to be sorted by conversation and position within partitions. A conversation is not held.
    """
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = [f.split()[0] for f in REPORT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv, _, *row in zip(*[batch.column(c).to_pylist() for c in REPAIRED_NAMES]):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Report(conv)
                now.add(*row)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
                done = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(now.row()), kinds)], names)

    return repaired.mapInArrow(run, REPORT)


REPAIRED_NAMES = [f.split()[0] for f in REPAIRED.split(", ")]


def with_empty(reports: DataFrame, convs: DataFrame, conv: str = "conv_id") -> DataFrame:
    """`reports`, and a row of zeros with an empty audit for each conversation of `convs` that has no rows left."""
    every = convs.select(column(conv).cast("long").alias("id")).distinct()
    both = every.join(reports, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    return both.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
