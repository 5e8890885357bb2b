"""Repairs against a search over all edits."""
import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from conftest import SF_DIR
from ledgerline.llm import conversations as cv


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def by_hand(rows):
    """Least (cost, edits) by trying everything, from the end."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        solid = text.strip(" \t\n\x0b\f\r")
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        def add(cost, edit, rest, line):
            if rest:
                found.append((cost + rest[0], edit + rest[1], line + rest[2]))
        if inserted < 3:
            for role in ("user", "assistant"):
                if role[0] in follow[last]:
                    add(3, "I", best(i, role[0], inserted + 1), (f"{role}:",))
        if i < len(rows):
            _, _, role, text = rows[i]
            add(4, "D", best(i + 1, last, 0), ())
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                if role[:1] and role[0] in follow[last]:
                    add(more, "K", best(i + 1, role[0], 0), (f"{role}:{text}",))
                for other in ("user", "assistant"):
                    if other[0] in follow[last]:
                        add(3 + more, "R", best(i + 1, other[0], 0), (f"{other}:{text}",))
        return min(found, default=None)

    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in cv.FAULTS],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    left = {c: [] for c, *_ in rows}
    for r in damaged(rows):
        left[r[0]].append(r)
    return {c: by_hand(own) for c, own in left.items()}


def result(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, edit string, position int")
    return {r[0]: tuple(r)[1:] for r in cv.with_empty(cv.report(cv.repair(cv.damage(df), **options)), df).collect()}


def odd_rows(n, longest, seed):
    rnd = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(1, longest)):
            turn = rnd.choice([turn] * 8 + [None, turn + 3, -turn])
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "ufo"])
            rows.append((conv, turn, role, rnd.choice(["Hi.", "Yes!", "Why? \n", "cut off", " ", "", None, "é", "a.", "b.", "\xa0", f"{turn}."])))
    return rows


def test_against_all_edits(spark):
    rows = odd_rows(250, 9, 1) + [(None, 1, "user", "no conversation."), (None, None, None, None), (None, 1, "user", "no conversation.")]
    rows += [(9000, t, ("user", "assistant")[t % 2], f"{t} " + "long " * 100_000 + ".") for t in range(4)]
    got, want = result(spark, rows), expected(rows)
    assert got == want
    assert {a[0] for v in want.values() for a in v[6]} == set("DIKR")


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_blocks_change_nothing(spark, block):
    rows = odd_rows(60, 14, 2)
    assert result(spark, rows, block=block) == expected(rows)


def test_table(spark):
    df = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert result(spark, rows) == expected(rows)


def test_one_long_conversation(spark):
    """Most rows are one conversation; their edits add up to the least cost."""
    rnd = random.Random(3)
    rows = [(1, t, rnd.choice(["user", "assistant"]), rnd.choice([f"{t}.", f"{t}.", f"{t}", "same."])) for t in range(6000)]
    rows += [(c, 0, "user", "a.") for c in range(2, 50)]
    got = result(spark, rows)
    left = sorted((r for r in damaged(rows) if r[0] == 1), key=lambda r: (r[1], r[2], r[3]))
    costs, seen, flags = cv.END, set(), []
    for _, _, role, text in left:
        flags.append("d" if not text.strip() or (role, text) in seen else "" if text[-1] == "." else "t")
        seen.add((role, text))
    for (_, _, role, _), flag in zip(reversed(left), reversed(flags)):
        costs = cv.costs_before((role[0], flag), costs)
    assert got[1][5] == costs[0] and len(got) == 49
    assert len(re.sub("I", "", got[1][6])) == len(left)


def test_empty_table(spark):
    assert result(spark, []) == {}


def test_rows_of_a_repair(spark):
    df = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", " ")], "conv_id long, turn long, role string, text string")
    assert [tuple(r)[1:] for r in cv.repair(df).collect()] == [
        (0, "K", 0, 0, "user", "user", "a.", None), (1, "R", 3, 1, "user", "assistant", "b.", None), (2, "D", 4, 2, "assistant", "assistant", " ", "blank")]
