"""Byte and word repeats against brute force: nulls, empty and short texts, repeated and negative ids, periodic texts."""
import hashlib
import random

import pytest

from ledgerline.llm import automaton_dedup, suffix_dedup


def rows():
    rnd = random.Random(3)
    passages = [" ".join(rnd.choice("a b c dd ee".split()) for _ in range(60)) for _ in range(4)]
    out = []
    for _ in range(200):
        words = " ".join(rnd.choice("a b é dd\n ee x1 x2 x3 日本 q".split(" ")) for _ in range(rnd.randint(0, 150)))
        text = rnd.choice([None, "", "a" * rnd.randint(0, 300), "a b " * rnd.randint(0, 80),
                           f"{words} {rnd.choice(passages)[rnd.randint(0, 60):]} zz\t\n {rnd.choice(passages)}"])
        out.append((rnd.choice([None, rnd.randint(-50, 10 ** 6), rnd.randint(0, 100)]), text))
    return out


def bytes_by_hand(table):
    first = {}
    for d, t in table:
        b = (t or "").encode()
        for i in range(len(b) - 49 if d is not None else 0):
            first[b[i:i + 50]] = min(d, first.get(b[i:i + 50], d))
    for d, t in table:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49 if d is not None else 0):
            if first[b[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        yield d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()


def words_by_hand(table):
    seen = set()
    for d, t in sorted(table, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode())):
        w = (t or "").encode().split()
        gone = [0] * len(w)
        for i in range(len(w) - 19 if d is not None else 0):
            key = tuple(w[i:i + 20])
            if key in seen:
                gone[i:i + 20] = [1] * 20
            seen.add(key)
        yield d, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()


def in_order(table):
    return sorted((tuple(r) for r in table), key=lambda r: tuple((x is None, x) for x in r))


def frame(spark, table):
    # Extra columns with the names used inside.
    return spark.createDataFrame([(d, t, 1, "x") for d, t in table], "doc_id long, text string, block int, to string").repartition(5)


def test_bytes(spark):
    table = rows()
    assert in_order(suffix_dedup.remove_repeats(frame(spark, table), 3000).collect()) == in_order(bytes_by_hand(table))


@pytest.mark.parametrize("hot", [1024, 1])
def test_words(spark, hot):
    table = rows()
    assert in_order(automaton_dedup.remove_repeats(frame(spark, table), 3000, hot=hot).collect()) == in_order(words_by_hand(table))


def test_empty_tables(spark):
    assert suffix_dedup.remove_repeats(frame(spark, []), 3000).collect() == []
    assert automaton_dedup.remove_repeats(frame(spark, []), 3000).collect() == []


def test_cover_has_every_difference():
    cover, v = suffix_dedup.COVER, suffix_dedup.MODULUS
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert suffix_dedup.DEPTH + v - 1 == suffix_dedup.LENGTH


def test_kept_content(spark):
    passage = "one passage that is long enough to be found twice in the corpus, word for word, again "
    got = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.remove_repeats(
        frame(spark, [(1, "A " + passage), (2, passage + "B")]), content=True).collect()}
    assert got == {1: "A " + passage, 2: "B"}


def test_automaton_statistics():
    automaton = automaton_dedup.SuffixAutomaton()
    rnd = random.Random(5)
    before = []
    for _ in range(30):
        sequence = [rnd.randint(0, 2) for _ in range(rnd.randint(0, 25))]
        want = [max(n for n in range(i + 2) if n == 0 or any(b[k:k + n] == sequence[i + 1 - n:i + 1] for b in before
                                                              for k in range(len(b) - n + 1))) for i in range(len(sequence))]
        assert automaton.statistics(sequence) == want
        automaton.add(sequence)
        before.append(sequence)
