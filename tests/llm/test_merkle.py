"""Trees and proofs against a tree built in one place."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from ledgerline.llm import catalog, merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """All levels, and per leaf its siblings with their side."""
    levels, proofs = [nodes], [[] for _ in nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        for i, p in enumerate(proofs):
            at = (i >> len(levels) - 1) ^ 1
            p.append((now[at], at % 2) if at < len(now) else None)
        levels.append([h(*now[k:k + 2]) for k in range(0, len(now), 2)])
    return levels[-1][0], proofs


def by_hand(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    made = {}
    for lang, own in groups.items():
        own.sort(key=lambda x: x[:3])
        made[lang] = (own, *tree([x[2] for x in own]))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    root, tops = tree([made[x][1] for x in order])
    out = []
    for lang, top in zip(order, tops):
        own, subroot, proofs = made[lang]
        for (*_, digest, r), proof in zip(own, proofs):
            d, source, _, n, text = r
            steps = proof + top
            bad = d is not None and zlib.crc32(str(d).encode()) % 7 == 0
            node = leaf(d, source, lang, n + 1 if bad and n is not None else n, text)
            for s in steps:
                node = h(node) if s is None else h(node, s[0]) if s[1] else h(s[0], node)
            out.append((d, digest, subroot, root, h(*[s[0] for s in steps if s]), node, node == root))
    return out


def table(n, seed):
    rnd = random.Random(seed)
    langs = ["en"] * 12 + [None, "", "=", "de", "é", "日", "en "]
    rows = [(k if k % 5 else rnd.choice([None, -k, k // 2]), rnd.choice([None, "", "web", "é"]), rnd.choice(langs), rnd.choice([None, k, -1]),
             rnd.choice([None, "", "text", "日本\n", f"{k}"])) for k in range(n)]
    return rows + rows[:20]


def run(spark, rows, height):
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, place int")
    return catalog.merkle_rows(docs, height)


@pytest.mark.parametrize("height, n", [(2, 1), (1, 2), (2, 17), (1, 300), (3, 300), (14, 300)])
def test_against_one_tree(spark, height, n):
    rows = table(n, n)
    got = sorted((tuple(r) for r in run(spark, rows, height).collect()), key=str)
    assert got == sorted(by_hand(rows), key=str)


def test_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    rows += [(10 ** 6, None, "en", 5, "long " * 300_000)]
    got = sorted((tuple(r) for r in run(spark, rows, 5).collect()), key=str)
    assert got == sorted(by_hand(rows), key=str)
    assert {r[6] for r in got} == {True, False}


def test_empty_table(spark):
    assert run(spark, [], 4).collect() == []


def test_siblings_fold_to_the_root(spark):
    rows = table(60, 3)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for r in merkle.manifest(docs, height=2).collect():
        assert r.proof_sha256 == h(*r.siblings) and r.verified and r.folded_root == r.root


def test_missing_nodes_are_the_least(spark):
    """What is missing are the siblings of all proofs, less what the leaves give themselves or what other missing nodes give."""
    rnd = random.Random(5)
    for _ in range(200):
        count = rnd.randint(1, 40)
        places = rnd.sample(range(count), rnd.randint(1, count))
        counts = [count]
        while counts[-1] > 1:
            counts.append(-(-counts[-1] // 2))
        own = {(k, p >> k) for p in places for k in range(len(counts))}
        wanted = {(k, (p >> k) ^ 1) for p in places for k in range(len(counts) - 1) if (p >> k) ^ 1 < counts[k]} - own
        assert sorted(merkle.missing(np.array(places), count)) == sorted(wanted)


def test_hot_leaf(spark):
    """Rows that are all alike are numbered over all tasks."""
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
                                    F.lit(1).cast("long").alias("n_chars"), F.lit("t").alias("text"))
    got = merkle.manifest(docs, height=6).collect()
    assert sorted(r.place for r in got) == list(range(3000)) and all(r.verified for r in got)
