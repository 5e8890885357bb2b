"""Merges and retention on files with key ranges, and the snapshot cycle."""
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import maintenance as mt
from ledgerline.sources import ranged
from ledgerline.streaming import cycle as cy, views as vw
from test_streaming import BUILD, at, build, folder, stream

SCHEMA = "k long, name string, v long"


def table(spark, tmp_path, rows, per_file=100, key="k", schema=SCHEMA):
    t = ranged.RangedTable(spark, str(tmp_path / "t"), key, per_file)
    t.create(spark.createDataFrame(rows, schema))
    return t


def files(t):
    return [f["name"] for f in t.current()["files"]]


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_one_percent_upsert_writes_few_files(spark, tmp_path):
    t = table(spark, tmp_path, [(k, "a", k) for k in range(0, 4000, 2)])
    before = files(t)
    assert len(before) >= 15
    lows = [int(f["low"]) for f in t.current()["files"]]
    assert lows == sorted(lows)
    new = spark.createDataFrame([(k, "b", -k) for k in range(1000, 1040)], SCHEMA)
    gone = t.upsert(new, ["k"], ["v"])
    owners = {f for f, low, high in zip(before, lows, lows[1:] + [10 ** 9]) if low <= 1039 and high > 1000}
    assert set(gone) == owners and len(gone) <= 3 and set(before) - set(files(t)) == owners
    want = {k: ("a", k) for k in range(0, 4000, 2)}
    want |= {k: ("a" if k % 2 == 0 else "b", -k) for k in range(1000, 1040)}
    assert content(t.read()) == sorted(((k, *v) for k, v in want.items()), key=str)
    after = t.current()
    assert t.upsert(new, ["k"], ["v"]) == [] and t.current() == after
    # A reader of some keys reads their files only.
    assert len(t.read().where("k = 1500").inputFiles()) == len(after["files"])
    small = [f for f in after["files"] if int(f["low"]) <= 1500]
    assert sum(f["rows"] for f in after["files"]) == len(want) and small


@pytest.mark.parametrize("seed", range(3))
def test_merges_equal_those_of_whole_tables(spark, tmp_path, seed):
    rnd = random.Random(seed)
    keys = [None] + [rnd.randint(-500, 500) for _ in range(300)]
    old = {(k, n): rnd.randint(0, 9) for k in keys for n in rnd.sample("xyz", 2)}
    t = table(spark, tmp_path, [(k, n, v) for (k, n), v in old.items()], per_file=rnd.choice([20, 50, 10 ** 6]))
    whole = spark.createDataFrame([(k, n, v) for (k, n), v in old.items()], SCHEMA)
    for step in range(3):
        new = spark.createDataFrame([(rnd.choice([-10 ** 6, 10 ** 6, rnd.randint(-600, 600)]), n, rnd.randint(0, 99)) for n in "xyzw" for _ in range(8)],
                                    SCHEMA).dropDuplicates(["k", "name"]).cache()
        if step == 1:
            t.insert_ignore(new, ["k", "name"], ["v"])
            whole = mt.insert_ignore(whole, new, ["k", "name"], ["v"])
        else:
            t.upsert(new, ["k", "name"], ["v"])
            whole = mt.upsert(whole, new, ["k", "name"], ["v"])
        assert content(t.read()) == content(whole)
        state = t.current()["files"]
        for f, g in zip(state, state[1:]):
            assert g["low"] is not None and (f["high"] is None or int(f["high"]) < int(g["low"]))


def test_enrich_and_empty(spark, tmp_path):
    t = table(spark, tmp_path, [(k, f"n{k % 7}", 0) for k in range(1000)])
    mapping = spark.createDataFrame([(5, 1), (7, None), (900, 2), (5000, 3)], "k long, v long")
    assert len(t.enrich(mapping, "v")) == 2
    assert {r.k: r.v for r in t.read().where("v <> 0").collect()} == {5: 1, 900: 2}
    assert t.enrich(mapping.limit(0), "v") == []
    empty = table(spark, tmp_path / "e", [])
    assert empty.read().count() == 0
    empty.upsert(spark.createDataFrame([(1, "a", 1), (None, "b", 2)], SCHEMA), ["k", "name"], ["v"])
    assert content(empty.read()) == [(1, "a", 1), (None, "b", 2)]


def test_text_keys(spark, tmp_path):
    rows = [(f"é{k:03d}", k) for k in range(200)] + [("", 1), ("a`b", 2)]
    t = table(spark, tmp_path, rows, 30, "name", "name string, v long")
    gone = t.upsert(spark.createDataFrame([("é1005", -1), ("zz", 7)], "name string, v long"), ["name"], ["v"])
    assert len(gone) <= 2 and content(t.read()) == sorted(rows + [("é1005", -1), ("zz", 7)], key=str)


def test_failure_before_the_commit(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path, [(k, "a", k) for k in range(300)])
    before = content(t.read())
    new = spark.createDataFrame([(5, "b", 1)], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(ranged, "swap_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            t.upsert(new, ["k"], ["v"])
    assert content(t.read()) == before
    assert len(t.upsert(new, ["k"], ["v"])) == 1 and t.read().where("v = 1").count() == 2


def test_retention_reads_nothing(spark, tmp_path):
    t = table(spark, tmp_path, [(k, "a", k) for k in range(2000)] + [(None, "n", 0)])
    before, version = files(t), len(list((tmp_path / "t").iterdir()))
    gone = t.drop_below(955)
    assert gone and files(t) == [f for f in before if f not in gone] and len(list((tmp_path / "t").iterdir())) == version
    kept = t.read()
    assert {f.rsplit("/t/", 1)[1] for f in kept.inputFiles()} == set(files(t))
    assert content(kept) == sorted([(k, "a", k) for k in range(955, 2000)] + [(None, "n", 0)], key=str)
    t.upsert(spark.createDataFrame([(3, "late", 3), (1999, "a", 0)], SCHEMA), ["k"], ["v"])
    assert t.read().where("k < 955").count() == 0 and t.read().where("k = 1999").first().v == 0


def test_snapshot_cycle_equals_brute_force(spark, tmp_path):
    """Snapshots every 60 s over 120 s, kept for 180 s; the first one comes at once."""
    rnd, batches = random.Random(6), []
    for b in range(8):
        batches.append([dict(build(50 * b + i, rnd.choice("ab"), i % 7, 10), ts=at(100 * b + 2 * i)) for i in range(45)])
    rows, start = [], 1704067200
    cycle = cy.SnapshotCycle(spark, str(tmp_path / "c"), 120, 60, 180, pane=10)
    (tmp_path / "in").mkdir()
    first = None
    for b, batch in enumerate(batches):
        (tmp_path / "in" / f"{b}.json").write_text("\n".join(map(json.dumps, batch)))
        cycle.start(stream(spark, str(tmp_path / "in"), BUILD), str(tmp_path / "ck")).awaitTermination()
        rows += batch
        seen = [100 * int(r["id"] // 50) + 2 * (r["id"] % 50) for r in rows]
        newest = max(s // 10 * 10 for s in seen)
        first = first if first is not None else newest + 10
        end = newest // 60 * 60
        times = [t for t in [first] + [t for t in range(0, end + 1, 60) if t > first] if t >= end - 180]
        want = {}
        for t in times:
            for r, s in zip(rows, seen):
                if t - 120 <= s < t:
                    want[(start + t, r["entity"])] = want.get((start + t, r["entity"]), 0) + 1
        got = {(r.t, r.entity): r.n for r in cycle.read().select(F.unix_seconds("snapshot_time").alias("t"), "entity", "n").collect()}
        assert got == want
    assert len(cycle.current()["snapshots"]) <= 4


def test_tasks_follow_rows_and_files_are_full(spark, tmp_path):
    """Files are as large as asked for, however many new rows a merge leaves out; one task writes many of them and equal keys share a file."""
    t = table(spark, tmp_path, [(k // 3 if k < 90 else k, "a", k) for k in range(400)], per_file=40)
    new = spark.createDataFrame([(k // 3, "b", k) for k in range(2000)], SCHEMA)
    t.insert_ignore(new, ["k"], ["v"])
    state = t.current()["files"]
    assert {f["name"].rsplit("/part-", 1)[1][:5] for f in state} == {"00000"}
    total = sum(f["rows"] for f in state)
    assert total == t.read().count() and total / 40 <= len(state) <= 2 * total / 40
    assert all(int(f["high"]) < int(g["low"]) for f, g in zip(state, state[1:]))


def test_listing_tasks_do_not_follow_files(spark, tmp_path):
    """What a listing sends to the driver is names, not the overhead of a task for each file; the session keeps its setting."""
    sc, usual = spark.sparkContext, spark.conf.get(ranged.LISTING)
    sc.setJobGroup("listing", "200 files")
    t = table(spark, tmp_path, [(k, "a", k) for k in range(2000)], per_file=10)
    rows = t.read()
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert len(files(t)) == 200 and rows.count() == 2000
    assert max(s.numTasks for s in stages if s) <= 20
    assert spark.conf.get(ranged.LISTING) == usual
