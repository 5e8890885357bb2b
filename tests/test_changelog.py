"""Change logs, pane logs and keyed state over several batches, restarts and failures."""
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.streaming import changelog as cl, keyed as ky, panelog as pl, views as vw
from test_streaming import BUILD, SCORE, at, build, folder, score, stream

KEYED = {"t": cl.Table(("k",))}


def rows(spark, values, schema="k long, v string"):
    return spark.createDataFrame(values, schema).coalesce(1)


def content(log, name="t"):
    return sorted(tuple(r) for r in log.read(name).collect())


def test_log_equals_a_dictionary(spark, tmp_path):
    rnd, want = random.Random(1), {}
    log = cl.ChangeLog(spark, str(tmp_path), KEYED, buckets=4, compact_after=3, keep_versions=1)
    for batch in range(12):
        change = {rnd.randint(0, 30): f"{batch}-{i}" for i in range(rnd.randint(0, 6))}
        want |= change
        assert log.append(batch, {"t": rows(spark, list(change.items()))})
        assert content(log) == sorted(want.items())
        assert spark.read.parquet(f"{tmp_path}/t/delta-{batch}").count() == len(change)     # changed keys only
    assert not log.append(11, {"t": rows(spark, [(1, "again")])}) and content(log) == sorted(want.items())
    assert len(list((tmp_path / "t").iterdir())) < 12                                        # old folders go


def test_rows_that_are_older_do_not_count(spark, tmp_path):
    log = cl.ChangeLog(spark, str(tmp_path), {"t": cl.Table(("k",), ("ts",))}, compact_after=2)
    for batch, values in enumerate([[(1, 5, "a"), (None, 1, "n")], [(1, 3, "old"), (2, 1, "b")], [(1, 5, "same time")], [(2, None, "no time")]]):
        log.append(batch, {"t": rows(spark, values, "k long, ts long, v string")})
    assert sorted(((r.k, r.v) for r in log.read("t").collect()), key=str) == [(1, "same time"), (2, "b"), (None, "n")]


def test_failure_between_data_and_commit(spark, tmp_path, monkeypatch):
    log = cl.ChangeLog(spark, str(tmp_path), {**KEYED, "whole": cl.Table()}, compact_after=1)
    log.append(0, {"t": rows(spark, [(1, "a")]), "whole": rows(spark, [(1, "x")])})
    log.append(1, {"t": rows(spark, [(2, "b")]), "whole": rows(spark, [(2, "y")])})
    with monkeypatch.context() as m:
        m.setattr(cl, "swap_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            log.append(2, {"t": rows(spark, [(1, "c"), (3, "c")]), "whole": rows(spark, [(3, "z")])})
    assert content(log) == [(1, "a"), (2, "b")] and content(log, "whole") == [(2, "y")] and log.batch == 1
    assert log.append(2, {"t": rows(spark, [(1, "d")]), "whole": rows(spark, [(3, "w")])})
    assert content(log) == [(1, "d"), (2, "b")] and content(log, "whole") == [(3, "w")]


def test_readers_look_at_named_folders_only(spark, tmp_path):
    log = cl.ChangeLog(spark, str(tmp_path), KEYED, compact_after=2)
    for batch in range(4):
        log.append(batch, {"t": rows(spark, [(batch, "v")])})
    for name in ("delta-99", "base-99", "delta-2"):
        junk = tmp_path / "t" / name
        junk.mkdir(exist_ok=True)
    (tmp_path / "t" / "delta-99" / "part-0.parquet").write_bytes(b"half a file")
    named = json.loads((tmp_path / "CURRENT").read_text())["tables"]["t"]
    folders = [f for _, f in named["deltas"]] + list(named["base"].values())
    assert {f.split("/t/")[1].rsplit("/", 1)[0] for f in log.read("t").inputFiles()} == {f.removeprefix("t/") for f in folders}
    assert content(log) == [(k, "v") for k in range(4)]
    assert [r.k for r in log.read("t", since=2).collect()] == [3]


def test_compaction_leaves_other_buckets(spark, tmp_path):
    log = cl.ChangeLog(spark, str(tmp_path), KEYED, buckets=8, compact_after=1)
    log.append(0, {"t": rows(spark, [(k, "a") for k in range(100)])})
    log.append(1, {"t": rows(spark, [(5, "b")])})
    before = log.current()["tables"]["t"]["base"]
    log.append(2, {"t": rows(spark, [(6, "c")])})
    after = log.current()["tables"]["t"]["base"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert dict(content(log)) == {k: "a" for k in range(100)} | {5: "b", 6: "c"}


def pane_rows(spark, log, low=None, high=None):
    return {r.k: r.n for r in log.read(low, high).select(F.unix_seconds("pane").alias("k"), "n").collect()}


def test_panes_equal_brute_force_with_late_rows(spark, tmp_path):
    """Rows come up to far behind the mark; none is lost, late ones are counted, closed parts are not read for new windows."""
    rnd, log = random.Random(2), pl.PaneLog(spark, str(tmp_path / "log"), vw.merge_panes, 60, parts=2, keep_versions=0)
    want, late, newest, n = {}, 0, 0, 0
    for batch in range(10):
        values = []
        for _ in range(20):
            second = max(0, batch * 100 + rnd.randint(0, 99) - rnd.choice([0, 0, 0, 30, 500]))
            n += 1
            values.append(dict(build(n, "a"), ts=at(second)))
            want[1704067200 + second // 3 * 3] = want.get(1704067200 + second // 3 * 3, 0) + 1
            mark = log.current()["mark"]
            late += mark is not None and 1704067200 + second // 3 * 3 < mark
        df = spark.read.schema(BUILD).json(spark.sparkContext.parallelize([json.dumps(v) for v in values]))
        assert log.add(vw.pane_counts(df, "3 seconds"), batch)
        assert not log.add(vw.pane_counts(df, "3 seconds"), batch)
        assert pane_rows(spark, log) == want
        kinds = [p["kind"] for p in log.current()["parts"]]
        assert kinds.count("open") <= 3 and kinds.count("late") <= 2
    state = log.current()
    assert late > 0 and state["late_rows"] == late
    low = state["mark"]
    assert pane_rows(spark, log, low) == {k: v for k, v in want.items() if k >= low}
    read = {f.split("/log/")[1].split("/part-")[0] for f in log.read(low).inputFiles()}
    assert read == {p["folder"] for p in state["parts"] if p["high"] >= low}
    assert len(read) < len(state["parts"]) and not any(p["kind"] == "closed" and p["folder"] in read for p in state["parts"])


def test_whole_parts_are_dropped(spark, tmp_path):
    log = pl.PaneLog(spark, str(tmp_path), vw.merge_panes, 0, parts=1)
    for batch, second in enumerate((0, 1000, 2000, 3000)):
        df = spark.read.schema(BUILD).json(spark.sparkContext.parallelize([json.dumps(dict(build(1, "a"), ts=at(second)))]))
        log.add(vw.pane_counts(df, "3 seconds"), batch)
    start = 1704067200
    assert len(log.drop_before(start + 1500)) == 2
    assert set(pane_rows(spark, log)) == {start + 1998, start + 3000}


def test_failure_of_a_pane_batch(spark, tmp_path, monkeypatch):
    log = pl.PaneLog(spark, str(tmp_path), vw.merge_panes, 0, parts=1)
    df = spark.read.schema(BUILD).json(spark.sparkContext.parallelize([json.dumps(build(i, "a")) for i in range(9)]))
    with monkeypatch.context() as m:
        m.setattr(pl, "swap_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            log.add(vw.pane_counts(df, "3 seconds"), 0)
    log.add(vw.pane_counts(df, "3 seconds"), 0)
    assert sum(pane_rows(spark, log).values()) == 9


def test_history_over_unordered_batches_and_restarts(spark, tmp_path):
    rnd, n = random.Random(3), 0
    batches, want = [], {}
    for b in range(4):
        batch = []
        for _ in range(60):
            n += 1
            e, second = rnd.choice("aaaaab" if b else "abc"), rnd.randint(0, 3000)
            batch.append(dict(score(n, e, float(n)), ts=at(second)))
            want.setdefault(e, []).append((second, n, float(n)))
        batches.append(batch)
    source, log = folder(tmp_path, batches[:2]), ky.history_log(spark, str(tmp_path / "log"), compact_after=2)

    def run():
        ky.keep_histories(stream(spark, source, SCORE), log, str(tmp_path / "c"), keep=7).awaitTermination()

    run()
    for b in (2, 3):                                       # a restart for each later batch
        (tmp_path / "in" / f"9{b}.json").write_text("\n".join(map(json.dumps, batches[b])))
        run()
        assert {r.entity for r in spark.read.parquet(str(tmp_path / "log" / "history" / f"delta-{b}")).collect()} == {r["entity"] for r in batches[b]}
    got = {r.entity: (r.ids, r.values) for r in log.read("history").collect()}
    assert got == {e: tuple(map(list, zip(*[(i, v) for _, i, v in sorted(points)[-7:]]))) for e, points in want.items()}


def test_history_of_nulls_and_ties(spark, tmp_path):
    batch = [dict(score(1, "a", 1.0), ts=None), score(2, "a", None), dict(score(2, "a", 5.0)), dict(score(3, None, 7.0))]
    log = ky.history_log(spark, str(tmp_path / "log"))
    ky.keep_histories(stream(spark, folder(tmp_path, [batch]), SCORE), log, str(tmp_path / "c"), keep=2).awaitTermination()
    assert {r.entity: r.values for r in log.read("history").collect()} == {"a": [None, 5.0], None: [7.0]}


def test_ranking_equals_brute_force(spark, tmp_path):
    """Scores that fall empty the board, which is then made anew."""
    rnd, n, log = random.Random(4), 0, ky.ranking_log(spark, str(tmp_path / "log"), compact_after=3)
    (tmp_path / "in").mkdir()
    latest, shown = {}, {}
    for b in range(6):
        batch = []
        for e in rnd.sample("abcdefghijklmnop", 16 if b == 0 else 5):
            n += 1
            value = None if rnd.random() < 0.05 else round(rnd.random() * 10 / (1 + b), 1)
            batch.append(score(n, e, value))
            latest[e] = value
        (tmp_path / "in" / f"{b}.json").write_text("\n".join(map(json.dumps, batch)))
        ky.keep_ranking(stream(spark, str(tmp_path / "in"), SCORE), log, str(tmp_path / "c"), 3, 2).awaitTermination()
        top = sorted(latest, key=lambda e: (latest[e] is None, -(latest[e] or 0), e))[:3]
        want = [(e, latest[e], round((latest[e] or 0) - shown[e], 1) if latest[e] is not None and shown.get(e) is not None else 0.0) for e in top]
        got = [(r.entity, r.score, r.delta) for r in log.read("top").orderBy("pos").collect()]
        assert [g[:2] for g in got] == [w[:2] for w in want] and [g[2] for g in got] == pytest.approx([w[2] for w in want])
        shown |= {e: latest[e] for e in top}
        assert log.read("board").count() <= 5
        assert {r.entity for r in spark.read.parquet(str(tmp_path / "log" / "latest" / f"delta-{b}")).collect()} == {r["entity"] for r in batch}
    assert log.current()["notes"]["rebuilt"] > 0
    assert {r.entity: r.score for r in log.read("latest").collect()} == latest


def test_recent_list_of_bounded_state(spark, tmp_path):
    rnd, newest = random.Random(5), {}
    batches = [[dict(build(10 * b + i, rnd.choice("abcdefgh")), ts=at(rnd.randint(0, 900))) for i in range(10)] for b in range(5)]
    for r in [r for b in batches for r in b]:
        newest[r["entity"]] = max(newest.get(r["entity"], ("", 0)), (r["ts"], r["id"]))
    log = ky.recent_log(spark, str(tmp_path / "log"))
    ky.keep_recent_list(stream(spark, folder(tmp_path, batches), BUILD), log, str(tmp_path / "c"), keep=3).awaitTermination()
    got = [r.entity for r in vw.recent_list(log.read("recent"), 3).orderBy("pos").collect()]
    assert got == sorted(newest, key=newest.get, reverse=True)[:3]


def test_counts_write_changed_keys(spark, tmp_path):
    batches = [[score(i, e, 1.0) for i, e in enumerate("aabbc")], [score(9, "a", 1.0)]]
    log = ky.counts_log(spark, str(tmp_path / "log"), "entity")
    view = vw.running_counts(stream(spark, folder(tmp_path, batches), SCORE), "entity")
    ky.keep_counts(view, log, str(tmp_path / "c")).awaitTermination()
    assert content(log, "counts") == [("a", 3), ("b", 2), ("c", 1)]
    assert [tuple(r)[:2] for r in spark.read.parquet(str(tmp_path / "log" / "counts" / "delta-1")).collect()] == [("a", 3)]
