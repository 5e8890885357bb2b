"""Live views over several micro-batches."""
import json

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import dashboards as db
from ledgerline.streaming import runner as rn, views as vw

BUILD = "id bigint, ts timestamp, entity string, star int, ename string, constellation int, level int, damage bigint, weapon string, artifact string"
SCORE = "id bigint, ts timestamp, entity string, score double, star int, ability double, look double"


def folder(tmp_path, batches):
    """One file per batch, with names in arrival order."""
    base = tmp_path / "in"
    base.mkdir()
    for i, batch in enumerate(batches):
        (base / f"{i:03d}.json").write_text("\n".join(json.dumps(r) for r in batch))
        import os
        os.utime(base / f"{i:03d}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    return str(base)


def stream(spark, path, schema):
    return vw.open_stream(spark, "json", schema, path, maxFilesPerTrigger=1)


def at(seconds):
    return f"2024-01-01T00:{seconds // 60:02d}:{seconds % 60:02d}Z"


def score(i, entity, value, **extra):
    return {"id": i, "ts": at(i), "entity": entity, "score": value, **extra}


def test_delta_is_against_the_last_showing(spark, tmp_path):
    batches = [[score(1, "a", 7.5), score(2, "b", 8.2)], [score(3, "a", 7.8), score(4, "b", 7.9)],
               [score(5, "c", 9.0), score(6, "d", 9.5)],       # a and b leave the top 2
               [score(7, "a", 9.9)]]                             # a returns: against 7.8
    src, out = folder(tmp_path, batches), str(tmp_path / "out")
    rn.live_ranking(spark, stream(spark, src, SCORE), out, str(tmp_path / "c"), n=2).awaitTermination()

    def top(batch):
        return {r.entity: (r.pos, r.delta, r.star, r.ability) for r in spark.read.parquet(f"{out}/top/batch={batch}").collect()}

    assert top(0) == {"b": (1, 0.0, 5, 8.2), "a": (2, 0.0, 5, 7.5)}
    assert top(1) == {"b": (1, -0.3, 5, 7.9), "a": (2, 0.3, 5, 7.8)}
    assert top(2) == {"d": (1, 0.0, 5, 9.5), "c": (2, 0.0, 5, 9.0)}
    assert top(3) == {"a": (1, 2.1, 5, 9.9), "d": (2, 0.0, 5, 9.5)}


def test_history_keeps_sixty_over_batches(spark, tmp_path):
    batches = [[score(i, "a", i / 10) for i in range(start, start + 13)] for start in range(0, 65, 13)]
    src, out = folder(tmp_path, batches), str(tmp_path / "out")
    rn.score_history(spark, stream(spark, src, SCORE), out, str(tmp_path / "c")).awaitTermination()
    kept = [r.score for r in rn.current(spark, out).orderBy("id").collect()]
    assert (len(kept), kept[0], kept[-1]) == (60, 0.5, 6.4)


def test_restart_continues(spark, tmp_path):
    src, out, ck = folder(tmp_path, [[score(1, "a", 1.0)]]), str(tmp_path / "out"), str(tmp_path / "c")
    for batch in (None, [score(2, "a", 2.0)]):
        if batch:
            (tmp_path / "in" / "900.json").write_text(json.dumps(batch[0]))
        rn.score_history(spark, stream(spark, src, SCORE), out, ck).awaitTermination()
    assert sorted(r.score for r in rn.current(spark, out).collect()) == [1.0, 2.0]


def build(i, entity, constellation=0, damage=0, weapon="w", artifact="s", **extra):
    return {"id": i, "ts": at(i % 60), "entity": entity, "star": 5, "ename": entity.upper(), "constellation": constellation,
            "level": 90, "damage": damage, "weapon": weapon, "artifact": artifact, **extra}


def test_window_of_ten_rows(spark):
    rows = [build(i, "a", i % 7, 80000 + 1000 * i) for i in range(10)]
    df = spark.read.schema(BUILD).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    got = vw.hot_entities(vw.pane_counts(df, "3 seconds"), 60, 3).filter("window_start = timestamp '2024-01-01 00:00:00'").first()
    assert (got.n, got.avg_constellation, got.avg_damage, got.c0, got.c6) == (10, 2.4, 84500, 20.0, 10.0)


def test_sliding_windows_equal_brute_force(spark, tmp_path):
    import random
    rng = random.Random(1)
    rows = [dict(build(i, rng.choice("ab")), ts=at(rng.randint(0, 200))) for i in range(120)]
    src = folder(tmp_path, [rows[:40], rows[40:80], rows[80:]])
    panes = rn.drain_updates(spark, vw.pane_counts(stream(spark, src, BUILD), "3 seconds"), "panes", vw.PANE_KEYS)
    got = {(int(r.w), r.entity): r.n for r in vw.hot_entities(panes, 60, 3).select(
        F.unix_seconds("window_start").alias("w"), "entity", "n").collect()}
    want = {}
    for r in rows:
        t = 1704067200 + int(r["ts"][14:16]) * 60 + int(r["ts"][17:19])
        for k in range(20):
            key = (t // 3 * 3 - 3 * k, r["entity"])
            want[key] = want.get(key, 0) + 1
    assert got == want


def test_top_order_and_shared_category(spark):
    rows = [build(i, e, artifact="shared", weapon="x" if i % 10 < 7 else "y") for e, n in
            (("a", 50), ("b", 30), ("c", 20), ("d", 10), ("e", 5)) for i in range(n)]
    df = spark.read.schema(BUILD).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    panes = vw.pane_counts(df, "60 seconds")
    assert [r.entity for r in vw.publish_top(vw.hot_entities(panes, 60, 60), 4).orderBy("pos").collect()] == list("abcd")
    mix = {(r.entity, r.name): (r.n, r.ratio) for r in vw.hot_mix(panes, "weapon", 60, 60).collect()}
    assert mix["d", "x"] == (7, 0.7) and mix["d", "y"] == (3, 0.3)
    assert {(r.name, r.n) for r in vw.hot_mix(panes, "artifact", 60, 60).filter("entity = 'd'").collect()} == {("shared", 10)}


def test_recent_list_one_entry_per_entity(spark, tmp_path):
    src = folder(tmp_path, [[build(1, "a", 1), build(2, "b")], [build(3, "a", 6, weapon=None, artifact=None)]])
    view = vw.recent_entries(stream(spark, src, BUILD))
    got = [(r.entity, r.constellation, r.weapon, r.artifact) for r in vw.recent_list(rn.drain(spark, view, "recent")).orderBy("pos").collect()]
    assert got == [("a", 6, "?", "?"), ("b", 0, "w", "s")]
    assert [r.entity for r in vw.recent_list(rn.drain(spark, vw.recent_entries(stream(spark, src, BUILD)), "r2"), 1).collect()] == ["a"]


def test_ten_draws_without_star(spark):
    draws = ["x"] * 5 + ["y"] * 3 + ["z"] * 2
    df = spark.createDataFrame([(i, n, "role", None) for i, n in enumerate(draws)], "id int, item string, type string, star int")
    df = df.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    got = vw.draw_windows(vw.draw_panes(df, "60 seconds"), 2).first()
    assert (got.draws, got.five_rate, got.top_item, [i["name"] for i in got["items"]]) == (10, 100.0, "x", ["x", "y"])


def test_late_rows_are_dropped_behind_the_watermark(spark, tmp_path):
    batches = [[build(1, "a", ts=at(0))], [build(2, "a", ts=at(600))], [build(3, "a", ts=at(1200))], [build(4, "a", ts=at(1))]]
    src = folder(tmp_path, batches)
    view = vw.pane_counts(vw.with_watermark(stream(spark, src, BUILD), "ts", "1 minute"), "3 seconds")
    seen = []
    rn.start(view, lambda df, i: seen.extend(r.pane for r in df.collect()), str(tmp_path / "c"), "update").awaitTermination()
    assert len(seen) == 3


def test_unparsable_messages_are_dropped(spark):
    rows = [('{"role": "a", "star": 5, "weapon": {"name": "w", "refinement": 1}}',), ("{oops",), ("",)]
    got = vw.parse_messages(spark.createDataFrame(rows, "value string"), schemas.BUILD_MESSAGE).collect()
    assert [(r.role, r.weapon.name) for r in got] == [("a", "w")]


@pytest.mark.parametrize("text,weapon,artifact,damage", [
    ('{"weapon": {"name": "w"}, "artifact_set": {"name": "s"}, "avg_damage": 5}', "w", "s", 5),
    ('{"weapon": "w", "artifact": {"set_name": "s"}, "damage": 6}', "w", "s", 6),
    ('{"weapon": "w", "artifact": "s"}', "w", "s", 0), ('{"weapon": null, "artifact_set": null}', "?", "?", 0), ("{}", "?", "?", 0)])
def test_polymorphic_fields(spark, text, weapon, artifact, damage):
    doc = F.parse_json(F.lit(text))
    row = spark.range(1).select(vw.message_weapon(doc), vw.message_artifact(doc), vw.message_damage(doc)).first()
    assert list(row) == [weapon, artifact, damage]


def test_draw_snapshot_forms(spark):
    totals = spark.createDataFrame([(42,)], "draws bigint")
    for text, names in (('["a","b"]', ["__ALL__", "a", "b"]), ("plain", ["__ALL__", "plain"]),
                        (json.dumps([str(i) for i in range(12)]), ["__ALL__"] + [str(i) for i in range(10)])):
        got = vw.draw_snapshot(totals, F.lit(text), F.lit("now")).orderBy("pos").collect()
        assert [r.entity for r in got] == names and [r.draws for r in got] == [42] + [0] * (len(names) - 1)


def test_landing_writes_each_row_once(spark, tmp_path):
    rows = [{"id": i, "topic_name": "t%d" % (i % 2), "ts": f"2024-01-0{1 + i % 3}T23:59:59Z"} for i in range(30)]
    src = folder(tmp_path, [rows[:10], rows[10:20], rows[20:]])
    out, ck = str(tmp_path / "out"), str(tmp_path / "c")
    for _ in range(2):
        rn.land(stream(spark, src, "id bigint, topic_name string, ts timestamp"), "topic_name", "ts", out, ck, interval=None).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 30 and got.select("topic", "dd").distinct().count() == 6
    assert spark.read.parquet(f"{out}/topic=t0/yyyy=2024/mm=01/dd=01").count() == 5


def test_empty_input(spark):
    none = spark.createDataFrame([], BUILD)
    assert vw.hot_entities(vw.pane_counts(none, "3 seconds"), 60, 3).count() == 0
    assert db.category_mix(none, ["entity"], "weapon").count() == 0
    assert vw.running_total(none).first().n == 0


def test_snapshot_top_four_with_three_names(spark):
    rows = [build(i, e, weapon=f"w{i % 5}") for e, n in zip("abcde", (25, 20, 15, 10, 5)) for i in range(n)]
    df = spark.read.schema(BUILD).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))
    panes = vw.pane_counts(df, "60 seconds")
    args = [vw.hot_mix(panes, c, 60, 60) for c in ("weapon", "artifact")]
    got = {r.entity: (json.loads(r.weapons), json.loads(r.artifacts)) for r in
           vw.snapshot_rows(vw.hot_entities(panes, 60, 60), *args, F.lit("now")).collect()}
    assert set(got) == set("abcd") and got["a"] == (["w0", "w1", "w2"], ["s"])


def test_partial_counts_keep_rows_that_come_late(spark, tmp_path):
    def row(i, seconds):
        return {"id": i, "ts": at(seconds), "entity": "a", "star": 5, "ename": f"n{i}", "constellation": 1, "level": 1,
                "damage": 10, "weapon": "w", "artifact": "x"}

    src = folder(tmp_path, [[row(1, 0), row(2, 3000)], [row(3, 1)], [row(4, 2), row(5, 3001)]])
    panes = rn.drain_partials(spark, stream(spark, src, BUILD), lambda df: vw.pane_counts(df, "3 seconds"),
                              vw.merge_panes, "late")
    got = {r.k: (r.n, r.damage, r.last.id) for r in panes.select("*", F.date_format("pane", "mm:ss").alias("k")).collect()}
    assert got == {"00:00": (3, 30, 4), "50:00": (2, 20, 5)}


def test_old_batches_of_a_history_are_removed(spark, tmp_path):
    src = folder(tmp_path, [[score(i, "a", i)] for i in range(5)])
    out = tmp_path / "out"
    rn.score_history(spark, stream(spark, src, SCORE), str(out), str(tmp_path / "c"), batches=2).awaitTermination()
    assert sorted(p.name for p in out.glob("batch=*")) == ["batch=3", "batch=4"]
    assert [r.score for r in rn.current(spark, str(out)).orderBy("id").collect()] == [0, 1, 2, 3, 4]
