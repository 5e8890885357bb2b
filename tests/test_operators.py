"""Operators on small frames with expected rows, and against brute force."""
import itertools
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline import functions as fn
from ledgerline.functions import argmax_struct, normalize_label, round_half_up
from ledgerline.operators import allocate as al, baskets as bk, dashboards as db, draws as dr, maintenance as mt
from ledgerline.operators import mining as mn, reconcile as rc, timeline as tl, usage as us
from ledgerline.sources import readers as rd, sinks as sk


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_rounding_is_half_up(spark):
    got = spark.range(1).select(*[round_half_up(F.lit(x), n).alias(str(i)) for i, (x, n) in enumerate(
        [(0.5, 0), (1.25, 1), (2.345, 2), (-0.25, 1), (33.333, 1)])]).first()
    assert list(got) == [1.0, 1.3, 2.35, -0.3, 33.3]


def test_label(spark):
    df = spark.createDataFrame([("6.6usage(1)",), ("other",)], "t string")
    assert rows(df.select(normalize_label(F.col("t"), ["usage", "duel"]).alias("t")), "t") == [("other",), ("v6.6(1)",)]


def test_argmax_first_wins_and_zero_gives_blank(spark):
    df = spark.createDataFrame([([("a", 1.0), ("b", 2.0), ("c", 2.0)],), ([("a", 0.0)],), ([],), (None,)],
                               "i array<struct<name:string,rate:double>>")
    assert [r[0] for r in df.select(argmax_struct(F.col("i"), "rate", "name")).collect()] == ["b", "", "", ""]


TIMELINE = [("v1", "a", 5, 10.0), ("v2", "a", 5, 20.0), ("v3", "a", 5, 30.0), ("v1", "b", 4, 30.0), ("v2", "b", 4, 20.0),
            ("v3", "b", 4, 25.0), ("v3", "c", 4, 25.0), ("v2", "d", 5, 9.0), ("v3", "d", 5, 8.0)]


def timeline(spark):
    return spark.createDataFrame([(*t, t[3]) for t in TIMELINE],
                                 "period string, entity string, star int, use_rate double, own_rate double")


def test_rate_changes(spark):
    got = {(r.entity, r.period): (r.change_pct, r.rank_current, r.rank_prev) for r in tl.rate_changes(timeline(spark)).collect()}
    assert got == {("a", "v2"): (10.0, 1, 2), ("a", "v3"): (10.0, 1, 1), ("b", "v2"): (-10.0, 1, 1),
                   ("b", "v3"): (5.0, 2, 1), ("d", "v3"): (-1.0, 4, 3)}


def test_trend_of_last_three(spark):
    got = {r.entity: (r.trend, r.period_count) for r in tl.period_averages(timeline(spark)).collect()}
    assert got == {"a": ("up", 3), "b": ("stable", 3), "c": ("stable", 1), "d": ("down", 2)}


def test_red_black_repeats_rows_of_a_small_period(spark):
    got = db.red_black(timeline(spark), 3).collect()
    assert [(r.rank_num, r.entity) for r in got if r.list_type == "red"] == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted((r.rank_num, r.entity) for r in got if r.list_type == "black") == [(2, "b"), (3, "c"), (4, "d")]
    assert {r.list_type for r in db.red_black(timeline(spark), 5, overlap=False).collect()} == {"red"}


def test_history_by_own_latest(spark):
    got = {r.entity: (r.periods, r.rates) for r in tl.rate_history(timeline(spark), 2, by="own_latest").collect()}
    assert got == {"a": ('["v1","v2","v3"]', "[10.0,20.0,30.0]"), "b": ('["v1","v2","v3"]', "[30.0,20.0,25.0]")}


def test_momentum_counts_missing_sides_as_zero(spark):
    df = timeline(spark).select("period", "entity", F.col("use_rate").alias("rate"))
    assert rows(tl.momentum(df), "entity", "prev_rate", "curr_rate", "change") == [
        ("b", 100.0, 83.3, -16.7), ("c", 0.0, 83.3, 83.3), ("d", 45.0, 26.7, -18.3)]
    assert rows(tl.momentum(df, "v2", "v1"), "entity", "change")[0] == ("a", 66.7)


def test_gap_does_not_match(spark):
    df = spark.createDataFrame([("v9", "a", 1.0), ("v10", "a", 3.0), ("v9", "b", 1.0), ("v11", "b", 2.0)],
                               "period string, entity string, rate double")
    order = spark.createDataFrame([("v9", 1), ("v10", 2), ("v11", 3)], "period string, period_order int")
    assert rows(tl.adjacent_change(df, order), "period", "entity", "change") == [("v10", "a", 2.0)]


def test_score_deltas_across_buckets(spark):
    rng = random.Random(3)
    data = [(rng.choice("aaab"), t, i, rng.randint(0, 100) / 10) for i, t in enumerate(sorted(rng.choices(range(50000), k=400)))]
    df = spark.createDataFrame(data, "entity string, t int, id int, score double").withColumn("ts", F.timestamp_seconds("t"))
    got = {r.id: r.delta for r in tl.score_deltas(df, 600).collect()}
    last, want = {}, {}
    for e, _, i, s in data:
        want[i] = math.floor((s - last.get(e, s)) * 10 + 0.5) / 10
        last[e] = s
    assert got == want


def test_recent_values_trim(spark):
    data = [("a", i, i, i / 10) for i in range(65)]
    df = spark.createDataFrame(data, "entity string, t int, id int, score double").withColumn("ts", F.timestamp_seconds("t"))
    row = tl.recent_values(df).first()
    assert (len(row["values"]), row["values"][0], row["values"][-1], len(row.shown), row.shown[0]) == (60, 0.5, 6.4, 22, 4.3)


@pytest.mark.parametrize("tile", [2, 3, 128])
def test_cooccurrence_of_large_baskets(spark, tile):
    rng = random.Random(5)
    groups = [[f"i{rng.randint(0, 11):02d}" for _ in range(rng.randint(1, 14))] + ["?", ""] for _ in range(60)]
    want = Counter(p for g in groups for p in itertools.combinations(sorted(set(g) - {"?", ""}), 2))
    df = spark.createDataFrame([(g,) for g in groups], "items array<string>")
    assert {(r.item_a, r.item_b): r.weight for r in bk.cooccurrence(df, tile=tile).collect()} == want


def test_rules_against_counts(spark):
    rng = random.Random(7)
    groups = [sorted(rng.sample("abcde", rng.randint(2, 4))) for _ in range(200)]
    df = spark.createDataFrame([(g,) for g in groups], "items array<string>")
    got = {r.pair: (r.n, r.confidence) for r in mn.rules(mn.itemsets(df, 0.1).cache(), F.lit(200), 0.1, 0.0).collect()}
    count = Counter(c for g in groups for k in (1, 2, 3) for c in itertools.combinations(g, k))
    want = {}
    for items, n in count.items():
        if len(items) > 1 and n >= 20:
            for cons in items:
                ante = tuple(x for x in items if x != cons)
                if n / count[ante] >= 0.1:
                    want["+".join(ante) + "-" + cons] = (n, math.floor(n / count[ante] * 10000 + 0.5) / 10000)
    assert got == want


def test_split_basket_keeps_positions(spark):
    df = spark.createDataFrame([("v1", "a + ? +  c+", 3)], "period string, basket string, use_count int")
    assert rows(bk.split_basket(df), "pos", "entity") == [(1, "a"), (3, "c")]


def test_usage_needs_four_members(spark):
    data = [(u, m, p) for u, team in enumerate(["dcba", "abcd", "abc", "abcde"]) for p, m in enumerate(team)]
    df = spark.createDataFrame(data, "uid int, entity string, pos int")
    got = rows(bk.basket_usage(df, F.lit(4), ["uid"]), "basket", "n", "use_rate", "has_rate")
    assert got == [("a+b+c+d", 2, 50.0, 35.0), ("d+c+b+a", 1, 25.0, 17.5)]
    assert rows(bk.basket_usage(df, F.lit(4), ["uid"], ordered=False), "basket", "n") == [("a + b + c + d", 3)]


def test_itemsets_of_a_size_are_counted(spark, monkeypatch):
    """Sets of one and two members equal those of the mining and do without it."""
    rnd = random.Random(3)
    data = [(sorted(rnd.sample("abcdefgh?", rnd.randint(0, 5)), key=lambda _: rnd.random()),) for _ in range(300)] + [(None,), (["rare", "a"],)]
    df = spark.createDataFrame(data, "items array<string>")
    every = [(tuple(r["items"]), r.freq) for r in mn.itemsets(df, 0.05).collect()]
    monkeypatch.setattr(mn, "FPGrowth", None)
    for size in (1, 2):
        got = mn.itemsets(df, 0.05, size)
        assert sorted((tuple(r["items"]), r.freq) for r in got.collect()) == sorted(x for x in every if len(x[0]) == size)
        assert got.columns == ["items", "freq"] and dict(got.dtypes)["freq"] == "bigint"
    assert mn.itemsets(df.limit(0), size=2).count() == 0


def test_feasible_pairs_are_not_moved(spark):
    """Only lists of baskets are shuffled, not a row for each user and pair."""
    able = spark.createDataFrame([(u, n) for u in (1, 2, None) for n in range(1, 6) if u != 2 or n != 3], "uid long, no int")
    pairs = spark.createDataFrame([(1, 3), (1, 4), (2, 5), (3, 5), (7, 8), (5, 9)], "a int, b int")
    got = bk.feasible_pairs(pairs, able)
    assert rows(got, "uid", "a", "b") == [(1, 1, 3), (1, 1, 4), (1, 2, 5), (1, 3, 5), (2, 1, 4), (2, 2, 5)]
    moves = [line.strip() for line in got._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
    assert len(moves) == 1 and "BroadcastHashJoin" in moves[0]


def test_disjoint_and_feasible_pairs(spark):
    sets = {"x": "ab", "y": "cd", "z": "bc", "w": "e"}
    df = spark.createDataFrame([(k, list(v), float(i)) for i, (k, v) in enumerate(sets.items(), 1)],
                               "basket string, items array<string>, use_rate double")
    lead = bk.leading_baskets(df, top=10).cache()
    number = {r.basket: r.no for r in lead.collect()}
    want = {tuple(sorted((number[a], number[b]))) for a, b in itertools.combinations(sets, 2) if not set(sets[a]) & set(sets[b])}
    pairs = bk.disjoint_pairs(lead)
    assert {(r.a, r.b) for r in pairs.collect()} == want
    owned = {"u": "abcd", "v": "abce", "t": "a"}
    inv = spark.createDataFrame([(u, e) for u, es in owned.items() for e in es + es[0]], "uid string, entity string")
    name = {no: k for k, no in number.items()}
    assert {(r.uid, r.a, r.b) for r in bk.feasible_pairs(pairs, bk.feasible_baskets(lead, inv)).collect()} == {
        (u, a, b) for u, es in owned.items() for a, b in want if set(sets[name[a]] + sets[name[b]]) <= set(es)}


def test_blend_baskets_matches_sets_first_wins(spark):
    base = spark.createDataFrame([("a+b", ["a", "b"], 10.0, 0.0), ("c", ["c"], 5.0, 5.0)],
                                 "basket string, members array<string>, use_rate double, has_rate double")
    other = spark.createDataFrame([("b+a", ["b", "a"], 50.0, 7.0, 1), ("a+b+a", ["a", "b", "a"], 90.0, 9.0, 2), ("c", ["z"], 1.0, 1.0, 3)],
                                  "basket string, members array<string>, use_rate double, has_rate double, ord int")
    assert rows(bk.blend_baskets(base, other), "basket", "use_rate", "has_rate") == [
        ("a+b", 11.0, 7.0), ("a+b+a", 90.0, 9.0), ("b+a", 50.0, 7.0), ("c", 5.0, 5.0)]


@pytest.mark.parametrize("counts,total", [([1] * 700, 1000), ([1, 4, 9, 16, 25, 2, 3], 11), ([5] * 10 + [7] * 300 + [11] * 9, 97)])
def test_allocation_adds_up(spark, counts, total):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "k int, n int")
    got = {r.k: r.quota for r in al.allocate(df, "k", "n", total).collect()}
    assert len(got) == len(counts) and sum(got.values()) == total
    whole = sum(math.sqrt(c) for c in counts)
    share = {i: math.sqrt(c) * total / whole for i, c in enumerate(counts)}
    assert all(q in (math.floor(share[i] + 1e-9), math.floor(share[i] + 1e-9) + 1, math.floor(share[i])) for i, q in got.items())
    rest = {i: share[i] - math.floor(share[i]) for i in got}
    up = [rest[i] for i, q in got.items() if q > math.floor(share[i])]
    down = [rest[i] for i, q in got.items() if q == math.floor(share[i])]
    assert not up or not down or min(up) >= max(down) - 1e-6


def test_weighted_pick_follows_the_weights(spark):
    items = spark.createDataFrame([("a", 1.0), ("b", 7.0), ("c", 0.0), ("d", 2.0)], "item string, w double")
    got = Counter(r.item for r in al.weighted_pick(spark.range(5000), "id", items, "item", "w", cells=16).collect())
    assert sum(got.values()) == 5000 and "c" not in got
    assert abs(got["b"] / 5000 - 0.7) < 0.03 and abs(got["a"] / 5000 - 0.1) < 0.03


def test_maintenance(spark):
    cols = "k int, a string, b string"
    old = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", "b2")], cols)
    new = spark.createDataFrame([(2, "A2", "B2"), (3, "A3", "B3")], cols)
    assert rows(mt.upsert(old, new, ["k"], ["a"]), "k", "a", "b") == [(1, "a1", "b1"), (2, "A2", "b2"), (3, "A3", "B3")]
    twice = new.union(spark.createDataFrame([(3, "A0", "B0")], cols))
    assert rows(mt.insert_ignore(old, twice, ["k"], ["a"]), "k", "a") == [(1, "a1"), (2, "a2"), (3, "A0")]
    assert rows(mt.replace_partition(old, new, "k"), "k", "a") == [(1, "a1"), (2, "A2"), (3, "A3")]
    assert rows(mt.enrich(old, new, "k", "b"), "k", "b") == [(1, "b1"), (2, "B2")]
    assert rows(mt.enrich(old, new, "k", "b", insert=True), "k", "a", "b")[2] == (3, None, "B3")


def test_retention(spark):
    df = spark.sql("SELECT timestamp_ntz '2024-01-01 00:00:00' AS ts, 1 AS id UNION ALL SELECT timestamp_ntz '2024-01-09 00:00:00', 2")
    assert rows(mt.retain(df, "ts", "2024-01-10 00:00:00", "7 DAYS"), "id") == [(2,)]


def test_blend_and_verdict(spark):
    schema = "entity string, star int, use_rate double, own_rate double"
    a = spark.createDataFrame([("a", 5, 10.0, 50.0), ("b", 4, 0.0, 1.0), ("c", 0, 3.0, 3.0)], schema)
    b = spark.createDataFrame([("a", 5, 20.0, 52.0), ("b", 4, 8.0, 0.0), ("d", 5, 4.0, 4.0)], schema)
    assert rows(rc.blend(a, b, "entity", ["use_rate"]), "entity", "star", "use_rate") == [
        ("a", 5, 10.2), ("b", 4, 8.0), ("c", 4, 3.0), ("d", 5, 4.0)]
    v = rc.verdict(rc.reconcile(a, b)).first()
    assert (v.compared, v.passed, v.pass_rate, v.mean_dev, v.verdict) == (2, 0, 0.0, 5.25, "FAIL")
    same = rc.verdict(rc.reconcile(a, a)).first()
    assert (same.passed, same.verdict) == (3, "PASS")
    empty = rc.verdict(rc.reconcile(a, a.limit(0))).first()
    assert (empty.compared, empty.pass_rate, empty.mean_dev) == (0, 0.0, 0.0)


def test_draw_stats_default_total(spark):
    df = spark.createDataFrame([(3, "x", None, True), (1, "x", "weapon", False), (2, "y", "role", True)],
                               "id int, item string, type string, is_up boolean")
    assert rows(dr.draw_stats(df), "item", "type", "five", "up", "five_rate", "total") == [
        ("__ALL__", "summary", 3, 2, 0.06, 5000), ("x", "weapon", 2, 1, 0.06, 5000), ("y", "role", 1, 1, 0.06, 5000)]


def test_usage_denominator_is_distinct_users(spark):
    df = spark.createDataFrame([("v", 1, "a", 5, 0, 80, 1), ("v", 2, "a", 5, 1, 90, 0), ("v", 3, "B", 4, 2, 1, 1)],
                               "period string, uid int, entity string, star int, constellation int, level int, used int")
    got = {r.entity: (r.users, r.own_rate, r.use_rate, r.avg_level) for r in us.usage_rates(df).collect()}
    assert got == {"a": (3, 66.67, 33.33, 85.0), "B": (3, 33.33, 33.33, 1.0)}


def test_csv_by_position_with_bom(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes("﻿version,name,rate\nv1,甲,1.50\n".encode())
    assert rows(rd.scan_csv(spark, str(tmp_path), "period string, entity string, use_rate decimal(5,2)"), "period", "entity") == [("v1", "甲")]


def test_documents_in_both_layouts(spark):
    docs = spark.createDataFrame([('{"title": "t1", "result": [{"s": []}, [{"name": "a", "star": 5, "use": 3, "own_rate": 1.5, "rank_class": "s"}]]}',),
                                  ('{"title": "t2", "result": [{"name": "b", "use_count": 2, "rank": "x"}]}',),
                                  ('{"title": "t3", "result": ["odd"]}',), ("broken",)], "body string")
    assert rows(rd.read_documents(docs), "period", "entity", "star", "use_count", "own_rate", "tier") == [
        ("t1", "a", 5, 3, 1.5, "s"), ("t2", "b", 0, 2, 0.0, "x")]


def test_split_text_forms(spark):
    lines = spark.createDataFrame([("v,u,a,5,0,90,",), ("v,u,a,5",), ("v,u, ,5,0,90,1",), ("key\tv,u,b,5,0,90,1",)], "value string")
    names = ["period", "uid", "entity", "star", "constellation", "level", "used"]
    assert rows(rd.split_text(lines, 7, names, key="entity"), "entity", "used") == [("a", ""), ("b", "1")]


def test_bad_lines(spark, tmp_path):
    (tmp_path / "x.txt").write_text('{"a": 1}\n{"a": \n\n{"a": 2}\n')
    assert rows(rd.scan_jsonl(spark, str(tmp_path), "a int", "skip"), "a") == [(1,), (2,)]
    assert rows(rd.scan_jsonl(spark, str(tmp_path), "a int", "count"), "is_bad", "n") == [(False, 2), (True, 1)]
    assert rows(rd.scan_jsonl(spark, str(tmp_path), "a int").filter("is_bad"), "raw") == [('{"a": ',)]


def test_members_and_tiers(spark):
    docs = ['{"name": "t1", "roles": ["a", {"name": "b"}, {"role": "c"}, {}], "use_count": 4}',
            '{"name": "t2", "roles": [], "members": "[\\"x\\"]", "use_rate": 0.25}', '{"name": "t3", "roles": "oops"}', '{"name": "t4", "members": ["y"]}']
    df = spark.createDataFrame([(d,) for d in docs], "j string").select(F.parse_json("j").alias("doc"))
    assert rows(bk.explode_members(df), "basket", "pos", "entity", "weight") == [
        ("t1", 1, "a", 4), ("t1", 2, "b", 4), ("t1", 3, "c", 4), ("t1", 4, "?", 4), ("t2", 1, "x", 25), ("t4", 1, "y", 1)]
    tiers = ['{"S": ["a", {"name": "b", "constellation": 2}]}', '[{"tier": "A", "chars": ["c"]}, {"name": "B", "chars": [{"constellation": 1}]}]']
    df = spark.createDataFrame([(d,) for d in tiers], "j string").select(F.parse_json("j").alias("doc"))
    assert rows(bk.explode_tiers(df), "tier", "entity", "constellation") == [
        ("A", "c", 0), ("B", "?", 1), ("S", "a", 0), ("S", "b", 2)]


def test_paired_documents(spark):
    left = spark.createDataFrame([("7_box.json", '{"uid": "7"}'), ("8_box.json", '{"uid": "8"}')], "file string, body string")
    right = spark.createDataFrame([("7_record.json", '{"uid": "7"}')], "file string, body string")
    assert rows(rd.to_lines(rd.pair_documents(left, right, "v1")), "value") == [
        ('{"uid":"7","version":"v1","box":{"uid":"7"},"record":{"uid":"7"}}',),
        ('{"uid":"8","version":"v1","box":{"uid":"8"},"record":null}',)]


def test_pairs_by_file_names(spark, tmp_path):
    """Users of one id in two folders stay apart; ids may hold any character of a file name."""
    files = {"v1/7_box.json": '{"uid": "7"}', "v1/7_record.json": '{\n "n": 1\n}', "v2/7_box.json": '{"uid": "seven"}', "v2/8_record.json": "{}",
             "v 3+é%/a b+ü%20_box.json": "[1]", "v 3+é%/a b+ü%20_record.json": "{broken", "v1/9_box.json": "", "v1/_box.json": "{}",
             "v1/notes.txt": "x", "v1/deep/7_box.json": "{}"}
    for name, body in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(body, encoding="utf-8")
    made = rd.to_lines(rd.scan_pairs(spark, str(tmp_path)))
    assert rows(made, "value") == [
        ('{"uid":"7","version":"deep","box":{},"record":null}',),
        ('{"uid":"7","version":"v1","box":{"uid":"7"},"record":{"n":1}}',),
        ('{"uid":"7","version":"v2","box":{"uid":"seven"},"record":null}',),
        ('{"uid":"a b+ü%20","version":"v 3+é%","box":[1],"record":null}',)]
    assert {r.version for r in rd.scan_pairs(spark, str(tmp_path), "now").collect()} == {"now"}
    # One scan and one exchange for both kinds.
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_rerun_of_a_partition_write(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("v1", 1), ("v2", 2)], "period string, n int")
    for part in (df, df.filter("period = 'v2'"), df.filter("period = 'v2'")):
        sk.write_partitions(part, path, ["period"])
    assert rows(spark.read.parquet(path), "period", "n") == [("v1", 1), ("v2", 2)]


def test_page_beyond_the_end(spark):
    df = spark.createDataFrame([("Ab", 1), ("aB", 2), ("c", 3)], "entity string, n int")
    assert rows(db.search_page(df, "AB", "entity", [("n", "desc")], 1, 1), "entity", "total") == [("aB", 2)]
    assert rows(db.search_page(df, "AB", "entity", [("n", "desc")], 3, 1), "entity") == []


def test_dimension_keeps_first(spark):
    df = spark.createDataFrame([(" a ", "", 1), ("a", "x", 2), ("", "y", 3), (None, "z", 4)], "name string, avatar string, i int")
    assert rows(dr.dedupe_dim(df, "name", "avatar", "i"), "name", "avatar") == [("a", "")]
    assert rows(dr.dedupe_dim(df, "name", "avatar", "i", need_attribute=True), "name", "avatar") == [("a", "x")]


def test_top_n_limits_before_the_shuffle(spark):
    plan = db.top_n(spark.range(100).withColumn("g", F.col("id") % 3), 5, [("id", "desc")], per="g")
    assert plan._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_large_group_limit(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 2)
    got = db.top_n(df, 1500, [("id", "desc")], per="g")
    assert rows(got.groupBy("g").agg(F.count("*").alias("n"), F.min("id").alias("low")), "g", "n", "low") == [(0, 1500, 2000), (1, 1500, 2001)]


def test_sums_keep_digits(spark):
    def total(values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(fn.exact_sum("x")).first()[0]
    assert total([0.00004, 0.00004, 0.00003]) == 0.00011
    assert total([1e25, 1.0, None]) == 1e25 + 1 and math.isnan(total([float("nan"), 1.0]))
    assert total([None]) is None


def test_rounding_of_signs_and_odd_numbers(spark):
    rows = [(-0.25, -0.3), (0.25, 0.3), (-0.04, 0.0), (float("inf"), float("inf")), (1e300, 1e300), (None, None)]
    got = spark.createDataFrame(rows, "x double, want double").select(fn.round_half_up("x", 1).alias("r"), "want").collect()
    assert all(r.r == r.want for r in got)
    assert math.isnan(spark.range(1).select(fn.round_half_up(F.lit(float("nan")), 1)).first()[0])


def test_null_rates_rank_last_and_stay(spark):
    df = spark.createDataFrame([("1", "a", 5.0), ("1", "b", None), ("2", "a", None), ("2", "b", 3.0), ("3", "a", 4.0), ("3", "b", 3.0)],
                               "period string, entity string, use_rate double")
    ranked = {(r.period, r.entity): r.k for r in tl.rank_within(df, "period", "use_rate", "k").collect()}
    assert ranked == {("1", "a"): 1, ("1", "b"): 2, ("2", "a"): 2, ("2", "b"): 1, ("3", "a"): 1, ("3", "b"): 2}
    changes = {(r.entity, r.period): r.rank_prev for r in tl.rate_changes(df).collect()}
    assert changes == {("a", "2"): 1, ("b", "3"): 1}


def test_lines_of_the_wrong_shape(spark):
    from ledgerline.sources.readers import handle_bad_lines
    lines = spark.createDataFrame([(x,) for x in ("5", "[1]", '{"star":"abc"}', '{"star":4}', "{", '{"other":1}', " ")], "value string")
    got = {r.raw: (r.is_bad, r.star) for r in handle_bad_lines(lines, "star int").collect()}
    assert got == {"5": (True, None), "[1]": (True, None), '{"star":"abc"}': (True, None), '{"star":4}': (False, 4), "{": (True, None),
                   '{"other":1}': (False, None)}


def test_ranks_of_a_continuous_measure_are_exact(spark):
    rates = {g: [(i * 7919 % 4001) / 7 for i in range(n)] for g, n in (("a", 4001), ("b", 5), ("c", 1))}
    rows = [(g, v) for g, values in rates.items() for v in values] + [("b", None), ("b", None), (None, 1.5), (None, 2.5)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.v): r.k for r in tl.rank_within(df, "g", "v", "k").collect()}
    groups = {**{g: v for g, v in rates.items()}, None: [1.5, 2.5]}
    want = {(g, v): 1 + sum(x > v for x in values) for g, values in groups.items() for v in values}
    assert got == {**want, ("b", None): 6}


def test_ranks_of_hot_values_and_many_cuts(spark, monkeypatch):
    """Two thirds of the rows have one value; cuts and tasks change nothing."""
    import random
    rnd = random.Random(1)
    rows = [(rnd.choice("ab"), 1.5 if rnd.random() < 0.66 else rnd.choice([None, rnd.randint(0, 40) / 4]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double, i int")
    monkeypatch.setattr(tl, "HOT_ROWS", 100)
    monkeypatch.setattr(tl, "CUT_VALUES", 7)
    got = {r.i: r.k for r in tl.rank_within(df, "g", "v", "k").collect()}
    groups = {g: [v for x, v, _ in rows if x == g] for g in "ab"}
    assert got == {i: 1 + sum(x is not None and (v is None or x > v) for x in groups[g]) for g, v, i in rows}
