"""One hand-made record per rule, and records that break two rules."""
import json

import pytest

from ledgerline.operators import quality as q


def item(name="a", star=5, constellation=0, level=90):
    return {"name": name, "star": star, "constellation": constellation, "level": level}


def team(half, names, no=1):
    return {"half": half, "team_index": no, "members": [{"name": n, "star": 5} for n in names]}


def record(uid="u", box_uid=None, rec_uid=None, items=None, teams=None, **extra):
    doc = {"uid": uid, "version": "v1",
           "box": {"uid": uid if box_uid is None else box_uid,
                   "characters": [item("a"), item("b", 4)] if items is None else items},
           "record": {"uid": uid if rec_uid is None else rec_uid,
                      "teams": [team(1, ["a"]), team(2, ["b"])] if teams is None else teams}}
    doc.update(extra)
    return json.dumps(doc)


MANY = [item(n) for n in "abcdefg"]
CASES = [
    ("accepted", record(), None),
    ("text numbers", record(items=[item("a", "5", "6", "1"), item("b", 4)]), None),
    ("no version", json.dumps({k: v for k, v in json.loads(record()).items() if k != "version"}), None),
    ("not json", '{"uid": ', "bad_uid"),
    ("json null", "null", "bad_uid"),
    ("empty uid", record(uid=""), "bad_uid"),
    ("null record", record(record=None), "bad_uid"),
    ("no box", json.dumps({"uid": "u", "record": {"uid": "u"}}), "bad_uid"),
    ("box uid differs", record(box_uid="x"), "bad_uid"),
    ("record uid differs", record(rec_uid="x"), "bad_uid"),
    ("empty box", record(items=[]), "empty_box"),
    ("box is text", record(box={"uid": "u", "characters": "abc"}), "empty_box"),
    ("three teams", record(teams=[team(1, ["a"]), team(2, ["b"]), team(2, ["b"])]), "bad_teams"),
    ("wrong halves", record(teams=[team(2, ["a"]), team(1, ["b"])]), "bad_teams"),
    ("missing name", record(items=[item("")]), "missing_field"),
    ("null name", record(items=[item(None)]), "missing_field"),
    ("odd item", record(items=[item("a"), "zz"]), "missing_field"),
    ("star 3", record(items=[item("a", 3)]), "bad_star"),
    ("star text", record(items=[item("a", "five")]), "bad_star"),
    ("constellation 7", record(items=[item("a", 5, 7)]), "bad_const"),
    ("level 0", record(items=[item("a", 5, 0, 0)]), "bad_level"),
    ("level 91", record(items=[item("a", 5, 0, 91)]), "bad_level"),
    ("empty team", record(teams=[team(1, ["a"]), team(2, [])]), "bad_team_size"),
    ("five names", record(items=MANY, teams=[team(1, "abcde"), team(2, "g")]), "bad_team_size"),
    ("repeats count once", record(items=MANY, teams=[team(1, "abcdda"), team(2, "g")]), None),
    ("blank member", record(teams=[team(1, ["a", ""]), team(2, ["b"])]), None),
    ("overlap", record(teams=[team(1, ["a"]), team(2, ["a", "b"])]), "overlap"),
    ("missing char", record(teams=[team(1, ["a"]), team(2, ["z"])]), "missing_char"),
    # two broken rules: the earlier one wins
    ("level before star of the next item", record(items=[item("a", 5, 0, 0), item("b", 3)]), "bad_level"),
    ("star before halves", record(items=[item("a", 3)], teams=[team(2, ["a"]), team(1, ["b"])]), "bad_star"),
    ("three teams before star", record(items=[item("a", 3)], teams=[team(1, ["a"])] * 3), "bad_teams"),
    ("overlap before missing", record(teams=[team(1, ["a", "z"]), team(2, ["a"])]), "overlap"),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(label, line) for label, line, _ in CASES] + [("blank", "   ")]
    return q.classify_records(spark.createDataFrame(rows, "label string, value string")).cache()


def test_first_failing_rule_wins(classified):
    got = {r.label: r.reason for r in classified.select("label", "reason").collect()}
    assert got == {label: reason for label, _, reason in CASES}


def test_unfolded_rows(spark):
    doubled = record(items=[item("a", 5, 1), item("b", 4, 2), item("a", 5, 3, 50), item("c", 4)],
                     teams=[team(1, ["a", ""], 7), team(2, ["b"], 9)])
    done = q.classify_records(spark.createDataFrame([(doubled,), (record(uid=""),)], "value string"))
    items = {r.entity: (r.star, r.constellation, r.level, r.used) for r in q.inventory_detail(done).collect()}
    assert items == {"a": (5, 3, 50, 1), "b": (4, 2, 90, 1), "c": (4, 0, 90, 0)}
    members = sorted((r.half, r.basket_no, r.pos, r.entity) for r in q.lineup_detail(done).collect())
    assert members == [(1, 7, 1, "a"), (1, 7, 2, ""), (2, 9, 1, "b")]


def test_counters(classified):
    total = {r.reason: r.n for r in q.reason_counts(classified).collect()}
    assert total["accepted"] == sum(reason is None for _, _, reason in CASES)
    assert q.quality_counters(classified).first().accepted == total["accepted"]


LINES = [
    ("v1,a,5,1,2,10.5,20,s1", None), ("v1,a,4,1,2,0,100,", None), ("v1,a,4,1,2,0,100,,extra", None),
    ("v1,a,5,1,2,10", "parse_error"), (",a,5,1,2,1,1,s", "missing_field"), ("v1, ,5,1,2,1,1,s", "missing_field"),
    ("v1,a,x,1,2,1,1,s", "parse_error"), ("v1,a,3,1,2,1,1,s", "bad_star"), ("v1,a,5,1,2,abc,1,s", "parse_error"),
    ("v1,a,5,1,2,-1,1,s", "bad_rate"), ("v1,a,5,1,2,1,100.1,s", "bad_rate"), ("v1,a,5,1,2,NaN,1,s", "bad_rate"),
    ("v1,a,5,1.5,2,1,1,s", "parse_error"), ("v1,a,5,1,-2,1,1,s", "bad_count"), ("v1,a,5,1,2,1,1,z", "bad_tier"),
    ("v1,a,3,1,2,999,1,z", "bad_star"), ("v1,a,5,-1,2,999,1,z", "bad_rate"), ("v1,,x,1,2,1,1,z", "missing_field"),
]


def test_flat_lines(spark):
    rows = [(line,) for line, _ in LINES] + [("version,name,star,use,own,use_rate,own_rate,tier",), ("  ",)]
    got = {r.line: r.reason for r in q.classify_csv(spark.createDataFrame(rows, "value string")).collect()}
    assert got == dict(LINES)


def test_batches_keep_the_newest(spark):
    rows = [(i, 10, i % 3) for i in range(1, 151)]
    got = {r.batch: r for r in q.batch_quality(spark.createDataFrame(rows, "batch int, total int, rejected int")).collect()}
    assert sorted(got) == list(range(51, 151))
    bad = sum(i % 3 for i in range(1, 121))
    assert got[120].cum_rate == pytest.approx(round((1200 - bad) / 1200 * 100, 2))
    assert got[120].clean_rate == 100.0


def test_record_lines_are_shuffled_once(spark, monkeypatch):
    from conftest import SF_DIR
    from ledgerline.plans import relations
    monkeypatch.setattr(relations, "stage", lambda spark, df, label: df)
    plan = relations.record_lines(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(period" in line for line in plan.splitlines()) == 1
