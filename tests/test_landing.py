"""Landing by bytes and counters of one write."""
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality as q
from ledgerline.sources import counted as ct
from ledgerline.streaming import landing as ld
from test_streaming import folder, stream

ROW = "id bigint, topic_name string, ts timestamp, body string"


def rows(spark, n, topics, seed=0, size=1000):
    rnd = random.Random(seed)
    values = [(i, rnd.choice(topics), f"2024-01-0{1 + i % 3}T10:00:00Z", "x" * size) for i in range(n)]
    return spark.createDataFrame(values, "id bigint, topic_name string, ts string, body string").withColumn("ts", F.col("ts").cast("timestamp"))


def test_folder_of_n_bytes_gives_n_by_target_files(spark, tmp_path):
    """A third and more of all rows is one topic; its day gets many writers, small folders share theirs."""
    land = ld.Landing(spark, str(tmp_path), "topic_name", "ts", target=50_000)
    df = rows(spark, 3000, ["hot"] * 8 + ["a", "b"])
    assert land.add(df, 0) and not land.add(df, 0)
    by_folder = {}
    for f in land.current()["files"]:
        by_folder.setdefault(tuple(f["folder"]), []).append(f["bytes"])
    assert len(by_folder) == 9
    for (topic, *_), sizes in by_folder.items():
        want = sum(sizes) / 50_000
        assert want - 1 <= len(sizes) <= want + 2 and max(sizes) < 50_000 * 1.6
        assert topic != "hot" or len(sizes) > 10
    assert sorted(r.id for r in land.read().collect()) == list(range(3000))
    assert land.read(topic="a", dd="02").count() == df.filter("topic_name = 'a' AND id % 3 = 1").count()


def test_small_files_are_joined_once(spark, tmp_path):
    land = ld.Landing(spark, str(tmp_path), "topic_name", "ts", target=40_000, keep_versions=0)
    for b in range(6):
        land.add(rows(spark, 60, ["a", "b", None], seed=b).withColumn("id", F.col("id") + 100 * b), b)
    before = land.current()["files"]
    want = sorted((r.id, r.topic or "", r.dd) for r in land.read().collect())
    assert len(want) == 360
    joined = land.compact()
    after = land.current()["files"]
    assert joined > 20 and len(after) < len(before) / 3
    assert sorted((r.id, r.topic or "", r.dd) for r in land.read().collect()) == want
    assert land.compact() == 0 and land.current()["files"] == after
    land.add(rows(spark, 1, ["a"]), 6)
    assert land.read().count() == 361


def test_landing_as_a_stream_with_a_failure(spark, tmp_path, monkeypatch):
    batches = [[{"id": 10 * b + i, "topic_name": "t", "ts": "2024-02-28T23:59:59Z", "body": "y"} for i in range(10)] for b in range(4)]
    source, land = folder(tmp_path, batches), ld.Landing(spark, str(tmp_path / "out"), "topic_name", "ts")
    real, calls = ld.swap_text, []

    def sometimes(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        real(*args)

    monkeypatch.setattr(ld, "swap_text", sometimes)
    with pytest.raises(Exception, match="lost"):
        land.start(stream(spark, source, ROW), str(tmp_path / "c"), None, 2).awaitTermination()
    assert land.read().count() == 10
    land.start(stream(spark, source, ROW), str(tmp_path / "c"), None, 2).awaitTermination()
    assert sorted(r.id for r in land.read(yyyy="2024", mm="02", dd="28").collect()) == list(range(40))


def test_bins():
    rnd = random.Random(1)
    for _ in range(100):
        sizes = [(str(i), rnd.randint(1, 120)) for i in range(rnd.randint(0, 40))]
        bins, of = ld.packed(sizes, 100), dict(sizes)
        assert sorted(n for b in bins for n in b) == sorted(of)
        assert all(len(b) == 1 or sum(of[n] for n in b) <= 100 for b in bins)
        assert len(bins) <= 2 * sum(of.values()) / 100 + 1


def test_counters_of_one_write(spark, tmp_path):
    lines = spark.createDataFrame([("version,name,star,use,own,use_rate,own_rate,tier",), ("1,a,5,1,1,2,3,s",), ("1,a,3,1,1,2,3,s",), ("1,,5,1,1,2,3,s",),
                                   ("bad",), ("1,a,5,1,1,200,3,s",)], "value string")
    classified = q.classify_csv(lines)
    watched, _ = ct.observed(classified, "reason", q.CSV_REASONS)
    plan = watched._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1 and "CollectMetrics" in plan
    counters = ct.route_counted(classified, "reason", str(tmp_path / "r"), q.CSV_REASONS, more={"names": F.count(F.nullif("f_name", F.lit("")))})
    filed = {r["reason"]: r["n"] for r in spark.read.parquet(str(tmp_path / "r")).groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert filed == {k: v for k, v in counters.items() if v and k not in ("total", "names")}
    assert counters["total"] == 5 and counters["other"] == 0 and counters["names"] == 3
    assert {r["reason"]: r["n"] for r in q.reason_counts(classified).collect()} == filed


def test_counters_of_a_stream(spark, tmp_path):
    batches = [[{"value": "1,a,5,1,1,2,3,s"}, {"value": "bad"}], [{"value": "1,a,3,1,1,2,3,s"}]]
    log = ct.counters_log(spark, str(tmp_path / "log"))
    for _ in range(2):
        ct.route_stream(stream(spark, folder(tmp_path, batches) if not (tmp_path / "in").exists() else str(tmp_path / "in"), "value string"),
                        q.classify_csv, str(tmp_path / "out"), log, str(tmp_path / "c"), q.CSV_REASONS, ["line"]).awaitTermination()
    got = {(r.batch, r.counter): r.n for r in log.read("counters").filter("n > 0").collect()}
    assert got == {(0, "total"): 2, (0, "accepted"): 1, (0, "parse_error"): 1, (1, "total"): 1, (1, "bad_star"): 1}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
