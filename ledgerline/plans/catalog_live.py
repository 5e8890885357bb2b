"""Live views: each runs as a stream over the events table until all input is taken."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dashboards as db, maintenance as mt
from ..operators.timeline import recent_values
from ..session import fresh_path
from ..sources.sinks import stage
from ..streaming import cycle as cy, keyed as ky, landing as ld, panelog as pl, runner as rn, views as vw
from . import relations as r
from .registry import ORACLES, query
from .relations import pct, rnd, sql

HOUR, QUARTER = 3600, 900
WS = "strftime(make_timestamp(ws*1000000), '%Y-%m-%d %H:%M:%S')"


def at(col):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def pane_log(spark, sf, of, partial, merge, pane, label):
    """Panes of a stream of several unordered batches; rows more than a day late are corrections."""
    base = fresh_path(spark, label)
    log = pl.PaneLog(spark, f"{base}/log", merge, 86400, pane, parts=2)
    pl.count_panes(of(r.unordered_stream(spark, sf)), partial, log, f"{base}/checkpoint").awaitTermination()
    return log


def panes(spark, sf):
    """Pane counts of the build stream, in closed, open and corrected parts."""
    return pane_log(spark, sf, r.builds_of, lambda df: vw.pane_counts(df, f"{QUARTER} seconds"), vw.merge_panes, "pane", "panes").read()


HOT = f"""SELECT {WS} AS window_start, entity, count(*) AS n, max_by(star, id) AS star, max_by(ename, id) AS ename,
  {rnd('sum(constellation)::DOUBLE/count(*)', 1)} AS avg_constellation, floor(sum(damage)/count(*))::BIGINT AS avg_damage, """ + ", ".join(
    f"{pct(f'count(CASE WHEN constellation={c} THEN 1 END)', 'count(*)', 1)} AS c{c}" for c in range(7)) + " FROM hot_rows GROUP BY 1, 2"


@query("j2_hot_entities", sql(HOT, "hot_rows"))
def hot_entities(spark, sf):
    """Sliding windows put together from streamed panes."""
    return vw.hot_entities(panes(spark, sf), HOUR, QUARTER).withColumn("window_start", at("window_start"))


@query("j2_hot_entities_batch", sql(HOT, "hot_rows"))
def hot_entities_batch(spark, sf):
    """The same view over a batch frame."""
    counted = vw.pane_counts(r.builds(spark, sf), f"{QUARTER} seconds")
    return vw.hot_entities(counted, HOUR, QUARTER).withColumn("window_start", at("window_start"))


@query("j2_top_entities", sql(f"""SELECT window_start, entity, n, pos FROM (SELECT {WS} AS window_start, entity, count(*) AS n,
    row_number() OVER (PARTITION BY ws ORDER BY count(*) DESC, entity) AS pos FROM hot_rows GROUP BY ws, entity) WHERE pos <= 4""", "hot_rows"))
def top_entities(spark, sf):
    hot = vw.hot_entities(vw.pane_counts(r.builds(spark, sf), f"{QUARTER} seconds"), HOUR, QUARTER)
    return vw.publish_top(hot, 4).select(at("window_start"), "entity", "n", "pos")


@query("j2_hot_mix", sql(f"""SELECT window_start, entity, name, n, pos, {rnd('n::DOUBLE/t', 2)} AS ratio FROM (
    SELECT {WS} AS window_start, entity, weapon AS name, count(*) AS n, sum(count(*)) OVER (PARTITION BY ws, entity) AS t,
      row_number() OVER (PARTITION BY ws, entity ORDER BY count(*) DESC, weapon) AS pos
    FROM hot_rows WHERE weapon <> '?' GROUP BY ws, entity, weapon)""", "hot_rows"))
def hot_mix(spark, sf):
    counted = vw.pane_counts(r.builds(spark, sf), f"{QUARTER} seconds")
    return vw.hot_mix(counted, "weapon", HOUR, QUARTER).withColumn("window_start", at("window_start"))


@query("j3_recent_entries", sql("""SELECT entity, star, constellation, level, damage, weapon, artifact,
    row_number() OVER (ORDER BY ts DESC, id DESC)::INTEGER AS pos
  FROM (SELECT * FROM builds QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC, id DESC) = 1)""", "builds"))
def recent_entries(spark, sf):
    view = vw.recent_entries(r.builds_of(r.event_stream(spark, sf)))
    return vw.recent_list(rn.drain(spark, view, "recent")).select(
        "entity", "star", "constellation", "level", "damage", "weapon", "artifact", "pos")


@query("j3_recent_board", sql("""SELECT entity, star, constellation, level, damage, weapon, artifact, pos FROM (
    SELECT *, row_number() OVER (ORDER BY ts DESC, id DESC)::INTEGER AS pos FROM (
      SELECT * FROM builds QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC, id DESC) = 1)) WHERE pos <= 3""", "builds"))
def recent_board(spark, sf):
    """The three entities with the newest messages, from a state of three rows, over unordered batches."""
    base = fresh_path(spark, "recent")
    log = ky.recent_log(spark, f"{base}/log")
    r.replay(spark, sf, lambda events: ky.keep_recent_list(r.builds_of(events), log, f"{base}/checkpoint", keep=3))
    return vw.recent_list(log.read("recent"), 3).select("entity", "star", "constellation", "level", "damage", "weapon", "artifact", "pos")


@query("j4_running_total", "SELECT count(*) AS n FROM events")
def running_total(spark, sf):
    return rn.drain(spark, vw.running_total(r.event_stream(spark, sf)), "total")


@query("j6_running_counts", sql("SELECT item, count(*) AS n FROM draws GROUP BY 1", "draws"))
def running_counts(spark, sf):
    return rn.drain(spark, vw.running_counts(r.draws_of(r.event_stream(spark, sf)), "item"), "counts")


@query("j6_counts_log", sql("SELECT item, count(*) AS n FROM draws GROUP BY 1", "draws"))
def counts_log(spark, sf):
    """Counts of all items in a change log that is compacted on the way."""
    base = fresh_path(spark, "counts")
    log = ky.counts_log(spark, f"{base}/log", "item", compact_after=2)
    r.replay(spark, sf, lambda events: ky.keep_counts(vw.running_counts(r.draws_of(events), "item"), log, f"{base}/checkpoint"), 4)
    return log.read("counts")


FIVE = "count(CASE WHEN star=5 OR type IN ('role','weapon') THEN 1 END)"


@query("j5_draw_windows", sql(f""", p AS (SELECT floor(epoch(ts)/3600)::BIGINT*3600 AS ws, item, count(*) AS n, {FIVE} AS five FROM draws GROUP BY 1, 2),
  t AS (SELECT ws, sum(n)::BIGINT AS draws, {pct('sum(five)', 'sum(n)', 1)} AS five_rate FROM p GROUP BY 1),
  i AS (SELECT ws, string_agg(item||':'||n::VARCHAR, ',' ORDER BY pos) AS items, min_by(item, pos) AS top_item FROM (
      SELECT *, row_number() OVER (PARTITION BY ws ORDER BY n DESC, item) AS pos FROM p) WHERE pos <= 50 GROUP BY 1)
  SELECT {WS.replace('ws*', 't.ws*')} AS window_start, draws, five_rate, top_item, items FROM t JOIN i ON t.ws=i.ws""", "draws"))
def draw_windows(spark, sf):
    counted = pane_log(spark, sf, r.draws_of, lambda df: vw.draw_panes(df, "1 hour"), vw.merge_draw_panes, "window_start", "draws").read()
    text = F.array_join(F.transform("items", lambda e: F.concat(e["name"], F.lit(":"), e["count"])), ",")
    return vw.draw_windows(counted, 50).select(at("window_start"), "draws", "five_rate", "top_item", text.alias("items"))


LATEST = """, last AS (SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ts DESC, id DESC) = 1)
  SELECT entity, score, coalesce(star, 5) AS star, coalesce(ability, score) AS ability, coalesce(look, score) AS look FROM last"""


@query("j7_latest_scores", sql(LATEST, "live"))
def latest_scores(spark, sf):
    view = vw.latest_scores(r.scores_of(r.event_stream(spark, sf)))
    return rn.drain(spark, view, "scores").select("entity", "score", "star", "ability", "look")


@query("j7_ranking", sql(LATEST.replace("SELECT entity, score,", "SELECT entity, score, 0e0 AS delta, (row_number() OVER (ORDER BY score DESC, entity))::INTEGER AS pos,")
                           + " ORDER BY score DESC, entity LIMIT 6", "live"))
def score_ranking(spark, sf):
    base = fresh_path(spark, "ranking")
    rn.live_ranking(spark, r.scores_of(r.event_stream(spark, sf)), base, f"{base}/checkpoint").awaitTermination()
    return rn.current(spark, f"{base}/top").select("entity", "score", "delta", "pos", "star", "ability", "look")


@query("j9_ranking_deltas", sql(f""", half AS (SELECT *, ts < TIMESTAMP '2024-01-16' AS early FROM live),
  before_top AS (SELECT entity, max_by(score, (ts, id)) AS score FROM half WHERE early GROUP BY 1 ORDER BY score DESC, entity LIMIT 6),
  now_top AS (SELECT entity, max_by(score, (ts, id)) AS score FROM half GROUP BY 1 ORDER BY score DESC, entity LIMIT 6)
  SELECT n.entity, n.score, coalesce({rnd('n.score-b.score', 1)}, 0e0) AS delta FROM now_top n LEFT JOIN before_top b ON n.entity=b.entity""", "live"))
def ranking_deltas(spark, sf):
    """Two showings: after the first half of the month and at its end."""
    scores = r.live_scores(spark, sf)
    _, shown = vw.ranking(vw.latest_scores(scores.filter(F.col("ts") < "2024-01-16")))
    top, _ = vw.ranking(vw.latest_scores(scores), shown)
    return top.select("entity", "score", "delta")


def live_log(spark, sf, path=None):
    """The ranking of three over unordered batches, with its change log."""
    base = fresh_path(spark, "ranking")
    log = ky.ranking_log(spark, f"{base}/log", compact_after=2)
    r.replay(spark, sf, lambda events: ky.keep_ranking(r.scores_of(events), log, f"{base}/checkpoint", 6, 2, base), SHOWINGS)
    return base, log


SHOWINGS = 4


@query("j7_change_log", sql(LATEST, "live"))
def change_log(spark, sf):
    """Last scores from the log of changed entities, some batches of it compacted."""
    return live_log(spark, sf)[1].read("latest").select("entity", "score", "star", "ability", "look")


@query("j9_live_deltas", sql(f""", k AS (SELECT unnest(range({SHOWINGS}))::INTEGER AS batch),
  known AS (SELECT k.batch, l.* FROM k JOIN live l ON l.id % {SHOWINGS} <= k.batch
    QUALIFY row_number() OVER (PARTITION BY k.batch, entity ORDER BY ts DESC, l.id DESC) = 1),
  tops AS (SELECT batch, entity, score, coalesce(star, 5) AS star, coalesce(ability, score) AS ability, coalesce(look, score) AS look,
      row_number() OVER (PARTITION BY batch ORDER BY score DESC, entity)::INTEGER AS pos FROM known QUALIFY pos <= 6)
  SELECT batch, entity, score, star, ability, look, pos,
    coalesce({rnd('score - lag(score) OVER (PARTITION BY entity ORDER BY batch)', 1)}, 0e0) AS delta FROM tops""", "live"))
def live_deltas(spark, sf):
    """Every showing of the top six, each with the delta against the entity's last showing."""
    base, _ = live_log(spark, sf)
    return spark.read.parquet(f"{base}/top").select("batch", "entity", "score", "star", "ability", "look", "pos", "delta")


@query("j8_keyed_history", sql("""SELECT entity, count(*) AS n_kept, string_agg(CASE WHEN rn <= 22 THEN score::VARCHAR END, ',' ORDER BY ts, id) AS shown
  FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ts DESC, id DESC) AS rn FROM live) WHERE rn <= 60 GROUP BY 1""", "live"))
def keyed_history(spark, sf):
    """The newest sixty scores of each entity from list state, over unordered batches and restarts."""
    base = fresh_path(spark, "history")
    log = ky.history_log(spark, f"{base}/log", compact_after=2)
    r.replay(spark, sf, lambda events: ky.keep_histories(r.scores_of(events), log, f"{base}/checkpoint"), 4)
    shown = F.slice("values", F.greatest(F.lit(1), F.size("values") - 21), 22)
    return log.read("history").select("entity", F.size("values").cast("bigint").alias("n_kept"),
                                      F.array_join(shown.cast("array<string>"), ",").alias("shown"))


@query("j8_score_history", sql("""SELECT entity, count(*) AS n_kept, string_agg(CASE WHEN rn <= 22 THEN score::VARCHAR END, ',' ORDER BY ts, id) AS shown
  FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ts DESC, id DESC) AS rn FROM live) WHERE rn <= 60 GROUP BY 1""", "live"))
def score_history(spark, sf):
    base = fresh_path(spark, "history")
    rn.score_history(spark, r.scores_of(r.event_stream(spark, sf)), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    out = recent_values(rn.current(spark, f"{base}/out"))
    return out.select("entity", F.size("values").cast("bigint").alias("n_kept"),
                      F.array_join(F.col("shown").cast("array<string>"), ",").alias("shown"))


@query("j10_detail_snapshot", sql(f""", w AS (SELECT * FROM builds, (SELECT date_trunc('hour', max(ts)) AS t FROM builds) x
    WHERE ts >= t - INTERVAL 1 DAY AND ts < t),
  b AS (SELECT entity, count(*) AS n, max_by(star, id) AS star, {rnd('sum(constellation)::DOUBLE/count(*)', 1)} AS avg_constellation,
      floor(sum(damage)/count(*))::BIGINT AS avg_damage, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS snapshot_time FROM w GROUP BY 1),
  tw AS (SELECT entity, weapon AS top_weapon, {rnd('n::DOUBLE/t', 2)} AS top_weapon_ratio FROM (
      SELECT entity, weapon, count(*) AS n, sum(count(*)) OVER (PARTITION BY entity) AS t,
        row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC, weapon) AS pos FROM w WHERE weapon<>'?' GROUP BY 1, 2) WHERE pos=1),
  ta AS (SELECT entity, artifact AS top_artifact, {rnd('n::DOUBLE/t', 2)} AS top_artifact_ratio FROM (
      SELECT entity, artifact, count(*) AS n, sum(count(*)) OVER (PARTITION BY entity) AS t,
        row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC, artifact) AS pos FROM w GROUP BY 1, 2) WHERE pos=1)
  SELECT b.entity, n, star, avg_constellation, avg_damage, coalesce(top_weapon, '?') AS top_weapon,
    coalesce(top_weapon_ratio, 0e0) AS top_weapon_ratio, coalesce(top_artifact, '?') AS top_artifact,
    coalesce(top_artifact_ratio, 0e0) AS top_artifact_ratio, snapshot_time
  FROM b LEFT JOIN tw ON b.entity=tw.entity LEFT JOIN ta ON b.entity=ta.entity""", "builds"))
def detail_snapshot(spark, sf):
    builds = r.builds(spark, sf)
    as_of = builds.agg(F.date_trunc("hour", F.max("ts"))).scalar()
    counted = stage(spark, vw.pane_counts(builds, f"{QUARTER} seconds"), "panes")
    return vw.detail_snapshot(counted, as_of, 86400).withColumn("snapshot_time", at("snapshot_time"))


CYCLE = 7200


@query("j10_detail_cycle", sql(f""", f AS (SELECT floor(max(epoch(ts))/{CYCLE})::BIGINT*{CYCLE} AS last FROM builds),
  w AS (SELECT b.*, s.k AS s FROM builds b, f, (SELECT unnest(range(7)) AS i) x,
      LATERAL (SELECT last - x.i*{CYCLE} AS k) s WHERE epoch(ts) < s.k AND epoch(ts) >= s.k - 86400),
  b AS (SELECT s, entity, count(*) AS n, max_by(star, id) AS star, {rnd('sum(constellation)::DOUBLE/count(*)', 1)} AS avg_constellation,
      floor(sum(damage)/count(*))::BIGINT AS avg_damage FROM w GROUP BY 1, 2),
  tw AS (SELECT s, entity, weapon, {rnd('n::DOUBLE/t', 2)} AS ratio FROM (
      SELECT s, entity, weapon, count(*) AS n, sum(count(*)) OVER (PARTITION BY s, entity) AS t,
        row_number() OVER (PARTITION BY s, entity ORDER BY count(*) DESC, weapon) AS pos FROM w WHERE weapon<>'?' GROUP BY 1, 2, 3) WHERE pos=1),
  ta AS (SELECT s, entity, artifact, {rnd('n::DOUBLE/t', 2)} AS ratio FROM (
      SELECT s, entity, artifact, count(*) AS n, sum(count(*)) OVER (PARTITION BY s, entity) AS t,
        row_number() OVER (PARTITION BY s, entity ORDER BY count(*) DESC, artifact) AS pos FROM w GROUP BY 1, 2, 3) WHERE pos=1)
  SELECT strftime(make_timestamp(b.s*1000000), '%Y-%m-%d %H:%M:%S') AS snapshot_time, b.entity, n, star, avg_constellation, avg_damage,
    coalesce(weapon, '?') AS top_weapon, coalesce(tw.ratio, 0e0) AS top_weapon_ratio,
    coalesce(artifact, '?') AS top_artifact, coalesce(ta.ratio, 0e0) AS top_artifact_ratio
  FROM b LEFT JOIN tw ON b.s=tw.s AND b.entity=tw.entity LEFT JOIN ta ON b.s=ta.s AND b.entity=ta.entity""", "builds"))
def detail_cycle(spark, sf):
    """Snapshots every two hours over a day each, those of the last twelve hours kept."""
    builds = r.builds(spark, sf)
    last = builds.agg(F.timestamp_seconds(F.floor(F.unix_seconds(F.max("ts")) / CYCLE) * CYCLE)).scalar()
    counted = stage(spark, vw.pane_counts(builds, f"{QUARTER} seconds"), "panes")
    return vw.detail_cycle(counted, last, 86400, CYCLE).withColumn("snapshot_time", at("snapshot_time"))


@query("j10_cycle_stream", ORACLES["j10_detail_cycle"])
def cycle_stream(spark, sf):
    """The cycle as a stream in order of time: snapshots are appended when due, those over twelve hours old are forgotten."""
    base = fresh_path(spark, "cycle")
    cycle = cy.SnapshotCycle(spark, f"{base}/snapshots", 86400, CYCLE, pane=QUARTER)
    r.replay(spark, sf, lambda events: cycle.start(r.builds_of(events), f"{base}/checkpoint"), in_order=True)
    return cycle.read().withColumn("snapshot_time", at("snapshot_time"))


DIST = "||','||".join(f"""'"c{c}":'||({pct(f'count(CASE WHEN constellation={c} THEN 1 END)', 'count(*)', 1)})::VARCHAR""" for c in range(7))


@query("j11_snapshot", sql(f""", h AS (SELECT entity, count(*) AS n, {rnd('sum(constellation)::DOUBLE/count(*)', 1)} AS avg_constellation,
      floor(sum(damage)/count(*))::BIGINT AS avg_damage FROM hot_rows WHERE ws=(SELECT max(ws) FROM hot_rows) GROUP BY 1 ORDER BY n DESC, entity LIMIT 4),
  m AS (SELECT entity, '["'||string_agg(weapon, '","' ORDER BY pos)||'"]' AS weapons FROM (SELECT entity, weapon,
      row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC, weapon) AS pos
      FROM hot_rows WHERE ws=(SELECT max(ws) FROM hot_rows) AND weapon<>'?' GROUP BY 1, 2) WHERE pos<=3 GROUP BY 1),
  a AS (SELECT entity, '["'||string_agg(artifact, '","' ORDER BY pos)||'"]' AS artifacts FROM (SELECT entity, artifact,
      row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC, artifact) AS pos
      FROM hot_rows WHERE ws=(SELECT max(ws) FROM hot_rows) GROUP BY 1, 2) WHERE pos<=3 GROUP BY 1),
  s AS (SELECT entity, '{{'||{DIST}||'}}' AS const_dist FROM hot_rows WHERE ws=(SELECT max(ws) FROM hot_rows) GROUP BY 1)
  SELECT h.entity, (SELECT strftime(make_timestamp(max(ws)*1000000), '%Y-%m-%d %H:%M:%S') FROM hot_rows) AS snapshot_time,
    avg_constellation, avg_damage, const_dist, coalesce(weapons, '[]') AS weapons, coalesce(artifacts, '[]') AS artifacts
  FROM h LEFT JOIN m ON h.entity=m.entity LEFT JOIN a ON h.entity=a.entity JOIN s ON h.entity=s.entity""", "hot_rows"))
def snapshot(spark, sf):
    counted = stage(spark, vw.pane_counts(r.builds(spark, sf), f"{QUARTER} seconds"), "panes")
    # The last window begins with the last pane; no earlier pane belongs to it.
    last = counted.agg(F.max("pane")).scalar()
    counted = counted.filter(F.col("pane") >= last)
    hot = vw.hot_entities(counted, HOUR, QUARTER)

    def of_last(df):
        return df.filter(F.col("window_start") == last)

    rows = vw.snapshot_rows(of_last(hot), of_last(vw.hot_mix(counted, "weapon", HOUR, QUARTER)),
                            of_last(vw.hot_mix(counted, "artifact", HOUR, QUARTER)), last)
    return rows.withColumn("snapshot_time", at("snapshot_time"))


@query("j11_snapshot_upsert", sql(""", l AS (SELECT max(ws) AS ws FROM hot_rows),
  h AS (SELECT h.ws, entity, count(*) AS n, """ + rnd('sum(constellation)::DOUBLE/count(*)', 1) + """ AS avg_constellation,
      floor(sum(damage)/count(*))::BIGINT AS avg_damage FROM hot_rows h, l WHERE h.ws >= l.ws - 900 GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY h.ws ORDER BY count(*) DESC, entity) <= 4)
  SELECT entity, avg_constellation, avg_damage, strftime(make_timestamp(ws*1000000), '%Y-%m-%d %H:%M:%S') AS snapshot_time
  FROM h QUALIFY row_number() OVER (PARTITION BY entity ORDER BY ws DESC) = 1""", "hot_rows"))
def snapshot_upsert(spark, sf):
    return (merged_snapshot(spark, sf).withColumn("snapshot_time", at("snapshot_time"))
            .select("entity", "avg_constellation", "avg_damage", "snapshot_time"))


def merged_snapshot(spark, sf):
    """The snapshot of the last window merged by entity into the one before it."""
    counted = stage(spark, vw.pane_counts(r.builds(spark, sf), f"{QUARTER} seconds"), "panes")
    last = counted.agg(F.max("pane")).scalar()
    before = last - F.make_dt_interval(secs=F.lit(QUARTER))
    recent = counted.filter(F.col("pane") >= before)
    hot, weapons, artifacts = (vw.hot_entities(recent, HOUR, QUARTER), vw.hot_mix(recent, "weapon", HOUR, QUARTER),
                               vw.hot_mix(recent, "artifact", HOUR, QUARTER))

    def rows(start):
        return vw.snapshot_rows(*[d.filter(F.col("window_start") == start) for d in (hot, weapons, artifacts)], start)

    new = rows(last)
    return mt.upsert(rows(before), new, ["entity"], [x for x in new.columns if x != "entity"])


def _first_names(cat, where=""):
    return f"""(SELECT ws, entity, '["'||string_agg({cat}, '","' ORDER BY pos)||'"]' AS names FROM (SELECT h.ws, entity, {cat},
      row_number() OVER (PARTITION BY h.ws, entity ORDER BY count(*) DESC, {cat}) AS pos FROM hot_rows h, l WHERE h.ws >= l.ws - 900 {where}
      GROUP BY 1, 2, 3) WHERE pos <= 3 GROUP BY 1, 2)"""


@query("j11_snapshot_merged", sql(f""", l AS (SELECT max(ws) AS ws FROM hot_rows),
  h AS (SELECT h.ws, entity, {rnd('sum(constellation)::DOUBLE/count(*)', 1)} AS avg_constellation,
      floor(sum(damage)/count(*))::BIGINT AS avg_damage, '{{{{'||{DIST}||'}}}}' AS const_dist FROM hot_rows h, l WHERE h.ws >= l.ws - 900 GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY h.ws ORDER BY count(*) DESC, entity) <= 4)
  SELECT h.entity, strftime(make_timestamp(h.ws*1000000), '%Y-%m-%d %H:%M:%S') AS snapshot_time, avg_constellation, avg_damage, const_dist,
    coalesce(m.names, '[]') AS weapons, coalesce(a.names, '[]') AS artifacts
  FROM h LEFT JOIN {_first_names('weapon', "AND weapon <> '?'")} m ON m.ws=h.ws AND m.entity=h.entity
    LEFT JOIN {_first_names('artifact')} a ON a.ws=h.ws AND a.entity=h.entity
  QUALIFY row_number() OVER (PARTITION BY h.entity ORDER BY h.ws DESC) = 1""".replace("{{", "{").replace("}}", "}"), "hot_rows"))
def snapshot_merged(spark, sf):
    """All columns of the merged snapshot."""
    return merged_snapshot(spark, sf).withColumn("snapshot_time", at("snapshot_time"))


@query("j11_draw_snapshot", sql("""SELECT 0 AS pos, '__ALL__' AS entity, count(*) AS draws FROM draws
  UNION ALL SELECT * FROM (SELECT row_number() OVER (ORDER BY count(*) DESC, item)::INTEGER AS pos, item, 0 FROM draws GROUP BY item) WHERE pos <= 10""", "draws"))
def draw_snapshot(spark, sf):
    draws = r.draws(spark, sf)
    counts = draws.groupBy("item").agg(F.count("*").alias("n"))
    top = db.top_n(counts, 12, [("n", "desc"), ("item", "asc")], name="rn")
    names = top.agg(F.to_json(F.sort_array(F.collect_list(F.struct("rn", "item")))["item"])).scalar()
    totals = draws.agg(F.count("*").alias("draws"))
    return vw.draw_snapshot(totals, names, F.lit("now")).select("pos", "entity", "draws")


@query("j1_parse_messages", """SELECT event_type AS role, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events WHERE event_id % 40 <> 3 GROUP BY 1""")
def parse_messages(spark, sf):
    stream = r.event_stream(spark, sf)
    text = F.to_json(F.struct(F.col("event_type").alias("role"), F.col("event_id").alias("id")))
    lines = stream.select(F.when(F.col("event_id") % 40 == 3, F.concat(F.lit("{"), text)).otherwise(text).alias("value"))
    parsed = vw.parse_messages(lines, "role string, id bigint")
    return rn.drain(spark, parsed.groupBy("role").agg(F.count("*").alias("n"), F.sum("id").alias("ids")), "parsed")


@query("j1_parsed_rows", "SELECT event_type AS role, event_id AS id FROM events WHERE event_id % 40 <> 3")
def parsed_rows(spark, sf):
    """Every message that could be read."""
    base = fresh_path(spark, "parsed")
    text = F.to_json(F.struct(F.col("event_type").alias("role"), F.col("event_id").alias("id")))

    def run(events):
        lines = events.select(F.when(F.col("event_id") % 40 == 3, F.concat(F.lit("{"), text)).otherwise(text).alias("value"))
        parsed = vw.parse_messages(lines, "role string, id bigint")
        return rn.start(parsed, lambda df, i: rn.publish(df, i, f"{base}/out"), f"{base}/checkpoint", "append")

    r.replay(spark, sf, run)
    return spark.read.parquet(f"{base}/out").select("role", "id")


@query("b5_polymorphic_messages", sql("""SELECT id, CASE WHEN id%4=3 THEN '?' ELSE weapon END AS weapon,
    CASE WHEN id%4=3 THEN '?' ELSE artifact END AS artifact, damage FROM builds""", "builds"))
def polymorphic(spark, sf):
    shape = F.col("id") % 4
    rows = r.builds(spark, sf)
    obj = F.to_json(F.struct("id", F.struct(F.col("weapon").alias("name")).alias("weapon"),
                             F.struct(F.col("artifact").alias("name")).alias("artifact_set"), F.col("damage").alias("avg_damage")))
    flat = F.to_json(F.struct("id", "weapon", "artifact", "damage"))
    named = F.to_json(F.struct("id", F.struct(F.col("weapon").alias("name")).alias("weapon"),
                               F.struct(F.col("artifact").alias("set_name")).alias("artifact"), "damage"))
    none = F.to_json(F.struct("id", F.lit(None).cast("string").alias("weapon"), "damage"), {"ignoreNullFields": "false"})
    text = F.when(shape == 0, obj).when(shape == 1, flat).when(shape == 2, named).otherwise(none)
    doc = F.col("doc")
    return rows.select(F.parse_json(text).alias("doc")).select(
        F.variant_get(doc, "$.id", "bigint").alias("id"), vw.message_weapon(doc).alias("weapon"),
        vw.message_artifact(doc).alias("artifact"), vw.message_damage(doc).alias("damage"))


@query("a12_landing", """SELECT event_type AS topic, strftime(ts, '%Y') AS yyyy, strftime(ts, '%m') AS mm, strftime(ts, '%d') AS dd,
  count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1, 2, 3, 4""")
def landing(spark, sf):
    base = fresh_path(spark, "landing")
    rn.land(r.event_stream(spark, sf), "event_type", "ts", f"{base}/out", f"{base}/checkpoint", interval=None).awaitTermination()
    text = [F.lpad(F.col(c).cast("string"), w, "0").alias(c) for c, w in (("yyyy", 4), ("mm", 2), ("dd", 2))]
    return (spark.read.parquet(f"{base}/out").select("topic", *text, "event_id")
            .groupBy("topic", "yyyy", "mm", "dd").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")))


@query("a12_landed_rows", """SELECT event_type AS topic, strftime(ts, '%Y') AS yyyy, strftime(ts, '%m') AS mm, strftime(ts, '%d') AS dd, event_id FROM events""")
def landed_rows(spark, sf):
    """Every event in its folder, after batches and a join of small files."""
    base = fresh_path(spark, "landed")
    landing = ld.Landing(spark, f"{base}/out", "event_type", "ts", target=1 << 16)
    r.replay(spark, sf, lambda events: landing.start(events, f"{base}/checkpoint", None, compact_every=2))
    return landing.read().select("topic", "yyyy", "mm", "dd", "event_id")
