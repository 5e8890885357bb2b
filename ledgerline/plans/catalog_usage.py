"""Queries on usage rates, timelines, rankings, joins and table maintenance."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import percent, round_half_up
from ..operators import allocate as al, dashboards as db, maintenance as mt, reconcile as rc, timeline as tl
from ..operators import usage as us
from ..session import fresh_path
from ..sources import ranged as rt, readers as rd
from ..sources.sinks import stage as write_once
from . import relations as r
from .registry import ORACLES, query
from .relations import eavg, esum, pct, rnd, sql

USAGE_COLS = "period, entity, star, own_count, use_count, users, own_rate, use_rate, avg_constellation, avg_level"


def changes_sql(body: str) -> str:
    return sql(f""", ranked AS (SELECT *, rank() OVER (PARTITION BY period ORDER BY use_rate DESC) AS rank_current FROM usage),
      lagged AS (SELECT *, lag(use_rate) OVER w AS prev_use_rate, lag(rank_current) OVER w AS rank_prev
                 FROM ranked WINDOW w AS (PARTITION BY entity ORDER BY period)),
      changes AS (SELECT entity, period, use_rate, prev_use_rate, {rnd('use_rate-prev_use_rate', 2)} AS change_pct,
                  rank_current, rank_prev FROM lagged WHERE prev_use_rate IS NOT NULL) {body}""", "usage")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Usage rates per year and entity with change and rank movement."""
    return tl.rate_changes(r.usage(spark, sf))


query("e4_rate_changes", changes_sql("SELECT * FROM changes"))(flagship)


@query("d2_distinct_users", sql("SELECT period, count(DISTINCT uid) AS users FROM detail GROUP BY 1", "detail"))
def distinct_users(spark, sf):
    return us.distinct_users(r.detail_of(r.lines(spark, sf)))


@query("d3_usage_rates", sql(f"SELECT {USAGE_COLS} FROM usage", "usage"))
def usage_rates(spark, sf):
    return us.usage_rates(r.detail(spark, sf))


@query("d1_period_averages", sql(f""", b AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS back FROM usage),
  t AS (SELECT entity, max(CASE WHEN back=1 THEN use_rate END) AS r1, max(CASE WHEN back=2 THEN use_rate END) AS r2,
        max(CASE WHEN back=3 THEN use_rate END) AS r3 FROM b GROUP BY 1)
  SELECT u.entity, max(star) AS star, {rnd(eavg('use_rate'), 2)} AS avg_use_rate, max(use_rate) AS max_use_rate,
    min(use_rate) AS min_use_rate, count(*) AS period_count,
    CASE WHEN max(r1)>max(r2) AND coalesce(max(r2)>max(r3), true) THEN 'up'
         WHEN max(r1)<max(r2) AND coalesce(max(r2)<max(r3), true) THEN 'down' ELSE 'stable' END AS trend
  FROM usage u JOIN t ON u.entity=t.entity GROUP BY 1""", "usage"))
def period_averages(spark, sf):
    return tl.period_averages(r.usage(spark, sf))


@query("e1_period_order", sql("""SELECT period, row_number() OVER (ORDER BY period) AS period_order
  FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS period FROM orders)"""))
def period_order(spark, sf):
    labels = r.table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("period"))
    return tl.period_order(labels)


@query("e2_recent_periods", sql("""SELECT entity, period, use_rate,
  row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS back FROM usage QUALIFY back <= 3""", "usage"))
def recent_periods(spark, sf):
    return tl.recent_periods(r.usage(spark, sf)).select("entity", "period", "use_rate", "back")


@query("e8_normalize_by_max", sql(f"""SELECT u.period, entity, use_rate AS rate,
  {pct('use_rate', 'top', 1)} AS norm FROM usage u
  JOIN (SELECT period, max(use_rate) AS top FROM usage GROUP BY 1) m ON u.period=m.period""", "usage"))
def normalize(spark, sf):
    rates = r.usage(spark, sf).select("period", "entity", F.col("use_rate").alias("rate"))
    return tl.normalize_by_max(rates)


@query("c5_momentum", sql(f""", two AS (SELECT DISTINCT period FROM usage ORDER BY period DESC LIMIT 2),
  n AS (SELECT entity, u.period, {pct('use_rate', 'max(use_rate) OVER (PARTITION BY u.period)', 1)} AS norm
        FROM usage u JOIN two ON u.period=two.period),
  c AS (SELECT * FROM n WHERE period=(SELECT max(period) FROM two)),
  p AS (SELECT * FROM n WHERE period=(SELECT min(period) FROM two))
  SELECT coalesce(c.entity, p.entity) AS entity, coalesce(p.norm, 0e0) AS prev_rate, coalesce(c.norm, 0e0) AS curr_rate,
    {rnd('coalesce(c.norm,0e0)-coalesce(p.norm,0e0)', 1)} AS change
  FROM c FULL JOIN p ON c.entity=p.entity
  WHERE abs({rnd('coalesce(c.norm,0e0)-coalesce(p.norm,0e0)', 1)}) >= 1""", "usage"))
def momentum(spark, sf):
    rates = r.usage(spark, sf).select("period", "entity", F.col("use_rate").alias("rate"))
    return tl.momentum(rates)


MONTHLY = """monthly AS (SELECT 'p'||((year(o_orderdate)-1990)*12+month(o_orderdate))::VARCHAR AS period,
    (year(o_orderdate)-1990)*12+month(o_orderdate) AS period_order, entity, count(*) AS n FROM lines GROUP BY 1, 2, 3),
  rates AS (SELECT period, period_order, entity, {rate} AS rate
            FROM monthly)""".format(rate=pct("n", "sum(n) OVER (PARTITION BY period)", 2))


def monthly(spark, sf):
    """Share of each entity per month; the labels are not padded, so their order needs a table."""
    number = (F.year("o_orderdate") - 1990) * 12 + F.month("o_orderdate")
    n = r.lines(spark, sf).groupBy(number.alias("period_order"), "entity").agg(F.count("*").alias("n"))
    totals = n.groupBy("period_order").agg(F.sum("n").alias("t"))
    return n.join(totals, "period_order").select(
        F.concat(F.lit("p"), "period_order").alias("period"), "period_order", "entity",
        percent("n", "t", 2).alias("rate"))


@query("c6_adjacent_change", sql(f""", {MONTHLY}
  SELECT c.period, c.entity, p.rate AS prev_rate, c.rate AS curr_rate, {rnd('c.rate-p.rate', 1)} AS change
  FROM rates c JOIN rates p ON c.entity=p.entity AND p.period_order=c.period_order-1
  WHERE {rnd('c.rate-p.rate', 1)} <> 0""", "lines"))
def adjacent_change(spark, sf):
    rates = monthly(spark, sf)
    order = rates.select("period", "period_order").distinct()
    return tl.adjacent_change(rates.select("period", "entity", "rate"), order)


HISTORY = """SELECT u.entity, max(star) AS star, '["'||string_agg(u.period, '","' ORDER BY u.period)||'"]' AS periods,
    '['||string_agg(use_rate::VARCHAR, ',' ORDER BY u.period)||']' AS rates
  FROM usage u JOIN leaders l ON u.entity=l.entity GROUP BY 1"""


@query("f1_rate_history", sql(f""", leaders AS (SELECT entity FROM latest ORDER BY use_rate DESC, entity LIMIT 15)
  {HISTORY}""", "latest"))
def rate_history(spark, sf):
    return tl.rate_history(r.usage(spark, sf), 15)


@query("f1_rate_history_own_latest", sql(f""", leaders AS (SELECT entity FROM
  (SELECT entity, max_by(use_rate, period) AS rate FROM usage GROUP BY 1) ORDER BY rate DESC, entity LIMIT 15)
  {HISTORY}""", "usage"))
def rate_history_own(spark, sf):
    return tl.rate_history(r.usage(spark, sf), 15, by="own_latest")


@query("e7_red_black", sql("""SELECT rank_num, entity, star, use_rate, own_rate, 'red' AS list_type FROM (
    SELECT *, row_number() OVER (ORDER BY use_rate DESC, entity) AS rank_num FROM latest) WHERE rank_num <= 10
  UNION ALL SELECT rank_num, entity, star, use_rate, own_rate, 'black' FROM (
    SELECT *, row_number() OVER (ORDER BY use_rate DESC, entity) AS rank_num, count(*) OVER () AS n FROM latest)
  WHERE rank_num > n - 10""", "latest"))
def red_black(spark, sf):
    return db.red_black(r.usage(spark, sf), 10)


@query("f3_top_ranked", sql("""SELECT row_number() OVER (ORDER BY use_rate DESC, entity) AS rank_num, entity, star, use_rate
  FROM latest_o QUALIFY rank_num <= 10""", "latest_o"))
def top_ranked(spark, sf):
    return db.top_ranked(r.usage(spark, sf, "O"), 10)


@query("d5_latest_rows", sql("SELECT period, entity, use_rate FROM latest", "latest"))
def latest_rows(spark, sf):
    return tl.latest_rows(r.usage(spark, sf)).select("period", "entity", "use_rate")


@query("d24_group_series", sql(f"""SELECT period, {rnd(eavg('CASE WHEN star=4 THEN use_rate END'), 2)} AS star_4,
  {rnd(eavg('CASE WHEN star=5 THEN use_rate END'), 2)} AS star_5 FROM usage GROUP BY 1""", "usage"))
def group_series(spark, sf):
    return tl.group_series(r.usage(spark, sf), "star", "use_rate", [4, 5])


@query("e9_score_deltas", sql(f"""SELECT entity, id, score, coalesce({rnd('score - lag(score) OVER (PARTITION BY entity ORDER BY ts, id)', 1)}, 0e0) AS delta
  FROM live""", "live"))
def score_deltas(spark, sf):
    return tl.score_deltas(r.live_scores(spark, sf)).select("entity", "id", "score", "delta")


@query("e10_recent_values", sql("""SELECT entity, count(*) AS n_kept, string_agg(score::VARCHAR, ',' ORDER BY ts, id) AS kept,
    string_agg(CASE WHEN rn <= 22 THEN score::VARCHAR END, ',' ORDER BY ts, id) AS shown
  FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ts DESC, id DESC) AS rn FROM live)
  WHERE rn <= 60 GROUP BY 1""", "live"))
def recent_values(spark, sf):
    out = tl.recent_values(r.live_scores(spark, sf))
    return out.select("entity", F.size("values").cast("bigint").alias("n_kept"),
                      F.array_join(F.col("values").cast("array<string>"), ",").alias("kept"),
                      F.array_join(F.col("shown").cast("array<string>"), ",").alias("shown"))


# -- joins and classes -----------------------------------------------------------------------------

def quads(spark, sf):
    return db.quadrants(r.usage(spark, sf), r.scores(spark, sf), 45, 5)


@query("c1_quadrants", sql("SELECT * FROM quads", "quads"))
def quadrants(spark, sf):
    return quads(spark, sf)


@query("d4_class_counts", sql("SELECT quadrant, count(*) AS n FROM quads GROUP BY 1", "quads"))
def class_counts(spark, sf):
    return db.class_counts(quads(spark, sf), "quadrant")


@query("f4_quadrant_leaders", sql("""SELECT quadrant, entity, star, use_rate, score FROM (
    SELECT *, row_number() OVER (ORDER BY use_rate DESC, entity) AS rn FROM quads WHERE quadrant='praised_popular') WHERE rn<=10
  UNION ALL SELECT quadrant, entity, star, use_rate, score FROM (
    SELECT *, row_number() OVER (ORDER BY score DESC, entity) AS rn FROM quads WHERE quadrant='praised') WHERE rn<=10""", "quads"))
def quadrant_leaders(spark, sf):
    return db.quadrant_leaders(quads(spark, sf))


@query("i2_scatter", sql("""SELECT entity, star, NULL::VARCHAR AS avatar, ability AS ability_score, use_rate,
  score AS satisfaction, votes AS vote_count, floor(ln(votes+1)*5)::INTEGER AS bubble_size FROM quads""", "quads"))
def scatter(spark, sf):
    return db.scatter(quads(spark, sf))


@query("c9_lookup", sql("""SELECT l.entity, use_rate, coalesce(avatar, '') AS avatar
  FROM latest l LEFT JOIN dim d ON l.entity=d.entity""", "latest", "dim"))
def lookup(spark, sf):
    rows = tl.latest_rows(r.usage(spark, sf)).select("entity", "use_rate")
    return db.lookup(rows, r.dimension(spark, sf), "entity", "avatar")


@query("c8_missing_keys", sql("""SELECT DISTINCT entity FROM lines
  WHERE entity NOT IN (SELECT entity FROM dim)""", "lines", "dim"))
def missing_keys(spark, sf):
    return rc.missing_keys(r.lines(spark, sf), r.dimension(spark, sf), ["entity"])


@query("c2_with_order", sql("""SELECT u.period, entity, use_rate, o.period_order FROM usage u JOIN (
  SELECT period, row_number() OVER (ORDER BY period) AS period_order FROM (SELECT DISTINCT period FROM usage)) o
  ON u.period=o.period""", "usage"))
def with_order(spark, sf):
    u = r.usage(spark, sf)
    return tl.with_order(u, tl.period_order(u)).select("period", "entity", "use_rate", "period_order")


def weighted_sql(b: str, o: str) -> str:
    return f"""(CASE WHEN coalesce({b},0)=0 THEN coalesce({o},0e0) WHEN coalesce({o},0)=0 THEN {b}
      ELSE {rnd(f'({b}*79e0+{o}*2e0)/81e0', 1)} END)"""


def both_sides(spark, sf):
    return r.user_rates(spark, sf, "F"), r.user_rates(spark, sf, "O")


@query("c14_blend", sql(f"""SELECT coalesce(lf.uid, lo.uid) AS uid, coalesce(lf.star, lo.star, 4) AS star,
    {weighted_sql('lf.use_rate', 'lo.use_rate')} AS use_rate, {weighted_sql('lf.own_rate', 'lo.own_rate')} AS own_rate
  FROM rates_f lf FULL JOIN rates_o lo ON lf.uid=lo.uid""", "rates_f", "rates_o"))
def blend(spark, sf):
    base, other = both_sides(spark, sf)
    return rc.blend(base, other, "uid", ["use_rate", "own_rate"])


RECON = """, d AS (SELECT lf.uid, lf.use_rate AS src_use, lf.own_rate AS src_own, lo.use_rate AS act_use,
    lo.own_rate AS act_own, abs(lf.use_rate-lo.use_rate) AS use_diff, abs(lf.own_rate-lo.own_rate) AS own_diff,
    abs(lf.use_rate-lo.use_rate)<=3 AND abs(lf.own_rate-lo.own_rate)<=3 AS ok
  FROM rates_f lf JOIN rates_o lo ON lf.uid=lo.uid)"""


@query("c12_reconcile", sql(f"{RECON} SELECT * FROM d", "rates_f", "rates_o"))
def reconcile(spark, sf):
    return rc.reconcile(*both_sides(spark, sf), key="uid")


@query("l1_verdict", sql(f"""{RECON} SELECT count(*) AS compared, count(CASE WHEN ok THEN 1 END) AS passed,
    {rnd(pct('count(CASE WHEN ok THEN 1 END)', 'count(*)'), 1)} AS pass_rate,
    {rnd(esum('use_diff+own_diff') + '/(count(*)*2)', 2)} AS mean_dev,
    CASE WHEN count(CASE WHEN ok THEN 1 END)*100e0/count(*) >= 95 THEN 'PASS'
         WHEN count(CASE WHEN ok THEN 1 END)*100e0/count(*) >= 85 THEN 'WARN' ELSE 'FAIL' END AS verdict
  FROM d""", "rates_f", "rates_o"))
def verdict(spark, sf):
    return rc.verdict(rc.reconcile(*both_sides(spark, sf), key="uid"))


@query("f9_failures", sql(f"""{RECON} SELECT uid, use_diff, own_diff FROM d WHERE NOT ok
  ORDER BY use_diff+own_diff DESC, uid LIMIT 15""", "rates_f", "rates_o"))
def worst(spark, sf):
    return rc.failures(rc.reconcile(*both_sides(spark, sf), key="uid"), key="uid").select("uid", "use_diff", "own_diff").limit(15)


@query("l3_deviations", sql(f"""SELECT lf.uid, lf.star, lf.own_rate AS src, coalesce(lo.own_rate, 0e0) AS act,
  coalesce(lo.own_rate, 0e0)-lf.own_rate AS delta FROM rates_f lf LEFT JOIN rates_o lo ON lf.uid=lo.uid""",
    "rates_f", "rates_o"))
def deviations(spark, sf):
    return rc.deviations(*both_sides(spark, sf), key="uid")


@query("l3_deviation_summary", sql(f""", d AS (SELECT coalesce(lo.own_rate, 0e0)-lf.own_rate AS delta
    FROM rates_f lf LEFT JOIN rates_o lo ON lf.uid=lo.uid)
  SELECT {rnd(eavg('abs(delta)'), 1)} AS mean_abs, {rnd('max(abs(delta))', 1)} AS max_abs FROM d""",
    "rates_f", "rates_o"))
def deviation_summary(spark, sf):
    return rc.deviation_summary(rc.deviations(*both_sides(spark, sf), key="uid"))


@query("l3_mean_constellation", sql(f"""SELECT entity, count(DISTINCT uid) AS owners, {rnd(eavg('constellation'), 2)} AS mean_constellation
  FROM detail GROUP BY 1""", "detail"))
def mean_constellations(spark, sf):
    return rc.mean_constellations(r.detail_of(r.lines(spark, sf)))


@query("d27_summarize", sql(f"""SELECT entity, count(*) AS n, count(DISTINCT uid) AS users, min(constellation) AS low,
  max(constellation) AS high, {rnd(eavg('constellation'), 2)} AS mean FROM detail GROUP BY ROLLUP (entity)""", "detail"))
def summarize(spark, sf):
    return rc.summarize(r.detail_of(r.lines(spark, sf)))


@query("d28_count_gaps", sql("""SELECT e.entity, coalesce(a.n, 0) - e.expected AS gap
  FROM (SELECT p_brand AS entity, count(*)*30 AS expected FROM part GROUP BY 1) e
  LEFT JOIN (SELECT entity, count(*) AS n FROM lines GROUP BY 1) a ON e.entity=a.entity
  WHERE coalesce(a.n, 0) <> e.expected""", "lines"))
def count_gaps(spark, sf):
    expected = r.table(spark, sf, "part").groupBy(F.col("p_brand").alias("entity")).agg(
        (F.count("*") * 30).alias("expected"))
    return rc.count_gaps(r.lines(spark, sf), expected)


# -- shares, pages, sets ----------------------------------------------------------------------------

@query("d22_share_by", sql(f"""SELECT star, count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM lines)', 2)} AS share
  FROM lines GROUP BY 1""", "lines"))
def share_by(spark, sf):
    return us.share_by(r.lines(spark, sf), "star")


@query("d23_with_means", sql(f"""SELECT entity, use_rate, own_rate,
  (SELECT {rnd(eavg('use_rate'), 2)} FROM latest) AS mean_use_rate,
  (SELECT {rnd(eavg('own_rate'), 2)} FROM latest) AS mean_own_rate FROM latest""", "latest"))
def with_means(spark, sf):
    rows = tl.latest_rows(r.usage(spark, sf)).select("entity", "use_rate", "own_rate")
    return us.with_means(rows, ["use_rate", "own_rate"])


@query("b17_search_page", sql("""SELECT period, entity, use_rate, count(*) OVER () AS total FROM usage
  WHERE lower(entity) LIKE '%brand#1%' ORDER BY use_rate DESC, period, entity LIMIT 10 OFFSET 10""", "usage"))
def search_page(spark, sf):
    rows = r.usage(spark, sf).select("period", "entity", "use_rate")
    return db.search_page(rows, "BRAND#1", "entity",
                          [("use_rate", "desc"), ("period", "asc"), ("entity", "asc")], page=2, size=10)


@query("g1_stack", sql("""SELECT period, entity, use_rate, 'first' AS source FROM usage_f
  UNION ALL SELECT period, entity, use_rate, 'second' FROM usage_o""", "usage_f", "usage_o"))
def stack_sources(spark, sf):
    a, b = (r.usage(spark, sf, s).select("period", "entity", "use_rate") for s in ("F", "O"))
    return db.stack(a, b, tags=["first", "second"])


@query("g3_key_union", sql("""SELECT coalesce(a.uid, b.uid) AS uid, a.uid IS NOT NULL AS in_a, b.uid IS NOT NULL AS in_b
  FROM (SELECT DISTINCT uid FROM detail_f) a FULL JOIN (SELECT DISTINCT uid FROM detail_o) b ON a.uid=b.uid""",
    "detail_f", "detail_o"))
def key_union(spark, sf):
    facts = r.lines(spark, sf)
    return db.key_union(facts.filter("ostatus = 'F'"), facts.filter("ostatus = 'O'"), ["uid"])


@query("f8_movers", changes_sql("""SELECT * FROM (SELECT entity, period, change_pct, 'top' AS side FROM changes ORDER BY change_pct DESC, entity, period LIMIT 3)
  UNION ALL SELECT * FROM (SELECT entity, period, change_pct, 'bottom' FROM changes ORDER BY change_pct, entity, period LIMIT 3)"""))
def movers(spark, sf):
    rows = tl.rate_changes(r.usage(spark, sf)).select("entity", "period", "change_pct")
    order = [("entity", "asc"), ("period", "asc")]
    return db.stack(db.top_n(rows, 3, [("change_pct", "desc"), *order]),
                    db.top_n(rows, 3, [("change_pct", "asc"), *order]), tags=["top", "bottom"], tag_col="side")


@query("f7_top_scores", sql("SELECT entity, score, ability, look, votes FROM scores ORDER BY score DESC, entity LIMIT 8", "scores"))
def top_scores(spark, sf):
    return db.top_n(r.scores(spark, sf), 8, [("score", "desc"), ("entity", "asc")]).select(
        "entity", "score", "ability", "look", "votes")


@query("g2_distinct_keys", sql("SELECT DISTINCT period, ostatus FROM lines", "lines"))
def distinct_keys(spark, sf):
    return db.distinct_keys(r.lines(spark, sf), ["period", "ostatus"])


@query("b15_fill_zero", """SELECT p_partkey, coalesce(sum(l_quantity)::BIGINT, 0) AS qty, coalesce(count(l_orderkey), 0) AS n
  FROM part LEFT JOIN lineitem ON l_partkey=p_partkey GROUP BY 1""")
def fill_zero(spark, sf):
    bulk = (r.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
            .agg(F.sum("l_quantity").cast("bigint").alias("qty"), F.count("*").alias("n")))
    return r.table(spark, sf, "part").select("p_partkey").join(bulk, "p_partkey", "left").na.fill(0, ["qty", "n"])


@query("i10_prefix_label", """SELECT p_partkey, CASE WHEN p_type LIKE 'ECONOMY%' THEN 'v1' WHEN p_type LIKE 'PROMO%' THEN 'v2' END AS label FROM part""")
def prefix_label(spark, sf):
    labels = {"ECONOMY": "v1", "PROMO": "v2"}
    return r.table(spark, sf, "part").select("p_partkey", rd.prefix_label(F.col("p_type"), labels).alias("label"))


@query("g4_array_sets", sql("""SELECT uid, len(list_intersect(a, b))::INTEGER AS common, (len(a) - len(list_intersect(a, b)))::INTEGER AS only_a,
    list_has_any(a, b) AS overlap FROM (SELECT uid, list(DISTINCT entity) FILTER (h1=1) AS a, list(DISTINCT entity) FILTER (h2=1) AS b FROM detail GROUP BY 1)
  WHERE a IS NOT NULL AND b IS NOT NULL""", "detail"))
def array_sets(spark, sf):
    # Sets of entities per user: as long as the entity vocabulary at most.
    sets = r.detail_of(r.lines(spark, sf)).groupBy("uid").agg(
        F.collect_set(F.when(F.col("h1") == 1, F.col("entity"))).alias("a"),
        F.collect_set(F.when(F.col("h2") == 1, F.col("entity"))).alias("b"))
    return sets.filter((F.size("a") > 0) & (F.size("b") > 0)).select(
        "uid", F.size(F.array_intersect("a", "b")).alias("common"), F.size(F.array_except("a", "b")).alias("only_a"),
        F.arrays_overlap("a", "b").alias("overlap"))


# -- table maintenance ------------------------------------------------------------------------------

@query("a15_replace_partition", sql("""SELECT period, entity, use_rate FROM usage WHERE period NOT IN (SELECT period FROM usage_o)
  UNION ALL SELECT period, entity, use_rate FROM usage_o""", "usage", "usage_o"))
def replace_partition(spark, sf):
    cols = ["period", "entity", "use_rate"]
    return mt.replace_partition(r.usage(spark, sf).select(*cols), r.usage(spark, sf, "O").select(*cols), "period")


@query("a16_upsert", sql("""SELECT coalesce(o.period, n.period) AS period, coalesce(o.entity, n.entity) AS entity,
    coalesce(n.use_rate, o.use_rate) AS use_rate, coalesce(o.own_rate, n.own_rate) AS own_rate
  FROM usage_f o FULL JOIN usage_o n ON o.period=n.period AND o.entity=n.entity""", "usage_f", "usage_o"))
def upsert(spark, sf):
    cols = ["period", "entity", "use_rate", "own_rate"]
    return mt.upsert(r.usage(spark, sf, "F").select(*cols), r.usage(spark, sf, "O").select(*cols),
                     ["period", "entity"], ["use_rate"])


@query("a17_insert_ignore", sql("""SELECT uid, orderkey FROM (SELECT o_custkey AS uid, min(o_orderkey) AS orderkey FROM orders WHERE o_orderstatus='F' GROUP BY 1)
  UNION ALL SELECT uid, orderkey FROM (SELECT o_custkey AS uid, min(o_orderkey) AS orderkey FROM orders WHERE o_orderstatus<>'F' GROUP BY 1)
  WHERE uid NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus='F')"""))
def insert_ignore(spark, sf):
    orders = r.table(spark, sf, "orders").select(F.col("o_custkey").alias("uid"), F.col("o_orderkey").alias("orderkey"),
                                                  "o_orderstatus")
    old = orders.filter("o_orderstatus = 'F'").groupBy("uid").agg(F.min("orderkey").alias("orderkey"))
    new = orders.filter("o_orderstatus <> 'F'").select("uid", "orderkey")
    return mt.insert_ignore(old, new, ["uid"], ["orderkey"])


@query("a18_enrich", sql("""SELECT coalesce(p.p_partkey, m.p_partkey) AS p_partkey, coalesce(m.kind, p.kind) AS kind FROM
  (SELECT p_partkey, p_type AS kind FROM part) p FULL JOIN
  (SELECT l_partkey AS p_partkey, CASE WHEN max(l_quantity) >= 50 THEN 'bulk' END AS kind FROM lineitem GROUP BY 1) m
  ON p.p_partkey=m.p_partkey"""))
def enrich(spark, sf):
    mapping = (r.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
               .agg(F.when(F.max("l_quantity") >= 50, "bulk").alias("kind")))
    part = r.table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("kind"))
    return mt.enrich(part, mapping, "p_partkey", "kind", insert=True)


@query("a19_retain", sql("""SELECT event_id, event_type FROM events
  WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY"""))
def retain(spark, sf):
    events = r.table(spark, sf, "events").select("event_id", "event_type", "ts")
    return mt.retain(events, "ts", events.agg(F.max("ts")).scalar(), "7 DAYS").select("event_id", "event_type")


# -- the same changes on tables of files with key ranges ------------------------------------------------

def ranged(spark, rows, key, label):
    table = rt.RangedTable(spark, fresh_path(spark, label), key, 500)
    table.create(rows)
    return table


@query("a16_upsert_files", ORACLES["a16_upsert"])
def upsert_files(spark, sf):
    """Only files that hold a key of the new rows are written; a second run replaces none."""
    cols = ["period", "entity", "use_rate", "own_rate"]
    table = ranged(spark, r.usage(spark, sf, "F").select(*cols), "period", "usage")
    new = r.usage(spark, sf, "O").select(*cols)
    table.upsert(new, ["period", "entity"], ["use_rate"])
    if table.upsert(new, ["period", "entity"], ["use_rate"]):
        raise AssertionError("a rerun changed files")
    return table.read()


@query("a17_insert_files", ORACLES["a17_insert_ignore"])
def insert_files(spark, sf):
    orders = r.table(spark, sf, "orders").select(F.col("o_custkey").alias("uid"), F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    old = orders.filter("o_orderstatus = 'F'").groupBy("uid").agg(F.min("orderkey").alias("orderkey"))
    table = ranged(spark, old, "uid", "first")
    table.insert_ignore(orders.filter("o_orderstatus <> 'F'").select("uid", "orderkey"), ["uid"], ["orderkey"])
    return table.read()


@query("a18_enrich_files", sql("""SELECT p.p_partkey, coalesce(m.kind, p.kind) AS kind FROM
  (SELECT p_partkey, p_type AS kind FROM part) p LEFT JOIN
  (SELECT l_partkey AS p_partkey, CASE WHEN max(l_quantity) >= 50 THEN 'bulk' END AS kind FROM lineitem GROUP BY 1) m
  ON p.p_partkey=m.p_partkey"""))
def enrich_files(spark, sf):
    mapping = (r.table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
               .agg(F.when(F.max("l_quantity") >= 50, "bulk").alias("kind")))
    table = ranged(spark, r.table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("kind")), "p_partkey", "parts")
    table.enrich(mapping, "kind")
    return table.read()


@query("a19_drop_files", ORACLES["a19_retain"])
def drop_files(spark, sf):
    """Files older than a week go by their ranges, nothing is read for it."""
    events = r.table(spark, sf, "events").select("event_id", "event_type", "ts")
    table = ranged(spark, events, "ts", "events")
    last = events.agg(F.max("ts") - F.expr("INTERVAL 7 DAYS")).first()[0]
    table.drop_below(last)
    return table.read().select("event_id", "event_type")


# -- allocation --------------------------------------------------------------------------------------

def md5_unit(x: str) -> str:
    return f"(('0x'||substr(md5({x}),1,8))::BIGINT::DOUBLE/4294967296e0)"


@query("e11_allocate", f"""WITH weights AS (SELECT o_custkey AS uid, sqrt(count(*)::DOUBLE) AS w FROM orders GROUP BY 1),
  shares AS (SELECT uid, w * 5000e0 / (SELECT sum(w::DECIMAL(38,12))::DOUBLE FROM weights) AS share FROM weights)
  SELECT uid, (floor(share) + CASE WHEN row_number() OVER (ORDER BY share-floor(share) DESC, {md5_unit('uid::VARCHAR')}, uid)
      <= 5000 - sum(floor(share)) OVER () THEN 1 ELSE 0 END)::BIGINT AS quota FROM shares""")
def allocate(spark, sf):
    counts = write_once(spark, r.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("uid"))
                   .agg(F.count("*").alias("n")), "counts")
    return al.allocate(counts, "uid", "n", 5000)


@query("e12_weighted_pick", sql(f""", items AS (SELECT entity AS item, count(*)::DECIMAL(24,4) AS w, floor({md5_unit('entity')}*256) AS part FROM lines GROUP BY 1, 3),
  spans AS (SELECT item, (sum(w) OVER (ORDER BY part, item) - w)::DOUBLE / (SELECT sum(w)::DOUBLE FROM items) AS low,
            (sum(w) OVER (ORDER BY part, item))::DOUBLE / (SELECT sum(w)::DOUBLE FROM items) AS high FROM items)
  SELECT o_orderkey, item FROM (SELECT o_orderkey, {md5_unit("'pick'||o_orderkey::VARCHAR")} AS u FROM orders) k
  JOIN spans ON u >= low AND u < high""", "lines"))
def weighted_pick(spark, sf):
    items = write_once(spark, r.lines(spark, sf).groupBy("entity").agg(F.count("*").alias("n")), "weights")
    return al.weighted_pick(r.table(spark, sf, "orders"), "o_orderkey", items, "entity", "n", seed="pick")
