"""The whole chain: raw record lines, classified, unfolded, rated, ranked and compared."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import baskets as bk, dashboards as db, quality as q, timeline as tl, usage as us
from ..sources.sinks import stage
from .catalog_records import OK_DETAIL, kept_records
from .registry import query
from .relations import _usage_sql, pct, rnd, sql

CHAIN = f"""{OK_DETAIL}, chain_detail AS (SELECT period, uid, entity, star, constellation, level, (h1=1 OR h2=1)::INTEGER AS used FROM ok),
  chain AS ({_usage_sql("chain_detail")})"""
NEEDS = ("records", "dropped_first")


def rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rates of the accepted records; one small row per period and entity, staged because reports read it twice."""
    return stage(spark, us.usage_rates(q.inventory_detail(kept_records(spark, sf))), "chain")


@query("chain_usage_rates", sql(f"""{CHAIN} SELECT period, entity, star, own_count, use_count, users, own_rate, use_rate,
  avg_constellation, avg_level FROM chain""", *NEEDS))
def chain_usage_rates(spark, sf):
    return us.usage_rates(q.inventory_detail(kept_records(spark, sf)))


@query("chain_red_black", sql(f"""{CHAIN}, last AS (SELECT *, row_number() OVER (ORDER BY use_rate DESC, entity) AS rank_num,
    count(*) OVER () AS n FROM chain WHERE period=(SELECT max(period) FROM chain))
  SELECT rank_num, entity, star, use_rate, own_rate, 'red' AS list_type FROM last WHERE rank_num <= 10
  UNION ALL SELECT rank_num, entity, star, use_rate, own_rate, 'black' FROM last WHERE rank_num > n - 10""", *NEEDS))
def chain_red_black(spark, sf):
    return db.red_black(rates(spark, sf), 10)


@query("chain_momentum", sql(f"""{CHAIN}, two AS (SELECT DISTINCT period FROM chain ORDER BY period DESC LIMIT 2),
  n AS (SELECT entity, c.period, {pct('use_rate', 'max(use_rate) OVER (PARTITION BY c.period)', 1)} AS norm
        FROM chain c JOIN two ON c.period=two.period),
  s AS (SELECT entity, coalesce(max(CASE WHEN period=(SELECT min(period) FROM two) THEN norm END), 0e0) AS prev_rate,
          coalesce(max(CASE WHEN period=(SELECT max(period) FROM two) THEN norm END), 0e0) AS curr_rate FROM n GROUP BY 1)
  SELECT entity, prev_rate, curr_rate, {rnd('curr_rate-prev_rate', 1)} AS change FROM s
  WHERE abs({rnd('curr_rate-prev_rate', 1)}) >= 1""", *NEEDS))
def chain_momentum(spark, sf):
    return tl.momentum(rates(spark, sf).select("period", "entity", F.col("use_rate").alias("rate")))


@query("chain_basket_usage", sql(f""", ok AS (SELECT d.* FROM detail d JOIN records r ON d.period=r.period AND d.uid=r.uid AND r.reason IS NULL),
  m AS (SELECT period, uid, 1 AS half, entity FROM ok WHERE h1=1 UNION ALL SELECT period, uid, 2, entity FROM ok WHERE h2=1),
  t AS (SELECT string_agg(entity, '+' ORDER BY entity) AS basket FROM m GROUP BY period, uid, half HAVING count(*) = 2),
  u AS (SELECT count(*) AS n FROM records WHERE reason IS NULL)
  SELECT basket, count(*) AS n, {pct('count(*)', '(SELECT n FROM u)', 1)} AS use_rate,
    {rnd(pct('count(*)', '(SELECT n FROM u)') + '*0.7e0', 1)} AS has_rate FROM t GROUP BY 1""", "records"))
def chain_basket_usage(spark, sf):
    """Lineups of accepted records with exactly two members, among these records."""
    kept = kept_records(spark, sf)
    members = q.lineup_detail(kept)
    keys = ["period", "uid", "half"]
    pairs = members.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n = 2").select(*keys)
    users = kept.agg(F.count(F.when(F.col("reason").isNull(), 1))).scalar()
    return bk.basket_usage(members.join(pairs, keys, "left_semi"), users, keys, size=2)
