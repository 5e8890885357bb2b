"""Queries on baskets, pairs, patterns and category mixes."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import round_half_up
from ..operators import baskets as bk, dashboards as db, mining as mn, usage as us
from ..sources.sinks import stage
from . import relations as r
from .registry import query
from .relations import esum, pct, rnd, sql


@query("d7_baskets", sql("""SELECT period, orderkey, string_agg(entity, '+' ORDER BY entity) AS items
  FROM basket_items GROUP BY 1, 2""", "basket_items"))
def baskets(spark, sf):
    return r.order_baskets(spark, sf).select("period", "orderkey", F.array_join("items", "+").alias("items"))


@query("d8_cooccurrence", sql("SELECT * FROM basket_pairs WHERE weight >= 2", "basket_pairs"))
def cooccurrence(spark, sf):
    return bk.cooccurrence(r.order_baskets(spark, sf), min_weight=2)


@query("f2_network", sql("""SELECT item_a, item_b, weight, a.avatar AS avatar_a, b.avatar AS avatar_b FROM (
    SELECT * FROM basket_pairs ORDER BY weight DESC, item_a, item_b LIMIT 30) p
  LEFT JOIN dim a ON a.entity=item_a LEFT JOIN dim b ON b.entity=item_b""", "basket_pairs", "dim"))
def network(spark, sf):
    dim = r.dimension(spark, sf).select("entity", "avatar")
    return bk.cooccurrence(r.order_baskets(spark, sf), min_weight=2, top=30, dim=dim)


@query("b14_split_basket", sql("""SELECT orderkey, pos::INTEGER AS pos, entity FROM (
    SELECT orderkey, entity, row_number() OVER (PARTITION BY orderkey ORDER BY entity) AS pos FROM basket_items)""", "basket_items"))
def split_basket(spark, sf):
    joined = r.order_baskets(spark, sf).select("orderkey", F.array_join("items", " + ").alias("basket"))
    return bk.split_basket(joined).select("orderkey", "pos", "entity")


def order_lineups(spark, sf):
    """Order lines as lineup rows; the line number is the position."""
    return r.lines(spark, sf).select(
        "period", "uid", "orderkey", (F.col("orderkey") % 2 + 1).alias("half"),
        (F.col("orderkey") % 20 + 1).alias("basket_no"), "entity", "star", F.col("linenumber").alias("pos"))


FOUR = """, four AS (SELECT orderkey, list(entity ORDER BY rn) AS m FROM (
    SELECT orderkey, entity, row_number() OVER (PARTITION BY orderkey ORDER BY linenumber, entity) AS rn FROM lines)
  WHERE rn <= 4 GROUP BY 1 HAVING count(*)=4)"""
USERS = "(SELECT count(DISTINCT o_custkey) FROM orders)"


@query("d12_basket_usage", sql(f"""{FOUR} SELECT array_to_string(m, '+') AS basket, count(*) AS n, {pct('count(*)', USERS, 1)} AS use_rate,
  {rnd(pct('count(*)', USERS) + '*0.7e0', 1)} AS has_rate FROM four GROUP BY 1""", "lines"))
def basket_usage(spark, sf):
    users = r.table(spark, sf, "orders").agg(F.count_distinct("o_custkey")).scalar()
    return bk.basket_usage(order_lineups(spark, sf), users, ["orderkey"])


@query("d12_basket_usage_sorted", sql(f"""{FOUR} SELECT array_to_string(list_sort(m), ' + ') AS basket, count(*) AS n, {pct('count(*)', USERS, 1)} AS use_rate,
  {rnd(pct('count(*)', USERS) + '*0.7e0', 1)} AS has_rate FROM four GROUP BY 1""", "lines"))
def basket_usage_sorted(spark, sf):
    users = r.table(spark, sf, "orders").agg(F.count_distinct("o_custkey")).scalar()
    return bk.basket_usage(order_lineups(spark, sf), users, ["orderkey"], ordered=False)


@query("d12_basket_avatars", sql(f"""{FOUR}, f AS (SELECT array_to_string(list_sort(m), ' + ') AS basket, count(*) AS n, min_by(m, orderkey) AS m
    FROM four GROUP BY 1), e AS (SELECT basket, unnest(m) AS entity, generate_subscripts(m, 1) AS pos FROM f)
  SELECT f.basket, f.n, (SELECT string_agg(coalesce(avatar, ''), ',' ORDER BY pos) FROM e LEFT JOIN dim ON e.entity=dim.entity
    WHERE e.basket=f.basket) AS avatars FROM f""", "lines", "dim"))
def basket_avatars(spark, sf):
    users = r.table(spark, sf, "orders").agg(F.count_distinct("o_custkey")).scalar()
    lineups = order_lineups(spark, sf)
    used = bk.basket_usage(lineups, users, ["orderkey"], ordered=False)
    return (bk.with_first_avatars(used, bk.first_members(lineups, ["orderkey"]), ["orderkey"], r.dimension(spark, sf), ordered=False)
            .select("basket", "n", "avatars"))


@query("d14_basket_shares", sql(f""", b AS (SELECT orderkey, string_agg(entity, '+' ORDER BY entity) AS basket FROM basket_items GROUP BY 1)
  SELECT basket, count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM b)', 1)} AS use_rate, {pct('count(*)', USERS, 1)} AS has_rate
  FROM b GROUP BY 1""", "basket_items"))
def basket_shares(spark, sf):
    users = r.table(spark, sf, "orders").agg(F.count_distinct("o_custkey")).scalar()
    return bk.basket_shares(r.order_baskets(spark, sf), users, "items")


@query("d11_basket_entity_rates", sql(f""", sets AS (SELECT period, list(entity ORDER BY entity) AS items FROM basket_items GROUP BY period, orderkey),
  rated AS (SELECT period, items, {rnd('count(*)*100e0/sum(count(*)) OVER (PARTITION BY period)', 4)} AS use_rate FROM sets GROUP BY 1, 2)
  SELECT period, entity, {esum('use_rate')} AS rate FROM (SELECT period, use_rate, unnest(items) AS entity FROM rated) GROUP BY 1, 2""", "basket_items"))
def basket_entity_rates(spark, sf):
    counts = r.order_baskets(spark, sf).groupBy("period", "items").agg(F.count("*").alias("n"))
    totals = counts.groupBy("period").agg(F.sum("n").alias("t"))
    return bk.basket_entity_rates(counts.join(totals, "period").withColumn(
        "use_rate", round_half_up(F.col("n") * 100.0 / F.col("t"), 4)))


@query("d13_entity_usage_once", sql(f""", o AS (SELECT entity, max(star) AS star, count(DISTINCT uid) AS own_count,
      sum(coalesce(nullif(quantity::INTEGER, 50), 1))::BIGINT AS copies FROM lines WHERE ostatus='F' GROUP BY 1),
  u AS (SELECT entity, max(star) AS star, count(DISTINCT uid) AS use_count FROM lines WHERE ostatus='O' GROUP BY 1),
  t AS (SELECT count(DISTINCT uid) AS n FROM lines WHERE ostatus='O')
  SELECT coalesce(o.entity, u.entity) AS entity, coalesce(o.star, u.star, 4) AS star, coalesce(own_count, 0) AS own_count,
    coalesce(copies, 0) AS copies, coalesce(use_count, 0) AS use_count,
    {pct('coalesce(own_count, 0)', '(SELECT n FROM t)', 1)} AS own_rate, {pct('coalesce(use_count, 0)', '(SELECT n FROM t)', 1)} AS use_rate
  FROM o FULL JOIN u ON o.entity=u.entity""", "lines"))
def entity_usage_once(spark, sf):
    facts = r.lines(spark, sf)
    owned = facts.filter("ostatus = 'F'").select("uid", "entity", "star", F.nullif(F.col("quantity").cast("int"), F.lit(50)).alias("copies"))
    used = stage(spark, facts.filter("ostatus = 'O'").select("uid", "entity", "star").distinct(), "used")
    return us.entity_usage_once(owned, used)


@query("d26_pair_usage", """WITH p AS (SELECT year(o_orderdate) AS y, o_custkey, min(o_orderkey%20+1) AS a, max(o_orderkey%20+1) AS b
    FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1, 2)
  SELECT a, b, count(*) AS n, """ + pct("count(*)", "(SELECT count(*) FROM p)", 1) + """ AS pct FROM p GROUP BY 1, 2
  ORDER BY n DESC, a, b LIMIT 10""")
def pair_usage(spark, sf):
    return bk.pair_usage(order_lineups(spark, sf), ["period", "uid"])


def leading(spark, sf):
    """The 30 most used lineup-sized baskets, written once: the pair queries read them from three sides."""
    return stage(spark, bk.leading_baskets(r.ranked_baskets(spark, sf).filter(F.size("items") <= r.LINEUP_SIZE), top=30), "leading")


DISJOINT = """, disjoint AS (SELECT a.no AS a, b.no AS b, a.use_rate*b.use_rate AS weight
  FROM lead_baskets a JOIN lead_baskets b ON a.no < b.no AND NOT list_has_any(a.items, b.items))"""


@query("c10_disjoint_pairs", sql(f"{DISJOINT} SELECT a::INTEGER AS a, b::INTEGER AS b, weight FROM disjoint", "lead_baskets"))
def disjoint_pairs(spark, sf):
    return bk.disjoint_pairs(leading(spark, sf))


@query("c11_feasible_pairs", sql(f"""{DISJOINT}, able AS (SELECT uid, no FROM (SELECT uid, list(DISTINCT entity) AS own FROM lines GROUP BY 1) u
    JOIN lead_baskets ON list_has_all(own, items))
  SELECT x.uid, d.a::INTEGER AS a, d.b::INTEGER AS b FROM disjoint d JOIN able x ON x.no=d.a JOIN able y ON y.no=d.b AND y.uid=x.uid""", "lead_baskets"))
def feasible_pairs(spark, sf):
    lead = leading(spark, sf)
    return bk.feasible_pairs(bk.disjoint_pairs(lead), bk.feasible_baskets(lead, r.lines(spark, sf)))


BASKET_SIDES = """, sized AS (SELECT any_value(ostatus) AS ostatus, string_agg(entity, '+' ORDER BY entity) AS basket
    FROM (SELECT DISTINCT orderkey, ostatus, entity FROM lines) GROUP BY orderkey HAVING count(*) >= 2),
  rated AS (SELECT ostatus, basket, count(*) AS n, """ + rnd("count(*)*100e0/sum(count(*)) OVER (PARTITION BY ostatus)", 2) + """ AS use_rate FROM sized GROUP BY 1, 2),
  base AS (SELECT * FROM rated WHERE ostatus='F'), other AS (SELECT * FROM rated WHERE ostatus='O')"""


def basket_side(spark, sf, status, sep):
    """Baskets of one order status; the two sides list their members in opposite order."""
    facts = r.lines(spark, sf).filter(F.col("ostatus") == status)
    sets = stage(spark, bk.baskets(facts, ["orderkey"], "entity"), "side")
    total = sets.agg(F.count("*")).scalar()
    rate = F.floor(F.col("n") * 100.0 / total * 100 + 0.5) / 100.0
    members = F.col("items") if sep == "+" else F.reverse("items")
    return sets.groupBy("items").agg(F.count("*").alias("n")).select(
        F.array_join(members, sep).alias("basket"), members.alias("members"), rate.alias("use_rate"),
        (rate / 2).alias("has_rate"), F.col("n").alias("ord"))


def weighted_sql(b: str, o: str) -> str:
    return f"(CASE WHEN {b}=0 THEN {o} WHEN {o}=0 THEN {b} ELSE {rnd(f'({b}*79e0+{o}*2e0)/81e0', 1)} END)"


@query("c7_blend_baskets", sql(f"""{BASKET_SIDES}
  SELECT b.basket, CASE WHEN o.basket IS NULL THEN b.use_rate ELSE {weighted_sql('b.use_rate', 'o.use_rate')} END AS use_rate,
    CASE WHEN o.basket IS NULL THEN b.use_rate/2 ELSE {weighted_sql('(b.use_rate/2)', '(o.use_rate/2)')} END AS has_rate
  FROM base b LEFT JOIN other o ON b.basket=o.basket
  UNION ALL SELECT array_to_string(list_reverse(string_split(basket, '+')), ' + '), use_rate, use_rate/2 FROM other""", "lines"))
def blend_baskets(spark, sf):
    # The sides spell their names differently, so every other basket is appended by name.
    return bk.blend_baskets(basket_side(spark, sf, "F", "+"), basket_side(spark, sf, "O", " + "))


@query("c13_unowned_members", sql("""SELECT DISTINCT uid, entity FROM lines WHERE ostatus='O'
  AND (uid, entity) NOT IN (SELECT (uid, entity) FROM lines WHERE ostatus='F')""", "lines"))
def unowned_members(spark, sf):
    from ..operators.reconcile import missing_keys
    facts = r.lines(spark, sf).select("uid", "entity", "ostatus")
    return missing_keys(facts.filter("ostatus = 'O'"), facts.filter("ostatus = 'F'"), ["uid", "entity"])


# -- variant documents --------------------------------------------------------------------------------

def member_documents(spark, sf):
    """Basket documents in the shapes the producers use: names, objects, JSON text, no members."""
    b = r.order_baskets(spark, sf)
    names = F.to_json("items")
    objects = F.to_json(F.transform("items", lambda x: F.struct(x.alias("name"))))
    roles = F.to_json(F.transform("items", lambda x: F.struct(x.alias("role"))))
    shape = F.col("orderkey") % 5
    body = (F.when(shape == 0, F.concat(F.lit('"roles": '), names, F.lit(', "use_count": 7')))
            .when(shape == 1, F.concat(F.lit('"roles": [], "members": '), objects, F.lit(', "count": 3')))
            .when(shape == 2, F.concat(F.lit('"members": '), roles, F.lit(', "use_rate": 0.25')))
            .when(shape == 3, F.concat(F.lit('"roles": '), F.to_json(F.struct(names.alias("x"))), F.lit("")))
            .otherwise(F.lit('"use_rate": 0.5')))
    text = F.when(shape == 3, F.concat(F.lit('"roles": "'), F.replace(names, F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise(body)
    return b.select(F.parse_json(F.concat(F.lit('{"name": "'), F.col("orderkey").cast("string"), F.lit('", '), text, F.lit("}"))).alias("doc"))


@query("b6_explode_members", sql("""SELECT orderkey::VARCHAR AS basket, row_number() OVER (PARTITION BY orderkey ORDER BY entity)::INTEGER AS pos, entity,
    CASE orderkey % 5 WHEN 0 THEN 7 WHEN 1 THEN 3 WHEN 2 THEN 25 ELSE 1 END::BIGINT AS weight
  FROM basket_items WHERE orderkey % 5 <> 4""", "basket_items"))
def explode_members(spark, sf):
    return bk.explode_members(member_documents(spark, sf))


@query("b7_explode_tiers", sql("""SELECT CASE WHEN use_rate > 45 THEN 'S' ELSE 'A' END AS tier, entity,
    CASE WHEN star=5 THEN own_count::INTEGER ELSE 0 END AS constellation FROM usage""", "usage"))
def explode_tiers(spark, sf):
    rows = r.usage(spark, sf).withColumn("tier", F.when(F.col("use_rate") > 45, "S").otherwise("A"))
    named = F.to_json(F.struct(F.col("entity").alias("name"), F.col("own_count").alias("constellation")))
    item = F.when(F.col("star") == 5, named).otherwise(F.concat(F.lit('"'), "entity", F.lit('"')))
    # A tier of one period lists each entity at most once.
    lists = rows.groupBy("period", "tier").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(item)), F.lit("]")).alias("l"))
    as_map = F.concat(F.lit('{"'), "tier", F.lit('": '), "l", F.lit("}"))
    as_list = F.concat(F.lit('[{"tier": "'), "tier", F.lit('", "chars": '), "l", F.lit("}]"))
    return bk.explode_tiers(lists.select(F.parse_json(F.when(F.col("period") % 2 == 0, as_map).otherwise(as_list)).alias("doc")))


# -- patterns ------------------------------------------------------------------------------------------

FREQ = """, total AS (SELECT count(DISTINCT (period, orderkey)) AS n FROM basket_items),
  single AS (SELECT entity, count(*) AS n FROM basket_items GROUP BY 1)"""


@query("h1_itemsets", sql(f"""{FREQ} SELECT item_a||'+'||item_b AS items, weight AS freq FROM basket_pairs
  WHERE weight >= ceil(0.01 * (SELECT n FROM total))""", "basket_pairs"))
def itemsets(spark, sf):
    sets = mn.itemsets(stage(spark, r.order_baskets(spark, sf), "baskets"), size=2)
    return sets.select(F.array_join("items", "+").alias("items"), "freq")


@query("h2_rules", sql(f"""{FREQ}, need AS (SELECT ceil(0.01 * n) AS least, n::DOUBLE AS n FROM total),
  pairs AS (SELECT * FROM basket_pairs WHERE weight >= (SELECT least FROM need)),
  triples AS (SELECT a.entity AS x, b.entity AS y, c.entity AS z, count(*) AS weight
    FROM basket_items a JOIN basket_items b USING (period, orderkey) JOIN basket_items c USING (period, orderkey)
    WHERE a.entity < b.entity AND b.entity < c.entity GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT least FROM need)),
  sided AS (
    SELECT item_a AS ante, item_b AS cons, p.weight, s.n AS ante_n FROM pairs p JOIN single s ON s.entity=item_a
    UNION ALL SELECT item_b, item_a, p.weight, s.n FROM pairs p JOIN single s ON s.entity=item_b
    UNION ALL SELECT x||'+'||y, z, t.weight, p.weight FROM triples t JOIN pairs p ON p.item_a=x AND p.item_b=y
    UNION ALL SELECT x||'+'||z, y, t.weight, p.weight FROM triples t JOIN pairs p ON p.item_a=x AND p.item_b=z
    UNION ALL SELECT y||'+'||z, x, t.weight, p.weight FROM triples t JOIN pairs p ON p.item_a=y AND p.item_b=z),
  rated AS (SELECT ante||'-'||cons AS pair, weight AS n, weight::DOUBLE/(SELECT n FROM need) AS support,
      weight::DOUBLE/ante_n AS confidence, (weight::DOUBLE/ante_n)/(s.n::DOUBLE/(SELECT n FROM need)) AS lift
    FROM sided JOIN single s ON s.entity=cons)
  SELECT pair, n, {rnd('support', 4)} AS support, {rnd('confidence', 4)} AS confidence, {rnd('lift', 2)} AS lift
  FROM rated WHERE confidence >= 0.1 AND lift > 1""", "basket_pairs"))
def rules(spark, sf):
    baskets = stage(spark, r.order_baskets(spark, sf), "baskets")
    sets = stage(spark, mn.itemsets(baskets), "itemsets")
    return mn.rules(sets, baskets.agg(F.count("*")).scalar())


# -- category mixes --------------------------------------------------------------------------------------

MIX = """, c AS (SELECT entity, weapon AS name, count(*) AS n FROM builds WHERE weapon IS NOT NULL GROUP BY 1, 2)"""


@query("d15_category_mix", sql(f"""{MIX} SELECT entity, name, n, row_number() OVER (PARTITION BY entity ORDER BY n DESC, name) AS pos,
  {rnd('n::DOUBLE/sum(n) OVER (PARTITION BY entity)', 2)} AS ratio FROM c""", "builds"))
def category_mix(spark, sf):
    return db.category_mix(r.builds(spark, sf), ["entity"], "weapon")


@query("d15_mix_arrays", sql(f"""{MIX} SELECT entity, string_agg(name||':'||n::VARCHAR, ',' ORDER BY n DESC, name) AS mix FROM c GROUP BY 1""", "builds"))
def mix_arrays(spark, sf):
    mix = db.mix_arrays(db.category_mix(r.builds(spark, sf), ["entity"], "weapon"), ["entity"], "m")
    return mix.select("entity", F.array_join(F.transform("m", lambda e: F.concat(e["name"], F.lit(":"), e["count"])), ",").alias("mix"))


@query("d17_top_category", sql(f"""{MIX} SELECT entity, name AS top_weapon, {rnd('n::DOUBLE/t', 2)} AS top_weapon_ratio FROM (
  SELECT *, sum(n) OVER (PARTITION BY entity) AS t, row_number() OVER (PARTITION BY entity ORDER BY n DESC, name) AS pos FROM c) WHERE pos=1""", "builds"))
def top_category(spark, sf):
    return db.top_category(db.category_mix(r.builds(spark, sf), ["entity"], "weapon"), ["entity"], "weapon")


@query("d16_bucket_mix", sql("SELECT entity, " + ", ".join(
    f"{pct(f'count(CASE WHEN constellation={c} THEN 1 END)', 'count(*)', 1)} AS c{c}" for c in range(7)) + " FROM builds GROUP BY 1", "builds"))
def bucket_mix(spark, sf):
    return db.bucket_mix(r.builds(spark, sf), ["entity"], "constellation")


@query("d20_first_last", sql("""SELECT entity, coalesce(min_by(weapon, id) FILTER (weapon <> ''), '') AS weapon, max_by(star, id) AS star
  FROM builds GROUP BY 1""", "builds"))
def first_last(spark, sf):
    b = r.builds(spark, sf)
    return db.first_and_last(b, "entity", "weapon", "star", ["ts", "id"])


@query("d21_latest_snapshot", sql(f"""SELECT count(*) AS n, {rnd('(sum(avg_constellation::DECIMAL(30,4))::DOUBLE/count(avg_constellation))', 1)} AS avg_constellation,
    {rnd('(sum(avg_damage::DECIMAL(30,4))::DOUBLE/count(avg_damage))', 0)} AS avg_damage, max(snapshot_time) AS snapshot_time
  FROM (SELECT strftime(ts, '%Y-%m-%d') AS snapshot_time, entity, {rnd('avg(constellation)', 1)} AS avg_constellation,
        floor(sum(damage)/count(*))::BIGINT AS avg_damage FROM builds GROUP BY 1, 2)
  WHERE snapshot_time=(SELECT strftime(max(ts), '%Y-%m-%d') FROM builds)""", "builds"))
def latest_snapshot(spark, sf):
    snaps = r.builds(spark, sf).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("snapshot_time"), "entity").agg(
        (F.floor(F.sum("constellation") / F.count("*") * 10 + 0.5) / 10.0).alias("avg_constellation"),
        F.floor(F.sum("damage") / F.count("*")).cast("bigint").alias("avg_damage"))
    return db.latest_snapshot_kpis(snaps)


@query("f6_top_per_group", sql("""SELECT period, orderkey, n FROM (SELECT period, orderkey, count(*) AS n FROM lines GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY period ORDER BY n DESC, orderkey) <= 50""", "lines"))
def top_per_group(spark, sf):
    sizes = r.lines(spark, sf).groupBy("period", "orderkey").agg(F.count("*").alias("n"))
    return db.top_n(sizes, 50, [("n", "desc"), ("orderkey", "asc")], per="period")
