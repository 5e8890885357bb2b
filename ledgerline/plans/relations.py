"""Usage, basket, draw and live relations derived from the test tables.

Every relation exists twice: as a DataFrame and as a SQL common table expression, so that queries
and their oracles start from the same rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import exact_avg, percent, round_half_up
from ..session import fresh_path
from ..sources.sinks import stage


# Fixed: a lineup has at most four members.
LINEUP_SIZE = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _brand_number(c: Column) -> Column:
    return F.substring(c, 7, 3).cast("int")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order and part: the raw usage facts.

    Orders are joined last, so that what is grouped by order next lies together already.
    """
    item = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("entity"))
    return (item.join(part, item.l_partkey == part.p_partkey)
            .join(order, item.l_orderkey == order.o_orderkey)
            .select(F.year("o_orderdate").cast("string").alias("period"), "o_orderdate",
                    F.col("o_custkey").alias("uid"), F.col("l_orderkey").alias("orderkey"),
                    F.when(F.col("o_orderstatus") == "F", "F").otherwise("O").alias("ostatus"), "entity",
                    (_brand_number(F.col("entity")) % 2 + 4).alias("star"),
                    F.col("l_linenumber").alias("linenumber"), F.col("l_quantity").alias("quantity"),
                    F.col("l_linestatus").alias("linestatus"), F.col("l_discount").alias("discount"),
                    F.col("l_tax").alias("tax")))


def detail_of(facts: DataFrame) -> DataFrame:
    """Owned entities per period and user; h1 and h2 tell which halves they played in."""
    def flag(c: Column) -> Column:
        return F.max(c.cast("int"))

    return facts.groupBy("period", "uid", "entity").agg(
        F.max("star").alias("star"),
        F.least(F.count("*") - 1, F.lit(6)).cast("int").alias("constellation"),
        F.greatest(F.lit(1), F.max("quantity").cast("int")).alias("level"),
        flag(F.col("linestatus") == "F").alias("used"),
        flag(F.col("linenumber").isin(1, 3)).alias("h1"),
        flag(F.col("linenumber").isin(2, 4)).alias("h2"))


def detail(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """The detail layer. It is written once, as the aggregates read it from several sides."""
    facts = lines(spark, sf_dir)
    if status:
        facts = facts.filter(F.col("ostatus") == status)
    return stage(spark, detail_of(facts), "detail")


def usage(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Rates per year and entity. Staged: one small row per pair, read many times."""
    from ..operators.usage import usage_rates
    return stage(spark, usage_rates(detail(spark, sf_dir, status)), "usage")


def order_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.baskets import baskets
    return baskets(lines(spark, sf_dir), ["period", "orderkey"], "entity")


def ranked_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets as distinct item sets, with their share of all baskets."""
    sets = stage(spark, order_baskets(spark, sf_dir), "baskets")
    total = sets.agg(F.count("*")).scalar()
    return (sets.groupBy("items").agg(F.count("*").alias("n"))
            .select(F.array_join("items", "+").alias("basket"), "items", "n",
                    round_half_up(F.col("n") * 100.0 / total, 4).alias("use_rate")))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score row per entity."""
    return lines(spark, sf_dir).groupBy("entity").agg(
        round_half_up(exact_avg(F.col("tax") * 100), 2).alias("ability"),
        round_half_up(exact_avg(F.col("quantity")) / 5, 2).alias("look"),
        round_half_up(exact_avg(F.col("discount") * 100), 2).alias("score"),
        F.count("*").alias("votes"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def draws_of(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return events.withColumn("k", _k()).select(
        F.col("event_id").alias("id"), "ts", F.col("user_id").alias("uid"),
        F.concat_ws("_", "event_type", (k % 10).cast("string")).alias("item"),
        F.when(k % 3 == 0, "weapon").when(k % 3 == 1, "role").alias("type"),
        F.when(F.col("value") >= 100, 5).when(F.col("value") >= 50, 4)
        .when(k % 11 != 0, 3).alias("star"),
        (k % 2 == 0).alias("is_up"))


def builds_of(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return events.withColumn("k", _k()).select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("entity"), (k % 2 + 4).alias("star"),
        F.upper("event_type").alias("ename"), (k % 7).alias("constellation"), (k % 90 + 1).alias("level"),
        F.floor(F.col("value") * 1000).alias("damage"),
        F.when(k % 13 == 0, F.lit("?")).otherwise(F.concat(F.lit("w"), k % 5)).alias("weapon"),
        F.concat(F.lit("a"), k % 3).alias("artifact"))


def scores_of(events: DataFrame) -> DataFrame:
    k = F.col("k")
    score = F.least(F.lit(10.0), round_half_up(F.col("value") / 10, 1))
    return events.withColumn("k", _k()).select(
        F.concat_ws("_", "event_type", (k % 4).cast("string")).alias("entity"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("id"), score.alias("score"),
        F.when(k % 5 != 0, k % 2 + 4).alias("star"),
        F.when(k % 5 != 0, score).alias("ability"), (k % 10).cast("double").alias("look"))


def draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draws_of(table(spark, sf_dir, "events"))


def builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builds_of(table(spark, sf_dir, "events"))


def live_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores_of(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    from ..streaming.views import open_stream
    return open_stream(spark, "parquet", table(spark, sf_dir, "events").schema, sf_dir,
                       pathGlobFilter="events.parquet")


def unordered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of several batches in no order of time."""
    from ..streaming.views import open_stream
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, "unordered")
    events = table(spark, sf_dir, "events")
    events.repartition(files, "event_id").write.parquet(path)
    return open_stream(spark, "parquet", events.schema, path, maxFilesPerTrigger=-(-files // 3))


def replay(spark: SparkSession, sf_dir: str, run, batches: int = 3, in_order: bool = False) -> None:
    """Feed the events to a stream in `batches` batches, mixed in time or one period after the other; the query stops and starts
    again for each. `run` gets the stream and starts a query that takes what is there.
    """
    from ..streaming.views import open_stream
    path = fresh_path(spark, "replay")
    events = table(spark, sf_dir, "events")
    part = F.pmod("event_id", F.lit(batches))
    if in_order:
        cuts = events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [i / batches for i in range(1, batches)], 1000)).first()[0]
        part = sum([(F.unix_micros(F.col("ts").cast("timestamp")) >= c).cast("int") for c in cuts or []], F.lit(0))
    for i in range(batches):
        events.filter(part == i).write.mode("append").parquet(path)
        run(open_stream(spark, "parquet", events.schema, path)).awaitTermination()


def banners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws per quarter, segment and entity: a table of its own, written once."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("uid"), F.col("c_mktsegment").alias("kind"))
    quarter = F.concat_ws("Q", F.year("o_orderdate").cast("string"), F.quarter("o_orderdate").cast("string"))
    return stage(spark, lines(spark, sf_dir).join(customer, "uid")
                 .groupBy(quarter.alias("period"), "kind", "entity").agg(F.count("*").alias("n")), "banners")


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension of the entities; those with a number divisible by five have no row."""
    d = (table(spark, sf_dir, "part").filter(_brand_number(F.col("p_brand")) % 5 != 0)
         .select(F.col("p_brand").alias("entity")).distinct())
    d = d.withColumn("star", _brand_number(F.col("entity")) % 2 + 4)
    return d.withColumn("avatar", F.concat(F.lit("img/"), _brand_number(F.col("entity"))))


def user_rates(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Rates per user from the orders of one status; many users occur under one status only."""
    d = detail_of(lines(spark, sf_dir).filter(F.col("ostatus") == status))
    entities = table(spark, sf_dir, "part").agg(F.count_distinct("p_brand")).scalar()
    return d.groupBy("uid").agg(
        F.max("star").alias("star"),
        percent(F.count(F.when(F.col("used") == 1, 1)), F.count("*"), 1).alias("use_rate"),
        percent(F.count_distinct("entity"), entities, 1).alias("own_rate"))


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records as JSON lines with faults by user id: period, uid, value.

    A record lists each entity once, so its arrays are as long as the entity vocabulary at most.
    """
    # Both groupings find their rows together after this one shuffle.
    facts = lines(spark, sf_dir).repartition("period", "uid")
    grouped = detail_of(facts).groupBy("period", "uid").agg(
        F.sort_array(F.collect_list(F.struct("entity", "star", "constellation", "level", "h1", "h2"))).alias("e"))
    f = F.col("uid") % 37
    uid = F.col("uid").cast("string")
    size = F.size("e")

    def text_at(i: Column, edge: Column, fault: int, value: str, normal: Column) -> Column:
        return F.when((f == fault) & (i == edge), value).otherwise(normal.cast("string"))

    def character(c: Column, i: Column) -> Column:
        first, last = F.lit(0), size - 1
        star = F.when((f == 8) & (i == first), "3").when((f == 13) & (i == last), "abc").otherwise(c["star"].cast("string"))
        level = F.when((f == 10) & (i == first), "91").when((f == 13) & (i == first), "0").otherwise(c["level"].cast("string"))
        return F.struct(text_at(i, first, 7, "", c["entity"]).alias("name"), star.alias("star"),
                        text_at(i, first, 9, "7", c["constellation"]).alias("constellation"),
                        level.alias("level"))

    def team(no: int, mark: str) -> Column:
        half = F.when(f == 11, 3 - no).otherwise(no)
        members = F.transform(F.filter("e", lambda c: c[mark] == 1),
                              lambda c: F.struct(c["entity"].alias("name"), c["star"].alias("star")))
        return F.struct(half.alias("half"), ((F.col("uid") * no) % 10 + 1).alias("team_index"),
                        members.alias("members"))

    characters = F.transform("e", character)
    kept = (F.when(f == 5, F.filter(characters, lambda _: F.lit(False)))
            .when(f == 14, F.slice(characters, 2, size)).otherwise(characters))
    teams = F.when(f == 6, F.array(team(1, "h1"), team(2, "h2"), team(2, "h2"))).otherwise(
        F.array(team(1, "h1"), team(2, "h2")))
    record = F.when(f != 3, F.struct(uid.alias("uid"), teams.alias("teams")))
    doc = F.to_json(F.struct(
        F.when(f == 2, "").otherwise(uid).alias("uid"), F.col("period").alias("version"),
        F.struct(F.when(f == 4, F.concat(uid, F.lit("x"))).otherwise(uid).alias("uid"),
                 kept.alias("characters")).alias("box"),
        record.alias("record")))
    value = F.when(f == 1, '{"uid": ').when(f == 12, "   ").otherwise(doc)
    # Written like any raw layer: the rules then read text, not the expressions that made it.
    return stage(spark, grouped.select("period", "uid", value.alias("value")), "records")


def csv_lines(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """Flat usage lines with faults by row; if asked for, whole ones have a last field that names the row."""
    key = F.col("orderkey") + F.col("linenumber")
    f = key % 17
    fields = [
        F.col("period"), F.when(f == 1, "").otherwise(F.col("entity")),
        F.when(f == 2, "x").when(f == 3, "3").otherwise(F.col("star").cast("string")),
        F.when(f == 7, "1.5").otherwise(F.col("quantity").cast("int").cast("string")),
        F.when(f == 8, "-1").otherwise(F.col("quantity").cast("int").cast("string")),
        F.when(f == 4, "abc").when(f == 6, "NaN").otherwise(F.col("discount").cast("string")),
        F.when(f == 5, "101").otherwise(F.col("tax").cast("string")),
        F.when(f == 9, "zz").when(f == 13, "").otherwise("s1")]
    value = (F.when(f == 0, F.concat_ws(",", *fields[:6])).when(f == 10, "")
             .when(f == 11, "version,name,star,use,own,use_rate,own_rate,tier")
             .otherwise(F.concat_ws(",", *fields, *([F.concat("orderkey", F.lit(":"), f)] if keyed else []))))
    return stage(spark, lines(spark, sf_dir).select(value.alias("value")), "csv-lines")


# ---------------------------------------------------------------------------------------- SQL twins

def rnd(x: str, digits: int = 0) -> str:
    return f"((CASE WHEN ({x})<0 THEN -floor(-({x})*1e{digits}+0.5e0) ELSE floor(({x})*1e{digits}+0.5e0) END)/1e{digits}+0e0)"


def pct(num: str, den: str, digits: int | None = None) -> str:
    v = f"(CASE WHEN coalesce(({den})::DOUBLE,0)=0 THEN 0e0 ELSE ({num})::DOUBLE/({den})::DOUBLE*100e0 END)"
    return v if digits is None else rnd(v, digits)


def esum(x: str) -> str:
    return f"(sum(({x})::DECIMAL(30,4))::DOUBLE)"


def eavg(x: str) -> str:
    return f"({esum(x)}/count({x}))"


def _usage_sql(source: str) -> str:
    return f"""SELECT d.period, entity, max(star) AS star, count(*) AS own_count,
      count(CASE WHEN used=1 THEN 1 END) AS use_count, max(users) AS users,
      {pct('count(*)', 'max(users)', 2)} AS own_rate,
      {pct('count(CASE WHEN used=1 THEN 1 END)', 'max(users)', 2)} AS use_rate,
      {rnd(eavg('constellation'), 2)} AS avg_constellation, {rnd(eavg('level'), 2)} AS avg_level
    FROM {source} d JOIN (SELECT period, count(DISTINCT uid) AS users FROM {source} GROUP BY 1) u
      ON d.period = u.period GROUP BY 1, 2"""


def _detail_sql(where: str = "") -> str:
    return f"""SELECT period, uid, entity, max(star) AS star,
      least(count(*)-1, 6)::INTEGER AS constellation, greatest(1, max(quantity)::INTEGER) AS level,
      max((linestatus='F')::INTEGER) AS used, max((linenumber IN (1,3))::INTEGER) AS h1,
      max((linenumber IN (2,4))::INTEGER) AS h2 FROM lines {where} GROUP BY 1, 2, 3"""


def _user_rates_sql(source: str) -> str:
    return f"""SELECT uid, max(star) AS star, {pct('count(CASE WHEN used=1 THEN 1 END)', 'count(*)', 1)} AS use_rate,
      {pct('count(DISTINCT entity)', '(SELECT count(DISTINCT p_brand) FROM part)', 1)} AS own_rate FROM {source} GROUP BY 1"""


_NUM = "substr({},7,3)::INTEGER"
_K = """regexp_extract(props, '"k": *([0-9]+)', 1)::INTEGER"""

CTES: dict[str, tuple[str, ...]] = {
    "lines": ((), f"""SELECT year(o_orderdate)::VARCHAR AS period, o_orderdate, o_custkey AS uid,
      l_orderkey AS orderkey, CASE WHEN o_orderstatus='F' THEN 'F' ELSE 'O' END AS ostatus, p_brand AS entity,
      {_NUM.format('p_brand')} % 2 + 4 AS star, l_linenumber AS linenumber, l_quantity AS quantity,
      l_linestatus AS linestatus, l_discount AS discount, l_tax AS tax
      FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN part ON l_partkey=p_partkey"""),
    "detail": (("lines",), _detail_sql()),
    "detail_f": (("lines",), _detail_sql("WHERE ostatus='F'")),
    "detail_o": (("lines",), _detail_sql("WHERE ostatus='O'")),
    "usage": (("detail",), _usage_sql("detail")),
    "usage_f": (("detail_f",), _usage_sql("detail_f")),
    "usage_o": (("detail_o",), _usage_sql("detail_o")),
    "latest": (("usage",), "SELECT * FROM usage WHERE period=(SELECT max(period) FROM usage)"),
    "latest_o": (("usage_o",), "SELECT * FROM usage_o WHERE period=(SELECT max(period) FROM usage_o)"),
    "basket_items": (("lines",), """SELECT period, orderkey, entity FROM (
      SELECT DISTINCT period, orderkey, entity FROM lines)
      QUALIFY count(*) OVER (PARTITION BY period, orderkey) >= 2"""),
    "basket_pairs": (("basket_items",), """SELECT a.entity AS item_a, b.entity AS item_b, count(*) AS weight
      FROM basket_items a JOIN basket_items b USING (period, orderkey) WHERE a.entity < b.entity GROUP BY 1, 2"""),
    "ranked_baskets": (("basket_items",), f"""SELECT basket, items, count(*) AS n,
      {rnd("count(*)*100e0/(SELECT count(DISTINCT (period, orderkey)) FROM basket_items)", 4)} AS use_rate
      FROM (SELECT list(entity ORDER BY entity) AS items, string_agg(entity, '+' ORDER BY entity) AS basket
            FROM basket_items GROUP BY period, orderkey) GROUP BY 1, 2"""),
    "lead_baskets": (("ranked_baskets",), """SELECT *, row_number() OVER (ORDER BY use_rate DESC, basket) AS no
      FROM ranked_baskets WHERE len(items) <= 4 QUALIFY no <= 30"""),
    "scores": (("lines",), f"""SELECT entity, {rnd(eavg('tax*100'), 2)} AS ability,
      {rnd(eavg('quantity') + '/5', 2)} AS look, {rnd(eavg('discount*100'), 2)} AS score, count(*) AS votes
      FROM lines GROUP BY 1"""),
    "quads": (("latest", "scores"), """SELECT l.entity, star, use_rate, ability, look, score, votes,
      CASE WHEN use_rate > 45 AND score > 5 THEN 'praised_popular' WHEN use_rate <= 45 AND score > 5 THEN 'praised'
           WHEN use_rate > 45 THEN 'popular' ELSE 'low' END AS quadrant
      FROM latest l JOIN scores s ON l.entity = s.entity"""),
    "ev": ((), f"SELECT *, {_K} AS k FROM events"),
    "draws": (("ev",), """SELECT event_id AS id, ts, user_id AS uid, event_type||'_'||(k%10)::VARCHAR AS item,
      CASE WHEN k%3=0 THEN 'weapon' WHEN k%3=1 THEN 'role' END AS type,
      CASE WHEN value>=100 THEN 5 WHEN value>=50 THEN 4 WHEN k%11<>0 THEN 3 END AS star, k%2=0 AS is_up FROM ev"""),
    "builds": (("ev",), """SELECT event_id AS id, ts, event_type AS entity, k%2+4 AS star,
      upper(event_type) AS ename, k%7 AS constellation, k%90+1 AS level, floor(value*1000)::BIGINT AS damage,
      CASE WHEN k%13=0 THEN '?' ELSE 'w'||(k%5)::VARCHAR END AS weapon, 'a'||(k%3)::VARCHAR AS artifact FROM ev"""),
    "live": (("ev",), f"""SELECT event_type||'_'||(k%4)::VARCHAR AS entity, ts, event_id AS id,
      least(10e0, {rnd('value/10', 1)}) AS score, CASE WHEN k%5<>0 THEN k%2+4 END AS star,
      CASE WHEN k%5<>0 THEN least(10e0, {rnd('value/10', 1)}) END AS ability, (k%10)::DOUBLE AS look FROM ev"""),
    "hot_rows": (("builds",), """SELECT *, (floor(epoch(ts)/900)::BIGINT - s.k)*900 AS ws
      FROM builds, (SELECT unnest([0,1,2,3]) AS k) s"""),
    "banners": (("lines",), """SELECT year(o_orderdate)::VARCHAR||'Q'||quarter(o_orderdate)::VARCHAR AS period,
      c_mktsegment AS kind, entity, count(*) AS n FROM lines JOIN customer ON uid=c_custkey GROUP BY 1, 2, 3"""),
    "dim": ((), f"""SELECT DISTINCT p_brand AS entity, {_NUM.format('p_brand')}%2+4 AS star,
      'img/'||({_NUM.format('p_brand')})::VARCHAR AS avatar FROM part WHERE {_NUM.format('p_brand')} % 5 <> 0"""),
    "rates_f": (("detail_f",), _user_rates_sql("detail_f")),
    "rates_o": (("detail_o",), _user_rates_sql("detail_o")),
    "records": (("detail",), """SELECT period, uid, CASE
        WHEN f IN (1,2,3,4) THEN 'bad_uid' WHEN f=5 OR (f=14 AND n=1) THEN 'empty_box' WHEN f=6 THEN 'bad_teams'
        WHEN f=7 THEN 'missing_field' WHEN f=8 THEN 'bad_star' WHEN f=9 THEN 'bad_const' WHEN f=10 THEN 'bad_level'
        WHEN f=13 AND n>=2 THEN 'bad_level' WHEN f=13 THEN 'bad_star' WHEN f=11 THEN 'bad_teams'
        WHEN n1 NOT BETWEEN 1 AND 4 OR n2 NOT BETWEEN 1 AND 4 THEN 'bad_team_size'
        WHEN both_halves > 0 THEN 'overlap' WHEN f=14 AND first_used THEN 'missing_char' END AS reason
      FROM (SELECT period, uid, uid%37 AS f, count(*) AS n, sum(h1) AS n1, sum(h2) AS n2,
              sum(h1*h2) AS both_halves, min_by(h1=1 OR h2=1, entity) AS first_used FROM detail GROUP BY 1, 2)
      WHERE f <> 12"""),
    "dropped_first": (("detail",), """SELECT period, uid, min(entity) AS entity FROM detail
      WHERE uid%37=14 GROUP BY 1, 2"""),
    "csv_rows": (("lines",), """SELECT orderkey, (orderkey+linenumber)%17 AS f, CASE (orderkey+linenumber)%17
        WHEN 0 THEN 'parse_error' WHEN 1 THEN 'missing_field' WHEN 2 THEN 'parse_error' WHEN 3 THEN 'bad_star'
        WHEN 4 THEN 'parse_error' WHEN 5 THEN 'bad_rate' WHEN 6 THEN 'bad_rate' WHEN 7 THEN 'parse_error'
        WHEN 8 THEN 'bad_count' WHEN 9 THEN 'bad_tier' END AS reason
      FROM lines WHERE (orderkey+linenumber)%17 NOT IN (10, 11)"""),
}


def sql(body: str, *names: str) -> str:
    """Prefix a query with the named relations and what they are built from.

    A body may begin with ", name AS (...)" to add relations of its own.
    """
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for need in CTES[name][0]:
            add(need)
        order.append(name)

    for name in names:
        add(name)
    if not order:
        return body
    own = body.lstrip()
    join = "" if own.startswith(",") else "\n"
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + join + own
