"""Queries on sources, sinks and record quality."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import argmax_struct, normalize_label, shorten_label
from ..operators import dashboards as db, draws as dr, quality as q
from ..session import fresh_path
from ..sources import counted as ct, large_json as lj, readers as rd, sinks as sk
from ..sources.sinks import stage
from . import relations as r
from .registry import ORACLES, query
from .relations import pct, rnd, sql


def records(spark, sf):
    return q.classify_records(r.record_lines(spark, sf))


def kept_records(spark, sf):
    """The classified layer, written once before its records are unfolded."""
    return stage(spark, records(spark, sf).select("doc", "reason"), "classified")


@query("b9_record_quality", sql("SELECT period, uid, reason FROM records", "records"))
def record_quality(spark, sf):
    return records(spark, sf).select("period", "uid", "reason")


@query("b18_reason_counts", sql("SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM records GROUP BY 1", "records"))
def reason_counts(spark, sf):
    return q.reason_counts(records(spark, sf))


# The user 14-fault drops the first item of the box; those records can still pass unharmed.
OK_DETAIL = """, ok AS (SELECT d.* FROM detail d JOIN records r ON d.period=r.period AND d.uid=r.uid AND r.reason IS NULL
    LEFT JOIN dropped_first x ON d.period=x.period AND d.uid=x.uid AND d.entity=x.entity WHERE x.uid IS NULL)"""


@query("b12_inventory_detail", sql(f"""{OK_DETAIL} SELECT period, uid::VARCHAR AS uid, entity, star, constellation, level,
  (h1=1 OR h2=1)::INTEGER AS used FROM ok""", "records", "dropped_first"))
def inventory_detail(spark, sf):
    return q.inventory_detail(kept_records(spark, sf))


@query("b13_lineup_detail", sql(f""", ok AS (SELECT d.* FROM detail d JOIN records r ON d.period=r.period AND d.uid=r.uid AND r.reason IS NULL),
  m AS (SELECT period, uid, 1 AS half, entity, star FROM ok WHERE h1=1 UNION ALL SELECT period, uid, 2, entity, star FROM ok WHERE h2=1)
  SELECT period, uid::VARCHAR AS uid, half, (uid*half%10+1)::INTEGER AS basket_no, entity, star,
    row_number() OVER (PARTITION BY period, uid, half ORDER BY entity)::INTEGER AS pos FROM m""", "records"))
def lineup_detail(spark, sf):
    return q.lineup_detail(kept_records(spark, sf))


@query("b18_quality_counters", sql(f"""{OK_DETAIL} SELECT (SELECT count(*) FROM records) AS records,
  (SELECT count(*) FROM records WHERE reason IS NULL) AS accepted, count(*) AS entity_rows,
  (SELECT sum(h1+h2)::BIGINT FROM detail d JOIN records r ON d.period=r.period AND d.uid=r.uid AND r.reason IS NULL) AS lineup_rows
  FROM ok""", "records", "dropped_first"))
def quality_counters(spark, sf):
    return q.quality_counters(records(spark, sf))


@query("l2_consistency", sql("""SELECT
    count(CASE WHEN absent THEN 1 END) AS missing_record,
    count(CASE WHEN f=4 THEN 1 END) AS uid_mismatch,
    coalesce(sum(CASE WHEN absent THEN 0 WHEN f IN (5) THEN m + CASE WHEN f=6 THEN n2 ELSE 0 END
      WHEN f=14 THEN first_members WHEN f=7 THEN first_members ELSE 0 END), 0)::BIGINT AS unowned_members,
    count(CASE WHEN NOT absent AND f<>6 AND both_halves>0 THEN 1 END) AS overlaps
  FROM (SELECT uid%37 AS f, uid%37 IN (1,3) AS absent, sum(h1+h2) AS m, sum(h2) AS n2, sum(h1*h2) AS both_halves,
          min_by(h1+h2, entity) AS first_members FROM detail GROUP BY period, uid) WHERE f<>12""", "detail"))
def consistency(spark, sf):
    from ..operators.reconcile import consistency as check
    return check(q.parse_records(r.record_lines(spark, sf)))


@query("a9_route", sql("SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n, sum(uid)::BIGINT AS uids FROM records GROUP BY 1", "records"))
def route(spark, sf):
    path = fresh_path(spark, "routed")
    sk.route(records(spark, sf).select("uid", "value", "reason"), "reason", path)
    return (spark.read.parquet(path).groupBy(F.col("reason").cast("string").alias("reason"))
            .agg(F.count("*").alias("n"), F.sum("uid").alias("uids")))


@query("a9_routed_rows", sql("SELECT coalesce(reason, 'accepted') AS reason, period, uid FROM records", "records"))
def routed_rows(spark, sf):
    """Every record as it was filed."""
    path = fresh_path(spark, "routed")
    sk.route(records(spark, sf).select("uid", "period", "value", "reason"), "reason", path)
    return spark.read.parquet(path).select(F.col("reason").cast("string").alias("reason"), "period", "uid")


@query("b18_observed_counts", ORACLES["b18_reason_counts"])
def observed_counts(spark, sf):
    """The counters of the one write that files the records."""
    rows = records(spark, sf).select("uid", "period", "value", "reason")
    return ct.counters_frame(spark, ct.route_counted(rows, "reason", fresh_path(spark, "routed"), q.RECORD_REASONS))


@query("b18_stream_counters", sql(f"""{OK_DETAIL} SELECT coalesce(reason, 'accepted') AS counter, count(*) AS n FROM records GROUP BY 1
  UNION ALL SELECT 'total', count(*) FROM records UNION ALL SELECT 'entity_rows', count(*) FROM ok
  UNION ALL SELECT 'lineup_rows', sum(h1+h2)::BIGINT FROM detail d JOIN records r ON d.period=r.period AND d.uid=r.uid AND r.reason IS NULL""",
                                  "records", "dropped_first"))
def stream_counters(spark, sf):
    """Record lines cleaned as a stream of three batches; counters come from the writes and add up over the batches."""
    base = fresh_path(spark, "cleaned")
    lines = r.record_lines(spark, sf)
    lines.repartition(6).write.parquet(f"{base}/lines")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/lines")
    log = ct.counters_log(spark, f"{base}/log")
    more = {k: v for k, v in q.quality_aggregates().items() if k.endswith("_rows")}
    ct.route_stream(stream, q.classify_records, f"{base}/out", log, f"{base}/checkpoint", q.RECORD_REASONS, ["period", "uid", "doc"],
                    more=more).awaitTermination()
    return (log.read("counters").groupBy("counter").agg(F.sum("n").alias("n")).filter("n > 0"))


@query("b10_csv_rows", sql("SELECT coalesce(reason, 'accepted') AS reason, CASE WHEN f <> 0 THEN orderkey||':'||f END AS row FROM csv_rows", "csv_rows"))
def csv_rows(spark, sf):
    """The reason of every line, by the name in its last field."""
    named = q.classify_csv(r.csv_lines(spark, sf, keyed=True))
    return named.select(F.coalesce("reason", F.lit(q.ACCEPTED)).alias("reason"), F.get(F.split("line", ","), 8).alias("row"))


@query("b10_csv_quality", sql("SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM csv_rows GROUP BY 1", "csv_rows"))
def csv_quality(spark, sf):
    return q.reason_counts(q.classify_csv(r.csv_lines(spark, sf)))


@query("a8_split_text", sql("""SELECT period, entity, count(*) AS n, sum(quantity)::BIGINT AS qty FROM lines
  WHERE (orderkey+linenumber)%17 NOT IN (0,1,10,11) GROUP BY 1, 2""", "lines"))
def split_text(spark, sf):
    rows = rd.split_text(r.csv_lines(spark, sf).filter(~F.col("value").startswith("version")), 7,
                         ["period", "entity", "star", "use", "own", "use_rate", "own_rate"], key="entity")
    quantity = F.when(F.col("use") == "1.5", F.col("own")).otherwise(F.col("use")).cast("int")
    return rows.groupBy("period", "entity").agg(F.count("*").alias("n"), F.sum(quantity).alias("qty"))


@query("b11_keep_star", sql("SELECT id, item FROM draws WHERE coalesce(star, 3)=3", "draws"))
def keep_star(spark, sf):
    return q.keep_star(r.draws(spark, sf), 3).select("id", "item")


@query("b1_valid_rows", sql("SELECT id, type, star FROM draws WHERE type IS NOT NULL AND star IS NOT NULL", "draws"))
def valid_rows(spark, sf):
    return q.valid_rows(r.draws(spark, sf), "type", "star").select("id", "type", "star")


@query("d29_batch_quality", sql(f""", b AS (SELECT strftime(ts, '%Y-%m-%d %H') AS batch, count(*) AS total,
    count(CASE WHEN event_type='error' THEN 1 END) AS rejected FROM events GROUP BY 1),
  c AS (SELECT *, sum(total) OVER (ORDER BY batch) AS ct, sum(rejected) OVER (ORDER BY batch) AS cr FROM b)
  SELECT batch, total, rejected, {pct('total-rejected', 'total', 2)} AS clean_rate, {pct('ct-cr', 'ct', 2)} AS cum_rate
  FROM c ORDER BY batch DESC LIMIT 100""", "ev"))
def batch_quality(spark, sf):
    batches = (r.table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("batch"))
               .agg(F.count("*").alias("total"), F.count(F.when(F.col("event_type") == "error", 1)).alias("rejected")))
    return q.batch_quality(batches)


# -- labels and arrays -------------------------------------------------------------------------------

@query("b3_normalize_label", """SELECT p_partkey, CASE WHEN p_name LIKE '%small %' THEN 'v'||replace(p_name, 'small ', '')
    WHEN p_name LIKE '%large %' THEN 'v'||replace(p_name, 'large ', '') ELSE p_name END AS label,
  replace(replace(replace(p_type||'(first)', 'ECONOMY', ''), '(first)', '①'), '(second)', '②') AS short FROM part""")
def labels(spark, sf):
    return r.table(spark, sf, "part").select(
        "p_partkey", normalize_label(F.col("p_name"), ["small ", "large "]).alias("label"),
        shorten_label(F.concat("p_type", F.lit("(first)")), "ECONOMY", {"(first)": "①", "(second)": "②"}).alias("short"))


@query("b8_argmax_struct", """SELECT l_orderkey, arg_max(l_returnflag, (rate, -pos)) AS best FROM (
    SELECT l_orderkey, l_returnflag, rate, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) AS pos
    FROM (SELECT l_orderkey, l_returnflag, count(*) AS rate FROM lineitem GROUP BY 1, 2)) GROUP BY 1""")
def argmax(spark, sf):
    counts = r.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").cast("double").alias("rate"))
    # Three return flags at most, so the array stays tiny.
    items = F.sort_array(F.collect_list(F.struct(F.col("l_returnflag").alias("name"), "rate")))
    return counts.groupBy("l_orderkey").agg(items.alias("i")).select(
        "l_orderkey", argmax_struct(F.col("i"), "rate", "name").alias("best"))


# -- files -------------------------------------------------------------------------------------------

USAGE_FILE = ("period string, entity string, star int, use_count bigint, own_count bigint, "
                                  "use_rate decimal(5,2), own_rate decimal(5,2), tier string")


@query("a1_csv_round_trip", sql("""SELECT period, entity, star, use_count, own_count, use_rate, own_rate,
  CASE WHEN use_rate > 45 THEN 's' ELSE 'a' END AS tier FROM usage""", "usage"))
def csv_round_trip(spark, sf):
    path = fresh_path(spark, "csv")
    rows = r.usage(spark, sf).select(
        F.col("period").alias("version"), F.col("entity").alias("name"), "star", F.col("use_count").alias("use"),
        F.col("own_count").alias("own"), "use_rate", "own_rate", F.when(F.col("use_rate") > 45, "s").otherwise("a").alias("tier"))
    sk.write_csv(rows, path, [F.col("use_rate").desc(), F.col("name")])
    back = rd.scan_csv(spark, path, USAGE_FILE)
    return back.withColumn("use_rate", F.col("use_rate").cast("double")).withColumn("own_rate", F.col("own_rate").cast("double"))


@query("a3_append_overwrite", """SELECT o_orderstatus AS status, count(*) AS n FROM orders
  WHERE o_orderstatus IN ('O', 'P') GROUP BY 1""")
def append_overwrite(spark, sf):
    path = fresh_path(spark, "table")
    orders = r.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    sk.write_table(orders.filter("status = 'F'"), path, "append")
    sk.write_table(orders.filter("status = 'O'"), path, "overwrite")
    sk.write_table(orders.filter("status = 'P'"), path, "append")
    return rd.scan_table(spark, path).groupBy("status").agg(F.count("*").alias("n"))


@query("a15_write_partitions", sql("""SELECT period, entity, use_rate FROM usage WHERE period NOT IN (SELECT period FROM usage_o)
  UNION ALL SELECT period, entity, use_rate FROM usage_o""", "usage", "usage_o"))
def write_partitions(spark, sf):
    path = fresh_path(spark, "partitions")
    new = r.usage(spark, sf, "O")
    for rows in (r.usage(spark, sf), new, new):  # the last rerun must not double anything
        sk.write_partitions(rows.select("period", "entity", "use_rate"), path, ["period"])
    schema = "entity string, use_rate double, period string"
    return spark.read.schema(schema).parquet(path).select("period", "entity", "use_rate")


def usage_documents(rows):
    """One statistics document per period in the two-element layout; a period lists each entity once."""
    item = F.struct(F.col("entity").alias("name"), "star", F.col("use_count").alias("use"),
                    F.col("own_count").alias("own"), "use_rate", "own_rate", F.lit("s").alias("rank_class"))
    flat = rows.groupBy("period").agg(F.to_json(F.sort_array(F.collect_list(item))).alias("l"))
    return flat.select("period", F.concat(
        F.lit('{"title": "'), "period", F.lit('usage statistics", "result": [{"s": []}, '), "l", F.lit("]}")).alias("value"))


@query("a5_scan_documents", sql("""SELECT 'v'||period AS period, entity, star, use_count, own_count, use_rate, own_rate, 's' AS tier FROM usage""", "usage"))
def scan_documents(spark, sf):
    path = fresh_path(spark, "documents")
    # One document per file, as the producer drops them.
    usage_documents(r.usage(spark, sf)).write.partitionBy("period").text(path)
    title = normalize_label(F.coalesce(F.try_variant_get("doc", "$.title", "string"), F.lit("")), ["usage statistics"])
    return rd.scan_documents(spark, path + "/*/*.txt", title)


@query("a5_large_documents", ORACLES["a5_scan_documents"])
def large_documents(spark, sf):
    """The same documents read in splits of 2,000 bytes, none of them by one task."""
    path = fresh_path(spark, "documents")
    usage_documents(r.usage(spark, sf)).write.partitionBy("period").text(path)
    title = normalize_label(F.coalesce(F.try_variant_get("doc", "$.title", "string"), F.lit("")), ["usage statistics"])
    return lj.scan_large_documents(spark, path + "/*/*.txt", title, split_bytes=2000)


@query("a6_jsonl_lines", """SELECT event_id % 50 = 7 AS is_bad, count(*) AS n, sum(CASE WHEN event_id%50<>7 THEN event_id END)::BIGINT AS ids
  FROM events GROUP BY 1""")
def jsonl_lines(spark, sf):
    path = fresh_path(spark, "jsonl")
    whole = F.to_json(F.struct("event_id", "event_type", "value"))
    broken = F.expr("substring(j, 1, length(j) - 3)")
    (r.table(spark, sf, "events").select("event_id", whole.alias("j"))
     .select(F.when(F.col("event_id") % 50 == 7, broken).otherwise(F.col("j")).alias("value")).write.text(path))
    rows = rd.scan_jsonl(spark, path, "event_id bigint, event_type string, value double")
    return rows.groupBy("is_bad").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("a6_jsonl_rows", """SELECT event_id, event_id % 50 = 7 AS is_bad, CASE WHEN event_id % 50 <> 7 THEN event_type END AS event_type,
    CASE WHEN event_id % 50 <> 7 THEN value END AS value FROM events""")
def jsonl_rows(spark, sf):
    """Every line with its values; bad ones keep their text, in which their number still stands."""
    path = fresh_path(spark, "jsonl")
    whole = F.to_json(F.struct("event_id", "event_type", "value"))
    (r.table(spark, sf, "events").select("event_id", whole.alias("j"))
     .select(F.when(F.col("event_id") % 50 == 7, F.expr("substring(j, 1, length(j) - 3)")).otherwise(F.col("j")).alias("value")).write.text(path))
    rows = rd.scan_jsonl(spark, path, "event_id bigint, event_type string, value double")
    number = F.coalesce("event_id", F.regexp_extract("raw", '"event_id":(\\d+)', 1).cast("bigint"))
    return rows.select(number.alias("event_id"), "is_bad", "event_type", "value")


@query("a7_pair_documents", """SELECT o_custkey::VARCHAR AS uid, '2001' AS version, count(*) AS owned,
    count(CASE WHEN o_orderstatus='F' THEN 1 END) > 0 AS has_record,
    CASE WHEN count(CASE WHEN o_orderstatus='F' THEN 1 END) > 0 THEN max(CASE WHEN o_orderstatus='F' THEN o_orderkey END) END AS last_key
  FROM orders GROUP BY 1""")
def pair_documents(spark, sf):
    orders = r.table(spark, sf, "orders")
    uid = F.col("o_custkey").cast("string")
    box = orders.groupBy(uid.alias("uid")).agg(F.count("*").alias("owned")).select(
        F.concat("uid", F.lit("_box.json")).alias("file"), F.to_json(F.struct("uid", "owned")).alias("body"))
    record = orders.filter("o_orderstatus = 'F'").groupBy(uid.alias("uid")).agg(F.max("o_orderkey").alias("last_key")).select(
        F.concat("uid", F.lit("_record.json")).alias("file"), F.to_json(F.struct("uid", "last_key")).alias("body"))
    made = rd.to_lines(rd.pair_documents(box, record, "2001"))
    doc = F.parse_json("value")
    return made.select(F.variant_get(doc, "$.uid", "string").alias("uid"), F.variant_get(doc, "$.version", "string").alias("version"),
                       F.variant_get(doc, "$.box.owned", "bigint").alias("owned"),
                       F.variant_get(doc, "$.record.uid", "string").isNotNull().alias("has_record"),
                       F.variant_get(doc, "$.record.last_key", "bigint").alias("last_key"))


@query("a11_messages", """SELECT event_type AS key, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1""")
def messages(spark, sf):
    """Keyed messages published to files and read back."""
    made = sk.to_messages(r.table(spark, sf, "events").select("event_id", "event_type", "value"), "event_type")
    path = fresh_path(spark, "messages")
    sk.publish_messages(made, "json", path=path)
    out = spark.read.schema(made.schema).json(path)
    return out.groupBy("key").agg(F.count("*").alias("n"),
                                  F.sum(F.get_json_object("value", "$.event_id").cast("bigint")).alias("ids"))


@query("a11_message_rows", "SELECT event_type AS key, event_id, value FROM events")
def message_rows(spark, sf):
    """Every message as it was published."""
    made = sk.to_messages(r.table(spark, sf, "events").select("event_id", "event_type", "value"), "event_type")
    path = fresh_path(spark, "messages")
    sk.publish_messages(made, "json", path=path)
    return spark.read.schema(made.schema).json(path).select(
        "key", F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), F.get_json_object("value", "$.value").cast("double").alias("value"))


def history(spark, sf):
    """Nested history documents, one per year, parsed with the history schema."""
    from pyspark.sql import Window
    rows = r.usage(spark, sf)
    chars = F.sort_array(F.collect_list(F.struct(F.col("entity").alias("n"), F.col("star").alias("st"), F.col("use_count").alias("uc"),
                                                 F.when(F.col("star") == 5, F.col("own_count")).alias("oc"),
                                                 F.col("own_rate").alias("or"), F.col("avg_constellation").alias("co"))))
    docs = rows.groupBy("period").agg(F.max("users").alias("s"), chars.alias("chars"))
    pairs = r.lines(spark, sf).groupBy("period", "entity", "star").agg(F.count("*").alias("n"))
    place = Window.partitionBy("period").orderBy(F.col("n").desc(), "entity")
    team = F.struct(F.array(F.struct(F.col("entity").alias("n")), F.struct(F.col("star").cast("string").alias("n"))).alias("m"),
                    (F.col("n") / 7.0).alias("ur"))
    teams = (pairs.withColumn("rn", F.row_number().over(place)).groupBy("period")
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("rn", team.alias("t")))), lambda e: e["t"]).alias("teams")))
    body = F.to_json(F.struct(F.col("period").alias("t"), "s", "chars", "teams"))
    return (docs.join(teams, "period").select(body.alias("body"))
            .select(F.from_json("body", rd.HISTORY_SCHEMA).alias("d")).select("d.*"))


@query("a21_history_entities", sql(f"""SELECT period, entity, star, CASE WHEN star=5 THEN own_count ELSE users END AS own_count, use_count, users,
  {pct('use_count', 'users', 2)} AS use_rate, {rnd('own_rate', 2)} AS own_rate, {rnd('avg_constellation', 1)} AS avg_constellation
  FROM usage""", "usage"))
def history_entities(spark, sf):
    return rd.history_entities(history(spark, sf))


@query("a21_history_baskets", sql(f"""SELECT period, pos::INTEGER AS pos, entity||' + '||star::VARCHAR AS basket, {rnd('n/7.0e0', 1)} AS use_rate, 0e0 AS has_rate
  FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY n DESC, entity) AS pos
        FROM (SELECT period, entity, star, count(*) AS n FROM lines GROUP BY 1, 2, 3)) WHERE pos <= 50""", "lines"))
def history_baskets(spark, sf):
    return rd.history_baskets(history(spark, sf))


# -- dimensions and banners ---------------------------------------------------------------------------

@query("b20_dedupe_dim", """SELECT trim(p_name) AS name, min_by(p_brand, p_partkey) AS brand FROM part
  WHERE trim(p_name) <> '' AND p_brand <> '' GROUP BY 1""")
def dedupe_dim(spark, sf):
    part = r.table(spark, sf, "part").select(F.concat(F.lit(" "), "p_name").alias("name"), F.col("p_brand").alias("brand"), "p_partkey")
    return dr.dedupe_dim(part, "name", "brand", "p_partkey", need_attribute=True)


@query("b21_explode_banner", sql("""SELECT period, lower(kind) AS kind, min(period)||'-start' AS start_date, min(period)||'-end' AS end_date, entity, sum(n)::BIGINT AS n
  FROM banners GROUP BY period, kind, entity""", "banners"))
def explode_banner(spark, sf):
    entry = F.struct(F.col("period").alias("version"), F.concat("period", F.lit("-start")).alias("start"),
                     F.concat("period", F.lit("-end")).alias("end"), "content")
    docs = (r.banners(spark, sf).groupBy("period", "kind")
            .agg(F.map_from_entries(F.collect_list(F.struct("entity", "n"))).alias("content")))
    kinds = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    lists = docs.select(*[F.when(F.col("kind") == k, F.array(entry)).alias(f"{k.lower()}_list") for k in kinds])
    return dr.explode_banner(lists, {f"{k.lower()}_list": k.lower() for k in kinds})


@query("d18_banner_kpis", sql("""SELECT count(DISTINCT period) AS periods, sum(n)::BIGINT AS total_draws,
  (SELECT entity FROM banners GROUP BY 1 ORDER BY sum(n) DESC, entity LIMIT 1) AS top_entity,
  (SELECT sum(n)::BIGINT FROM banners GROUP BY entity ORDER BY sum(n) DESC, entity LIMIT 1) AS top_entity_draws,
  (SELECT period FROM banners GROUP BY 1 ORDER BY sum(n) DESC, period LIMIT 1) AS top_period FROM banners""", "banners"))
def banner_kpis(spark, sf):
    return dr.banner_kpis(r.banners(spark, sf))


@query("d19_totals", sql("""SELECT 'period' AS by_what, period AS name, sum(n)::BIGINT AS total FROM banners GROUP BY 2
  UNION ALL SELECT 'kind', kind, sum(n)::BIGINT FROM banners GROUP BY 2
  UNION ALL SELECT * FROM (SELECT 'entity', entity, sum(n)::BIGINT AS t FROM banners GROUP BY 2 ORDER BY t DESC, entity LIMIT 10)""", "banners"))
def totals(spark, sf):
    b = r.banners(spark, sf)
    top = db.top_n(dr.banner_totals(b, "entity"), 10, [("total", "desc"), ("entity", "asc")])
    parts = [dr.banner_totals(b, "period"), dr.banner_totals(b, "kind", "role"), top]
    names = ["period", "kind", "entity"]
    return db.stack(*[p.withColumnRenamed(n, "name") for p, n in zip(parts, names)], tags=names, tag_col="by_what")


@query("d25_period_maps", sql("""SELECT period, string_agg(entity||'='||n::VARCHAR, ',' ORDER BY entity) AS content, count(*) AS size
  FROM (SELECT period, entity, sum(n)::BIGINT AS n FROM banners GROUP BY 1, 2) GROUP BY 1""", "banners"))
def period_maps(spark, sf):
    from ..operators.timeline import period_maps as maps
    text = F.array_join(F.transform(F.map_entries("content"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return maps(r.banners(spark, sf)).select("period", text.alias("content"), F.size("content").cast("bigint").alias("size"))


# -- draws ---------------------------------------------------------------------------------------------

@query("d9_draw_counts", sql("SELECT item, count(*) AS n FROM draws GROUP BY 1", "draws"))
def draw_counts(spark, sf):
    return dr.draw_counts(r.draws(spark, sf))


@query("d10_draw_stats", sql(f""", five AS (SELECT * FROM draws WHERE coalesce(star, 3)=5), t AS (SELECT count(*) AS total FROM draws)
  SELECT item, min_by(coalesce(type, 'role'), id) AS type, count(*) AS five, count(CASE WHEN is_up THEN 1 END) AS up,
    {pct('(SELECT count(*) FROM five)', '(SELECT total FROM t)', 2)} AS five_rate, (SELECT total FROM t) AS total FROM five GROUP BY 1
  UNION ALL SELECT '__ALL__', 'summary', count(*), count(CASE WHEN is_up THEN 1 END),
    {pct('count(*)', '(SELECT total FROM t)', 2)}, (SELECT total FROM t) FROM five""", "draws"))
def draw_stats(spark, sf):
    draws = r.draws(spark, sf)
    return dr.draw_stats(q.keep_star(draws, 5), draws.agg(F.count("*")).scalar())
