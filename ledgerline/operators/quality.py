"""Record quality: classify, keep the reason of every reject, unfold the accepted records."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schemas
from ..functions import distinct_names, lenient_int, percent

# Fixed values of the rule set.
VALID_STARS = (4, 5)
CONSTELLATION_RANGE = (0, 6)
LEVEL_RANGE = (1, 90)
TEAM_SIZE_RANGE = (1, 4)
RATE_RANGE = (0.0, 100.0)
VALID_TIERS = ("s1", "s", "a", "b", "c", "f", "")
HEADER_PREFIX = "version"

ACCEPTED = "accepted"
RECORD_REASONS = ("bad_uid", "empty_box", "bad_teams", "missing_field", "bad_star", "bad_const", "bad_level", "bad_team_size", "overlap",
                  "missing_char")
CSV_REASONS = ("parse_error", "missing_field", "bad_star", "bad_rate", "bad_count", "bad_tier")


def _is_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def parse_records(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Drop blank lines and add `doc`: the user record with lenient integers.

    One typed parse serves nearly all records; only where it yields no list is the record parsed
    again item by item.
    """
    loose = F.from_json(F.trim(json_col), schemas.LOOSE_RECORD)

    def loose_team(item: Column) -> Column:
        t = F.from_json(item, schemas.LOOSE_TEAM)
        return F.struct(t["half"].alias("half"), t["team_index"].alias("team_index"), F.transform(
            t["members"], lambda m: F.from_json(m, schemas.MEMBER_ITEM)).alias("members"))

    box = F.coalesce("_raw.box.characters", F.transform(
        loose["box"]["characters"], lambda item: F.from_json(item, schemas.BOX_ITEM)))
    teams = F.coalesce("_raw.record.teams", F.transform(loose["record"]["teams"], loose_team))
    characters = F.transform("_box", lambda c: F.struct(
        c["name"].alias("name"),
        lenient_int(c["star"], -1).alias("star"),
        lenient_int(c["constellation"], -1).alias("constellation"),
        lenient_int(c["level"], -1).alias("level")))
    lineups = F.transform("_teams", lambda t: F.struct(
        lenient_int(t["half"], -1).alias("half"),
        lenient_int(t["team_index"], 0).alias("team_index"),
        F.transform(t["members"], lambda m: F.struct(
            m["name"].alias("name"), lenient_int(m["star"], 0).alias("star"))).alias("members")))
    return (df.filter(F.trim(json_col) != "")
            .withColumn("_raw", F.from_json(F.trim(json_col), schemas.USER_RECORD))
            .withColumns({"_box": box, "_teams": teams})
            .withColumn("doc", F.struct(
                F.col("_raw.uid").alias("uid"), F.col("_raw.version").alias("period"),
                F.col("_raw.box.uid").alias("box_uid"), F.col("_raw.record.uid").alias("record_uid"),
                characters.alias("characters"), lineups.alias("teams")))
            .drop("_raw", "_box", "_teams"))


def _entity_code(c: Column) -> Column:
    """First rule an inventory item breaks, null if none."""
    return (F.when(_is_blank(c["name"]), "missing_field")
            .when(~c["star"].isin(*VALID_STARS), "bad_star")
            .when(~c["constellation"].between(*CONSTELLATION_RANGE), "bad_const")
            .when(~c["level"].between(*LEVEL_RANGE), "bad_level"))


def classify_records(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Nested record rules, first failing rule wins: adds `doc` and `reason` (null = accepted).

    All rules look at one record, so this is a narrow map without any shuffle. Write the result
    once (`route` or `stage`) before unfolding it: a filter on the reason over the raw lines would
    parse them again for the filter.
    """
    doc = F.col("doc")
    names = [distinct_names(F.get(doc["teams"], i)["members"]["name"]) for i in (0, 1)]
    box_names = doc["characters"]["name"]
    codes = F.transform(doc["characters"], _entity_code)
    low, high = TEAM_SIZE_RANGE
    rules = [
        (F.coalesce(doc["uid"], F.lit("")) == "", F.lit("bad_uid")),
        (~(doc["uid"].eqNullSafe(doc["box_uid"]) & doc["uid"].eqNullSafe(doc["record_uid"])),
         F.lit("bad_uid")),
        (F.coalesce(F.size(doc["characters"]), F.lit(0)) < 1, F.lit("empty_box")),
        (F.coalesce(F.size(doc["teams"]), F.lit(0)) != 2, F.lit("bad_teams")),
        (F.col("_code").isNotNull(), F.col("_code")),
        ((F.get(doc["teams"], 0)["half"] != 1) | (F.get(doc["teams"], 1)["half"] != 2),
         F.lit("bad_teams")),
        (~F.size("_half1").between(low, high) | ~F.size("_half2").between(low, high),
         F.lit("bad_team_size")),
        (F.arrays_overlap("_half1", "_half2"), F.lit("overlap")),
        (F.size(F.array_except(F.array_union("_half1", "_half2"), box_names)) > 0,
         F.lit("missing_char")),
    ]
    reason = F.lit(None).cast("string")
    for broken, code in reversed(rules):
        reason = F.when(broken, code).otherwise(reason)
    return (parse_records(df, json_col)
            .withColumn("_code", F.get(F.filter(codes, lambda c: c.isNotNull()), F.lit(0)))
            .withColumn("_half1", names[0]).withColumn("_half2", names[1])
            .withColumn("reason", reason)
            .drop("_code", "_half1", "_half2"))


def inventory_detail(classified: DataFrame) -> DataFrame:
    """One row per owned entity of each accepted record; a repeated name keeps its last values."""
    ok = classified.filter(F.col("reason").isNull())
    chars = F.col("doc.characters")
    # Repeats are rare: look for later namesakes only in boxes that have any.
    last_only = F.filter(chars, lambda c, i: ~F.array_contains(
        F.slice(chars, i + 2, F.size(chars))["name"], c["name"]))
    unique = F.when(F.size(F.array_distinct(chars["name"])) == F.size(chars), chars).otherwise(last_only)
    used = F.flatten(F.col("doc.teams.members"))["name"]
    return (ok.select(F.col("doc.period").alias("period"), F.col("doc.uid").alias("uid"),
                      used.alias("_used"), F.explode(unique).alias("c"))
            .select("period", "uid", F.col("c.name").alias("entity"), F.col("c.star").alias("star"),
                    F.col("c.constellation").alias("constellation"), F.col("c.level").alias("level"),
                    F.coalesce(F.array_contains("_used", F.col("c.name")), F.lit(False))
                    .cast("int").alias("used")))


def lineup_detail(classified: DataFrame) -> DataFrame:
    """One row per lineup member of each accepted record, positions from 1 in list order."""
    return (classified.filter(F.col("reason").isNull())
            .select(F.col("doc.period").alias("period"), F.col("doc.uid").alias("uid"),
                    F.explode("doc.teams").alias("t"))
            .select("period", "uid", F.col("t.half").alias("half"),
                    F.col("t.team_index").alias("basket_no"), F.posexplode("t.members").alias("i", "m"))
            .select("period", "uid", "half", "basket_no", F.col("m.name").alias("entity"),
                    F.col("m.star").alias("star"), (F.col("i") + 1).alias("pos")))


def classify_csv(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Flat usage line rules, first failing rule wins: line, its fields and `reason`.

    Header and blank lines are dropped. A NaN rate counts as out of range.
    """
    names = ("version", "name", "star", "use", "own", "use_rate", "own_rate", "tier")
    line = F.trim(line_col)
    fields = F.split(line, ",", -1)
    out = df.filter((line != "") & ~line.startswith(HEADER_PREFIX)).select(
        line.alias("line"), F.size(fields).alias("_n"),
        *[F.trim(F.get(fields, i)).alias(f"f_{n}") for i, n in enumerate(names)])
    star = F.col("f_star").try_cast("int")
    rates = [F.col(c).try_cast("double") for c in ("f_use_rate", "f_own_rate")]
    counts = [F.col(c).try_cast("int") for c in ("f_use", "f_own")]
    rules = [
        (F.col("_n") < len(names), "parse_error"),
        (_is_blank(F.col("f_name")) | _is_blank(F.col("f_version")), "missing_field"),
        (star.isNull(), "parse_error"),
        (~star.isin(*VALID_STARS), "bad_star"),
        (rates[0].isNull() | rates[1].isNull(), "parse_error"),
        (~rates[0].between(*RATE_RANGE) | ~rates[1].between(*RATE_RANGE), "bad_rate"),
        (counts[0].isNull() | counts[1].isNull(), "parse_error"),
        ((counts[0] < 0) | (counts[1] < 0), "bad_count"),
        (~F.col("f_tier").isin(*VALID_TIERS), "bad_tier"),
    ]
    reason = F.lit(None).cast("string")
    for broken, code in reversed(rules):
        reason = F.when(broken, F.lit(code)).otherwise(reason)
    return out.withColumn("reason", reason).drop("_n")


def reason_counts(classified: DataFrame) -> DataFrame:
    """Records per reason; accepted ones under their own name."""
    return (classified.groupBy(F.coalesce("reason", F.lit(ACCEPTED)).alias("reason"))
            .agg(F.count("*").alias("n")))


def quality_aggregates() -> dict[str, Column]:
    """Accepted records and the detail rows that they unfold to, as aggregates of classified records."""
    ok = F.col("reason").isNull()
    members = F.aggregate("doc.teams", F.lit(0), lambda n, t: n + F.coalesce(F.size(t["members"]), F.lit(0)))
    return {"records": F.count("*"), "accepted": F.count(F.when(ok, 1)),
            "entity_rows": F.coalesce(F.sum(F.when(ok, F.size(F.array_distinct("doc.characters.name")))), F.lit(0)),
            "lineup_rows": F.coalesce(F.sum(F.when(ok, members)), F.lit(0))}


def quality_counters(classified: DataFrame) -> DataFrame:
    """Accepted records and the detail rows they unfold to, in one pass."""
    return classified.agg(*[c.alias(n) for n, c in quality_aggregates().items()])


def valid_rows(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Keep rows with a non-empty key and a measure."""
    return df.filter(F.col(key).isNotNull() & (F.col(key) != "") & F.col(measure).isNotNull())


def keep_star(df: DataFrame, star: int = 5, missing: int = 3, col: str = "star") -> DataFrame:
    """Keep one star class; a missing star counts as `missing`."""
    return df.filter(F.coalesce(F.col(col), F.lit(missing)) == star)


def batch_quality(batches: DataFrame, keep: int = 100) -> DataFrame:
    """Clean rate per batch and cumulative clean rate, for the newest `keep` batches.

    `batches` has batch (ordered id), total, rejected. The running totals are taken backwards from
    the grand totals, so only the kept rows are ever ordered.
    """
    newest = batches.orderBy(F.col("batch").desc()).limit(keep)
    grand = batches.agg(F.struct(F.sum("total").alias("total"), F.sum("rejected").alias("rejected"))).scalar()
    later = Window.orderBy(F.col("batch").desc()).rowsBetween(Window.unboundedPreceding, -1)
    run = newest.select(
        "batch", "total", "rejected",
        (grand["total"] - F.coalesce(F.sum("total").over(later), F.lit(0))).alias("cum_total"),
        (grand["rejected"] - F.coalesce(F.sum("rejected").over(later), F.lit(0))).alias("cum_rejected"))
    return run.select(
        "batch", "total", "rejected",
        percent(F.col("total") - F.col("rejected"), F.col("total"), 2).alias("clean_rate"),
        percent(F.col("cum_total") - F.col("cum_rejected"), F.col("cum_total"), 2).alias("cum_rate"))
