"""Aggregations that accept a streaming or a batch frame."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import percent, round_half_up
from ..functions.lenient import CORRUPT, is_object, parse_checked
from ..operators.dashboards import category_mix, top_category, top_n

UNKNOWN = "?"


def open_stream(spark: SparkSession, format: str = "kafka", schema: str | T.StructType | None = None,
                path: str | None = None, **options) -> DataFrame:
    """Topic source from the latest offsets, or a folder source with a schema."""
    if format == "kafka":
        options.setdefault("startingOffsets", "latest")
    reader = spark.readStream.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def parse_messages(df: DataFrame, schema: str | T.StructType, col: str = "value") -> DataFrame:
    """JSON messages to columns; what is no object, or has values of other types, is dropped."""
    rest = [c for c in df.columns if c != col]
    text = F.col(col).cast("string")
    return (df.select(*rest, F.when(is_object(text), parse_checked(text, schema)).alias("_m"))
            .filter(F.col("_m").isNotNull() & F.col(f"_m.{CORRUPT}").isNull())
            .select(*rest, "_m.*").drop(CORRUPT))


# Fixed alternatives of the loosely typed build messages.
def message_weapon(doc: Column) -> Column:
    """Weapon name from an object or a plain string; unknown otherwise."""
    return F.coalesce(F.try_variant_get(doc, "$.weapon.name", "string"),
                      F.when(F.schema_of_variant(F.try_variant_get(doc, "$.weapon", "variant")) == "STRING",
                             F.try_variant_get(doc, "$.weapon", "string")), F.lit(UNKNOWN))


def message_artifact(doc: Column) -> Column:
    """Artifact from either field, object with name or set_name, or a plain string."""
    parts = []
    for path in ("$.artifact_set", "$.artifact"):
        v = F.try_variant_get(doc, path, "variant")
        parts += [F.try_variant_get(v, "$.name", "string"), F.try_variant_get(v, "$.set_name", "string"),
                  F.when(F.schema_of_variant(v) == "STRING", F.nullif(F.try_variant_get(v, "$", "string"), F.lit("")))]
    return F.coalesce(*parts, F.lit(UNKNOWN))


def message_damage(doc: Column) -> Column:
    return F.coalesce(F.try_variant_get(doc, "$.avg_damage", "bigint"),
                      F.try_variant_get(doc, "$.damage", "bigint"), F.lit(0).cast("bigint"))


def with_watermark(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time with bounded state; later rows are dropped and counted by the query progress."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


PANE_KEYS = ["pane", "entity", "constellation", "weapon", "artifact"]
DRAW_KEYS = ["window_start", "item"]


def pane_counts(builds: DataFrame, pane: str = "3 seconds") -> DataFrame:
    """Counts per pane (the slide of the sliding window) at the finest category level.

    Every event updates one pane only; windows are put together from panes afterwards, so the
    state does not grow with the ratio of window to slide.
    """
    return (builds.groupBy(F.window("ts", pane).alias("_p"), "entity", "constellation", "weapon", "artifact")
            .agg(F.count("*").alias("n"), F.sum("damage").alias("damage"),
                 F.max(F.struct("ts", "id", "star", "ename")).alias("last"))
            .select(F.col("_p.start").alias("pane"), "entity", "constellation", "weapon", "artifact",
                    "n", "damage", "last"))


def merge_panes(parts: DataFrame) -> DataFrame:
    """Pane counts from the pane counts of several batches."""
    return parts.groupBy(*PANE_KEYS).agg(F.sum("n").alias("n"), F.sum("damage").alias("damage"),
                                         F.max("last").alias("last"))


def windows_of(panes: DataFrame, window_seconds: int, slide_seconds: int) -> DataFrame:
    """List each pane under every sliding window that covers it."""
    steps = window_seconds // slide_seconds
    starts = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)),
                         lambda k: F.timestamp_seconds(F.unix_seconds("pane") - k * slide_seconds))
    return panes.withColumn("window_start", F.explode(starts))


def hot_entities(panes: DataFrame, window_seconds: int = 60, slide_seconds: int = 3) -> DataFrame:
    """Per sliding window and entity: count, last star and name, means and the c0..c6 shares."""
    rows = windows_of(panes, window_seconds, slide_seconds)
    n = F.sum("n")
    shares = [percent(F.sum(F.when(F.col("constellation") == c, F.col("n")).otherwise(0)), n, 1).alias(f"c{c}")
              for c in range(7)]
    return (rows.groupBy("window_start", "entity").agg(
        n.alias("n"), F.max("last").alias("_last"),
        round_half_up(F.sum(F.col("constellation") * F.col("n")).cast("double") / n, 1).alias("avg_constellation"),
        F.floor(F.sum("damage") / n).cast("bigint").alias("avg_damage"), *shares)
        .withColumn("star", F.col("_last.star"))
        .withColumn("ename", F.coalesce("_last.ename", F.lit(""))).drop("_last"))


def hot_mix(panes: DataFrame, cat: str, window_seconds: int = 60, slide_seconds: int = 3) -> DataFrame:
    """Category mix per sliding window and entity, long form."""
    rows = windows_of(panes, window_seconds, slide_seconds).filter(F.col(cat) != UNKNOWN)
    return category_mix(rows, ["window_start", "entity"], cat, weight=F.col("n"))


def publish_top(hot: DataFrame, n: int = 4) -> DataFrame:
    """The n most frequent entities of every window."""
    return top_n(hot, n, [("n", "desc"), ("entity", "asc")], per="window_start", name="pos")


def _details(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, means and top categories per key; no known category is written as `?` with share 0."""
    n = F.sum("n")
    base = rows.groupBy(*keys).agg(
        n.alias("n"), F.max("last")["star"].alias("star"),
        round_half_up(F.sum(F.col("constellation") * F.col("n")).cast("double") / n, 1).alias("avg_constellation"),
        F.floor(F.sum("damage") / n).cast("bigint").alias("avg_damage"))
    for cat in ("weapon", "artifact"):
        mix = category_mix(rows.filter(F.col(cat) != UNKNOWN), keys, cat, weight=F.col("n"))
        base = (base.join(top_category(mix, keys, cat), keys, "left")
                .fillna({f"top_{cat}": UNKNOWN, f"top_{cat}_ratio": 0.0}))
    return base


def detail_snapshot(panes: DataFrame, as_of: Column, window_seconds: int = 60) -> DataFrame:
    """All entities of the window that ends at `as_of`, with their top categories and shares."""
    recent = panes.filter((F.col("pane") >= as_of - F.make_dt_interval(secs=F.lit(window_seconds)))
                          & (F.col("pane") < as_of))
    return _details(recent, ["entity"]).withColumn("snapshot_time", as_of)


def detail_cycle(panes: DataFrame, last: Column, window_seconds: int, every_seconds: int = 7200,
                 keep_seconds: int = 43200) -> DataFrame:
    """The kept snapshots at `last`: one every `every_seconds`, dropped once older than `keep_seconds`.

    A snapshot is the sliding window that ends at its time, so all of them come from one aggregate and
    a rerun gives the same table. Panes must divide `every_seconds`, which must divide the window.
    """
    reach = F.make_dt_interval(secs=F.lit(keep_seconds + window_seconds))
    slot = F.timestamp_seconds(F.floor(F.unix_seconds("pane") / every_seconds) * every_seconds)
    slots = panes.filter((F.col("pane") >= last - reach) & (F.col("pane") < last)).withColumn("pane", slot)
    rows = windows_of(slots, window_seconds, every_seconds)
    rows = (rows.withColumn("snapshot_time", F.timestamp_seconds(F.unix_seconds("window_start") + window_seconds))
            .filter((F.col("snapshot_time") <= last)
                    & (F.col("snapshot_time") >= last - F.make_dt_interval(secs=F.lit(keep_seconds)))))
    return _details(rows, ["snapshot_time", "entity"])


def recent_entries(builds: DataFrame) -> DataFrame:
    """The newest message of each entity."""
    entry = F.struct("ts", "id", "star", "constellation", "level", "damage",
                     F.coalesce("weapon", F.lit(UNKNOWN)).alias("weapon"),
                     F.coalesce("artifact", F.lit(UNKNOWN)).alias("artifact"))
    return builds.groupBy("entity").agg(F.max(entry).alias("e")).select("entity", "e.*")


def recent_list(entries: DataFrame, keep: int = 200) -> DataFrame:
    """Newest first, one entry per entity."""
    return top_n(entries, keep, [("ts", "desc"), ("id", "desc")], name="pos")


def running_total(df: DataFrame) -> DataFrame:
    return df.groupBy().agg(F.count("*").alias("n"))


def running_counts(df: DataFrame, key: str) -> DataFrame:
    """Count per key since the start, never expiring."""
    return df.groupBy(key).agg(F.count("*").alias("n"))


def draw_panes(draws: DataFrame, window: str = "1 second") -> DataFrame:
    """Counts per window and item, with top-star draws: star 5, or a type of the newer message shape."""
    five = F.coalesce(F.col("star") == 5, F.lit(False)) | F.coalesce(F.col("type").isin("role", "weapon"), F.lit(False))
    return (draws.groupBy(F.window("ts", window).alias("_w"), F.coalesce("item", F.lit(UNKNOWN)).alias("item"))
            .agg(F.count("*").alias("n"), F.count(F.when(five, 1)).alias("five"))
            .select(F.col("_w.start").alias("window_start"), "item", "n", "five"))


def merge_draw_panes(parts: DataFrame) -> DataFrame:
    """Draw panes from the draw panes of several batches."""
    return parts.groupBy(*DRAW_KEYS).agg(F.sum("n").alias("n"), F.sum("five").alias("five"))


def draw_windows(panes: DataFrame, top: int = 50) -> DataFrame:
    """Per window: draws, top-star rate, the top item and the `top` items as (name, count)."""
    totals = panes.groupBy("window_start").agg(
        F.sum("n").alias("draws"), percent(F.sum("five"), F.sum("n"), 1).alias("five_rate"))
    heads = top_n(panes, top, [("n", "desc"), ("item", "asc")], per="window_start", name="pos")
    items = heads.groupBy("window_start").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "item", "n"))),
                    lambda e: F.struct(e["item"].alias("name"), e["n"].alias("count"))).alias("items"))
    return (totals.join(items, "window_start")
            .select("window_start", "draws", "five_rate",
                    F.get("items", F.lit(0))["name"].alias("top_item"), "items"))


def latest_scores(scores: DataFrame) -> DataFrame:
    """The last score of each entity; star 5 and the score itself stand in for absent fields."""
    last = F.max(F.struct("ts", "id", "score", F.coalesce("star", F.lit(5)).alias("star"),
                          F.coalesce("ability", "score").alias("ability"),
                          F.coalesce("look", "score").alias("look")))
    return scores.groupBy("entity").agg(last.alias("s")).select(
        "entity", "s.*")


def ranking(latest: DataFrame, shown: DataFrame | None = None, n: int = 6) -> tuple[DataFrame, DataFrame]:
    """Top n by score with the delta against the score shown when the entity was last in the top.

    Returns the ranking and the new `shown` table (entity, shown_score): entities that leave the
    top keep the score they left with.
    """
    top = top_n(latest, n, [("score", "desc"), ("entity", "asc")], name="pos")
    if shown is None:
        ranked = top.withColumn("delta", F.lit(0.0))
        return ranked, top.select("entity", F.col("score").alias("shown_score"))
    ranked = (top.join(shown, "entity", "left")
              .withColumn("delta", F.coalesce(round_half_up(F.col("score") - F.col("shown_score"), 1), F.lit(0.0)))
              .drop("shown_score"))
    kept = (shown.join(top.select("entity", "score"), "entity", "full_outer")
            .select("entity", F.coalesce("score", "shown_score").alias("shown_score")))
    return ranked, kept


def snapshot_rows(hot: DataFrame, weapons: DataFrame, artifacts: DataFrame, as_of: Column, n: int = 4,
                  names: int = 3) -> DataFrame:
    """The n most frequent entities of one window as snapshot rows with their first few names.

    `hot` has one row per entity; the mixes are long form with `pos`.
    """
    top = top_n(hot, n, [("n", "desc"), ("entity", "asc")], name="pos")

    def first_names(mix: DataFrame, name: str) -> DataFrame:
        head = mix.filter(F.col("pos") <= names)
        return head.groupBy("entity").agg(
            F.to_json(F.sort_array(F.collect_list(F.struct("pos", "name")))["name"]).alias(name))

    dist = F.to_json(F.create_map(*[x for c in range(7) for x in (F.lit(f"c{c}"), F.col(f"c{c}"))]))
    return (top.join(first_names(weapons, "weapons"), "entity", "left")
            .join(first_names(artifacts, "artifacts"), "entity", "left")
            .select("entity", as_of.alias("snapshot_time"), "avg_constellation", "avg_damage",
                    dist.alias("const_dist"),
                    F.coalesce("weapons", F.lit("[]")).alias("weapons"),
                    F.coalesce("artifacts", F.lit("[]")).alias("artifacts")))


def draw_snapshot(totals: DataFrame, top_items: Column, as_of: Column, limit: int = 10) -> DataFrame:
    """The all-draws row and the listed top items; the list is JSON or one plain name."""
    listed = F.coalesce(F.from_json(top_items, "array<string>"), F.array(top_items))
    return (totals.select(F.posexplode(F.concat(
        F.array(F.lit("__ALL__")), F.slice(listed, 1, limit))).alias("pos", "entity"), F.col("draws"))
        .select("pos", "entity", F.when(F.col("pos") == 0, F.col("draws")).otherwise(0).cast("bigint").alias("draws"),
                as_of.alias("snapshot_time")))
