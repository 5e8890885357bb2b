"""Rankings, mixes, lookups and pages."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import bubble_size, exact_avg, percent, quadrant_label, round_half_up
from .timeline import latest_rows

# Largest per-group limit that Spark applies before the shuffle (its windowGroupLimitThreshold).
PRE_LIMIT = 1000
HASH_PARTS = 256

QUADRANTS = ("praised_popular", "praised", "popular", "low")


def top_n(df: DataFrame, n: int, order: list[tuple[str, str]], per: str | None = None,
          name: str | None = None) -> DataFrame:
    """First n rows by the order, overall or per group. Order items are (column, "asc"/"desc").

    Overall it is a distributed limit; per group the row limit also runs before the shuffle. Spark
    does so up to a number of rows; for more, a limit per hash part of each group goes first.
    """
    keys = [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in order]
    if per is None:
        head = df.orderBy(*keys).limit(n)
        return head if name is None else head.withColumn(name, F.row_number().over(Window.orderBy(*keys)))
    num = name or "_rn"
    if n > PRE_LIMIT:
        part = F.pmod(F.xxhash64(*[F.col(c) for c, _ in order]), F.lit(HASH_PARTS))
        within = Window.partitionBy(per, "_part").orderBy(*keys)
        df = (df.withColumn("_part", part).withColumn("_pre", F.row_number().over(within))
              .filter(F.col("_pre") <= n).drop("_part", "_pre"))
    out = (df.withColumn(num, F.row_number().over(Window.partitionBy(per).orderBy(*keys)))
           .filter(F.col(num) <= n))
    return out if name else out.drop(num)


def red_black(timeline: DataFrame, n: int = 10, overlap: bool = True) -> DataFrame:
    """Best and worst n of the latest period with their rank.

    Two limited sorts and a count: the ranks at the bottom follow from the number of rows. With
    `overlap=False` there is no black list when the period has fewer than n rows.
    """
    rows = latest_rows(timeline)
    total = rows.agg(F.count("*")).scalar()
    red = top_n(rows, n, [("use_rate", "desc"), ("entity", "asc")], name="rank_num")
    black = (top_n(rows, n, [("use_rate", "asc"), ("entity", "desc")], name="_from_end")
             .withColumn("rank_num", total - F.col("_from_end") + 1).drop("_from_end"))
    if not overlap:
        black = black.filter(total >= n)
    cols = ["rank_num", "entity", "star", "use_rate", "own_rate"]
    return (red.select(*cols, F.lit("red").alias("list_type"))
            .unionByName(black.select(*cols, F.lit("black").alias("list_type"))))


def top_ranked(timeline: DataFrame, n: int = 10) -> DataFrame:
    """Best n of the latest period."""
    return (top_n(latest_rows(timeline), n, [("use_rate", "desc"), ("entity", "asc")], name="rank_num")
            .select("rank_num", "entity", "star", "use_rate"))


def quadrants(usage: DataFrame, scores: DataFrame, use_cut: float = 30, score_cut: float = 8,
              names: tuple[str, str, str, str] = QUADRANTS) -> DataFrame:
    """Latest usage joined with scores, numeric gaps as 0, and the class of each entity."""
    joined = (latest_rows(usage).select("entity", "star", "use_rate")
              .join(scores.select("entity", "ability", "look", "score", "votes"), "entity")
              .na.fill(0.0, ["star", "use_rate", "ability", "look", "score", "votes"]))
    return joined.withColumn("quadrant", quadrant_label(
        F.col("use_rate"), F.col("score"), use_cut, score_cut, names))


def quadrant_leaders(classified: DataFrame, n: int = 10, names: tuple[str, str, str, str] = QUADRANTS) -> DataFrame:
    """Leaders of the two praised classes, each with its own sort key."""
    popular = top_n(classified.filter(F.col("quadrant") == names[0]), n, [("use_rate", "desc"), ("entity", "asc")])
    hidden = top_n(classified.filter(F.col("quadrant") == names[1]), n, [("score", "desc"), ("entity", "asc")])
    return popular.unionByName(hidden).select("quadrant", "entity", "star", "use_rate", "score")


def scatter(classified: DataFrame) -> DataFrame:
    """Chart rows: renamed measures, a bubble size and a typed empty picture column."""
    return classified.select(
        "entity", "star", F.lit(None).cast("string").alias("avatar"),
        F.col("ability").alias("ability_score"), "use_rate",
        F.col("score").alias("satisfaction"), F.col("votes").alias("vote_count"),
        bubble_size("votes").alias("bubble_size"))


def class_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), col)


def category_mix(df: DataFrame, group: list[str], cat: str, digits: int = 2, weight: Column | None = None) -> DataFrame:
    """Counts and shares (0..1) of each category in its group, long form with the rank by count.

    Windows run over the counted categories, not over the rows.
    """
    n = F.count("*") if weight is None else F.sum(weight)
    counts = df.filter(F.col(cat).isNotNull()).groupBy(*group, F.col(cat).alias("name")).agg(n.alias("n"))
    whole = Window.partitionBy(*group)
    ranked = whole.orderBy(F.col("n").desc(), "name")
    return (counts.withColumn("pos", F.row_number().over(ranked))
            .withColumn("ratio", round_half_up(F.try_divide(F.col("n").cast("double"), F.sum("n").over(whole)), digits)))


def mix_arrays(mix: DataFrame, group: list[str], name: str) -> DataFrame:
    """Nest a long mix: an array of (name, count, ratio) by falling count."""
    return mix.groupBy(*group).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "name", "n", "ratio"))),
        lambda e: F.struct(e["name"].alias("name"), e["n"].alias("count"), e["ratio"].alias("ratio"))).alias(name))


def top_category(mix: DataFrame, group: list[str], name: str) -> DataFrame:
    """The first category of each group with its share."""
    return mix.filter(F.col("pos") == 1).select(
        *group, F.col("name").alias(f"top_{name}"), F.col("ratio").alias(f"top_{name}_ratio"))


def bucket_shares(col: str, low: int, high: int, prefix: str = "c", digits: int = 1) -> list[Column]:
    """Aggregates for the share of each value low..high in percent, zero-filled."""
    return [percent(F.count(F.when(F.col(col) == v, 1)), F.count("*"), digits).alias(f"{prefix}{v}")
            for v in range(low, high + 1)]


def bucket_mix(df: DataFrame, group: list[str], col: str, low: int = 0, high: int = 6) -> DataFrame:
    """Value distribution over fixed buckets, one column each."""
    return df.groupBy(*group).agg(*bucket_shares(col, low, high))


def first_and_last(df: DataFrame, key: str, first: str, last: str, order: list[str]) -> DataFrame:
    """First non-empty value of one attribute and last value of another, in one aggregate."""
    value = F.when(F.coalesce(first, F.lit("")) != "", F.col(first))
    at = F.when(value.isNotNull(), F.struct(*order))
    return df.groupBy(key).agg(F.coalesce(F.min_by(value, at), F.lit("")).alias(first),
                               F.max_by(last, F.struct(*order)).alias(last))


def latest_snapshot_kpis(df: DataFrame) -> DataFrame:
    """Rows and averages of the newest snapshot only."""
    newest = df.agg(F.max("snapshot_time")).scalar()
    return df.filter(F.col("snapshot_time") == newest).agg(
        F.count("*").alias("n"),
        round_half_up(exact_avg("avg_constellation"), 1).alias("avg_constellation"),
        round_half_up(exact_avg("avg_damage"), 0).alias("avg_damage"),
        F.max("snapshot_time").alias("snapshot_time"))


def lookup(df: DataFrame, dim: DataFrame, key: str, col: str, default: str = "") -> DataFrame:
    """Attribute from a dimension, the default where it is absent."""
    return (df.join(dim.select(key, F.col(col).alias("_v")), key, "left")
            .withColumn(col, F.coalesce("_v", F.lit(default))).drop("_v"))


def search_page(df: DataFrame, keyword: str, field: str, sort: list[tuple[str, str]], page: int = 1,
                size: int = 30) -> DataFrame:
    """One page of the rows whose field contains the keyword, with the total number of matches."""
    hits = df.filter(F.lower(field).contains(keyword.lower())) if keyword else df
    keys = [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in sort]
    total = hits.agg(F.count("*")).scalar()
    return hits.orderBy(*keys).offset((page - 1) * size).limit(size).withColumn("total", total)


def stack(*frames: DataFrame, tags: list[str] | None = None, tag_col: str = "source") -> DataFrame:
    """Union by name, each input with its own tag."""
    parts = [f.withColumn(tag_col, F.lit(t)) for f, t in zip(frames, tags)] if tags else list(frames)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def distinct_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def key_union(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """All keys of both inputs with marks telling which side has them."""
    left = distinct_keys(a, keys).withColumn("in_a", F.lit(True))
    right = distinct_keys(b, keys).withColumn("in_b", F.lit(True))
    return left.join(right, keys, "full_outer").na.fill(False, ["in_a", "in_b"])
