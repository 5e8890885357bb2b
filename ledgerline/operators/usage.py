"""Usage and ownership rates."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import exact_avg, percent, round_half_up


def distinct_users(detail: DataFrame) -> DataFrame:
    """Distinct users per period, at least 1."""
    return (detail.groupBy("period").agg(F.count_distinct("uid").alias("users"))
            .withColumn("users", F.greatest("users", F.lit(1).cast("bigint"))))


def usage_rates(detail: DataFrame) -> DataFrame:
    """Per period and entity: counts, rates over the distinct users, mean constellation and level.

    The joined denominator has one row per period; Spark broadcasts it when it is small.
    """
    per_entity = detail.groupBy("period", "entity").agg(
        F.max("star").alias("star"),
        F.count("*").alias("own_count"),
        F.count(F.when(F.col("used") == 1, 1)).alias("use_count"),
        round_half_up(exact_avg("constellation"), 2).alias("avg_constellation"),
        round_half_up(exact_avg("level"), 2).alias("avg_level"))
    return (per_entity.join(distinct_users(detail), "period")
            .select("period", "entity", "star", "own_count", "use_count", "users",
                    percent("own_count", "users", 2).alias("own_rate"),
                    percent("use_count", "users", 2).alias("use_rate"),
                    "avg_constellation", "avg_level"))


def entity_usage_once(inventory: DataFrame, lineups: DataFrame) -> DataFrame:
    """Owned and used once per user, with copies; the union of both sets of entities.

    Inventory: uid, entity, star, copies (null counts as 1). Lineups: uid, entity, star.
    """
    owned = inventory.groupBy("entity").agg(
        F.max("star").alias("own_star"), F.count_distinct("uid").alias("own_count"),
        F.sum(F.coalesce("copies", F.lit(1))).alias("copies"))
    used = lineups.groupBy("entity").agg(
        F.max("star").alias("use_star"), F.count_distinct("uid").alias("use_count"))
    users = lineups.agg(F.count_distinct("uid")).scalar()
    zero = F.lit(0).cast("bigint")
    return (owned.join(used, "entity", "full_outer")
            .select("entity",
                    F.coalesce("own_star", "use_star", F.lit(4)).alias("star"),
                    F.coalesce("own_count", zero).alias("own_count"),
                    F.coalesce("copies", zero).alias("copies"),
                    F.coalesce("use_count", zero).alias("use_count"))
            .withColumn("own_rate", percent("own_count", users, 1))
            .withColumn("use_rate", percent("use_count", users, 1)))


def share_by(df: DataFrame, col: str) -> DataFrame:
    """Rows per value with the share of the total in percent."""
    counted = df.groupBy(col).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("share", percent("n", total, 2))


def with_means(df: DataFrame, cols: list[str]) -> DataFrame:
    """Add the overall mean of each column next to every row."""
    means = df.agg(F.struct(*[round_half_up(exact_avg(c), 2).alias(c) for c in cols])).scalar()
    return df.withColumns({f"mean_{c}": means[c] for c in cols})
