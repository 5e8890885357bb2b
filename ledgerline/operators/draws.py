"""Draw records and banner tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import percent

ALL = "__ALL__"


def draw_counts(df: DataFrame, item: str = "item") -> DataFrame:
    """Rows per item."""
    return df.groupBy(item).agg(F.count("*").alias("n"))


def draw_stats(df: DataFrame, total_draws: int | Column = 5000, order: str = "id") -> DataFrame:
    """Top-star draws per item plus a summary row: five, up, type of the first row, overall rate.

    `df` holds the kept draws only. The summary is rolled up from the per-item rows. The overall
    rate comes from the same per-item aggregate, whole, so that its shuffle is shared.
    """
    per_item = df.groupBy("item").agg(
        F.count("*").alias("five"), F.count(F.when(F.col("is_up"), 1)).alias("up"),
        F.min_by(F.coalesce("type", F.lit("role")), order).alias("type"))
    total = total_draws if isinstance(total_draws, Column) else F.lit(total_draws)
    whole = per_item.agg(F.struct(F.sum("five").alias("five"), F.sum("up").alias("up"),
                                  F.max("type").alias("type"))).scalar()
    rolled = per_item.rollup("item").agg(
        F.grouping("item").alias("_all"), F.sum("five").alias("five"), F.sum("up").alias("up"),
        F.max("type").alias("type"))
    return rolled.select(
        F.when(F.col("_all") == 1, ALL).otherwise(F.col("item")).alias("item"),
        F.when(F.col("_all") == 1, "summary").otherwise(F.col("type")).alias("type"),
        "five", "up", percent(whole["five"], total, 2).alias("five_rate"),
        total.cast("bigint").alias("total"))


def explode_banner(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Banner lists to rows in one pass: each list column's content maps become rows of its kind."""
    tagged = [F.struct(F.lit(kind).alias("kind"), F.col(c).alias("list")) for c, kind in kinds.items()]
    return (df.select(F.explode(F.array(*tagged)).alias("k"))
            .select(F.col("k.kind").alias("kind"), F.explode("k.list").alias("b"))
            .select(F.col("b.version").alias("period"), "kind", F.col("b.start").alias("start_date"),
                    F.col("b.end").alias("end_date"), F.explode("b.content").alias("entity", "n")))


def banner_totals(banners: DataFrame, by: str, default: str | None = None) -> DataFrame:
    """Sum of draws per column value; a missing value falls under the default."""
    key = F.col(by) if default is None else F.coalesce(by, F.lit(default))
    return banners.groupBy(key.alias(by)).agg(F.sum("n").alias("total"))


def banner_kpis(banners: DataFrame) -> DataFrame:
    """One row: distinct periods, all draws, the top entity with its total, the top period."""
    sums = banners.groupBy("period", "entity").agg(F.sum("n").alias("n"))
    by_entity = sums.groupBy("entity").agg(F.sum("n").alias("t"))
    by_period = sums.groupBy("period").agg(F.sum("n").alias("t"))
    # Largest total, then the smallest name.
    top_entity = by_entity.orderBy(F.col("t").desc(), "entity").limit(1)
    top_period = by_period.orderBy(F.col("t").desc(), "period").limit(1)
    best = top_entity.agg(F.struct(F.max("entity").alias("entity"), F.max("t").alias("t"))).scalar()
    return by_period.agg(F.count("*").alias("periods"), F.sum("t").alias("total_draws")).select(
        "periods", "total_draws", best["entity"].alias("top_entity"), best["t"].alias("top_entity_draws"),
        top_period.agg(F.max("period")).scalar().alias("top_period"))


def dedupe_dim(df: DataFrame, key: str, attribute: str, order: str, need_attribute: bool = False) -> DataFrame:
    """First row per non-empty trimmed name, optionally only among rows with the attribute."""
    rows = df.withColumn(key, F.trim(key)).filter(F.coalesce(key, F.lit("")) != "")
    if need_attribute:
        rows = rows.filter(F.coalesce(attribute, F.lit("")) != "")
    first = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1).select(key, attribute)
