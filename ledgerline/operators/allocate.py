"""Quotas and deterministic weighted picks."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import hash_unit

CELLS = 4096


def allocate(df: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Largest-remainder split of `total` over the keys, weight = square root of the count.

    Equal remainders take turns by key hash. Remainders are ranked as distinct values, cell by
    cell; only the keys that share the remainder at the cut are ordered at all, and those inside
    hash cells. No step orders the keys as a whole, however many share a count.
    """
    weights = df.select(key, F.sqrt(F.col(count).cast("double")).alias("_w"))
    whole = weights.agg(F.sum(F.col("_w").cast("decimal(38,12)")).cast("double")).scalar()
    shares = (weights.withColumn("_share", F.col("_w") * F.lit(float(total)) / whole)
              .withColumn("_base", F.floor("_share"))
              .withColumn("_rest", F.col("_share") - F.col("_base")))
    extra = shares.agg(F.lit(total) - F.sum("_base")).scalar()
    ranked = shares.join(_count_above(shares), "_rest").withColumn("_extra", extra)
    safe = ranked.filter((F.col("_above") + F.col("_n") <= F.col("_extra")) | (F.col("_above") >= F.col("_extra")))
    cut = (ranked.filter((F.col("_above") < F.col("_extra")) & (F.col("_extra") < F.col("_above") + F.col("_n")))
           .withColumn("_h", hash_unit(F.col(key))).withColumn("_part", F.floor(F.col("_h") * CELLS)))
    sizes = cut.groupBy("_part").agg(F.count("*").alias("_m"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_shift"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_h", key)) + F.col("_shift")
    taken = cut.join(shift, "_part").withColumn("_more", F.col("_above") + place <= F.col("_extra"))
    return (safe.withColumn("_more", F.col("_above") < F.col("_extra")).select(key, "_base", "_more")
            .unionByName(taken.select(key, "_base", "_more"))
            .select(key, (F.col("_base") + F.col("_more").cast("int")).alias("quota")))


def _count_above(shares: DataFrame) -> DataFrame:
    """For each distinct remainder: how many keys have it and how many have a larger one."""
    values = shares.groupBy("_rest").agg(F.count("*").alias("_n")).withColumn(
        "_cell", F.floor(F.col("_rest") * CELLS))
    cells = values.groupBy("_cell").agg(F.sum("_n").alias("_t"))
    higher = Window.orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("_cell", F.coalesce(F.sum("_t").over(higher), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_cell").orderBy(F.col("_rest").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return values.join(offsets, "_cell").select(
        "_rest", "_n", (F.col("_offset") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_above"))


def weight_intervals(items: DataFrame, item: str, weight: str, parts: int = 256) -> DataFrame:
    """Cumulative weight intervals [low, high) in 0..1 in hash-part, item order.

    Running sums are built per part and shifted by the totals of earlier parts. Weights are summed
    as decimals, so the bounds do not depend on partitioning.
    """
    exact = items.select(F.col(item).alias("item"), F.col(weight).cast("decimal(24,4)").alias("_w"),
                         F.floor(hash_unit(F.col(item)) * parts).alias("_part"))
    totals = exact.groupBy("_part").agg(F.sum("_w").alias("_t"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select("_part", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_shift"))
    whole = exact.agg(F.sum("_w").cast("double")).scalar()
    inside = Window.partitionBy("_part").orderBy("item").rowsBetween(Window.unboundedPreceding, 0)
    run = exact.join(shift, "_part").withColumn("_high", F.sum("_w").over(inside) + F.col("_shift"))
    return run.select("item",
                      ((F.col("_high") - F.col("_w")).cast("double") / whole).alias("low"),
                      (F.col("_high").cast("double") / whole).alias("high")).filter(F.col("high") > F.col("low"))


def weighted_pick(keys: DataFrame, key: str, items: DataFrame, item: str, weight: str, seed: str = "",
                  cells: int = 1024) -> DataFrame:
    """Pick one item per key with probability by weight, the same on every run.

    The key hash falls into one interval. Both sides meet through an equality join on grid cells:
    an interval is listed under every cell it touches.
    """
    spans = weight_intervals(items, item, weight)
    top = F.least(F.lit(cells - 1), F.ceil(F.col("high") * cells) - 1)
    # The last interval ends at 1 and takes whatever lies above it.
    grid = spans.select("item", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") * cells), F.greatest(F.floor(F.col("low") * cells), top))).alias("_cell"))
    drawn = keys.select(key, hash_unit(F.col(key), seed).alias("_u")).withColumn(
        "_cell", F.floor(F.col("_u") * cells))
    return (drawn.join(grid, "_cell")
            .filter((F.col("_u") >= F.col("low")) & (F.col("_u") < F.col("high")))
            .select(key, "item"))
