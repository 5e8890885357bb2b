"""Frequent item sets with MLlib, association rules by joins over the item sets."""
from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import round_half_up


def itemsets(baskets_df: DataFrame, min_support: float = 0.01, size: int | None = None) -> DataFrame:
    """Frequent item sets with members in order: items, freq.

    Sets of one or two members, if only those are asked for, are counted as they are; for more the baskets are mined
    by FP-growth. The result is mined again by every action on it; write it once when it is used further. The
    same goes for the baskets, which the mining reads more than once. A basket holds an item once.
    """
    if size in (1, 2):
        return _counted(baskets_df.select("items").filter(F.col("items").isNotNull()), min_support, size)
    model = FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets_df.select("items"))
    sets = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    return sets if size is None else sets.filter(F.size("items") == size)


def _counted(baskets_df: DataFrame, min_support: float, size: int) -> DataFrame:
    """Frequent items or pairs of them by counting; pair counts combine before their shuffle.

    The frequent items are few: at the most the mean length of a basket over the support.
    """
    need = baskets_df.agg(F.ceil(F.lit(float(min_support)) * F.count("*"))).scalar()
    single = (baskets_df.select(F.explode("items").alias("x")).groupBy("x").agg(F.count("*").alias("freq"))
              .filter(F.col("freq") >= need))
    if size == 1:
        return single.select(F.array("x").alias("items"), "freq")
    frequent = single.agg(F.collect_list("x")).scalar()
    pairs = (baskets_df.select(F.sort_array(F.array_intersect("items", frequent)).alias("_s"))
             .select("_s", F.posexplode("_s").alias("_i", "x"))
             .select("x", F.explode(F.slice("_s", F.col("_i") + 2, F.size("_s"))).alias("y")))
    return (pairs.groupBy("x", "y").agg(F.count("*").alias("freq")).filter(F.col("freq") >= need)
            .select(F.array("x", "y").alias("items"), "freq"))


def rules(sets: DataFrame, n_baskets: Column, min_conf: float = 0.1, min_lift: float = 1.0) -> DataFrame:
    """Rules with one consequent: pair, n (baskets with both sides), support, confidence, lift.

    Strongest lift first. `sets` holds all frequent item sets, so every side of a rule is found in it by an equality join.
    """
    parts = sets.filter(F.size("items") >= 2).select(
        "items", "freq", F.explode("items").alias("cons")).withColumn(
        "ante", F.array_remove("items", F.col("cons")))
    counts = sets.select(F.col("items").alias("ante"), F.col("freq").alias("_ante_n"))
    singles = sets.filter(F.size("items") == 1).select(
        F.get("items", F.lit(0)).alias("cons"), F.col("freq").alias("_cons_n"))
    confidence = F.col("freq").cast("double") / F.col("_ante_n")
    rated = (parts.join(counts, "ante").join(singles, "cons")
             .withColumn("support", F.col("freq").cast("double") / n_baskets)
             .withColumn("confidence", confidence)
             .withColumn("lift", F.col("confidence") / (F.col("_cons_n").cast("double") / n_baskets)))
    return (rated.filter((F.col("confidence") >= min_conf) & (F.col("lift") > min_lift))
            .select(F.concat_ws("-", F.array_join("ante", "+"), "cons").alias("pair"),
                    F.col("freq").alias("n"),
                    round_half_up("support", 4).alias("support"),
                    round_half_up("confidence", 4).alias("confidence"),
                    round_half_up("lift", 2).alias("lift"))
            .orderBy(F.col("lift").desc(), "pair"))
