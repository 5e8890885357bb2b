"""Blending two sources and checking one against the other."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import exact_avg, exact_sum, percent, round_half_up


def weighted(base: Column, other: Column, w_base: float, w_other: float) -> Column:
    """Weighted mean; a side that is 0 gives way to the other."""
    mean = (base * F.lit(float(w_base)) + other * F.lit(float(w_other))) / F.lit(float(w_base + w_other))
    return F.when(base == 0, other).when(other == 0, base).otherwise(round_half_up(mean, 1))


def blend(base: DataFrame, other: DataFrame, key: str, cols: list[str], w_base: float = 79,
          w_other: float = 2) -> DataFrame:
    """Full outer merge of two rate tables; absent values count as 0, star from base, other, else 4."""
    b = base.select(key, F.col("star").alias("_bs"), *[F.col(c).alias(f"_b_{c}") for c in cols])
    o = other.select(key, F.col("star").alias("_os"), *[F.col(c).alias(f"_o_{c}") for c in cols])
    zero = F.lit(0.0)
    return b.join(o, key, "full_outer").select(
        key, F.coalesce(F.nullif("_bs", F.lit(0)), "_os", F.lit(4)).alias("star"),
        *[weighted(F.coalesce(f"_b_{c}", zero), F.coalesce(f"_o_{c}", zero), w_base, w_other).alias(c)
          for c in cols])


def missing_keys(fact: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the facts that the dimension lacks."""
    return fact.select(*keys).distinct().join(dim.select(*keys).distinct(), keys, "left_anti")


def reconcile(source: DataFrame, actual: DataFrame, key: str = "entity", tol: float = 3.0) -> DataFrame:
    """Absolute differences of both rates on the common keys and whether they are within tolerance."""
    a = source.select(key, F.col("use_rate").alias("src_use"), F.col("own_rate").alias("src_own"))
    b = actual.select(key, F.col("use_rate").alias("act_use"), F.col("own_rate").alias("act_own"))
    return (a.join(b, key)
            .withColumn("use_diff", F.abs(F.col("src_use") - F.col("act_use")))
            .withColumn("own_diff", F.abs(F.col("src_own") - F.col("act_own")))
            .withColumn("ok", (F.col("use_diff") <= tol) & (F.col("own_diff") <= tol)))


def failures(checked: DataFrame, key: str = "entity") -> DataFrame:
    """Rows out of tolerance, largest total difference first."""
    return checked.filter(~F.col("ok")).orderBy((F.col("use_diff") + F.col("own_diff")).desc(), key)


def verdict(checked: DataFrame, pass_at: float = 95, warn_at: float = 85) -> DataFrame:
    """One row: compared, passed, pass rate, mean deviation and the verdict."""
    out = checked.agg(
        F.count("*").alias("compared"), F.count(F.when(F.col("ok"), 1)).alias("passed"),
        exact_sum(F.col("use_diff") + F.col("own_diff")).alias("_dev"))
    rate = percent("passed", "compared")
    return out.select(
        "compared", "passed", round_half_up(rate, 1).alias("pass_rate"),
        F.when(F.col("compared") == 0, F.lit(0.0)).otherwise(
            round_half_up(F.try_divide(F.col("_dev"), F.col("compared") * 2), 2)).alias("mean_dev"),
        F.when(rate >= pass_at, "PASS").when(rate >= warn_at, "WARN").otherwise("FAIL").alias("verdict"))


def deviations(source: DataFrame, actual: DataFrame, key: str = "entity") -> DataFrame:
    """Signed difference of the owned rate for every source key, absent actuals as 0."""
    act = actual.select(key, F.col("own_rate").alias("_a"))
    return (source.select(key, "star", F.col("own_rate").alias("src")).join(act, key, "left")
            .withColumn("act", F.coalesce("_a", F.lit(0.0))).drop("_a")
            .withColumn("delta", F.col("act") - F.col("src")))


def mean_constellations(detail: DataFrame) -> DataFrame:
    """Owners and mean constellation per entity."""
    return detail.groupBy("entity").agg(F.count_distinct("uid").alias("owners"),
                                        round_half_up(exact_avg("constellation"), 2).alias("mean_constellation"))


def deviation_summary(devs: DataFrame) -> DataFrame:
    """Mean and largest absolute deviation."""
    return devs.agg(round_half_up(exact_avg(F.abs("delta")), 1).alias("mean_abs"),
                    round_half_up(F.max(F.abs("delta")), 1).alias("max_abs"))


def consistency(records: DataFrame) -> DataFrame:
    """Counts of broken invariants over parsed records (`doc` with characters and teams).

    Missing record, user id mismatch, members nobody owns, halves that share a member. All four
    are sums over one record each: one pass, one small aggregate.
    """
    doc = F.col("doc")
    teams = F.coalesce(doc["teams"], F.filter(doc["teams"], lambda _: F.lit(False)))
    absent = doc["record_uid"].isNull() & doc["teams"].isNull()
    box = doc["characters"]["name"]
    unowned = F.size(F.filter(F.flatten(teams["members"]), lambda m: ~F.array_contains(box, m["name"])))
    clash = F.arrays_overlap(F.get(teams, 0)["members"]["name"], F.get(teams, 1)["members"]["name"])

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(F.when(~absent, c.cast("bigint"))), F.lit(0).cast("bigint"))

    return records.agg(
        F.count(F.when(absent, 1)).alias("missing_record"),
        total(F.coalesce(~doc["box_uid"].eqNullSafe(doc["record_uid"]), F.lit(False)).cast("int")).alias("uid_mismatch"),
        total(F.coalesce(unowned, F.lit(0))).alias("unowned_members"),
        total(((F.size(teams) == 2) & F.coalesce(clash, F.lit(False))).cast("int")).alias("overlaps"))


def summarize(df: DataFrame, key: str = "entity", user: str = "uid", value: str = "constellation") -> DataFrame:
    """Rows, users and value range per key, plus one row (null key) for the whole input."""
    return df.rollup(key).agg(
        F.count("*").alias("n"), F.count_distinct(user).alias("users"),
        F.min(value).alias("low"), F.max(value).alias("high"),
        round_half_up(exact_avg(value), 2).alias("mean"))


def count_gaps(actual: DataFrame, expected: DataFrame, key: str = "entity") -> DataFrame:
    """Keys whose number of rows differs from the expected number: actual minus expected."""
    have = actual.groupBy(key).agg(F.count("*").alias("_have"))
    return (expected.select(key, F.col("expected").alias("_want")).join(have, key, "left")
            .withColumn("gap", F.coalesce("_have", F.lit(0)) - F.col("_want"))
            .filter(F.col("gap") != 0).select(key, "gap"))
