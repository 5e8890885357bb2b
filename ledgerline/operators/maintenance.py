"""Table maintenance as functions old x new -> merged; sinks write the result."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def replace_partition(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of `new` take the place of all old rows with the same key value."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """Insert new keys; for known keys only the listed columns change.

    `new` holds one row per key. Columns keep the order of `old`.
    """
    fresh = new.select(*keys, F.lit(True).alias("_new"),
                       *[F.col(c).alias(f"_n_{c}") for c in new.columns if c not in keys])
    both = old.withColumn("_old", F.lit(True)).join(fresh, keys, "full_outer")
    known, incoming = F.coalesce("_old", F.lit(False)), F.coalesce("_new", F.lit(False))
    cols = []
    for c in old.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c not in new.columns:
            cols.append(F.col(c))
        elif c in update_cols:
            cols.append(F.when(incoming, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.when(known, F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c))
    return both.select(*cols)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep what is there; of the new rows only the first per unknown key comes in."""
    first = Window.partitionBy(*keys).orderBy(*order)
    fresh = (new.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1).drop("_rn")
             .join(old.select(*keys).distinct(), keys, "left_anti"))
    return old.unionByName(fresh.select(*old.columns))


def enrich(df: DataFrame, mapping: DataFrame, key: str, col: str, insert: bool = False) -> DataFrame:
    """Set a column from a mapping where the key is known; optionally add the unknown keys."""
    m = mapping.select(key, F.col(col).alias("_v"))
    out = (df.join(m, key, "full_outer" if insert else "left")
           .withColumn(col, F.coalesce("_v", col)).drop("_v"))
    return out.select(*df.columns)


def retain(df: DataFrame, ts_col: str, as_of, interval: str) -> DataFrame:
    """Drop rows older than the interval before `as_of` (a column or a timestamp text)."""
    at = as_of if not isinstance(as_of, str) else F.lit(as_of).cast("timestamp_ntz")
    return df.filter(F.col(ts_col) >= at - F.expr(f"INTERVAL {interval}"))
