"""Array expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def argmax_struct(items: Column, by: str, name: str) -> Column:
    """Name of the array element with the largest `by`.

    Starts at zero with a strict comparison: the first of equals wins, and an array that is empty
    or has no positive value gives an empty string.
    """
    start = F.struct(F.lit(0.0).alias("best"), F.lit("").alias("name"))

    def step(acc: Column, item: Column) -> Column:
        value = F.coalesce(item[by].cast("double"), F.lit(0.0))
        return F.when(value > acc["best"],
                      F.struct(value.alias("best"),
                               F.coalesce(item[name], F.lit("")).alias("name"))).otherwise(acc)

    return F.aggregate(F.coalesce(items, F.array().cast("array<struct<%s:string,%s:double>>" % (name, by))),
                       start, step, lambda acc: acc["name"])


def sorted_set(names: Column) -> Column:
    """Canonical form of a member list: distinct, in order."""
    return F.array_sort(F.array_distinct(names))


def distinct_names(names: Column) -> Column:
    """Distinct names without nulls and empty strings."""
    return F.array_distinct(F.filter(F.coalesce(names, F.array().cast("array<string>")),
                                     lambda n: n.isNotNull() & (n != "")))
