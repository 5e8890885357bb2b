"""A table whose files have known key ranges, so that a merge rewrites only files that can hold a key.

A commit file lists the files with the least value of the range key in each; a key belongs to the file with the largest least value
that is not above it. Equal values of the range key are always in one file. Files are never changed: a merge writes new ones in
place of those whose rows differ and then puts a new commit file in the place of the old one, all at once for readers.
Retention by the range key names the files that stay and reads or writes none.
"""
from __future__ import annotations

import json
import math
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..operators.maintenance import enrich, insert_ignore, upsert
from .files import children, delete, read_text, swap_text

# A task writes many small files: the tasks, and what each of them reports to the driver, follow the rows and not the files.
ROWS_PER_TASK = 100_000
# Spark lists files by a task for each path, up to the number in this setting; a task sends some 3 KB to the driver besides the names it found.
LISTING, FILES_PER_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 500
_listing = threading.Lock()


@contextmanager
def few_listing_tasks(spark: SparkSession, files: int) -> Iterator[None]:
    """Inside, about `files` files are listed by a task for every few hundred of them, and no fewer tasks than cores."""
    with _listing:
        usual = spark.conf.get(LISTING)
        spark.conf.set(LISTING, str(min(int(usual), max(spark.sparkContext.defaultParallelism, files // FILES_PER_LISTING))))
        try:
            yield
        finally:
            spark.conf.set(LISTING, usual)


def _by_part(made: list[dict]) -> dict[int, list[dict]]:
    parts: dict[int, list[dict]] = {}
    for m in made:
        parts.setdefault(m["part"], []).append(m)
    return parts


class RangedTable:
    """Rows under `path`, cut by the column `key` into files of about `rows_per_file` rows. One writer, any number of readers."""

    def __init__(self, spark: SparkSession, path: str, key: str, rows_per_file: int = 1_000_000, keep_versions: int = 3):
        self.spark, self.path, self.key, self.rows_per_file = spark, path.rstrip("/"), key, rows_per_file
        self.keep_versions = keep_versions

    def current(self) -> dict:
        text = read_text(self.spark, f"{self.path}/CURRENT")
        return json.loads(text) if text else {"version": 0, "files": [], "schema": None, "floor": None, "left": []}

    def create(self, rows: DataFrame) -> None:
        """Write the table anew."""
        state = self.current()
        made = self._write(rows.withColumn("_part", F.lit(0)), state["version"] + 1, rows.count())
        before = state["files"]
        self._commit(state | {"schema": rows.schema.jsonValue(), "floor": None, "files": [],
                              "left": state["left"] + [[state["version"] + 1, f["name"]] for f in before]}, made, set())

    def read(self) -> DataFrame:
        state = self.current()
        rows = self._read(state["files"], state)
        return rows if state["floor"] is None else rows.filter(
            F.col(self.key).isNull() | (F.col(self.key) >= self._value(state["floor"], state)))

    def _schema(self, state: dict) -> T.StructType:
        return T.StructType.fromJson(state["schema"])

    def _value(self, text: str, state: dict) -> Column:
        return F.lit(text).cast(self._schema(state)[self.key].dataType)

    def _read(self, files: list[dict], state: dict) -> DataFrame:
        schema = self._schema(state)
        if not files:
            return self.spark.createDataFrame([], schema)
        with few_listing_tasks(self.spark, len(files)):
            return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f['name']}" for f in files])

    def _owner(self, state: dict) -> Column:
        """Number of the file that a key belongs to. Least values are looked at in two steps, so a row takes about two roots of their number."""
        lows = [f["low"] for f in state["files"]]
        kind = self._schema(state)[self.key].dataType.simpleString()
        step = max(1, math.isqrt(len(lows)))
        every = F.from_json(F.lit(json.dumps(lows[1:])), "array<string>").cast(f"array<{kind}>")
        heads = F.from_json(F.lit(json.dumps(lows[1::step])), "array<string>").cast(f"array<{kind}>")
        key = F.col(self.key)

        def up_to(values: Column) -> Column:
            return F.size(F.filter(values, lambda low: low <= key))

        block = F.greatest(up_to(heads) - 1, F.lit(0))
        return F.when(key.isNull(), 0).otherwise(block * step + up_to(F.slice(every, block * step + 1, F.lit(step)))).cast("int")

    def _write(self, rows: DataFrame, version: int, count: int) -> list[dict]:
        """Write rows (with `_part`, the file that they replace) and describe the new files."""
        folder, own = f"v{version}", [c for c in rows.columns if c != "_part"]
        n = max(1, -(-count // max(self.rows_per_file, ROWS_PER_TASK)))
        # A task holds a block of the key order and cuts it into files; rows with equal keys have one rank, so they stay together.
        place = F.rank().over(Window.partitionBy("_part", "_block").orderBy(self.key)) - 1
        cut = F.shiftleft(F.col("_block").cast("long"), 32) + F.floor(place / self.rows_per_file)
        (rows.repartitionByRange(n, "_part", self.key).withColumn("_block", F.spark_partition_id())
         .repartition(n, "_part", "_block").withColumn("_cut", cut).drop("_block").sortWithinPartitions("_part", "_cut", self.key)
         .write.mode("overwrite").partitionBy("_part", "_cut").parquet(f"{self.path}/{folder}"))
        schema = T.StructType([rows.schema[c] for c in own] + [T.StructField("_part", T.IntegerType()), T.StructField("_cut", T.LongType())])
        with few_listing_tasks(self.spark, count // self.rows_per_file):
            made = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        key = F.col(self.key)
        found = (made.groupBy(F.col("_metadata.file_path").alias("_name"), "_part")
                 .agg(F.min(key).alias("_least"), F.max(key).alias("_most"), F.count("*").alias("_rows"), F.count_if(key.isNull()).alias("_nulls"),
                      F.sum(F.xxhash64(*own).cast("decimal(38,0)")).alias("_sum"))
                 .orderBy("_part", F.col("_least").asc_nulls_first())
                 .select("_name", "_part", F.col("_least").cast("string"), F.col("_most").cast("string"), "_rows", "_nulls", F.col("_sum").cast("string")).collect())
        return [{"name": f"{folder}/{name.rsplit(f'/{folder}/', 1)[1]}", "low": low, "high": high, "rows": rows, "nulls": nulls, "sum": total, "part": part}
                for name, part, low, high, rows, nulls, total in found]

    def _commit(self, state: dict, made: list[dict], parts: set[int]) -> None:
        """Name `made` in place of the files with the numbers `parts`."""
        version, files, gone, instead = state["version"] + 1, [], [], _by_part(made)
        for i, f in enumerate(state["files"]):
            if i in parts:
                files += instead.get(i, [])
                gone.append(f["name"])
            else:
                files.append(f)
        old = [n for v, n in state["left"] if v < version - self.keep_versions]
        left = [[v, n] for v, n in state["left"] if v >= version - self.keep_versions] + [[version, n] for n in gone]
        swap_text(self.spark, f"{self.path}/CURRENT", json.dumps(
            state | {"version": version, "files": files if state["files"] else made, "left": left}))
        for name in old:
            delete(self.spark, f"{self.path}/{name}")

    def merge(self, new: DataFrame, fn: Callable[[DataFrame, DataFrame], DataFrame], inserts: bool = True) -> list[str]:
        """Put `fn(old rows, new rows)` in place of the old rows of the files that keys of `new` belong to; the names of the files replaced.

        `fn` must leave rows alone whose range key is not in `new`. A file whose rows come out as they were stays, so a rerun changes nothing.
        """
        state = self.current()
        owner = self._owner(state)
        touched = sorted(r[0] for r in new.select(owner.alias("f")).distinct().collect())
        if not touched:
            return []
        before = {i: state["files"][i] for i in touched if state["files"]}
        count = sum(f["rows"] for f in before.values()) + (new.count() if inserts else 0)
        merged = fn(self._read(list(before.values()), state), new).select(*self._schema(state).names)
        made = self._write(merged.withColumn("_part", owner), state["version"] + 1, count)
        instead = _by_part(made)
        same = {i for i, f in before.items()
                if (sum(m["rows"] for m in instead.get(i, [])), sum(int(m["sum"]) for m in instead.get(i, []))) == (f["rows"], int(f["sum"]))}
        for m in made:
            if m["part"] in same:
                delete(self.spark, f"{self.path}/{m['name']}")
        made = [m for m in made if m["part"] not in same]
        changed = set(before) - same
        if changed or made:
            self._commit(state, made, changed)
        return [before[i]["name"] for i in sorted(changed)]

    def upsert(self, new: DataFrame, keys: list[str], update_cols: list[str]) -> list[str]:
        """Insert new keys, change the listed columns of known ones. `keys` hold the range key."""
        return self.merge(new, lambda old, fresh: upsert(old, fresh, keys, update_cols))

    def insert_ignore(self, new: DataFrame, keys: list[str], order: list[str]) -> list[str]:
        """Insert the first row of each unknown key."""
        return self.merge(new, lambda old, fresh: insert_ignore(old, fresh, keys, order))

    def enrich(self, mapping: DataFrame, col: str) -> list[str]:
        """Set a column from a mapping by the range key where that is known."""
        return self.merge(mapping, lambda old, m: enrich(old, m, self.key, col), inserts=False)

    def drop_below(self, value: object) -> list[str]:
        """Forget rows whose range key is below `value`: files that lie below it go from the list, the one across it is filtered when read.

        No rows are read or written; rows without a range key stay. The names of the files dropped.
        """
        state = self.current()
        kind = self._schema(state)[self.key].dataType
        low = F.lit(value).cast(kind)
        highs = F.from_json(F.lit(json.dumps([f["high"] for f in state["files"]])), "array<string>").cast(f"array<{kind.simpleString()}>")
        row = self.spark.range(1).select(F.transform(highs, lambda h: F.coalesce(h < low, F.lit(False))).alias("below"),
                                         low.cast("string").alias("floor")).first()
        out = [f["name"] for f, below in zip(state["files"], row["below"]) if below and not f["nulls"]]
        version, dropped = state["version"] + 1, set(out)
        swap_text(self.spark, f"{self.path}/CURRENT", json.dumps(state | {
            "version": version, "files": [f for f in state["files"] if f["name"] not in dropped], "floor": row["floor"],
            "left": state["left"] + [[version, name] for name in out]}))
        return out
