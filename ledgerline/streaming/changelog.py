"""Published state as a log of changes: deltas per batch, compacted buckets, and one commit file that names what is current.

A batch writes its changed rows to new folders and then puts a new commit file in the place of the old one. Whatever is not
named there does not exist for a reader: half written folders, those of failed batches and old versions are neither read nor
listed. A table is a set of folders: for each bucket of its keys one with the compacted rows, and the deltas since. After
`compact_after` deltas the buckets that these touch are written anew, the others stay as they are.
"""
from __future__ import annotations

import json
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.files import children, delete, read_text, swap_text


class Table(NamedTuple):
    """`keys` name a row. Of rows with equal keys the one with the largest `newest` columns counts, of equal ones that of the last
    batch. Without keys a table has only the rows of the last batch that wrote it."""
    keys: tuple[str, ...] = ()
    newest: tuple[str, ...] = ()


class ChangeLog:
    """Tables under `path`, written by one stream and read by anyone. `buckets` is fixed when a table is first compacted."""

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, Table], buckets: int = 16, compact_after: int = 8,
                 keep_versions: int = 5, files: int = 8):
        self.spark, self.path, self.tables = spark, path.rstrip("/"), tables
        self.buckets, self.compact_after, self.keep_versions, self.files = buckets, compact_after, keep_versions, files

    # The commit file: version, batch, notes, folders of each table, and folders that are no longer named, with the version that left them.
    def current(self) -> dict:
        text = read_text(self.spark, f"{self.path}/CURRENT")
        return json.loads(text) if text else {"version": 0, "batch": -1, "notes": {}, "tables": {}, "left": []}

    @property
    def batch(self) -> int:
        """The last batch that was committed, -1 before the first."""
        return self.current()["batch"]

    def read(self, name: str, since: int | None = None) -> DataFrame:
        """The current rows of a table; with `since`, only what batches after that number have written."""
        return self._rows(name, self.current(), since)

    def _rows(self, name: str, state: dict, since: int | None = None, plus: Iterable[str] = ()) -> DataFrame:
        table = self.tables[name]
        own = state["tables"].get(name)
        if own is None:
            raise ValueError(f"no batch has written {name}")
        schema = T.StructType.fromJson(own["schema"])
        folders = [f for b, f in own["deltas"] if since is None or b > since] + list(plus)
        base = sorted(own["base"].values()) if since is None else []
        if not base + folders:
            return self.spark.createDataFrame([], schema).drop("_batch")
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in base + folders])
        if table.keys and len(folders) + bool(base) > 1:
            rows = self._newest(rows, table)
        return rows.drop("_batch")

    @staticmethod
    def _newest(rows: DataFrame, table: Table) -> DataFrame:
        values = [c for c in rows.columns if c not in table.keys]
        order = F.struct(*table.newest, "_batch")
        return (rows.groupBy(*table.keys).agg(F.max_by(F.struct(*values), order).alias("_row"))
                .select(*table.keys, "_row.*").select(*rows.columns))

    def write(self, name: str, rows: DataFrame, batch: int) -> DataFrame:
        """Write what a batch changes in a table to its folder, and read it back; it is not current before `commit`."""
        folder = f"{self.path}/{name}/delta-{batch}"
        made = rows.withColumn("_batch", F.lit(batch).cast("long"))
        made.coalesce(self.files).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(made.schema).parquet(folder)

    def commit(self, batch: int, written: dict[str, DataFrame], notes: dict | None = None) -> bool:
        """Make the rows that `write` returned current, all at once; False if the batch is there already."""
        state = self.current()
        if batch <= state["batch"]:
            return False
        version, left = state["version"] + 1, []
        for name, rows in written.items():
            own = state["tables"].setdefault(name, {"deltas": [], "base": {}, "buckets": self.buckets})
            own["schema"] = rows.schema.jsonValue()
            if not self.tables[name].keys:
                left += [f for _, f in own["deltas"]]
                own["deltas"] = []
            elif len(own["deltas"]) >= self.compact_after:
                left += self._compact(name, state, version)
            own["deltas"].append([batch, f"{name}/delta-{batch}"])
        gone = [f for v, f in state["left"] if v < version - self.keep_versions]
        named = [[v, f] for v, f in state["left"] if v >= version - self.keep_versions] + [[version, f] for f in left]
        self._swap({"version": version, "batch": batch, "notes": notes if notes is not None else state["notes"],
                    "tables": state["tables"], "left": named})
        for folder in gone:
            delete(self.spark, f"{self.path}/{folder}")
        return True

    def _swap(self, state: dict) -> None:
        swap_text(self.spark, f"{self.path}/CURRENT", json.dumps(state))

    def append(self, batch: int, changes: dict[str, DataFrame], notes: dict | None = None) -> bool:
        """Write and commit the changes of a batch; a batch that was committed before does nothing."""
        if batch <= self.batch:
            return False
        return self.commit(batch, {name: self.write(name, rows, batch) for name, rows in changes.items()}, notes)

    def _compact(self, name: str, state: dict, version: int) -> list[str]:
        """Merge the deltas into the buckets that they touch; the folders that are no longer needed."""
        own, table = state["tables"][name], self.tables[name]
        schema = T.StructType.fromJson(own["schema"])
        bucket = F.pmod(F.xxhash64(*table.keys), F.lit(own["buckets"])).cast("int")
        deltas = [f for _, f in own["deltas"]]
        changed = self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in deltas])
        touched = sorted(str(r[0]) for r in changed.select(bucket).distinct().collect())
        old = sorted({own["base"][b] for b in touched if b in own["base"]})
        rows = changed
        if old:
            rows = rows.unionByName(self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in old]))
        folder = f"{name}/base-{version}"
        (self._newest(rows, table).withColumn("bucket", bucket).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}"))
        own["base"].update({b: f"{folder}/bucket={b}" for b in touched})
        own["deltas"] = []
        return deltas + old

    def bytes_of(self, name: str, batch: int) -> int:
        """Bytes that a batch wrote to a table."""
        return sum(n for _, n in children(self.spark, f"{self.path}/{name}/delta-{batch}"))
