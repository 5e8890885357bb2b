"""Snapshots of all entities that a stream appends on a fixed cycle and forgets after a while."""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import delete, read_text, swap_text
from .panelog import PaneLog
from .runner import start
from .views import detail_cycle, detail_snapshot, merge_panes, pane_counts


class SnapshotCycle:
    """Details of the last `window` seconds of event time, first at once, then at every multiple of `every`, kept for `keep` seconds.

    Each snapshot is a folder of its own that a commit file names; those that are too old go from the file without being read. A
    snapshot sees the rows that have come by its time; rows that come later count for the next ones.
    """

    def __init__(self, spark: SparkSession, path: str, window: int, every: int = 7200, keep: int = 43200, pane: int = 900, files: int = 8):
        self.spark, self.path, self.window, self.every, self.keep, self.pane, self.files = spark, path.rstrip("/"), window, every, keep, pane, files
        self.panes = PaneLog(spark, f"{self.path}/panes", merge_panes, window)

    def current(self) -> dict:
        text = read_text(self.spark, f"{self.path}/CURRENT")
        return json.loads(text) if text else {"batch": -1, "last": None, "snapshots": [], "schema": None, "left": []}

    def read(self) -> DataFrame:
        """The snapshots that are kept, told apart by `snapshot_time`."""
        state = self.current()
        if state["schema"] is None:
            raise ValueError("no snapshot has been taken")
        schema = T.StructType.fromJson(state["schema"])
        if not state["snapshots"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for _, f in state["snapshots"]])

    def step(self, builds: DataFrame, batch: int) -> list[int]:
        """Take in a batch and the snapshots that are due after it; their times in seconds."""
        self.panes.add(pane_counts(builds, f"{self.pane} seconds"), batch)
        state, newest = self.current(), self.panes.current()["newest"]
        if batch <= state["batch"] or newest is None:
            return []
        end = newest // self.every * self.every
        if state["last"] is None:
            due = [newest + self.pane]
            rows = detail_snapshot(self.panes.read(due[0] - self.window, due[0]), F.timestamp_seconds(F.lit(due[0])), self.window)
        else:
            begin = max(state["last"] // self.every * self.every + self.every, end - self.keep)
            due = list(range(begin, end + 1, self.every))
            if due:
                seen = self.panes.read(begin - self.window, end)
                rows = detail_cycle(seen, F.timestamp_seconds(F.lit(end)), self.window, self.every, end - begin)
        made = []
        if due:
            folder = f"snapshots-{batch}"
            (rows.withColumn("_at", F.unix_seconds("snapshot_time")).repartition(self.files, "_at", F.pmod(F.xxhash64("entity"), F.lit(self.files)))
             .write.mode("overwrite").partitionBy("_at").parquet(f"{self.path}/{folder}"))
            state["schema"] = rows.schema.jsonValue()
            found = self.spark.read.schema(T.StructType(rows.schema.fields + [T.StructField("_at", T.LongType())])).parquet(f"{self.path}/{folder}")
            made = [[r[0], f"{folder}/_at={r[0]}"] for r in found.select("_at").distinct().orderBy("_at").collect()]
        every = state["snapshots"] + made
        old = [f for t, f in every if t < end - self.keep]
        swap_text(self.spark, f"{self.path}/CURRENT", json.dumps(
            {"batch": batch, "last": max([*due, state["last"] or 0]), "schema": state["schema"], "left": old,
             "snapshots": [s for s in every if s[1] not in old]}))
        self.panes.drop_before(end - self.window - self.keep)
        for f in state["left"]:                 # a batch later nobody reads them any more
            delete(self.spark, f"{self.path}/{f}")
        return due

    def start(self, builds: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
        return start(builds, self.step, checkpoint, "append", interval)
