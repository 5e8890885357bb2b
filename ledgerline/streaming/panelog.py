"""Pane counts of a stream in parts whose number does not grow with the batches.

Panes behind the low-water mark (the newest event time less an allowed delay) are closed: their parts are merged once into a
segment with a known range of panes. Parts of open panes are merged at the same time, so there is at most one of them and those of
the batches since. A row that comes behind the mark goes to a correction part, with its range; readers add corrections to
the segments. So no row is lost, late ones are counted, and a reader of some windows reads the segments, corrections and parts that overlap
them. Retention drops whole segments from the commit file.
"""
from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import delete, read_text, swap_text

KINDS = ("open", "closed", "late")


class PaneLog:
    """Parts under `path`, written by one stream. `merge` makes one row of all parts of a pane, `pane` is its start and `n` its rows."""

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], delay: int, pane: str = "pane",
                 parts: int = 8, keep_versions: int = 5, files: int = 8):
        self.spark, self.path, self.merge, self.delay, self.pane = spark, path.rstrip("/"), merge, delay, pane
        self.parts, self.keep_versions, self.files = parts, keep_versions, files

    def current(self) -> dict:
        text = read_text(self.spark, f"{self.path}/CURRENT")
        return json.loads(text) if text else {"version": 0, "batch": -1, "mark": None, "newest": None, "late_rows": 0,
                                              "parts": [], "schema": None, "left": []}

    def _seconds(self) -> Column:
        """Seconds of the start of a pane; a start without a zone is one of the session's zone."""
        return F.unix_seconds(F.col(self.pane).cast("timestamp"))

    def add(self, rows: DataFrame, batch: int) -> bool:
        """Add the pane counts of a batch; False if the batch is there already."""
        state = self.current()
        if batch <= state["batch"]:
            return False
        version, mark = state["version"] + 1, state["mark"]
        at = self._seconds()
        late = F.lit(False) if mark is None else at < mark
        folder = f"batch-{batch}"
        state["schema"] = T.StructType(rows.schema.fields + [T.StructField("_at", T.LongType())]).jsonValue()
        for kind, low, high, n, name in self._file(rows.withColumn("_at", at), late, ("late", "open"), folder):
            state["parts"].append({"kind": kind, "low": low, "high": high, "folder": name})
            state["late_rows"] += n if kind == "late" else 0
            state["newest"] = max(high, state["newest"] if state["newest"] is not None else high)
        left = self._settle(state, version)
        gone = [f for v, f in state["left"] if v < version - self.keep_versions]
        state["left"] = [[v, f] for v, f in state["left"] if v >= version - self.keep_versions] + [[version, f] for f in left]
        self._swap(state | {"version": version, "batch": batch})
        for old in gone:
            delete(self.spark, f"{self.path}/{old}")
        return True

    def _file(self, rows: DataFrame, which: Column, kinds: tuple[str, str], folder: str) -> list[tuple[str, int, int, int, str]]:
        """Write rows apart by a condition; kind, first and last second, number of counted rows and folder of each part that has any.

        The figures are gathered by the write itself.
        """
        seen, flag = Observation(), F.coalesce(which, F.lit(False))
        own = {k: flag if k == kinds[0] else ~flag for k in kinds}
        watched = rows.observe(seen, *[f(F.when(c, F.col(v))).alias(f"{k}_{n}") for k, c in own.items()
                                       for n, f, v in (("low", F.min, "_at"), ("high", F.max, "_at"), ("n", F.sum, "n"))])
        (watched.withColumn("_part", F.when(flag, kinds[0]).otherwise(kinds[1])).coalesce(self.files)
         .write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/{folder}"))
        got = seen.get
        return [(k, got[f"{k}_low"], got[f"{k}_high"], got[f"{k}_n"], f"{folder}/_part={k}") for k in kinds if got[f"{k}_low"] is not None]

    def _swap(self, state: dict) -> None:
        swap_text(self.spark, f"{self.path}/CURRENT", json.dumps(state))

    def _settle(self, state: dict, version: int) -> list[str]:
        """Close what lies behind the new mark once enough parts have gathered; the folders that are no longer needed."""
        left: list[str] = []
        of = {k: [p for p in state["parts"] if p["kind"] == k] for k in KINDS}
        if len(of["open"]) >= self.parts and state["newest"] is not None:
            mark = max(state["newest"] - self.delay, state["mark"] if state["mark"] is not None else state["newest"] - self.delay)
            rows = self.merge(self._read(of["open"], state)).withColumn("_at", self._seconds())
            merged = [{"kind": kind, "low": low, "high": high, "folder": name}
                      for kind, low, high, _, name in self._file(rows, F.col("_at") < mark, ("closed", "open"), f"merged-{version}")]
            left += [p["folder"] for p in of["open"]]
            of["open"], of["closed"] = [p for p in merged if p["kind"] == "open"], of["closed"] + [p for p in merged if p["kind"] == "closed"]
            state["mark"] = mark
        if len(of["late"]) >= self.parts:
            folder = f"corrected-{version}"
            rows = self.merge(self._read(of["late"], state)).withColumn("_at", self._seconds())
            rows.coalesce(self.files).write.mode("overwrite").parquet(f"{self.path}/{folder}")
            left += [p["folder"] for p in of["late"]]
            of["late"] = [{"kind": "late", "low": min(p["low"] for p in of["late"]), "high": max(p["high"] for p in of["late"]), "folder": folder}]
        state["parts"] = [p for k in KINDS for p in of[k]]
        return left

    def _read(self, parts: list[dict], state: dict) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p['folder']}" for p in parts])

    def read(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """Counts of the panes that start at `low` or later and before `high` (seconds), from the parts that have such panes."""
        state = self.current()
        if state["schema"] is None:
            raise ValueError("no batch has been added")
        wanted = [p for p in state["parts"] if (high is None or p["low"] < high) and (low is None or p["high"] >= low)]
        rows = self._read(wanted, state)
        if low is not None:
            rows = rows.where(F.col("_at") >= low)
        if high is not None:
            rows = rows.where(F.col("_at") < high)
        return self.merge(rows.drop("_at"))

    def drop_before(self, low: int) -> list[str]:
        """Forget parts all of whose panes start before `low`, without reading or writing any rows; their folders. Panes before `low` in the part
        across the edge stay until that goes; `read(low)` leaves them out."""
        state = self.current()
        out = [p["folder"] for p in state["parts"] if p["kind"] != "open" and p["high"] < low]
        if out:
            version = state["version"] + 1
            state["parts"] = [p for p in state["parts"] if p["folder"] not in out]
            state["left"] += [[version, f] for f in out]
            self._swap(state | {"version": version})
        return out


def count_panes(stream: DataFrame, partial: Callable[[DataFrame], DataFrame], log: PaneLog, checkpoint: str,
                interval: str | None = None) -> StreamingQuery:
    """Aggregate every micro-batch by itself and add it to the log."""
    from .runner import start

    return start(stream, lambda df, i: log.add(partial(df), i), checkpoint, "append", interval)
