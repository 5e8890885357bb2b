"""Landing of topics in folders per day whose files have a wanted size, whatever the volume.

Every batch measures the bytes of each topic and day and gives each writer about `target` bytes: a large folder gets many writers, small
folders share one. Files that stay small are joined later, packed into bins of the wanted size. A commit file names the files
that count, so a batch or a join is there as a whole or not at all.
"""
from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import delete, read_text, swap_text

FOLDER = ["topic", "yyyy", "mm", "dd"]


def row_bytes(rows: DataFrame) -> Column:
    """Bytes of a row: those of texts and binaries as they are, eight for anything else."""
    sizes = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.lit(8)
             for f in rows.schema.fields]
    return sum(sizes, F.lit(0)).cast("long")


def packed(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """Bins of names whose sizes add up to `target` at most, the largest first; a name alone may be larger."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        fits = [i for i, (used, _) in enumerate(bins) if used + size <= target]
        if fits:
            best = max(fits, key=lambda i: bins[i][0])
            bins[best] = (bins[best][0] + size, bins[best][1] + [name])
        else:
            bins.append((size, [name]))
    return [names for _, names in bins]


class Landing:
    """Rows under `path` in folders topic/yyyy/mm/dd, written by one stream. `target` is the size of a file in bytes as measured in rows."""

    def __init__(self, spark: SparkSession, path: str, topic_col: str, ts_col: str, target: int = 128 << 20, keep_versions: int = 5):
        self.spark, self.path, self.topic_col, self.ts_col = spark, path.rstrip("/"), topic_col, ts_col
        self.target, self.keep_versions = target, keep_versions

    def current(self) -> dict:
        text = read_text(self.spark, f"{self.path}/CURRENT")
        return json.loads(text) if text else {"version": 0, "batch": -1, "schema": None, "files": [], "left": []}

    def _commit(self, state: dict, gone: list[str] = ()) -> None:
        version = state["version"] + 1
        old = [n for v, n in state["left"] if v < version - self.keep_versions]
        left = [[v, n] for v, n in state["left"] if v >= version - self.keep_versions] + [[version, n] for n in gone]
        swap_text(self.spark, f"{self.path}/CURRENT", json.dumps(state | {"version": version, "left": left}))
        for name in old:
            delete(self.spark, f"{self.path}/{name}")

    def _written(self, folder: str, schema: T.StructType) -> list[dict]:
        made = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        found = (made.groupBy(F.col("_metadata.file_path").alias("_file"), *FOLDER)
                 .agg(F.count("*").alias("_rows"), F.sum(row_bytes(made.drop(*FOLDER))).alias("_bytes")).collect())
        return [{"name": f"{folder}/{r['_file'].rsplit(f'/{folder}/', 1)[1]}", "folder": [r[c] for c in FOLDER], "rows": r["_rows"], "bytes": r["_bytes"]}
                for r in found]

    def add(self, rows: DataFrame, batch: int) -> bool:
        """Land a batch; False if it is there already."""
        state = self.current()
        if batch <= state["batch"]:
            return False
        day = F.col(self.ts_col)
        own = rows.withColumns({"topic": F.col(self.topic_col).cast("string"), **{n: F.date_format(day, p) for n, p in zip(FOLDER[1:], ("yyyy", "MM", "dd"))}})
        sized = row_bytes(rows)
        sizes = own.groupBy(*FOLDER).agg(F.sum(sized).alias("bytes")).orderBy(*FOLDER).collect()
        # Folders lie one after the other on a line of bytes, which writers share evenly.
        ends, table = 0, []
        for r in sizes:
            table.append((*[r[c] for c in FOLDER], ends, r["bytes"]))
            ends += r["bytes"]
        schema = T.StructType(rows.schema.fields + [T.StructField(c, T.StringType()) for c in FOLDER if c not in rows.columns])
        files: list[dict] = []
        if table:
            places = self.spark.createDataFrame(table, ", ".join(f"_{c} string" for c in FOLDER) + ", _at long, _bytes long")
            same = F.lit(True)
            for c in FOLDER:
                same = same & own[c].eqNullSafe(places[f"_{c}"])
            u = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 11) / F.lit(float(1 << 53))
            writers = max(1, -(-ends // self.target))
            writer = F.least(F.floor((F.col("_at") + u * F.col("_bytes")) / self.target), F.lit(writers - 1)).cast("int")
            (own.join(places, same).withColumn("_writer", writer).repartitionById(writers, "_writer")
             .select(*schema.names).write.mode("overwrite").partitionBy(*FOLDER).parquet(f"{self.path}/batch-{batch}"))
            files = self._written(f"batch-{batch}", schema)
        self._commit(state | {"batch": batch, "schema": schema.jsonValue(), "files": state["files"] + files})
        return True

    def compact(self) -> int:
        """Join the files of a folder that are under half the wanted size; how many went into others."""
        state = self.current()
        small: dict[tuple, list[tuple[str, int]]] = defaultdict(list)
        for f in state["files"]:
            if f["bytes"] * 2 < self.target:
                small[tuple(f["folder"])].append((f["name"], f["bytes"]))
        bins = [names for own in small.values() for names in packed(own, self.target) if len(names) > 1]
        if not bins:
            return 0
        schema, gone = T.StructType.fromJson(state["schema"]), {n for names in bins for n in names}
        folder = f"joined-{state['version'] + 1}"
        names = self.spark.createDataFrame([(n, i) for i, own in enumerate(bins) for n in own], "_name string, _bin int")
        roots = sorted({n.split("/", 1)[0] for n in gone})
        parts = []
        for root in roots:
            files = [f"{self.path}/{n}" for n in sorted(gone) if n.split("/", 1)[0] == root]
            rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/{root}").parquet(*files)
            parts.append(rows.withColumn("_name", F.concat(F.lit(f"{root}/"), F.substring_index("_metadata.file_path", f"/{root}/", -1))))
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        (every.join(names, "_name").repartitionById(len(bins), "_bin").select(*schema.names)
         .write.mode("overwrite").partitionBy(*FOLDER).parquet(f"{self.path}/{folder}"))
        made = self._written(folder, schema)
        if sum(f["rows"] for f in made) != sum(f["rows"] for f in state["files"] if f["name"] in gone):
            raise RuntimeError("a join of files lost or doubled rows")
        self._commit(state | {"files": [f for f in state["files"] if f["name"] not in gone] + made}, sorted(gone))
        return len(gone)

    def read(self, **folder: str) -> DataFrame:
        """The landed rows, or those of one topic, year, month or day by the names of the folders."""
        state = self.current()
        if state["schema"] is None:
            raise ValueError("nothing has been landed")
        schema = T.StructType.fromJson(state["schema"])
        roots: dict[str, list[str]] = defaultdict(list)
        for f in state["files"]:
            if all(f["folder"][FOLDER.index(k)] == v for k, v in folder.items()):
                roots[f["name"].split("/", 1)[0]].append(f"{self.path}/{f['name']}")
        if not roots:
            return self.spark.createDataFrame([], schema)
        parts = [self.spark.read.schema(schema).option("basePath", f"{self.path}/{root}").parquet(*files) for root, files in sorted(roots.items())]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def start(self, stream: DataFrame, checkpoint: str, interval: str | None = "30 seconds", compact_every: int = 20) -> StreamingQuery:
        """Land a stream; the flush is the interval or the source's limit of rows a batch. Small files are joined every few batches."""
        from .runner import start

        def step(batch: DataFrame, batch_id: int) -> None:
            self.add(batch, batch_id)
            if batch_id % compact_every == compact_every - 1:
                self.compact()

        return start(stream, step, checkpoint, "append", interval)
