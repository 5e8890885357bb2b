"""Helpers of the operators: tables, checkpoints, packed byte planes and ragged gathers."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import shared_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its whole name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def free(taken: list[str], *names: str) -> list[str]:
    """`names`, each with underscores behind it until no column of `taken` is called so (in any case)."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def map_all(docs: DataFrame, run: Callable, extra: list[T.StructField]) -> DataFrame:
    """`docs.mapInArrow(run)` with columns called c0, c1, ... inside, and their own names, types and `extra` outside."""
    own = docs.schema.fields
    inner = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(own)]
    made = docs.toDF(*[f.name for f in inner]).mapInArrow(run, T.StructType(inner + extra))
    return made.toDF(*docs.columns, *[f.name for f in extra])


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from there, with no lineage behind it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unit(*cols: str, seed: int = 0) -> Column:
    """A number in [0, 1) with 53 bits, fixed by the values of `cols`."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def texts(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, null as empty, one value at a time."""
    values = batch.column(column)
    for i in range(batch.num_rows):
        v = values[i]
        yield v.as_buffer().to_pybytes() if v.is_valid else b""


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every slice, one slice after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 on an array of unsigned 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
