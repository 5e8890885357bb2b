"""Counters of a write, gathered while it runs."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..streaming.changelog import ChangeLog, Table
from .sinks import route


def observed(rows: DataFrame, reason_col: str, reasons: Sequence[str], accepted: str = "accepted",
             more: dict[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """`rows` that count themselves when they are written: in all (`total`), accepted, per reason of `reasons`, `other`, and the aggregates of `more`."""
    seen, reason = Observation(), F.coalesce(reason_col, F.lit(accepted))
    known = [accepted, *[r for r in reasons if r != accepted]]
    counts = [F.count_if(reason == r).alias(r) for r in known]
    return rows.observe(seen, F.count("*").alias("total"), *counts, F.count_if(~reason.isin(known)).alias("other"),
                        *[c.alias(n) for n, c in (more or {}).items()]), seen


def route_counted(rows: DataFrame, reason_col: str, path: str, reasons: Sequence[str], accepted: str = "accepted",
                  more: dict[str, Column] | None = None) -> dict[str, int]:
    """File every row under its reason and return the counters of this one write; the rows are made once."""
    watched, seen = observed(rows, reason_col, reasons, accepted, more)
    route(watched, reason_col, path, accepted)
    return seen.get


def counters_frame(spark: SparkSession, counters: dict[str, int], leave_out: Sequence[str] = ("total",)) -> DataFrame:
    """`reason`, `n` of the counters that are not zero."""
    return spark.createDataFrame([(k, v) for k, v in counters.items() if v and k not in leave_out], "reason string, n long")


def counters_log(spark: SparkSession, path: str, **options) -> ChangeLog:
    return ChangeLog(spark, path, {"counters": Table(("batch", "counter"))}, **options)


def route_stream(lines: DataFrame, classify: Callable[[DataFrame], DataFrame], path: str, log: ChangeLog, checkpoint: str,
                 reasons: Sequence[str], keep: Sequence[str], reason_col: str = "reason", more: dict[str, Column] | None = None,
                 interval: str | None = None) -> StreamingQuery:
    """Classify a stream of lines, file the columns `keep` of each batch under `path`/batch=n by reason, and log the counters of that write.

    The table `counters` of the log has `batch`, `counter`, `n`. A repeated batch writes its folder anew and counts once.
    """
    from ..streaming.runner import start

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = classify(batch)
        watched, seen = observed(rows, reason_col, reasons, more=more)
        route(watched.select(*keep, reason_col), reason_col, f"{path}/batch={batch_id}")
        counted = log.spark.createDataFrame([(batch_id, k, int(v)) for k, v in seen.get.items()], "batch long, counter string, n long")
        log.append(batch_id, {"counters": counted})

    return start(lines, step, checkpoint, "append", interval)
