"""Live views whose cost follows the keys that change: state per key in the state store, results in a change log."""
from __future__ import annotations

import heapq
import itertools
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .changelog import ChangeLog, Table
from .runner import drop_batch, publish, start
from .views import latest_scores, ranking, recent_entries

# Functions of tasks travel with their code, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
POINTS = "entity string, at long, id long, score double"
HISTORY = "entity string, ids array<long>, values array<double>, n_new long"


def newest_points(rows: DataFrame, keep: int) -> DataFrame:
    """The newest `keep` points of every entity within each task, so that a busy entity sends at most as many from each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list[tuple]] = {}
        ties = itertools.count()
        for batch in batches:
            for entity, at, number, score in zip(*[c.to_pylist() for c in batch.columns]):
                heap = held.setdefault(entity, [])
                point = (*_place_in_time(at, number, score), next(ties), (at, number, score))
                if len(heap) < keep:
                    heapq.heappush(heap, point)
                else:
                    heapq.heappushpop(heap, point)
        rows = [(e, *p[-1]) for e, heap in held.items() for p in heap]
        for i in range(0, len(rows), 10_000):
            columns = zip(*rows[i:i + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.float64()))],
                                             ["entity", "at", "id", "score"])

    return rows.select("entity", "at", "id", "score").mapInArrow(run, POINTS)


def _place_in_time(at: int | None, number: int | None, score: float | None) -> tuple:
    """By time, then number, nulls first; of these also equal, by score, null first and NaN last."""
    value = (0, 0.0) if score is None else (2, 0.0) if score != score else (1, score)
    return (at is not None, at or 0, number is not None, number or 0, value)


class BoundedHistory(StatefulProcessor):
    """The newest points of an entity in list state; a row out for every entity that got points."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.points = handle.getListState("points", "at long, id long, score double")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        old = [tuple(p) for p in self.points.get()]
        new = 0

        def counted() -> Iterator[tuple]:
            nonlocal new
            for r in rows:
                new += 1
                yield r.at, r.id, r.score

        kept = heapq.nlargest(self.keep, itertools.chain(old, counted()), key=lambda p: _place_in_time(*p))[::-1]
        self.points.put(kept)
        yield Row(entity=key[0], ids=[p[1] for p in kept], values=[p[2] for p in kept], n_new=new)

    def close(self) -> None:
        pass


def micros(ts: str, kind: str) -> Column:
    """Microseconds of a time column of type `kind`."""
    if kind == "timestamp":
        return F.unix_micros(ts)
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', CAST(`{ts}` AS TIMESTAMP_NTZ))")


def histories(scores: DataFrame, keep: int = 60) -> DataFrame:
    """A stream of the changed entities with their newest `keep` scores, oldest first, and how many rows came for each.

    Order is by time and id, whatever order the rows come in. Entities without news cost nothing.
    """
    scores.sparkSession.conf.set(*STATE_STORE)
    points = scores.select("entity", micros("ts", scores.schema["ts"].dataType.simpleString()).alias("at"), F.col("id").cast("long").alias("id"),
                           F.col("score").cast("double").alias("score"))
    return (newest_points(points, keep).groupBy("entity")
            .transformWithState(BoundedHistory(keep), HISTORY, "Update", "None"))


def history_log(spark: SparkSession, path: str, **options) -> ChangeLog:
    return ChangeLog(spark, path, {"history": Table(("entity",))}, **options)


def keep_histories(scores: DataFrame, log: ChangeLog, checkpoint: str, keep: int = 60, interval: str | None = None) -> StreamingQuery:
    """Histories of all entities in the table `history` of a log; a batch writes the entities that got scores."""
    return start(histories(scores, keep), lambda df, i: log.append(i, {"history": df}), checkpoint, "update", interval)


def counts_log(spark: SparkSession, path: str, key: str, **options) -> ChangeLog:
    return ChangeLog(spark, path, {"counts": Table((key,))}, **options)


def keep_counts(counts: DataFrame, log: ChangeLog, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Running counts (a streaming aggregate) in the table `counts` of a log; a batch writes the keys that it counted."""
    return start(counts, lambda df, i: log.append(i, {"counts": df}), checkpoint, "update", interval)


def recent_log(spark: SparkSession, path: str, **options) -> ChangeLog:
    return ChangeLog(spark, path, {"recent": Table()}, **options)


def keep_recent_list(builds: DataFrame, log: ChangeLog, checkpoint: str, keep: int = 200, interval: str | None = None) -> StreamingQuery:
    """The `keep` entities with the newest messages, one row each, in the table `recent` of a log.

    An entity's newest message only gets newer, so whoever falls out of the list needs a newer message than all who fell out to
    come back, and that message is then its newest: the list itself is all the state there is.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= log.batch:
            return
        rows = recent_entries(batch)
        if log.batch >= 0:
            rows = rows.unionByName(log.read("recent").select(*rows.columns))
        values = [c for c in rows.columns if c != "entity"]
        newest = rows.groupBy("entity").agg(F.max(F.struct(*values)).alias("_row")).select("entity", "_row.*")
        log.append(batch_id, {"recent": newest.orderBy(F.desc("ts"), F.desc("id")).limit(keep)})

    return start(builds, step, checkpoint, "append", interval)


RANKING = {"latest": Table(("entity",)), "shown": Table(("entity",)), "board": Table(), "top": Table()}


def ranking_log(spark: SparkSession, path: str, **options) -> ChangeLog:
    return ChangeLog(spark, path, RANKING, **options)


def _place(row: Row | list) -> tuple:
    """Order of a ranking: high scores first (NaN before all, null last), then names, null first."""
    entity, score = (row.entity, row.score) if isinstance(row, Row) else row
    level = (2, 0.0) if score is None else (0, 0.0) if score != score else (1, -score)
    return (*level, entity is not None, entity or "")


def advance_board(board: list[Row], changed: list[Row], floor: list | None, size: int) -> tuple[list[Row], list | None]:
    """The best `size` of the board and the changed entities, and the new floor: the best place of anyone that is left out."""
    news = {r.entity for r in changed}
    every = sorted([r for r in board if r.entity not in news] + changed, key=_place)
    left_out = [[r.entity, r.score] for r in every[size:size + 1]] + ([floor] if floor else [])
    return every[:size], min(left_out, key=_place, default=None)


def keep_ranking(scores: DataFrame, log: ChangeLog, checkpoint: str, n: int = 6, spare: int = 58, path: str | None = None,
                 batches: int = 20, interval: str | None = None) -> StreamingQuery:
    """Top `n` scores after every batch, each with the delta against when it was last in the top.

    Tables of the log, committed together: `latest`, the last score of each entity (a batch writes those that got a newer
    one); `board`, the best `n + spare` entities; `top`; `shown`, the score at the last showing. A batch looks at its
    changed entities and the board only. Whoever is not on the board is no better than a floor that is kept beside it; if
    scores of the board fall so far that fewer than `n` of it are better than the floor, the board is made anew from
    `latest`, so the ranking is exact at all times. With `path`, `top` is also published there per batch.
    """
    size = n + spare
    order = [F.desc_nulls_last("score"), F.asc_nulls_first("entity")]

    def step(batch: DataFrame, batch_id: int) -> None:
        state = log.current()
        if batch_id <= state["batch"]:
            return
        spark = log.spark
        changed = log.write("latest", batch.select("entity", "ts", "id", "score", "star", "ability", "look"), batch_id)
        first = "board" not in state["tables"]
        # Of many changed entities only those that can be on the board matter, and the best that can't.
        best = changed.drop("_batch").orderBy(*order).limit(size + 1).collect()
        names = [] if first else [r.entity for r in log.read("board").select("entity").collect()]
        fallen = [] if first else changed.drop("_batch").where(F.col("entity").isin(names) | F.col("entity").isNull()).collect()
        known = {r.entity: r for r in best + fallen}
        board, floor = advance_board([] if first else log.read("board").collect(), list(known.values()), state["notes"].get("floor"), size)
        rebuilt = bool(floor) and sum(_place(r) < _place(floor) for r in board) < n
        if rebuilt:
            every = log._rows("latest", state, plus=[f"latest/delta-{batch_id}"])
            found = every.orderBy(*order).limit(size + 1).collect()
            board, floor = found[:size], [found[size].entity, found[size].score] if len(found) > size else None
        listed = spark.createDataFrame(board, changed.drop("_batch").schema)
        shown = None if first else log.read("shown")
        top, _ = ranking(listed, shown, n)
        top = log.write("top", top, batch_id)
        if path:
            publish(top.drop("_batch"), batch_id, f"{path}/top")
            drop_batch(spark, f"{path}/top", batch_id - max(2, batches))
        log.commit(batch_id, {"latest": changed, "board": log.write("board", listed, batch_id), "top": top,
                              "shown": log.write("shown", top.select("entity", F.col("score").alias("shown_score")), batch_id)},
                   {"floor": floor, "rebuilt": state["notes"].get("rebuilt", 0) + rebuilt})

    return start(latest_scores(scores), step, checkpoint, "update", interval)
