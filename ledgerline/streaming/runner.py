"""Starting views, publishing snapshots, landing topics, state kept as published tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import fresh_path


def start(view: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update",
          interval: str | None = None) -> StreamingQuery:
    """Run a view; offsets and state live under the checkpoint. Without an interval it takes what
    is available and stops."""
    writer = view.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def publish(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write the current value of a view under its batch number; a repeated batch replaces itself."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def current(spark: SparkSession, path: str) -> DataFrame:
    """The value of the newest published batch; older batch folders are pruned."""
    table = spark.read.parquet(path)
    return table.filter(F.col("batch") == table.agg(F.max("batch")).scalar()).drop("batch")


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove a published batch, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={batch_id}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drain(spark: SparkSession, view: DataFrame, label: str, mode: str = "complete") -> DataFrame:
    """Run a view over all available input and return its last published value."""
    base = fresh_path(spark, label)
    query = start(view, lambda df, i: publish(df, i, f"{base}/out"), f"{base}/checkpoint", mode)
    query.awaitTermination()
    return current(spark, f"{base}/out")


def latest_updates(table: DataFrame, keys: list[str]) -> DataFrame:
    """The last value of every key in a log of update-mode batches."""
    values = [c for c in table.columns if c not in keys and c != "batch"]
    return (table.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
            .select(*keys, "_v.*"))


def drain_updates(spark: SparkSession, view: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Run a view in update mode over all available input and return the last value per key.

    Only changed keys are written per batch, and keys behind the watermark leave the state.
    """
    base = fresh_path(spark, label)
    query = start(view, lambda df, i: publish(df, i, f"{base}/out"), f"{base}/checkpoint", "update")
    query.awaitTermination()
    return latest_updates(spark.read.parquet(f"{base}/out"), keys)


def drain_partials(spark: SparkSession, stream: DataFrame, partial: Callable[[DataFrame], DataFrame],
                   merge: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """Aggregate every micro-batch by itself over all available input and merge the published parts.

    There is no state and no watermark: a batch costs its own rows, and a row that comes late is one more part of
    its window. A repeated batch replaces itself.
    """
    base = fresh_path(spark, label)
    query = start(stream, lambda df, i: publish(partial(df), i, f"{base}/out"), f"{base}/checkpoint", "append")
    query.awaitTermination()
    return merge(spark.read.parquet(f"{base}/out").drop("batch"))


def land(stream: DataFrame, topic_col: str, ts_col: str, path: str, checkpoint: str,
         interval: str | None = "30 seconds", files: int = 4) -> StreamingQuery:
    """Land messages as topic/year/month/day folders, each row once.

    The flush size is the source's maxOffsetsPerTrigger (or maxFilesPerTrigger). Rows are filed by
    their own day, so a new day opens a new folder. Rows of a folder come together in `files` tasks before
    the write, so that not every task opens a file in every folder.
    """
    day = F.col(ts_col)
    out = (stream.withColumn("topic", F.col(topic_col))
           .withColumn("yyyy", F.date_format(day, "yyyy")).withColumn("mm", F.date_format(day, "MM"))
           .withColumn("dd", F.date_format(day, "dd"))
           .repartition("topic", "yyyy", "mm", "dd", F.pmod(F.xxhash64(*stream.columns), F.lit(files))))
    writer = (out.writeStream.format("parquet").outputMode("append")
              .partitionBy("topic", "yyyy", "mm", "dd").option("path", path)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The value the previous batch published; reading by number keeps a repeated batch repeatable."""
    return spark.read.parquet(f"{path}/batch={batch_id - 1}") if batch_id > 0 else None


def keep_recent(kept: DataFrame | None, batch: DataFrame, keep: int = 60) -> DataFrame:
    """Fold a micro-batch into the newest `keep` scores per entity.

    The limit runs on each side of the shuffle, so one busy entity sends at most `keep` rows per task.
    """
    cols = ["entity", "ts", "id", "score"]
    rows = batch.select(*cols) if kept is None else kept.select(*cols).unionByName(batch.select(*cols))
    newest = Window.partitionBy("entity").orderBy(F.col("ts").desc(), F.col("id").desc())
    return rows.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= keep).drop("_rn")


def score_history(spark: SparkSession, scores: DataFrame, path: str, checkpoint: str, keep: int = 60,
                  interval: str | None = None, batches: int = 20) -> StreamingQuery:
    """Bounded score history per entity, kept as a published table of which the newest `batches` stay;
    `recent_values` shows its tail."""
    def step(batch: DataFrame, batch_id: int) -> None:
        publish(keep_recent(before(spark, path, batch_id), batch, keep), batch_id, path)
        drop_batch(spark, path, batch_id - max(2, batches))

    return start(scores, step, checkpoint, "append", interval)


def live_ranking(spark: SparkSession, scores: DataFrame, path: str, checkpoint: str, n: int = 6,
                 interval: str | None = None, batches: int = 20) -> StreamingQuery:
    """Top scores after every batch, each with the delta against when it was last in the top, published under `path`/top.

    The newest `batches` stay. The state is the change log `path`/log of `keyed.keep_ranking`.
    """
    from .keyed import keep_ranking, ranking_log
    return keep_ranking(scores, ranking_log(spark, f"{path}/log"), checkpoint, n, path=path, batches=batches, interval=interval)
