"""Sinks."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import fresh_path


def write_table(df: DataFrame, path: str | None = None, mode: str = "append", format: str = "parquet",
                partition_by: list[str] | None = None, **options) -> None:
    """Append or overwrite a table; `format="jdbc"` takes url and dbtable options."""
    writer = df.write.format(format).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path) if path else writer.save()


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that occur in `df`; a rerun gives the same table."""
    write_table(df, path, "overwrite", partition_by=partition_by, partitionOverwriteMode="dynamic")


def write_csv(df: DataFrame, path: str, order: list[Column]) -> None:
    """CSV with a header, files in the given order."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def route(df: DataFrame, reason_col: str, path: str, accepted: str = "accepted") -> None:
    """One write that files every row under its reason."""
    (df.withColumn(reason_col, F.coalesce(reason_col, F.lit(accepted)))
     .write.mode("overwrite").partitionBy(reason_col).parquet(path))


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """Keyed JSON messages of all columns."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def publish_messages(messages: DataFrame, format: str = "kafka", **options) -> None:
    """Write messages to a topic. For Kafka pass kafka.bootstrap.servers and topic."""
    defaults = {"kafka.acks": "all", "kafka.enable.idempotence": "true",
                "kafka.compression.type": "gzip"} if format == "kafka" else {}
    messages.write.format(format).options(**{**defaults, **options}).save()


def stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several branches read to the shared folder and read it back.

    The work is done once, columns can still be pruned, and the files outlive lost executors.
    """
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
