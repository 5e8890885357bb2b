"""Session defaults and the shared folder for checkpoints and intermediate tables."""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "ledgerline", **conf: str) -> SparkSession:
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="ledgerline-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def staged_root(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables."""
    return f"{shared_dir(spark)}/ledgerline/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{staged_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_staged(spark: SparkSession) -> None:
    """Drop this application's intermediate tables; call it when no result is read any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(staged_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
