"""Session defaults and the place for intermediate files."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "aeropunct",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution; the cluster's own settings win elsewhere.

    ``shuffle_partitions`` is the *initial* count: adaptive execution merges
    small partitions and splits skewed join partitions, but adds none. On a cluster
    set it to at least two to three times the cores, and for jobs that shuffle whole
    records (cleaning, exact copies, row accounting) to one partition for each 128 to
    256 MB of raw text. It covers every job of the session.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Tables written side by side in one pass need no sort of the rows by table.
        "spark.sql.maxConcurrentOutputFileWriters": "8",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**settings, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``, the shared folder the cluster names.
    A machine-local folder is used only by a local session without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        # A local cluster has executors with folders of their own.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table, through the file system it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Put a written table in the place of an earlier one; false where there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path(source)):
        return False
    system.delete(path(target), True)
    if not system.rename(path(source), path(target)):
        raise OSError(f"cannot move {source} to {target}")
    return True
