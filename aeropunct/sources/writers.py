"""Sinks of the cleaned table, the reports and the run metrics.

Files are written by all tasks in parallel. The two single-file forms exist
because the reports are delivered as one file; they take finished reports, whose
size depends on the number of carriers, airports and months and not on the
number of flights. The work before the last step stays parallel there too.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, contextmanager
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aeropunct.session import move, remove
from aeropunct.sources.readers import NULL_TEXT


# Setting for the files that a task of a partitioned write may hold open without a sort.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
# Setting that removes the shuffle files of a statement at its end.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Records of a file of raw text, which one task reads whole since it is compressed.
RAW_FILE_RECORDS = 1_000_000
# Row groups of tables that are written side by side.
ROW_GROUP_BYTES = 32 << 20


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting has this value meanwhile."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def _open_files(spark: SparkSession, n: int) -> Iterator[None]:
    """At least ``n`` files of a partitioned write may be open in a task meanwhile."""
    before = spark.conf.get(OPEN_FILES, None)
    with _setting(spark, OPEN_FILES, str(max(n, int(before or 0)))):
        yield


def _shuffles_freed(df: DataFrame) -> AbstractContextManager[None]:
    """The shuffle files of a write meanwhile go when it is done.

    Otherwise they stay until the driver happens to collect garbage, beside those of the
    next step. A write plans its table anew, so nothing reads them again.
    """
    return _setting(df.sparkSession, FREE_SHUFFLES, "true")


def write_parquet(df: DataFrame, path: str) -> None:
    with _shuffles_freed(df):
        df.write.mode("overwrite").parquet(path)


def write_datasets(df: DataFrame, column: str, names: Sequence[str], out_dir: str) -> dict[str, str]:
    """Rows to the Parquet table that ``column`` names, all tables in one pass.

    The tables are written as partitions of a new folder and moved to their names when the
    pass is done, so an earlier table stays whole until then. A name without rows gets an
    empty table. Gives the paths by name.

    A task keeps a file of each table open, so that its rows, many times those it read,
    need no sort by table. Row groups are small, since a task buffers one for each file.
    """
    spark, base = df.sparkSession, out_dir.rstrip("/")
    new = f"{base}/_new-{uuid4().hex}"
    # One more than there are tables: Spark begins to sort when the last file is opened.
    with _open_files(spark, len(names) + 1), _shuffles_freed(df):
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(column).parquet(new)
    paths = {}
    for name in names:
        paths[name] = f"{base}/{name}.parquet"
        if not move(spark, f"{new}/{column}={name}", paths[name]):
            empty = spark.createDataFrame([], df.drop(column).schema)
            write_parquet(empty, paths[name])
    remove(spark, new)
    return paths


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Compressed CSV with a header in every part file; a file has a bounded number of records."""
    with _shuffles_freed(df):
        df.write.mode("overwrite").option("maxRecordsPerFile", RAW_FILE_RECORDS).csv(
            path, header=True, compression="gzip"
        )


def write_delimited(df: DataFrame, path: str) -> None:
    """Plain comma-separated parts without a header; null is ``\\N``."""
    df.write.mode("overwrite").csv(path, sep=",", nullValue=NULL_TEXT, compression="none")


def _one_partition(df: DataFrame, order: Sequence[str]) -> DataFrame:
    # repartition, not coalesce: coalescing would pull the aggregation itself
    # into the single task.
    return df.repartition(1).sortWithinPartitions(*order)


def write_single_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """One CSV file with one header row, in the given order. For finished reports."""
    _one_partition(df, order).write.mode("overwrite").csv(
        path, header=True, nullValue=NULL_TEXT, compression="none"
    )


def write_keyed_text(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Lines of key, tab and value in byte order of the key.

    The keys are range-partitioned: the parts, read in order of their names, are one
    sorted list. ``single_file`` writes one part, in one task; for small reports.
    """
    ordered = _one_partition(df, ["Key"]) if single_file else df.orderBy("Key")
    ordered.select(F.concat_ws("\t", "Key", "Value").alias("value")).write.mode("overwrite").text(
        path
    )


def append_run_metrics(
    spark: SparkSession, path: str, rows: Sequence[Mapping[str, object]], columns: Sequence[str]
) -> None:
    """Append run-metrics rows to a CSV folder. Each run adds its own small part file
    with a header, so that concurrent runs cannot damage each other's rows."""
    schema = StructType()
    for name in columns:
        # One kind per suffix, so that the folders of all jobs can be read together.
        whole = name.endswith(("_Records", "_Cells"))
        kind = "double" if name.endswith("_Sec") else "long" if whole else "string"
        schema = schema.add(name, kind)
    values = [[row[name] for name in columns] for row in rows]
    frame = spark.createDataFrame(values, schema).coalesce(1)
    frame.write.mode("append").csv(path, header=True)


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    """All appended run-metrics rows."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_labelled_metrics(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """Run metrics of several jobs, ``folders`` by label, with the label as Framework."""
    parts = [
        read_run_metrics(spark, path).select(
            F.lit(label).alias("Framework"),
            "Environment",
            "Dataset",
            F.col("Execution_Time_Sec").cast("double"),
        )
        for label, path in folders.items()
    ]
    return reduce(DataFrame.unionByName, parts)
