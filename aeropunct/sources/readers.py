"""Scans of raw, cleaned and report files, and table registration."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType
from pyspark.sql.window import Window

from aeropunct.functions.columns import as_float, as_int
from aeropunct.schema import BAND_REPORT_SCHEMA, CLEAN_SCHEMA, RAW_EXTRAS, RAW_SCHEMA

# Fixed value: how the delimited reports write null.
NULL_TEXT = "\\N"


def read_raw(
    spark: SparkSession,
    path: str,
    schema: StructType | None = RAW_SCHEMA,
    infer: bool = False,
    checked: bool = False,
) -> DataFrame:
    """Raw CSV with a header.

    The declared schema is the default, since inference reads the whole input
    once more. Columns are bound by the names of the header, whatever their order and
    case: declared columns that it lacks are null, others are left out. All files must
    have the header of the first; Spark refuses others when it reads them. Cells are read
    as text and converted: whole numbers may be written with a decimal point, and a cell
    that does not convert is null.

    ``checked`` adds ``_unconverted``, the number of such cells in a row, and
    ``_broken_line``, the text of a line with too few or too many cells, else null. The
    cells that a broken line has are read, the others are null. :func:`rejected_cells`
    lists both one by one.
    """
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    text, cells = _text_cells(spark, path, schema, checked)
    converted = [_converted(cells[f.name], f.dataType).alias(f.name) for f in schema]
    if not checked:
        return text.select(*converted)
    lost = F.size(F.filter(F.array(*_unread(cells, schema)), lambda c: F.trim(c) != ""))
    return text.select(*converted, lost.alias(RAW_EXTRAS[0]), F.col(RAW_EXTRAS[1]))


def _text_cells(
    spark: SparkSession, path: str, schema: StructType, checked: bool
) -> tuple[DataFrame, dict[str, Column]]:
    """The cells as text under the header's names, and the cell of each declared column."""
    header = header_of(spark, path)
    names = StructType()
    for name in header:
        names = names.add(name, "string")
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if checked:
        names = names.add(RAW_EXTRAS[1], "string")
        reader = reader.option("columnNameOfCorruptRecord", RAW_EXTRAS[1])
    bound = bind_header(header, schema.names)
    cells = {
        name: F.col("`" + at.replace("`", "``") + "`") if at is not None else F.lit(None).cast("string")
        for name, at in bound.items()
    }
    return reader.schema(names).csv(path), cells


def bind_header(header: Sequence[str], declared: Sequence[str]) -> dict[str, str | None]:
    """The header's name of each declared column, by name without case and outer spaces."""
    by_name: dict[str, str] = {}
    for name in header:
        if by_name.setdefault(name.strip().lower(), name) is not name:
            raise ValueError(f"the header names the column {name.strip()!r} twice")
    bound = {name: by_name.get(name.lower()) for name in declared}
    if not any(bound.values()):
        raise ValueError("the header names none of the declared columns")
    return bound


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Names in the first line of the first file, read by the driver without a job."""
    line = _first_line(spark, path).removeprefix("\ufeff")
    return next(csv.reader([line], escapechar="\\"), [])


def _first_line(spark: SparkSession, path: str) -> str:
    """First line that is not blank of the files below a path, through their file system."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(conf)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    for start in system.globStatus(root) or []:
        files = system.listFiles(start.getPath(), True)
        while files.hasNext():
            file = files.next()
            if file.getLen() == 0 or file.getPath().getName().startswith(("_", ".")):
                continue
            stream = system.open(file.getPath())
            codec = codecs.getCodec(file.getPath())
            if codec is not None:
                stream = codec.createInputStream(stream)
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            try:
                while (line := lines.readLine()) is not None:
                    if line.strip():
                        return line
            finally:
                lines.close()
    raise ValueError(f"no file with a header at {path}")


def _converted(cell: Column, kind: DataType) -> Column:
    plain = {"string": lambda c: c, "int": as_int, "float": as_float}
    return plain.get(kind.simpleString(), lambda c: c.try_cast(kind))(cell)


def _unread(cells: Mapping[str, Column], schema: StructType) -> list[Column]:
    """Per declared column the cell's text where it gives no value, blank or not, else null.

    The texts that count are picked from an array of these by one short function. A test
    of its own for each column makes the generated code of a row too long for the JVM to
    compile, and each row several times slower.
    """
    return [
        F.when(_converted(cells[f.name], f.dataType).isNull(), cells[f.name]) for f in schema
    ]


def _lost(cell: Column, kind: DataType) -> Column:
    """Whether a cell holds text which is no value of the type; a null cell does not."""
    return F.coalesce((F.trim(cell) != "") & _converted(cell, kind).isNull(), F.lit(False))


def unconverted_cells(text: DataFrame, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """(column, cells): cells that hold text which is no value of the declared type."""
    lost = [F.count_if(_lost(F.col(f.name), f.dataType)).alias(f.name) for f in schema]
    return text.agg(*lost).unpivot([], list(schema.names), "column", "cells")


def rejected_cells(
    spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA
) -> DataFrame:
    """(file, row, column, value) of every cell that does not convert and every broken line.

    ``row`` counts the file's data rows from 1. A broken line has no column and its whole
    text as the value. Rows are numbered inside each block of a file that one task reads,
    and the blocks are counted in a pass of their own, so nothing is sorted as a whole.
    """
    text, cells = _text_cells(spark, path, schema, checked=True)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start")
    # The id rises along the rows of a block, whichever task reads it.
    rows = text.select("*", place.alias("_place"), F.monotonically_increasing_id().alias("_at"))
    blocks = rows.groupBy("_place").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # One row a block; a window over the blocks of one file.
    earlier = (
        Window.partitionBy("_place.file_path")
        .orderBy("_place.file_block_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    blocks = blocks.select("_place", (before - F.col("_first") + 1).alias("_shift"))
    # Columns of text are looked at too: Spark finds a line broken by the columns it reads.
    found = [
        F.when(unread.isNotNull(), F.struct(F.lit(name).alias("column"), unread.alias("value")))
        for name, unread in zip(schema.names, _unread(cells, schema), strict=True)
    ]
    whole = F.struct(F.lit(None).cast("string").alias("column"), F.col(RAW_EXTRAS[1]).alias("value"))
    found.append(F.when(F.col(RAW_EXTRAS[1]).isNotNull(), whole))
    lost = F.filter(
        F.array(*found),
        lambda x: x.isNotNull() & (x["column"].isNull() | (F.trim(x["value"]) != "")),
    )
    rejected = rows.select("_place", "_at", F.inline(lost))
    return rejected.join(blocks, "_place").select(
        F.col("_place.file_path").alias("file"),
        (F.col("_at") + F.col("_shift")).alias("row"),
        "column",
        "value",
    )


def read_raw_text(spark: SparkSession, path: str) -> DataFrame:
    """Raw CSV with a header, every column as text."""
    return spark.read.csv(path, header=True, inferSchema=False)


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table, its schema from the files."""
    return spark.read.parquet(path)


def read_keyed_text(
    spark: SparkSession, path: str, names: Sequence[str] = ("Key", "Value")
) -> DataFrame:
    """Tab-separated text without a header. Quotes have no meaning in it."""
    schema = StructType()
    for name in names:
        schema = schema.add(name, "string")
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | None = BAND_REPORT_SCHEMA,
    header: bool = True,
) -> DataFrame:
    """Comma-separated report in which ``\\N`` is null; without a schema types are inferred."""
    reader = spark.read.option("header", header).option("nullValue", NULL_TEXT)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_dictionary(spark: SparkSession, path: str, extra: Sequence[str] = ()) -> DataFrame:
    """Name and type of each column from a data dictionary file, and ``extra`` columns."""
    return read_raw_text(spark, path).select(
        F.col("column").alias("column_name"), F.col("dtype").alias("data_type"), *extra
    )


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database when it is missing and make it the current one."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    spark.catalog.setCurrentDatabase(name)


def register_flights(
    spark: SparkSession, name: str, path: str, schema: StructType = CLEAN_SCHEMA
) -> DataFrame:
    """External table with declared columns over an existing Parquet folder.

    An earlier table of that name is dropped first; its files stay.
    """
    quoted = ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))
    spark.sql(f"DROP TABLE IF EXISTS {quoted}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return spark.table(name)
