"""Sources and sinks. Each writes to the shared scratch folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeropunct.checks.registry import (
    check,
    cleaned,
    comparable,
    comparable_sql,
    raw,
    rounded,
    two_decimals,
)
from aeropunct.operators import profiling, reports, selection
from aeropunct.plans import jobs
from aeropunct.schema import (
    BAND_REPORT_SCHEMA,
    CLEAN_COLUMNS,
    RANKING_FIELDS,
    RAW_COLUMNS,
    RAW_FIELDS,
)
from aeropunct.session import remove, scratch_dir
from aeropunct.sources import readers, writers

BAND_REPORT = "SELECT * FROM band_report"
RANKING = f"SELECT {', '.join(RANKING_FIELDS)} FROM ranking"


# Report text from the columns of a punctuality view.
STATS_VALUE = f"""
'Flights Operated: ' || total_flights
  || ' | Min Arr Delay: ' || printf('%.2f', low) || ' min'
  || ' | Max Arr Delay: ' || printf('%.2f', high) || ' min'
  || ' | Avg Arr Delay: ' || coalesce({two_decimals("delay_sum", "flown")}, '0.00') || ' min'
  || ' | Cancel Rate: ' || {two_decimals("100*gone", "total_flights")} || '%'
  || ' | Months of operation: ' || months"""


def raw_csv(spark, sf_dir: str, label: str) -> str:
    """The raw view as CSV files in the scratch folder."""
    path = scratch_dir(spark, label)
    writers.write_raw_csv(raw(spark, sf_dir), path)
    return path


def clean_parquet(spark, sf_dir: str, label: str) -> str:
    """The cleaned table as Parquet in the scratch folder."""
    path = scratch_dir(spark, label)
    writers.write_parquet(cleaned(spark, sf_dir), path)
    return path


@check("s1_csv_scan", f"SELECT {comparable_sql()} FROM raw")
def _(spark, sf_dir):
    return comparable(readers.read_raw(spark, raw_csv(spark, sf_dir, "s1")))


@check("s1_header_binding", f"SELECT {comparable_sql()} FROM raw")
def _(spark, sf_dir):
    # The same records under a header in another order and case, with a column more.
    path = scratch_dir(spark, "s1h")
    turned = raw(spark, sf_dir).select(
        F.lit("x").alias("remark"), *[F.col(c).alias(c.upper()) for c in reversed(RAW_COLUMNS)]
    )
    writers.write_raw_csv(turned, path)
    return comparable(readers.read_raw(spark, path))


@check(
    "s1_rejected_cells",
    """SELECT "column", "value", count(*) AS cells FROM (
  SELECT 'dep_delay' AS "column", 'late' AS "value" FROM raw WHERE dep_delay > 60
  UNION ALL SELECT 'crs_dep_time', '24h' FROM raw WHERE crs_dep_time = 2400) AS lost
GROUP BY "column", "value" """,
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "s1r")
    spoiled = raw(spark, sf_dir).withColumns(
        {
            "dep_delay": F.when(F.col("dep_delay") > 60, "late").otherwise(F.col("dep_delay").cast("string")),
            "crs_dep_time": F.when(F.col("crs_dep_time") == 2400, "24h").otherwise(
                F.col("crs_dep_time").cast("string")
            ),
        }
    )
    writers.write_raw_csv(spoiled, path)
    rejected = readers.rejected_cells(spark, path)
    return rejected.groupBy("column", "value").agg(F.count("*").alias("cells"))


@check(
    "s2_csv_text_scan",
    "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in RAW_COLUMNS) + " FROM raw",
)
def _(spark, sf_dir):
    return readers.read_raw_text(spark, raw_csv(spark, sf_dir, "s2"))


@check("s3_parquet_scan", "SELECT * FROM clean")
def _(spark, sf_dir):
    return readers.read_flights(spark, clean_parquet(spark, sf_dir, "s3"))


@check("s4_registered_table", "SELECT * FROM clean")
def _(spark, sf_dir):
    return readers.register_flights(
        spark, "default.s4_flights", clean_parquet(spark, sf_dir, "s4")
    )


@check("s5_use_database", "SELECT 'punctuality' AS database_name, count(*) AS flights FROM clean")
def _(spark, sf_dir):
    before = spark.catalog.currentDatabase()
    try:
        readers.use_database(spark, "punctuality", scratch_dir(spark, "s5db"))
        table = readers.register_flights(spark, "flights", clean_parquet(spark, sf_dir, "s5"))
        name = spark.catalog.currentDatabase()
    finally:
        spark.catalog.setCurrentDatabase(before)
    return table.agg(F.count("*").alias("flights")).select(
        F.lit(name).alias("database_name"), "flights"
    )


@check(
    "s6_query_parameters",
    """SELECT origin, month, delay_band, total_flights,
  dep100/100.0 AS avg_dep_delay, arr100/100.0 AS avg_arr_delay FROM band_stats""",
)
def _(spark, sf_dir):
    cleaned(spark, sf_dir).createOrReplaceTempView("s6_flights")
    return jobs.band_stats_sql(spark, "s6_flights", medium_from=15, high_above=60)


@check("s7_parquet_sink", RANKING)
def _(spark, sf_dir):
    path = scratch_dir(spark, "s7")
    writers.write_parquet(reports.carrier_ranking(cleaned(spark, sf_dir)), path)
    return readers.read_flights(spark, path)


@check("s8_delimited_sink", BAND_REPORT)
def _(spark, sf_dir):
    path = scratch_dir(spark, "s8")
    writers.write_delimited(reports.band_report(cleaned(spark, sf_dir)), path)
    return readers.read_delimited(spark, path, BAND_REPORT_SCHEMA, header=False)


def text_lines(parts: str, place: str) -> str:
    return (
        f"SELECT op_unique_carrier || ',' || {place} AS Key, {STATS_VALUE} AS Value FROM {parts}"
    )


_CSV_FIELDS = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in BAND_REPORT_SCHEMA.names)


@check(
    "s9_single_csv",
    f"SELECT concat_ws(',', {_CSV_FIELDS}) AS line FROM band_report"
    f" UNION ALL SELECT '{','.join(BAND_REPORT_SCHEMA.names)}'",
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "s9")
    report = reports.band_report(cleaned(spark, sf_dir))
    writers.write_single_csv(report, path, reports.BAND_KEYS)
    return spark.read.text(path).withColumnRenamed("value", "line")


@check(
    "s10_keyed_text_sink",
    f"SELECT Key || chr(9) || Value AS line FROM ({text_lines('airport_parts', 'origin')}) AS t",
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "s10")
    text = reports.format_stats(reports.carrier_airport_stats(cleaned(spark, sf_dir)))
    writers.write_keyed_text(text, path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@check("s11_keyed_text_scan", text_lines("route_parts", "route"))
def _(spark, sf_dir):
    path = scratch_dir(spark, "s11")
    text = reports.format_stats(reports.carrier_route_stats(cleaned(spark, sf_dir)), "route")
    writers.write_keyed_text(text, path, single_file=False)
    return readers.read_keyed_text(spark, path)


@check("s12_delimited_scan", BAND_REPORT)
def _(spark, sf_dir):
    path = scratch_dir(spark, "s12")
    writers.write_single_csv(
        reports.band_report(cleaned(spark, sf_dir)), path, reports.BAND_KEYS
    )
    return readers.read_delimited(spark, path)


@check(
    "s13_run_metrics",
    """SELECT 'check' AS Environment, count(*) AS Initial_Records,
  (SELECT count(*) FROM clean) AS Final_Records,
  count(*) - (SELECT count(*) FROM clean) AS Dropped_Records FROM raw""",
)
def _(spark, sf_dir):
    source, out, metrics = (scratch_dir(spark, f"s13{x}") for x in ("raw", "clean", "metrics"))
    writers.write_raw_csv(raw(spark, sf_dir), source)
    jobs.run_cleaning(spark, source, out, "check", metrics)
    remove(spark, source)
    counts = ("Initial_Records", "Final_Records", "Dropped_Records")
    return writers.read_run_metrics(spark, metrics).select(
        "Environment", *[F.col(c).cast("bigint").alias(c) for c in counts]
    )


_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in CLEAN_COLUMNS)


@check("s14_preview", f"SELECT * FROM clean ORDER BY {_ORDER} LIMIT 10")
def _(spark, sf_dir):
    return selection.preview(cleaned(spark, sf_dir), 10, CLEAN_COLUMNS)


@check(
    "d18_dictionary",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{dtype.simpleString()}' AS data_type,"
        f" {rounded(f'100*(count(*) - count({name}))', 'count(*)')} AS null_pct FROM raw"
        for name, dtype in RAW_FIELDS
    ),
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "d18")
    writers.write_raw_csv(profiling.dictionary_of(raw(spark, sf_dir)), path)
    listed = readers.read_dictionary(spark, path, ["null_pct"])
    return listed.withColumn("null_pct", F.col("null_pct").cast("double"))
