"""Schemas and column groups of the flight data model."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# Names, order and types of the public flight record and of the
# reports made from it.
# ---------------------------------------------------------------------------
RAW_FIELDS: tuple[tuple[str, DataType], ...] = (
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("day_of_month", IntegerType()),
    ("day_of_week", IntegerType()),
    ("fl_date", DateType()),
    ("op_unique_carrier", StringType()),
    ("op_carrier_fl_num", DoubleType()),
    ("origin", StringType()),
    ("origin_city_name", StringType()),
    ("origin_state_nm", StringType()),
    ("dest", StringType()),
    ("dest_city_name", StringType()),
    ("dest_state_nm", StringType()),
    ("crs_dep_time", IntegerType()),
    ("dep_time", DoubleType()),
    ("dep_delay", DoubleType()),
    ("taxi_out", DoubleType()),
    ("wheels_off", DoubleType()),
    ("wheels_on", DoubleType()),
    ("taxi_in", DoubleType()),
    ("crs_arr_time", IntegerType()),
    ("arr_time", DoubleType()),
    ("arr_delay", DoubleType()),
    ("cancelled", IntegerType()),
    ("cancellation_code", StringType()),
    ("diverted", IntegerType()),
    ("crs_elapsed_time", DoubleType()),
    ("actual_elapsed_time", DoubleType()),
    ("air_time", DoubleType()),
    ("distance", DoubleType()),
    ("carrier_delay", IntegerType()),
    ("weather_delay", IntegerType()),
    ("nas_delay", IntegerType()),
    ("security_delay", IntegerType()),
    ("late_aircraft_delay", IntegerType()),
)

# Columns kept by cleaning, by target type.
FLOAT_COLUMNS = ("distance", "dep_delay", "arr_delay")
CAUSE_COLUMNS = (
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
)
INT_COLUMNS = ("month", "crs_dep_time", "cancelled", *CAUSE_COLUMNS)
STRING_COLUMNS = ("op_unique_carrier", "origin", "dest", "cancellation_code")
KEPT_COLUMNS = (*FLOAT_COLUMNS, *INT_COLUMNS, *STRING_COLUMNS)

# A physical flight: rows that agree on these are logical duplicates.
LOGICAL_KEY = (
    "fl_date",
    "crs_dep_time",
    "op_unique_carrier",
    "op_carrier_fl_num",
    "origin",
    "dest",
)

CLEAN_FIELDS: tuple[tuple[str, DataType], ...] = (
    ("distance", FloatType()),
    ("dep_delay", FloatType()),
    ("arr_delay", FloatType()),
    ("month", IntegerType()),
    ("cancelled", IntegerType()),
    ("carrier_delay", IntegerType()),
    ("weather_delay", IntegerType()),
    ("nas_delay", IntegerType()),
    ("security_delay", IntegerType()),
    ("late_aircraft_delay", IntegerType()),
    ("op_unique_carrier", StringType()),
    ("origin", StringType()),
    ("dest", StringType()),
    ("cancellation_code", StringType()),
    ("hour", IntegerType()),
)

BAND_REPORT_FIELDS: tuple[tuple[str, DataType], ...] = (
    ("origin", StringType()),
    ("month", IntegerType()),
    ("delay_band", StringType()),
    ("total_flights", LongType()),
    ("avg_dep_delay", DoubleType()),
    ("avg_arr_delay", DoubleType()),
    ("top_cause_1", StringType()),
    ("top_cause_2", StringType()),
    ("top_cause_3", StringType()),
)

RANKING_FIELDS = (
    "origin",
    "op_unique_carrier",
    "total_flights",
    "avg_dep_delay",
    "avg_arr_delay",
    "cancellation_rate",
    "airport_avg_dep_delay",
    "diff_from_airport_avg",
    "carrier_rank",
)

CLEANING_METRICS = (
    "Environment",
    "Dataset",
    "Execution_Time_Sec",
    "Initial_Records",
    "Final_Records",
    "Dropped_Records",
    # Before, after and dropped of each step: copies, then the quality rule.
    "Duplicates_Before_Records",
    "Duplicates_After_Records",
    "Duplicates_Dropped_Records",
    "Quality_Before_Records",
    "Quality_After_Records",
    "Quality_Dropped_Records",
    # Lines with too few or too many cells, and cells that are no value of their type.
    "Broken_Records",
    "Unconverted_Cells",
)
GENERATION_METRICS = ("Environment", "Generated_Dataset", "Execution_Time_Sec")
RUN_METRICS = ("Environment", "Dataset", "Execution_Time_Sec")
SKIPPING_METRICS = (*RUN_METRICS, "Skipped_Records")
# ---------------------------------------------------------------------------

# What a checked read adds to each raw record: its unconverted cells, and its broken line.
RAW_EXTRAS = ("_unconverted", "_broken_line")


def _struct(fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


RAW_SCHEMA = _struct(RAW_FIELDS)
RAW_COLUMNS = tuple(name for name, _ in RAW_FIELDS)
CLEAN_SCHEMA = _struct(CLEAN_FIELDS)
CLEAN_COLUMNS = tuple(name for name, _ in CLEAN_FIELDS)
BAND_REPORT_SCHEMA = _struct(BAND_REPORT_FIELDS)
