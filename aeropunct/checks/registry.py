"""Registered queries, each next to the SQL that another engine checks it with."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropunct.operators.cleaning import clean
from aeropunct.schema import CAUSE_COLUMNS, CLEAN_FIELDS, RAW_COLUMNS
from aeropunct.session import scratch_dir
from aeropunct.sources import star
from aeropunct.sources.readers import read_flights
from aeropunct.sources.writers import write_parquet

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    run: Runner
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query and, where SQL can say the same, its SQL."""

    def register(run: Runner) -> Runner:
        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")
        CHECKS[name] = Check(run, _with_views(sql) if sql else None)
        return run

    return register


# -- inputs of the Spark side -------------------------------------------------


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.raw_flights(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned table of the raw view, which holds no copies."""
    return clean(star.raw_flights(spark, sf_dir), drop_copies=False)


def finished(spark: SparkSession, report: DataFrame, label: str) -> DataFrame:
    """The report written to the shared scratch folder and read back.

    Roll-ups read a report several times; reading the flights as often would
    cost as many scans of the whole table.
    """
    path = scratch_dir(spark, label)
    write_parquet(report, path)
    return read_flights(spark, path)


def comparable(df: DataFrame) -> DataFrame:
    """Raw columns in types that every client reads alike: dates as text, and the
    causes, whole numbers with nulls, as double."""
    casts = {"fl_date": "string", **dict.fromkeys(CAUSE_COLUMNS, "double")}
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else c for c in df.columns])


def comparable_sql(columns: Sequence[str] = RAW_COLUMNS) -> str:
    """Select list of the same."""
    casts = {"fl_date": "VARCHAR", **dict.fromkeys(CAUSE_COLUMNS, "DOUBLE")}
    return ", ".join(f"CAST({c} AS {casts[c]}) AS {c}" if c in casts else c for c in columns)


# -- the same inputs as SQL views ---------------------------------------------

_SQL_TYPES = {"float": "FLOAT", "int": "INT", "string": "VARCHAR"}


def _clean_column(name: str, kind: str) -> str:
    source = "floor(crs_dep_time/100)" if name == "hour" else name
    if name in CAUSE_COLUMNS:
        source = f"coalesce({name}, 0)"
    return f"CAST({source} AS {_SQL_TYPES[kind]}) AS {name}"


_SHAPED = "SELECT " + ", ".join(
    _clean_column(name, dtype.simpleString()) for name, dtype in CLEAN_FIELDS
)
_QUALITY = """distance > 0 AND origin IS NOT NULL AND dest IS NOT NULL AND (
  (cancelled = 0 AND cancellation_code IS NULL AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL)
  OR (cancelled = 1 AND cancellation_code IS NOT NULL))"""

BAND_CASE = """CASE WHEN dep_delay IS NULL THEN 'UNKNOWN' WHEN dep_delay > 60 THEN 'HIGH'
  WHEN dep_delay < 15 THEN 'LOW' ELSE 'MEDIUM' END"""
PEAK = "greatest(carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay)"
CAUSE_CASE = f"""CASE WHEN cancelled = 1 THEN 'CANCELLED_' || ifnull(cancellation_code, 'UNKNOWN')
  WHEN {PEAK} <= 0 THEN 'NONE'
  WHEN carrier_delay = {PEAK} THEN 'CARRIER'
  WHEN weather_delay = {PEAK} THEN 'WEATHER'
  WHEN nas_delay = {PEAK} THEN 'NAS'
  WHEN security_delay = {PEAK} THEN 'SECURITY'
  ELSE 'LATE_AIRCRAFT' END"""


def rounded(numerator: str, denominator: str) -> str:
    """Quotient of integers, rounded half up to two decimals by integer arithmetic."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST(nullif({denominator}, 0) AS HUGEINT)"
    return f"CAST(sign({n}) * ((200*abs({n}) + {d}) // (2*{d})) / 100.0 AS DOUBLE)"


def hundredths(numerator: str, denominator: str) -> str:
    """As :func:`rounded`, in hundredths as an integer."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST(nullif({denominator}, 0) AS HUGEINT)"
    return f"CAST(sign({n}) * ((200*abs({n}) + {d}) // (2*{d})) AS BIGINT)"


def two_decimals(numerator: str, denominator: str) -> str:
    """As :func:`rounded`, as text."""
    size = rounded(f"abs({numerator})", denominator)
    return f"CASE WHEN {numerator} < 0 THEN '-' ELSE '' END || printf('%.2f', {size})"


FLOWN_SUM = "coalesce(sum(CAST(coalesce(arr_delay, 0) AS BIGINT)) FILTER (WHERE cancelled <> 1), 0)"
FLOWN = "count(*) FILTER (WHERE cancelled <> 1)"
GONE = "count(*) FILTER (WHERE cancelled = 1)"
DEP_SUM = "sum(CAST(dep_delay AS BIGINT))"
ARR_SUM = "sum(CAST(arr_delay AS BIGINT))"


def _punctuality(keys: str, place: str) -> str:
    return f"""
SELECT {keys}, {place} count(*) AS total_flights,
  coalesce(CAST(min(coalesce(arr_delay, 0)) FILTER (WHERE cancelled <> 1) AS DOUBLE), 0.0) AS low,
  coalesce(CAST(max(coalesce(arr_delay, 0)) FILTER (WHERE cancelled <> 1) AS DOUBLE), 0.0) AS high,
  CAST({FLOWN_SUM} AS BIGINT) AS delay_sum, {FLOWN} AS flown, {GONE} AS gone,
  '[' || array_to_string(list_sort(list(DISTINCT month)), ', ') || ']' AS months
FROM clean GROUP BY ALL"""


# Views by name, in the order of their dependencies.
VIEWS = {
    "raw": star.raw_flights_sql(),
    "raw_copies": star.raw_flights_sql(copies=True),
    "raw_ids": star.raw_flights_sql(ids=True),
    "runs": star.run_metrics_sql(),
    "clean": f"{_SHAPED} FROM raw WHERE {_QUALITY}",
    "clean_distinct": f"{_SHAPED} FROM (SELECT DISTINCT * FROM raw_copies) AS d WHERE {_QUALITY}",
    "shaped": f"{_SHAPED} FROM raw",
    "airport_parts": _punctuality("op_unique_carrier, origin", ""),
    "route_parts": _punctuality("op_unique_carrier", "origin || '-' || dest AS route,"),
    "base": f"SELECT *, {BAND_CASE} AS delay_band, {CAUSE_CASE} AS primary_cause FROM clean",
    "band_stats": f"""
SELECT origin, month, delay_band, count(*) AS total_flights,
  {hundredths(DEP_SUM, "count(dep_delay)")} AS dep100,
  {hundredths(ARR_SUM, "count(arr_delay)")} AS arr100
FROM base GROUP BY origin, month, delay_band""",
    "causes": """
SELECT origin, month, delay_band, primary_cause, count(*) AS cause_freq FROM base
WHERE primary_cause <> 'NONE' GROUP BY origin, month, delay_band, primary_cause""",
    "ranked_causes": """
SELECT *, row_number() OVER most_frequent AS rnk FROM causes
WINDOW most_frequent AS (PARTITION BY origin, month, delay_band
  ORDER BY -cause_freq, primary_cause)""",
    "cause_lists": """
SELECT origin, month, delay_band, list(primary_cause ORDER BY rnk) AS top FROM ranked_causes
GROUP BY ALL""",
    "band_report": """
SELECT origin, month, delay_band, total_flights,
  dep100/100.0 AS avg_dep_delay, arr100/100.0 AS avg_arr_delay,
  top[1] AS top_cause_1, top[2] AS top_cause_2, top[3] AS top_cause_3
FROM band_stats LEFT JOIN cause_lists USING (origin, month, delay_band)""",
    "carriers": f"""
SELECT origin, op_unique_carrier, count(*) AS total_flights,
  {hundredths(DEP_SUM, "count(dep_delay)")} AS dep100,
  {rounded(ARR_SUM, "count(arr_delay)")} AS avg_arr_delay,
  {rounded("100*sum(cancelled)", "count(cancelled)")} AS cancellation_rate
FROM clean GROUP BY origin, op_unique_carrier""",
    "airports": f"""
SELECT origin, {hundredths(DEP_SUM, "count(dep_delay)")} AS airport100
FROM clean GROUP BY origin""",
    "ranking": """
SELECT c.origin, op_unique_carrier, total_flights, dep100/100.0 AS avg_dep_delay, avg_arr_delay,
  cancellation_rate, airport100/100.0 AS airport_avg_dep_delay,
  (dep100 - airport100)/100.0 AS diff_from_airport_avg,
  CAST(rank() OVER (PARTITION BY c.origin ORDER BY dep100 ASC NULLS FIRST) AS INT) AS carrier_rank,
  dep100 - airport100 AS diff100
FROM carriers c JOIN airports a ON c.origin = a.origin""",
}


def _with_views(body: str) -> str:
    """The query with the views it uses, directly or through others."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name, sql in VIEWS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                pending.append(sql)
    views = [f"{name} AS (\n{sql.strip()}\n)" for name, sql in VIEWS.items() if name in needed]
    prefix = "WITH " + ",\n".join(views) + "\n" if views else ""
    return prefix + body.strip()
