"""The jobs: read, compute, write, and record the run."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropunct.operators import reports, rollups, sampling, trends
from aeropunct.operators.cleaning import accounting_of, clean, clean_with_counts
from aeropunct.operators.whole_profile import whole_profile
from aeropunct.schema import (
    BAND_REPORT_SCHEMA,
    CLEAN_COLUMNS,
    CLEANING_METRICS,
    GENERATION_METRICS,
    RAW_EXTRAS,
    RUN_METRICS,
    SKIPPING_METRICS,
)
from aeropunct.session import remove, scratch_dir
from aeropunct.sources import readers, writers


def _dataset(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run_cleaning(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    environment: str,
    metrics_path: str | None = None,
    rejects_path: str | None = None,
) -> DataFrame:
    """Raw CSV to the cleaned Parquet table.

    With ``metrics_path`` the metrics row holds the rows before, after and dropped of each
    step, the broken lines and the cells that did not convert; all of them are counted in
    the one read of the raw text. ``rejects_path`` also lists every such cell and line
    with its file and row, as Parquet, from a read of its own.
    """
    # Removing copies shuffles whole records: see build_session for the partitions.
    if metrics_path:
        _clean_counted(spark, raw_path, out_path, environment, metrics_path)
    else:
        writers.write_parquet(clean(readers.read_raw(spark, raw_path)), out_path)
    if rejects_path:
        writers.write_parquet(readers.rejected_cells(spark, raw_path), rejects_path)
    return readers.read_flights(spark, out_path)


def _clean_counted(
    spark: SparkSession, raw_path: str, out_path: str, environment: str, metrics_path: str
) -> None:
    """Cleans and records the counts that came with the distinct records.

    The records are written once with their counts; the table is a copy of those that
    pass, and the counts are sums over a few narrow columns.
    """
    staged = scratch_dir(spark, "records")
    unconverted, broken = RAW_EXTRAS
    measures = {
        "unconverted": F.col(unconverted),
        "broken": F.col(broken).isNotNull().cast("int"),
    }
    try:

        def write() -> None:
            raw = readers.read_raw(spark, raw_path, checked=True)
            writers.write_parquet(clean_with_counts(raw, measures), staged)
            records = readers.read_flights(spark, staged)
            writers.write_parquet(records.filter("consistent").select(*CLEAN_COLUMNS), out_path)

        seconds = _timed(write)
        totals = readers.read_flights(spark, staged).agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
            F.count("*").alias("distinct_rows"),
            F.count_if("consistent").alias("consistent"),
            *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures],
        )
        counted = totals.first()
        steps = {r.step: r for r in accounting_of(totals).collect()}
    finally:
        remove(spark, staged)
    row = {
        "Environment": environment,
        "Dataset": _dataset(raw_path),
        "Execution_Time_Sec": seconds,
        "Initial_Records": counted.total_rows,
        "Final_Records": counted.consistent,
        "Dropped_Records": counted.total_rows - counted.consistent,
        "Broken_Records": counted.broken,
        "Unconverted_Cells": counted.unconverted,
    }
    for step in ("duplicates", "quality"):
        for figure in ("before", "after", "dropped"):
            row[f"{step.title()}_{figure.title()}_Records"] = steps[step][figure]
    writers.append_run_metrics(spark, metrics_path, [row], CLEANING_METRICS)


def run_scaling(
    spark: SparkSession,
    base_path: str,
    out_dir: str,
    environment: str,
    metrics_path: str | None = None,
    keys: Sequence[str] | None = None,
) -> dict[str, str]:
    """Write the seven scaled data sets; gives their paths by name.

    One map-only pass over the Parquet base: every row is written to all data sets that
    hold it. With ``keys`` the samples are chosen by key hash and are the same on every
    cluster. The metrics share the seconds of the pass by the size of the data sets.
    """
    base = readers.read_flights(spark, base_path)
    marked = sampling.scaled_family(base, keys=keys)
    names = list(sampling.SCALES)
    paths = {}

    def write() -> None:
        paths.update(writers.write_datasets(marked, sampling.DATASET, names, out_dir))

    seconds = _timed(write)
    if metrics_path:
        whole = sum(sampling.SCALES.values())
        rows = [
            {
                "Environment": environment,
                "Generated_Dataset": name,
                "Execution_Time_Sec": round(seconds * size / whole, 3),
            }
            for name, size in sampling.SCALES.items()
        ]
        writers.append_run_metrics(spark, metrics_path, rows, GENERATION_METRICS)
    return paths


def _recorded(
    spark: SparkSession,
    in_path: str,
    environment: str,
    metrics_path: str | None,
    action: Callable[[], object],
    skipped: Callable[[], int] | None = None,
) -> None:
    seconds = _timed(action)
    if metrics_path:
        row = {
            "Environment": environment,
            "Dataset": _dataset(in_path),
            "Execution_Time_Sec": seconds,
        }
        if skipped:
            row["Skipped_Records"] = skipped()
        columns = SKIPPING_METRICS if skipped else RUN_METRICS
        writers.append_run_metrics(spark, metrics_path, [row], columns)


def _carrier_reports(
    spark: SparkSession,
    in_path: str,
    paths: dict[str, str],
    environment: str,
    metrics_path: str | None,
    single_file: bool,
) -> None:
    """Reports of one or both levels and the count of skipped rows, from one scan.

    All of them follow from a small table of parts, which is kept as files while the
    job runs, so that a lost executor does not cost another scan.
    """
    if len(paths) == 1 and not metrics_path:
        # Nothing else reads the parts: the report follows from the scan at once.
        ((level, path),) = paths.items()
        flights = readers.read_flights(spark, in_path)
        writers.write_keyed_text(reports.carrier_report(flights, level), path, single_file)
        return
    keys = reports.LEVEL_KEYS["route" if "route" in paths else "airport"]
    # A row is skipped by the strictest report that was asked for.
    kept = scratch_dir(spark, "parts")
    try:

        def write() -> None:
            flights = readers.read_flights(spark, in_path)
            writers.write_parquet(reports.punctuality_parts(flights, keys), kept)
            parts = readers.read_flights(spark, kept)
            for level, path in paths.items():
                writers.write_keyed_text(reports.report_of_parts(parts, level), path, single_file)

        def skipped() -> int:
            return reports.skipped_rows(readers.read_flights(spark, kept), keys).first()[0]

        _recorded(spark, in_path, environment, metrics_path, write, skipped)
    finally:
        remove(spark, kept)


def run_carrier_report(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    environment: str,
    metrics_path: str | None = None,
    level: str = "airport",
    single_file: bool = False,
) -> DataFrame:
    """Carrier statistics per airport or route as sorted report text.

    The metrics row holds the number of rows skipped for want of a required field.
    """
    if level not in reports.LEVEL_KEYS:
        raise ValueError(f"level is one of {', '.join(reports.LEVEL_KEYS)}, not {level!r}")
    _carrier_reports(spark, in_path, {level: out_path}, environment, metrics_path, single_file)
    return readers.read_keyed_text(spark, out_path)


def run_carrier_reports(
    spark: SparkSession,
    in_path: str,
    out_dir: str,
    environment: str,
    metrics_path: str | None = None,
    single_file: bool = False,
) -> dict[str, DataFrame]:
    """Airport and route report from a single scan of the flights."""
    paths = {level: f"{out_dir.rstrip('/')}/{level}" for level in reports.LEVEL_KEYS}
    _carrier_reports(spark, in_path, paths, environment, metrics_path, single_file)
    return {level: readers.read_keyed_text(spark, path) for level, path in paths.items()}


def run_band_report(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    environment: str,
    metrics_path: str | None = None,
    single_csv: str | None = None,
) -> DataFrame:
    """Band report as delimited text, and on demand as one CSV file with a header."""
    report = reports.band_report(readers.read_flights(spark, in_path))
    _recorded(
        spark, in_path, environment, metrics_path, lambda: writers.write_delimited(report, out_path)
    )
    written = readers.read_delimited(spark, out_path, BAND_REPORT_SCHEMA, header=False)
    if single_csv:
        writers.write_single_csv(written, single_csv, reports.BAND_KEYS)
    return written


def run_ranking(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    environment: str,
    metrics_path: str | None = None,
) -> DataFrame:
    """Carriers ranked against their airport's average, as Parquet."""
    ranking = reports.carrier_ranking(readers.read_flights(spark, in_path))
    _recorded(
        spark, in_path, environment, metrics_path, lambda: writers.write_parquet(ranking, out_path)
    )
    return readers.read_flights(spark, out_path)


def run_profile(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    environment: str,
    metrics_path: str | None = None,
) -> DataFrame:
    """The whole profile of raw CSV, as Parquet.

    The text is read once and kept as a converted table while the job runs; the profile
    reads that table three times.
    """
    kept = scratch_dir(spark, "profile")
    try:

        def write() -> None:
            table = f"{kept}/table"
            writers.write_parquet(readers.read_raw(spark, raw_path), table)
            converted = readers.read_flights(spark, table)
            writers.write_parquet(whole_profile(converted, kept), out_path)

        _recorded(spark, raw_path, environment, metrics_path, write)
    finally:
        remove(spark, kept)
    return readers.read_flights(spark, out_path)


def run_trends(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    environment: str,
    metrics_path: str | None = None,
) -> DataFrame:
    """The one- and two-variable statistics of raw CSV, as Parquet."""
    found = trends.trends(readers.read_raw(spark, raw_path))
    _recorded(
        spark, raw_path, environment, metrics_path, lambda: writers.write_parquet(found, out_path)
    )
    return readers.read_flights(spark, out_path)


def run_rollups(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    environment: str,
    metrics_path: str | None = None,
) -> DataFrame:
    """All reports of a cleaned table and their roll-ups, as Parquet, below one folder."""
    base = out_path.rstrip("/")

    def write() -> None:
        text = run_carrier_reports(spark, in_path, f"{base}/carriers", environment)
        band = run_band_report(spark, in_path, f"{base}/bands", environment)
        ranking = run_ranking(spark, in_path, f"{base}/ranking", environment)
        found = report_rollups(
            reports.parse_stats(text["airport"]),
            reports.parse_stats(text["route"], "route"),
            band,
            ranking,
        )
        writers.write_parquet(found, f"{base}/rollups")

    _recorded(spark, in_path, environment, metrics_path, write)
    return readers.read_flights(spark, f"{base}/rollups")


def report_rollups(
    airport_report: DataFrame,
    route_report: DataFrame,
    band_report: DataFrame,
    ranking: DataFrame,
    min_flights: int = rollups.MIN_AIRPORT_FLIGHTS,
) -> DataFrame:
    """Every roll-up of the finished reports as (report, label, item, value)."""

    def rows(report: str, df: DataFrame, label: str, item, value) -> DataFrame:
        return df.select(
            F.lit(report).alias("report"),
            F.col(label).alias("label"),
            item.cast("string").alias("item"),
            value.cast("double").alias("value"),
        )

    def melted(report: str, wide: DataFrame) -> DataFrame:
        measures = [c for c in wide.columns if c != "origin"]
        long = wide.unpivot(["origin"], measures, "item", "value").filter("value IS NOT NULL")
        return rows(report, long, "origin", F.col("item"), F.col("value"))

    nothing = F.lit(None)
    parts = [
        rows(
            "carrier_cancel_rate",
            rollups.carrier_cancel_rollup(airport_report),
            "op_unique_carrier",
            nothing,
            F.col("global_cancel_rate"),
        ),
        rows(
            "airport_delay",
            rollups.airport_delay_rollup(airport_report, min_flights=min_flights),
            "origin",
            nothing,
            F.col("global_avg_delay"),
        ),
        rows(
            "route_delay",
            rollups.route_rollup(route_report),
            "route",
            nothing,
            F.col("global_avg_delay"),
        ),
        melted("month_heatmap", rollups.month_heatmap(band_report)),
        melted("band_share", rollups.band_share(band_report)),
        rows(
            "carrier_airport_diff",
            rollups.diff_cells(ranking),
            "origin",
            F.col("op_unique_carrier"),
            F.col("diff_from_airport_avg"),
        ),
        rows(
            "carrier_diff",
            rollups.carrier_diff_rollup(ranking),
            "op_unique_carrier",
            nothing,
            F.col("global_avg_diff"),
        ),
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined


# The band statistics as SQL text with named parameters, for SQL users.
BAND_STATS_SQL = """
SELECT origin, month,
  CASE WHEN dep_delay IS NULL THEN 'UNKNOWN'
       WHEN dep_delay > :high_above THEN 'HIGH'
       WHEN dep_delay < :medium_from THEN 'LOW'
       ELSE 'MEDIUM' END AS delay_band,
  count(*) AS total_flights,
  round(avg(dep_delay), 2) AS avg_dep_delay,
  round(avg(arr_delay), 2) AS avg_arr_delay
FROM IDENTIFIER(:flights)
GROUP BY ALL
"""


def band_stats_sql(
    spark: SparkSession, flights: str, medium_from: int = 15, high_above: int = 60
) -> DataFrame:
    """Band statistics of a registered table; table and band limits are parameters."""
    return spark.sql(
        BAND_STATS_SQL,
        args={"flights": flights, "medium_from": medium_from, "high_above": high_above},
    )
