"""The jobs and their files."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from conftest import ROOT, SF_DIR
from pyspark.sql import functions as F

from aeropunct.__main__ import JOBS, parse, run
from aeropunct.operators import profiling, reports, rollups, sampling
from aeropunct.plans import jobs
from aeropunct.schema import BAND_REPORT_SCHEMA, CLEANING_METRICS, RAW_SCHEMA, SKIPPING_METRICS
from aeropunct.session import scratch_dir
from aeropunct.sources import readers, writers
from aeropunct.sources.star import raw_flights


@pytest.fixture(scope="module")
def raw_path(spark, raw):
    path = scratch_dir(spark, "csv")
    writers.write_raw_csv(raw, path)
    return path


@pytest.fixture(scope="module")
def clean_path(spark, cleaned):
    path = scratch_dir(spark, "table")
    writers.write_parquet(cleaned, path)
    return path


def same_rows(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(a.columns)).count() == 0


def test_csv_round_trip_with_commas_and_nulls(spark, raw, raw_path):
    back = readers.read_raw(spark, raw_path)
    assert back.schema == RAW_SCHEMA
    assert same_rows(back, raw)
    assert back.filter(F.col("origin_city_name").contains(",")).count() == back.count()


def test_inferred_schema_reads_the_same_values(spark, raw, raw_path):
    inferred = readers.read_raw(spark, raw_path, infer=True)
    kinds = dict(inferred.dtypes)
    assert (kinds["month"], kinds["dep_delay"], kinds["dest"]) == ("int", "double", "string")
    assert inferred.agg(F.sum("dep_delay")).first() == raw.agg(F.sum("dep_delay")).first()


def test_columns_are_bound_by_the_names_of_the_header(spark, raw, raw_path):
    path = scratch_dir(spark, "turned")
    names = [F.col(c).alias(f" {c.upper()}") for c in reversed(raw.columns) if c != "taxi_in"]
    writers.write_raw_csv(raw.select(F.lit("1,2").alias("re,mark"), *names), path)
    back = readers.read_raw(spark, path)
    assert back.schema == RAW_SCHEMA
    assert same_rows(back, raw.withColumn("taxi_in", F.lit(None).cast("double")))
    packed = scratch_dir(spark, "packed")
    raw.write.option("compression", "gzip").csv(packed, header=True)
    assert same_rows(readers.read_raw(spark, packed), raw)


def test_headers_that_cannot_be_bound_are_refused(spark, raw, tmp_path):
    (tmp_path / "none.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="none of the declared"):
        readers.read_raw(spark, str(tmp_path / "none.csv"))
    (tmp_path / "twice.csv").write_text("month,Month\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        readers.read_raw(spark, str(tmp_path / "twice.csv"))
    with pytest.raises(ValueError, match="no file"):
        readers.read_raw(spark, str(tmp_path / "absent"))
    # A second file with its columns in another order than the first is no silent mix-up.
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    (mixed / "a.csv").write_text("origin,dest\nJFK,LAX\n")
    (mixed / "b.csv").write_text("dest,origin\nLAX,JFK\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_raw(spark, str(mixed)).collect()


def spoiled(tmp_path):
    """Two files of raw text: good rows, cells that are no numbers, and broken lines."""
    cells = dict.fromkeys(RAW_SCHEMA.names, "") | {
        "fl_date": "2024-01-02", "month": "1", "crs_dep_time": "930", "cancelled": "0", "op_unique_carrier": "AA",
        "origin": "JFK", "dest": "LAX", "distance": "100", "dep_delay": "1", "arr_delay": "2",
    }
    line = lambda **more: ",".join((cells | more)[c] for c in RAW_SCHEMA.names)
    folder = tmp_path / "spoiled"
    folder.mkdir()
    header = ",".join(RAW_SCHEMA.names)
    one = [line(), line(dep_delay="late"), line(month="Jan", distance="far"), line(), "2024,1,broken"]
    two = [line(origin="SFO"), "", line(origin="SFO") + ",more", line(arr_delay="?")]
    (folder / "one.csv").write_text("\n".join([header, *one]) + "\n")
    (folder / "two.csv").write_text("\n".join([header, *two]) + "\n")
    return folder, line(origin="SFO") + ",more"


def test_rejected_cells_and_broken_lines(spark, tmp_path):
    folder, long_line = spoiled(tmp_path)
    found = readers.rejected_cells(spark, str(folder)).collect()
    got = {(r.file.rsplit("/", 1)[1], r.row, r.column, r.value) for r in found}
    assert got == {
        ("one.csv", 2, "dep_delay", "late"),
        ("one.csv", 3, "month", "Jan"),
        ("one.csv", 3, "distance", "far"),
        ("one.csv", 5, "day_of_month", "broken"),
        ("one.csv", 5, None, "2024,1,broken"),
        ("two.csv", 2, None, long_line),
        ("two.csv", 3, "arr_delay", "?"),
    }


def test_rows_are_numbered_across_blocks(spark, tmp_path):
    lines = ["month,origin"] + [f"{'x' if i % 50 == 0 else 1},A{i}" for i in range(1, 2001)]
    (tmp_path / "long.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = readers.rejected_cells(spark, str(tmp_path / "long.csv")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.row for r in found) == list(range(50, 2001, 50))


def test_cleaning_counts_each_step_and_every_bad_cell(spark, tmp_path):
    folder, _ = spoiled(tmp_path)
    out, metrics, rejects = (str(tmp_path / x) for x in ("out", "metrics", "rejects"))
    table = jobs.run_cleaning(spark, str(folder), out, "Local_1", metrics, rejects)
    plain = jobs.run_cleaning(spark, str(folder), str(tmp_path / "plain"), "Local_1")
    assert same_rows(table, plain) and table.schema == plain.schema
    row = writers.read_run_metrics(spark, metrics).first().asDict()
    # The longer line has the cells of the row before it, so it is a copy of that row.
    want = {
        "Initial_Records": 8, "Final_Records": 2, "Dropped_Records": 6,
        "Duplicates_Before_Records": 8, "Duplicates_After_Records": 6, "Duplicates_Dropped_Records": 2,
        "Quality_Before_Records": 6, "Quality_After_Records": 2, "Quality_Dropped_Records": 4,
        "Broken_Records": 2, "Unconverted_Cells": 5,
    }
    assert {k: row[k] for k in want} == want
    assert spark.read.parquet(rejects).count() == 7


def test_cleaning_with_metrics_reads_the_text_once(spark, raw_path, monkeypatch):
    reads, read = [], readers.read_raw
    monkeypatch.setattr(readers, "read_raw", lambda *a, **k: reads.append(a) or read(*a, **k))
    jobs.run_cleaning(spark, raw_path, scratch_dir(spark, "o"), "Local_1", scratch_dir(spark, "m"))
    plans = [read(spark, raw_path, checked=True)]
    staged = jobs.clean_with_counts(plans[0])
    text = staged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(reads) == 1 and text.count("FileScan csv") == 1


def test_cleaning_job(spark, raw_path, cleaned):
    out, metrics = scratch_dir(spark, "out"), scratch_dir(spark, "metrics")
    for _ in range(2):
        table = jobs.run_cleaning(spark, raw_path, out, "Local_1", metrics)
    assert same_rows(table, cleaned)
    rows = writers.read_run_metrics(spark, metrics)
    assert tuple(rows.columns) == CLEANING_METRICS
    # Two runs, two rows, no header among them.
    assert rows.count() == 2
    first = rows.first()
    assert first.Environment == "Local_1" and first.Dataset == raw_path.rsplit("/", 1)[-1]
    assert first.Initial_Records - first.Final_Records == first.Dropped_Records > 0


def test_scaling_job(spark, clean_path, cleaned):
    out, metrics = scratch_dir(spark, "scaled"), scratch_dir(spark, "metrics")
    paths = jobs.run_scaling(spark, clean_path, out, "Local_1", metrics)
    n = cleaned.count()
    assert list(paths) == [f"flight_{p}" for p in (10, 25, 50, 75, 150, 200, 300)]
    for name, path in paths.items():
        pct = int(name.split("_")[1])
        table = readers.read_flights(spark, path)
        assert path.endswith(f"{name}.parquet")
        assert table.schema == readers.read_flights(spark, clean_path).schema
        assert abs(table.count() - n * pct / 100) < (1 if pct in (200, 300) else 5 * (n / 4) ** 0.5)
    assert writers.read_run_metrics(spark, metrics).count() == 7
    # Nothing but the data sets is left, and a second run takes their place.
    assert len(jobs.run_scaling(spark, clean_path, out, "Local_1")) == 7
    folder = spark._jvm.java.io.File(out.removeprefix("file://"))
    assert sorted(folder.list()) == sorted(f"{name}.parquet" for name in paths)


def test_scaling_is_one_scan_and_its_samples_are_nested(spark, clean_path, cleaned):
    for keys in (None, ["origin", "dest", "distance", "hour"]):
        marked = sampling.scaled_family(readers.read_flights(spark, clean_path), keys=keys)
        text = marked._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 1 and "Exchange" not in text
        counts = dict(marked.groupBy(sampling.DATASET).count().collect())
        n = cleaned.count()
        assert (counts["flight_200"], counts["flight_300"]) == (2 * n, 3 * n)
        assert counts["flight_150"] == n + counts["flight_50"]
        small, large = (marked.filter(F.col(sampling.DATASET) == f"flight_{p}") for p in (10, 25))
        assert small.drop(sampling.DATASET).exceptAll(large.drop(sampling.DATASET)).count() == 0


def test_a_data_set_without_rows_is_an_empty_table(spark, cleaned):
    out = scratch_dir(spark, "few")
    few = cleaned.limit(0).withColumn("set", F.lit("a")).unionByName(cleaned.limit(1).withColumn("set", F.lit("a")))
    paths = writers.write_datasets(few, "set", ["a", "b"], out)
    assert [readers.read_flights(spark, paths[x]).count() for x in "ab"] == [1, 0]
    assert readers.read_flights(spark, paths["b"]).schema == cleaned.schema


def test_carrier_report_job_is_one_sorted_file(spark, clean_path, cleaned):
    out, metrics = scratch_dir(spark, "text"), scratch_dir(spark, "metrics")
    text = jobs.run_carrier_report(
        spark, clean_path, out, "Local_1", metrics, level="route", single_file=True
    )
    assert len(text.inputFiles()) == 1
    keys = [line.value.split("\t")[0] for line in spark.read.text(out).collect()]
    assert keys == sorted(keys, key=lambda k: k.encode())
    assert len(keys) == reports.carrier_route_stats(cleaned).count()
    assert tuple(writers.read_run_metrics(spark, metrics).columns) == SKIPPING_METRICS


def test_keyed_text_parts_are_in_order(spark, cleaned):
    out = scratch_dir(spark, "parts")
    text = reports.format_stats(reports.carrier_route_stats(cleaned), "route")
    writers.write_keyed_text(text, out, single_file=False)
    parts = sorted(spark.read.text(out).inputFiles())
    keys = [r.value for p in parts for r in spark.read.text(p).collect()]
    assert keys == sorted(keys, key=lambda k: k.split("\t")[0].encode())


def test_band_report_job(spark, clean_path, cleaned):
    out, one = scratch_dir(spark, "band"), scratch_dir(spark, "one")
    parts = jobs.run_band_report(spark, clean_path, out, "Local_1", single_csv=one)
    expected = reports.band_report(cleaned)
    assert same_rows(parts, expected)
    single = readers.read_delimited(spark, one)
    assert len(single.inputFiles()) == 1 and same_rows(single, expected)
    lines = [r.value for r in spark.read.text(one).collect()]
    assert lines[0] == ",".join(BAND_REPORT_SCHEMA.names)
    assert any("\\N" in line for line in lines)
    inferred = readers.read_delimited(spark, one, schema=None)
    assert dict(inferred.dtypes)["avg_dep_delay"] == "double"
    assert inferred.filter("avg_dep_delay IS NULL").count() == expected.filter(
        "avg_dep_delay IS NULL"
    ).count()


def test_ranking_job(spark, clean_path, cleaned):
    out = scratch_dir(spark, "rank")
    assert same_rows(
        jobs.run_ranking(spark, clean_path, out, "Local_1"), reports.carrier_ranking(cleaned)
    )


def test_registering_a_table_again_keeps_its_files(spark, clean_path, cleaned):
    readers.use_database(spark, "airlines")
    try:
        for _ in range(2):
            table = readers.register_flights(spark, "flights", clean_path)
        assert table.count() == cleaned.count()
        assert spark.catalog.currentDatabase() == "airlines"
        stats = jobs.band_stats_sql(spark, "airlines.flights", medium_from=15, high_above=60)
        rounded = reports.band_stats(cleaned).select(
            *reports.BAND_KEYS,
            "total_flights",
            *[F.round(c, 2).alias(c) for c in ("avg_dep_delay", "avg_arr_delay")],
        )
        assert same_rows(stats, rounded)
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_dictionary(spark, raw):
    path = scratch_dir(spark, "dictionary")
    writers.write_raw_csv(profiling.dictionary_of(raw), path)
    listed = readers.read_dictionary(spark, path)
    assert listed.columns == ["column_name", "data_type"] and listed.count() == 35


def test_scratch_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_whole_numbers_with_a_decimal_point_are_kept(spark, tmp_path):
    path = tmp_path / "raw.csv"
    cells = dict.fromkeys(RAW_SCHEMA.names, "") | {
        "fl_date": "2024-01-02", "month": "1.0", "crs_dep_time": "930.0", "cancelled": "0.0",
        "op_unique_carrier": "AA", "origin": "JFK", "dest": "LAX", "distance": "100",
        "dep_delay": "x", "arr_delay": "2.5",
    }
    good = cells | {"dep_delay": "1"}
    lines = [",".join(row[c] for c in RAW_SCHEMA.names) for row in (cells, good)]
    path.write_text("\n".join([",".join(RAW_SCHEMA.names), *lines]) + "\n")
    table = jobs.run_cleaning(spark, str(path), str(tmp_path / "out"), "Local_1")
    assert [(r.month, r.cancelled, r.hour) for r in table.collect()] == [(1, 0, 9)]
    lost = readers.unconverted_cells(readers.read_raw_text(spark, str(path)))
    assert [tuple(r) for r in lost.filter("cells > 0").collect()] == [("dep_delay", 1)]


def test_skipped_rows_reach_the_metrics(spark, flights, tmp_path):
    path = str(tmp_path / "flights")
    rows = [{}, {"month": None}, {"dest": None}, {"cancelled": None}, {"origin": None, "month": None}]
    writers.write_parquet(flights(*rows), path)
    metrics = {x: str(tmp_path / f"m{x}") for x in ("airport", "route", "both")}
    for level in ("airport", "route"):
        jobs.run_carrier_report(
            spark, path, str(tmp_path / level), "Local_1", metrics[level], level=level
        )
    both = jobs.run_carrier_reports(spark, path, str(tmp_path / "both"), "Local_1", metrics["both"])
    skipped = {x: writers.read_run_metrics(spark, m).first().Skipped_Records for x, m in metrics.items()}
    assert skipped == {"airport": 3, "route": 4, "both": 4}
    text = {x: df.first().Value.split(" | ")[0] for x, df in both.items()}
    assert text == {"airport": "Flights Operated: 2", "route": "Flights Operated: 1"}
    with pytest.raises(ValueError, match="level"):
        jobs.run_carrier_report(spark, path, str(tmp_path / "x"), "Local_1", level="town")


def test_metrics_to_summary(spark, clean_path, tmp_path):
    folders = {"hive": str(tmp_path / "a"), "spark": str(tmp_path / "b")}
    named = str(tmp_path / "flight_100.parquet")
    writers.write_parquet(readers.read_flights(spark, clean_path), named)
    jobs.run_band_report(spark, named, str(tmp_path / "band"), "Local_1", folders["hive"])
    jobs.run_carrier_report(spark, named, str(tmp_path / "air"), "Local_1", folders["spark"])
    metrics = writers.read_labelled_metrics(spark, folders)
    summary = rollups.run_summary(metrics, environment="Local_1")
    assert {(r.view, r.Framework, r.label) for r in summary.collect()} == {
        (view, name, label)
        for view, label in (("scale_out", "Local_1"), ("scale_up", "100"))
        for name in folders
    }


def test_command_line(spark, tmp_path, clean_path):
    out, metrics = tmp_path / "ranking", tmp_path / "metrics"
    command = [sys.executable, "-m", "aeropunct", "ranking", clean_path, str(out), "Local_1"]
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--conf spark.ui.enabled=false pyspark-shell"}
    subprocess.run(
        [*command, "--metrics", str(metrics)], cwd=ROOT, check=True, timeout=300,
        capture_output=True, env=env,
    )
    assert spark.read.parquet(str(out)).count() > 0
    assert writers.read_run_metrics(spark, str(metrics)).first().Environment == "Local_1"


@pytest.mark.parametrize("job", sorted(JOBS))
def test_every_job_from_its_arguments(spark, job, raw_path, clean_path):
    out, metrics, one = (scratch_dir(spark, x) for x in ("cli", "climetrics", "clione"))
    source = raw_path if job in ("clean", "profile", "trends") else clean_path
    args = [job, source, out, "Local_1", "--metrics", metrics, "--single-csv", one]
    run(spark, parse([*args, "--keys", "origin", "dest", "distance"]))
    written = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(out)
    assert written.count() > 0
    assert writers.read_run_metrics(spark, metrics).count() == (7 if job == "scale" else 1)
    if job == "band-report":
        assert readers.read_delimited(spark, one).count() > 0


def test_adapter_has_no_copies_by_default(spark):
    df = raw_flights(spark, SF_DIR)
    assert profiling.exact_dups(df).first().duplicates == 0
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    assert df.count() == lines
