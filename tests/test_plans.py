"""Physical plans: what reaches the scan, how often tables are read, what is shuffled."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR

import __spark_entry__  # noqa: F401  registers the queries
from aeropunct.checks.registry import CHECKS
from aeropunct.operators import profiling, reports, sampling, selection, trends
from aeropunct.operators.cleaning import clean
from aeropunct.sources import readers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """Scans of the plan, a reused exchange counted as none."""
    return len(re.findall(r"FileScan", _initial(df)))


def _initial(df):
    return plan(df).split("Initial Plan")[-1]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(CHECKS[name].run(spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert node not in text


@pytest.mark.parametrize(
    "report",
    [
        reports.carrier_ranking,
        reports.band_report,
        reports.carrier_airport_stats,
        reports.carrier_route_stats,
        reports.carrier_stats_by_level,
        trends.trends,
        profiling.profile,
        sampling.oversample_150,
        lambda df: sampling.replicate(df, 3),
        lambda df: sampling.hash_sub_samples(df, ["origin"]),
    ],
)
def test_one_scan(cleaned, report):
    assert scans(report(cleaned)) == 1


def test_profile_has_no_limit_and_no_single_task_but_for_its_result(cleaned):
    text = plan(profiling.profile(cleaned))
    assert "Limit" not in text
    assert len(re.findall("SinglePartition", text.split("Initial Plan")[-1])) == 1


def test_ranking_reads_only_its_columns(cleaned):
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan(reports.carrier_ranking(cleaned)))
    names = {c.split(":")[0] for c in scan.group(1).split(",")}
    assert names == {"origin", "op_unique_carrier", "dep_delay", "arr_delay", "cancelled"}


def test_filters_reach_the_scan(spark, cleaned):
    text = plan(reports.carrier_ranking(cleaned))
    assert "PushedFilters: [IsNotNull(origin)]" in text
    text = plan(reports.carrier_route_stats(cleaned))
    # The plan's text is cut after some filters.
    for c in reports.ROUTE_REQUIRED[:4]:
        assert f"IsNotNull({c})" in re.search(r"PushedFilters: \[([^\]]*)", text).group(1)


@pytest.mark.parametrize(
    "report",
    [
        reports.carrier_airport_stats,
        reports.carrier_route_stats,
        reports.carrier_stats,
        reports.band_stats,
        reports.cause_counts,
    ],
)
def test_aggregates_hash_and_start_before_the_shuffle(cleaned, report):
    text = plan(report(cleaned))
    # The carrier statistics merge the months of a group in a second, small step.
    by_month = report in (reports.carrier_airport_stats, reports.carrier_route_stats)
    assert "partial_count" in text and text.count("Exchange") == (2 if by_month else 1)
    below = text.rsplit("Exchange", 1)[1]
    assert "HashAggregate" in below and "partial_count" in below
    rows = below if by_month else text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in rows


def test_quality_filter_runs_below_dedup(raw):
    lines = optimized(clean(raw)).splitlines()
    depth = {kind: next(i for i, line in enumerate(lines) if kind in line)
             for kind in ("Aggregate", "Filter")}
    assert depth["Filter"] > depth["Aggregate"]


def test_samplers_do_not_shuffle(cleaned):
    for df in (
        sampling.sample(cleaned, 0.1),
        sampling.hash_sample(cleaned, ["origin"], 0.1),
        sampling.oversample_150(cleaned),
        sampling.replicate(cleaned, 3),
    ):
        assert "Exchange" not in plan(df)


def test_extremes_aggregate_the_table_once(spark, cleaned):
    df = profiling.extremes(cleaned)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 3


def test_top_k_keeps_k_rows_per_task(cleaned):
    df = selection.preview(cleaned, 5, ["distance", "origin"])
    assert "TakeOrderedAndProject" in plan(df)


def test_small_side_of_membership_is_known_by_its_limit(spark, cleaned):
    ranking = reports.carrier_ranking(cleaned)
    text = plan(selection.keep_top(ranking, "origin", "total_flights", 10))
    assert "LeftSemi" in text


def test_declared_schema_needs_no_extra_pass(spark, raw):
    from aeropunct.session import scratch_dir
    from aeropunct.sources import writers

    path = scratch_dir(spark, "schema")
    writers.write_raw_csv(raw, path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("declared", "declared")
    readers.read_raw(spark, path)
    assert len(tracker.getJobIdsForGroup("declared")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
