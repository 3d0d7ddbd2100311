"""Relations that hold on any data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aeropunct.operators import cleaning, profiling, reports, rollups, sampling, trends
from aeropunct.schema import CLEAN_COLUMNS, CLEAN_SCHEMA


def total(df, column="total_flights"):
    return df.agg(F.sum(column)).first()[0]


def test_every_report_counts_every_flight(cleaned):
    n = cleaned.count()
    assert n > 0
    assert total(reports.carrier_airport_stats(cleaned)) == n
    assert total(reports.carrier_route_stats(cleaned)) == n
    assert total(reports.carrier_stats(cleaned)) == n
    assert total(reports.band_stats(cleaned)) == n
    assert total(reports.band_report(cleaned)) == n
    assert total(reports.carrier_ranking(cleaned)) == n


def test_brackets_cover_known_delays(raw):
    known = raw.filter("dep_delay IS NOT NULL").count()
    shares = trends.bracket_share(raw)
    assert total(shares, "flights") == known
    assert total(shares, "share_pct") == pytest.approx(100)


def test_fused_and_joined_forms_agree(cleaned):
    for one, two in (
        (reports.band_report, reports.band_report_joined),
        (reports.carrier_ranking, reports.carrier_ranking_joined),
    ):
        a, b = one(cleaned), two(cleaned)
        assert a.exceptAll(b.select(a.columns)).count() == 0
        assert a.count() == b.count()


def test_levels_agree_with_separate_reports(cleaned):
    levels = reports.carrier_stats_by_level(cleaned)
    airport = reports.carrier_airport_stats(cleaned).withColumnRenamed("origin", "place")
    route = reports.carrier_route_stats(cleaned).withColumnRenamed("route", "place")
    for name, df in (("airport", airport), ("route", route)):
        part = levels.filter(F.col("level") == name).drop("level")
        assert part.exceptAll(df.select(part.columns)).count() == 0
        assert part.count() == df.count()


def test_trends_agree_with_separate_reports(raw):
    together = {
        (r.report, r.label): r.value for r in trends.trends(raw).collect()
    }
    for r in trends.delay_by_carrier(raw).collect():
        assert together["delay_by_carrier", r.op_unique_carrier] == r.avg_dep_delay
    for r in trends.delay_by_hour(raw).collect():
        assert together["delay_by_hour", str(r.hour)] == r.avg_dep_delay
    for r in trends.cancellations_by_code(raw).collect():
        assert together["cancellations_by_code", r.cancellation_code] == r.flights
    for r in trends.cause_minutes(raw).collect():
        assert together["cause_minutes", r.delay_cause] == r.total_minutes


def test_trends_and_profile_of_text(raw):
    """Exploration reads every column as text; the figures stay the same."""
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    def values(df):
        return {tuple(r) for r in df.collect()}

    for report in (
        trends.trends,
        trends.delay_by_carrier,
        trends.delay_by_month,
        trends.delay_by_hour,
        trends.cancellations_by_code,
        trends.bracket_share,
        trends.cause_minutes,
        profiling.profile,
        profiling.sparse_rows,
        profiling.describe_exact,
        profiling.extremes,
        profiling.recovery,
        profiling.logical_dups,
        cleaning.clean,
    ):
        assert values(report(text)) == values(report(raw)), report.__name__


def test_cleaned_table_has_its_schema_and_rules(cleaned):
    assert [(f.name, f.dataType) for f in cleaned.schema] == [
        (f.name, f.dataType) for f in CLEAN_SCHEMA
    ]
    assert cleaned.filter(~cleaning.is_consistent()).count() == 0
    assert cleaning.quality_filter(cleaned).count() == cleaned.count()


def test_row_accounting_agrees_with_cleaning(raw, cleaned):
    steps = {r.step: r for r in cleaning.row_accounting(raw).collect()}
    assert steps["duplicates"].before == raw.count()
    assert steps["duplicates"].after == cleaning.dedup(raw).count()
    assert steps["total"].after == cleaned.count()
    assert steps["duplicates"].dropped == profiling.exact_dups(raw).first().duplicates > 0


def test_every_airport_has_a_first_rank(cleaned):
    ranking = reports.carrier_ranking(cleaned)
    firsts = ranking.filter("carrier_rank = 1").select("origin").distinct().count()
    assert firsts == ranking.select("origin").distinct().count()


def test_text_round_trip(cleaned):
    stats = reports.carrier_airport_stats(cleaned)
    back = {(r.op_unique_carrier, r.origin): r for r in
            reports.parse_stats(reports.format_stats(stats)).collect()}
    rows = stats.collect()
    assert len(back) == len(rows)
    for r in rows:
        b = back[r.op_unique_carrier, r.origin]
        assert b.total_flights == r.total_flights
        assert b.avg_arr_delay == pytest.approx(r.avg_arr_delay, abs=0.0051)
        assert b.cancelation_rate == pytest.approx(r.cancelation_rate, abs=0.0051)
        assert b.months_of_operation == ", ".join(map(str, r.months_of_operation))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_replicas(cleaned, n):
    many = sampling.replicate(cleaned, n)
    assert many.columns == cleaned.columns
    assert many.count() == n * cleaned.count()
    assert many.distinct().count() == cleaned.distinct().count()


@pytest.mark.parametrize("pct", sampling.SUB_SIZES)
def test_samples_are_subsets_of_the_right_size(cleaned, pct):
    n = cleaned.count()
    slack = 5 * (n * pct / 100 * (1 - pct / 100)) ** 0.5
    random = sampling.sub_samples(cleaned)[f"flight_{pct}"]
    hashed = sampling.hash_sample(cleaned, CLEAN_COLUMNS, pct / 100)
    for part in (random, hashed):
        assert abs(part.count() - n * pct / 100) < slack
        assert part.exceptAll(cleaned).count() == 0


def test_hash_samples_ignore_partitioning_and_nest(cleaned):
    small = sampling.hash_sample(cleaned, CLEAN_COLUMNS, 0.1)
    again = sampling.hash_sample(cleaned.repartition(7), CLEAN_COLUMNS, 0.1)
    assert small.exceptAll(again).count() == 0 and small.count() == again.count()
    assert small.exceptAll(sampling.hash_sample(cleaned, CLEAN_COLUMNS, 0.25)).count() == 0
    family = sampling.hash_sub_samples(cleaned, CLEAN_COLUMNS)
    assert family.filter("sample_pct = 10").count() == small.count()


def test_oversample_holds_every_row(cleaned):
    n = cleaned.count()
    for more in (
        sampling.oversample_150(cleaned),
        sampling.oversample_150(cleaned, keys=CLEAN_COLUMNS),
    ):
        assert cleaned.exceptAll(more).count() == 0
        assert abs(more.count() - 1.5 * n) < 5 * (n * 0.25) ** 0.5


def test_approximate_counts_are_close(raw):
    columns = ["op_unique_carrier", "origin", "dest", "op_carrier_fl_num"]
    approx = {r.column: r.approx_distinct for r in
              profiling.approx_distinct(raw, columns).collect()}
    for c in columns:
        exact = raw.select(c).dropna().distinct().count()
        assert abs(approx[c] - exact) <= max(1, 0.15 * exact)


def test_sketched_quartiles_lie_among_the_exact(raw):
    exact = {r.column: r for r in profiling.describe_exact(raw).collect()}
    for r in profiling.describe(raw).collect():
        e = exact[r.column]
        assert (r["count"], r.min, r.max, r.mean) == (e["count"], e.min, e.max, e.mean)
        for q in ("p25", "p50", "p75"):
            assert abs(r[q] - e[q]) <= 1


def test_matrix_holds_the_cells(cleaned):
    ranking = reports.carrier_ranking(cleaned)
    cells = {(r.origin, r.op_unique_carrier): r.diff_from_airport_avg
             for r in rollups.diff_cells(ranking).collect()}
    matrix = rollups.diff_matrix(ranking)
    assert len(matrix.columns) == 11
    wide = {(r.origin, c): r[c] for r in matrix.collect() for c in matrix.columns[1:]
            if r[c] is not None}
    assert wide == {k: v for k, v in cells.items() if v is not None}
