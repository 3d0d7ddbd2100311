"""Hand-written rows at the edges of the rules."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from aeropunct.functions import columns as fn
from aeropunct.operators import cleaning, profiling, reports, rollups, sampling, selection, trends
from aeropunct.schema import CAUSE_COLUMNS, RAW_SCHEMA


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_all_cancelled_group_shows_zero_delays(flights):
    gone = {"cancelled": 1, "cancellation_code": "B", "dep_delay": None, "arr_delay": None}
    df = flights(gone, {**gone, "month": 3})
    row = reports.carrier_airport_stats(df).first()
    assert (row.total_flights, row.min_arr_delay, row.max_arr_delay) == (2, 0.0, 0.0)
    assert (row.avg_arr_delay, row.cancelation_rate) == (0.0, 100.0)
    assert row.months_of_operation == [1, 3]


def test_carrier_without_average_ranks_first(flights):
    gone = {"cancelled": 1, "cancellation_code": "B", "dep_delay": None, "arr_delay": None}
    df = flights({**gone, "op_unique_carrier": "ZZ"}, {"dep_delay": 4.0})
    for ranking in (reports.carrier_ranking, reports.carrier_ranking_joined):
        first = ranking(df).first()
        assert (first.op_unique_carrier, first.avg_dep_delay, first.carrier_rank) == ("ZZ", None, 1)
        assert first.airport_avg_dep_delay == 4.0 and first.diff_from_airport_avg is None


def test_unknown_arrival_counts_as_zero_in_statistics_only(flights):
    df = flights({"arr_delay": None}, {"arr_delay": 10.0})
    assert reports.carrier_airport_stats(df).first().avg_arr_delay == 5.0
    assert reports.carrier_stats(df).first().avg_arr_delay == 10.0


@pytest.mark.parametrize("field", reports.AIRPORT_REQUIRED)
def test_rows_without_required_fields_are_skipped_and_counted(flights, field):
    df = flights({field: None}, {}, {})
    assert reports.carrier_airport_stats(df).first().total_flights == 2
    kept, counts = cleaning.skip_bad(df, reports.AIRPORT_REQUIRED)
    assert kept.count() == 2 and rows(counts) == [(2, 1)]


def test_row_without_destination_counts_for_its_airport_only(flights):
    df = flights({"dest": None}, {})
    levels = {r.level: r for r in reports.carrier_stats_by_level(df).collect()}
    assert levels["airport"].total_flights == 2
    assert (levels["route"].place, levels["route"].total_flights) == ("JFK-LAX", 1)
    assert reports.carrier_route_stats(df).count() == 1


def test_any_month_is_reported(flights):
    months = [99, -1, 1, 62, 63, 10**9]
    df = flights(*[{"month": m} for m in months])
    row = reports.carrier_airport_stats(df).first()
    assert row.months_of_operation == sorted(months) and row.total_flights == 6
    assert reports.carrier_stats_by_level(df).first().months_of_operation == sorted(months)


@pytest.mark.parametrize(
    ("delay", "band"),
    [(14.99, "LOW"), (15.0, "MEDIUM"), (60.0, "MEDIUM"), (60.01, "HIGH"), (None, "UNKNOWN")],
)
def test_band_edges(flights, delay, band):
    assert reports.flight_base(flights({"dep_delay": delay})).first().delay_band == band


@pytest.mark.parametrize(
    ("delay", "bracket"),
    [(0.0, 0), (0.5, 1), (15.0, 1), (15.5, 2), (60.0, 2), (60.5, 3)],
)
def test_bracket_edges_differ_from_bands(flights, delay, bracket):
    df = flights({"dep_delay": delay}).select(fn.delay_bracket("dep_delay"))
    assert df.first()[0] == fn.BRACKETS[bracket]


@pytest.mark.parametrize(
    ("values", "cause"),
    [
        ({"weather_delay": 30, "nas_delay": 30}, "WEATHER"),
        ({"late_aircraft_delay": 30, "nas_delay": 29}, "LATE_AIRCRAFT"),
        ({"security_delay": 1}, "SECURITY"),
        ({c: 7 for c in CAUSE_COLUMNS}, "CARRIER"),
        ({}, "NONE"),
        ({"carrier_delay": -5}, "NONE"),
        ({"cancelled": 1}, "CANCELLED_UNKNOWN"),
        ({"cancelled": 1, "cancellation_code": "C", "nas_delay": 9}, "CANCELLED_C"),
    ],
)
def test_primary_cause(flights, values, cause):
    df = flights(values)
    assert reports.flight_base(df).first().primary_cause == cause
    assert df.filter(fn.has_cause()).count() == (cause != "NONE")


def test_band_report_keeps_groups_without_causes(flights):
    df = flights({}, {"carrier_delay": 5}, {"month": 2}, {"month": 2})
    for report in (reports.band_report(df), reports.band_report_joined(df)):
        by_month = {r.month: r for r in report.collect()}
        assert (by_month[1].total_flights, by_month[1].top_cause_1) == (2, "CARRIER")
        assert by_month[1].top_cause_2 is None
        assert (by_month[2].total_flights, by_month[2].top_cause_1) == (2, None)


def test_band_report_null_keys_have_no_causes(flights):
    df = flights({"month": None, "carrier_delay": 5})
    assert rows(reports.band_report(df)) == rows(reports.band_report_joined(df))
    assert reports.band_report(df).first().top_cause_1 is None


def test_equal_averages_share_a_rank(flights):
    carrier = "op_unique_carrier"
    df = flights({carrier: "A", "dep_delay": 5.001}, {carrier: "B", "dep_delay": 5.0},
                 {carrier: "C", "dep_delay": 9.0})
    ranks = {r.op_unique_carrier: r.carrier_rank for r in reports.carrier_ranking(df).collect()}
    assert ranks == {"A": 1, "B": 1, "C": 3}


def test_difference_uses_rounded_averages(flights):
    carrier = "op_unique_carrier"
    df = flights(
        {carrier: "A", "dep_delay": 1.0}, {carrier: "A", "dep_delay": 1.0},
        {carrier: "A", "dep_delay": 2.0}, {carrier: "B", "dep_delay": 0.0},
    )
    row = reports.carrier_ranking(df).filter("op_unique_carrier = 'A'").first()
    assert (row.avg_dep_delay, row.airport_avg_dep_delay) == (1.33, 1.0)
    assert row.diff_from_airport_avg == 0.33


def test_hour_from_clock(spark):
    df = spark.createDataFrame([(5,), (1430,), (2400,), (None,)], "crs_dep_time int")
    assert [r.hour for r in cleaning.with_hour(df).collect()] == [0, 14, 24, None]


def test_hourly_report_drops_hour_24(flights):
    df = flights({"hour": 24, "dep_delay": 100.0}, {"hour": 3, "dep_delay": 6.0})
    assert rows(trends.delay_by_hour(df)) == [(3, 6.0)]


def test_casts_of_bad_text_give_null(spark):
    values = [("12.0", "x"), ("abc", "3.5"), ("-7.9", None)]
    df = spark.createDataFrame(values, "i string, f string")
    out = cleaning.cast_columns(df, {"int": ["i"], "float": ["f"]})
    assert rows(out) == [(12, None), (None, 3.5), (-7, None)]
    assert dict(out.dtypes) == {"i": "int", "f": "float"}


RAW_ROW = {
    "fl_date": datetime.date(2024, 1, 1), "month": 1, "origin": "JFK", "dest": "LAX",
    "op_unique_carrier": "AA", "op_carrier_fl_num": 1.0, "crs_dep_time": 900, "distance": 10.0,
    "dep_delay": 1.0, "arr_delay": 2.0, "cancelled": 0, "diverted": 0,
}


def raw_rows(spark, *changes):
    values = [
        [{**dict.fromkeys(RAW_SCHEMA.names), **RAW_ROW, **c}[n] for n in RAW_SCHEMA.names]
        for c in changes
    ]
    return spark.createDataFrame(values, RAW_SCHEMA)


@pytest.mark.parametrize(
    ("change", "kept"),
    [
        ({}, True),
        ({"distance": 0.0}, False),
        ({"distance": None}, False),
        ({"origin": None}, False),
        ({"dest": None}, False),
        ({"arr_delay": None, "diverted": 1}, False),
        ({"dep_delay": None}, False),
        ({"cancellation_code": "A"}, False),
        ({"cancelled": 1, "cancellation_code": "A", "dep_delay": None, "arr_delay": None}, True),
        ({"cancelled": 1}, False),
        ({"cancelled": None}, False),
    ],
)
def test_quality_rule(spark, change, kept):
    assert cleaning.clean(raw_rows(spark, change)).count() == int(kept)


def test_cleaning_drops_true_copies_only(spark):
    df = raw_rows(spark, {}, {}, {"taxi_out": 5.0}, {"distance": 0.0})
    # Rows that differ in a column which is pruned later are no copies.
    assert cleaning.clean(df).count() == 2
    steps = {r.step: (r.before, r.after, r.dropped) for r in cleaning.row_accounting(df).collect()}
    assert steps == {"duplicates": (4, 3, 1), "quality": (3, 2, 1), "total": (4, 2, 2)}


def test_causes_are_filled(spark):
    row = cleaning.clean(raw_rows(spark, {"nas_delay": 4})).first()
    assert (row.carrier_delay, row.nas_delay) == (0, 4)


def test_logical_duplicates(spark):
    df = raw_rows(spark, {}, {"dep_delay": 9.0}, {"crs_dep_time": None}, {"crs_dep_time": None})
    assert profiling.logical_dups(df).first().duplicates == 2
    assert profiling.exact_dups(df).first().duplicates == 1


def test_profile_of_text_counts_empty_as_missing(spark):
    df = spark.createDataFrame([("", "a", None), (None, "a", None), ("x", "a", None)],
                               "p string, q string, r string")
    found = {r.column: r for r in profiling.profile(df).collect()}
    assert [found[c].nulls for c in "pqr"] == [2, 0, 3]
    assert [found[c].zero_variance for c in "pqr"] == [False, True, True]
    assert [found[c].sparse for c in "pqr"] == [False, False, True]


def test_columns_that_vary_later_are_still_found(spark):
    df = spark.range(3000).select(
        F.col("id").alias("early"),
        F.when(F.col("id") < 2900, "same").otherwise("other").alias("late"),
        F.lit("x").alias("never"),
        F.lit(None).cast("string").alias("void"),
    ).coalesce(1)
    assert {r.column for r in profiling.profile(df).collect() if r.zero_variance} == {
        "never",
        "void",
    }


def test_profile_of_empty_table(spark):
    df = spark.createDataFrame([], "p string, q int")
    assert [r.nulls for r in profiling.profile(df).collect()] == [0, 0]


def test_redundant_ids(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, None), (2, "b", 1, None), (3, "c", 2, None)],
        "origin_airport_id int, origin string, dest_id int, dest string",
    ).withColumn("void_id", F.lit(None).cast("int")).withColumn("void", F.lit("x"))
    pairs = {"origin_airport_id": "origin", "dest_id": "dest", "void_id": "void", "no_id": "no"}
    found = {r.column: r.redundant for r in profiling.redundant_ids(df, pairs).collect()}
    assert found == {"origin_airport_id": True, "dest_id": False, "void_id": False}
    # Without pairs they are found by name.
    found = {r.column: r.redundant for r in profiling.redundant_ids(df).collect()}
    assert found == {"origin_airport_id": True, "dest_id": False, "void_id": False}
    assert profiling.redundant_ids(df.select("origin")).count() == 0


def test_a_million_matching_ids_are_redundant(spark):
    df = spark.range(1_000_000).select(
        F.col("id").alias("origin_airport_id"), F.concat(F.lit("a"), "id").alias("origin")
    )
    assert profiling.redundant_ids(df).first().redundant
    halved = df.withColumn("origin", F.when(F.col("origin_airport_id") % 2 == 0, F.col("origin")).otherwise("a1"))
    assert not profiling.redundant_ids(halved).first().redundant


def test_extremes_count_repeated_pairs(flights):
    pairs = [(9.0, 1.0)] * 3 + [(8.0, 2.0), (7.0, 3.0), (1.0, 9.0), (0.0, 5.0)]
    df = flights(*[{"dep_delay": d, "arr_delay": a} for d, a in pairs])
    # The three copies of the largest pair fill all k places of that list.
    got = {(r.dep_delay, r.arr_delay) for r in profiling.extremes(df, 3).collect()}
    tops = {(9.0, 1.0), (1.0, 9.0), (0.0, 5.0), (7.0, 3.0)}
    assert got == tops
    one = flights({"dep_delay": 8.0, "arr_delay": 2.0})
    assert profiling.extremes(df, 3, sample=one).count() == 5


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [-100.0, 3.0, 3.0, 64.0, 1000.0, 7.5]])
def test_exact_quartiles(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v float")
    row = profiling.describe_exact(df, ["v"]).first()
    expected = [round(float(x), 2) for x in np.percentile(values, [25, 50, 75])]
    assert [row.p25, row.p50, row.p75] == expected
    assert (row["count"], row.min, row.max) == (len(values), min(values), max(values))


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_exact_quartiles_of_fractions_and_large_numbers(spark, scale):
    import numpy as np

    values = (np.random.default_rng(4).random(20_000) * scale).astype(np.float32)
    df = spark.createDataFrame([(float(v),) for v in values], "v float")
    row = profiling.describe_exact(df, ["v"]).first()
    want = np.percentile(values.astype(float), [25, 50, 75])
    assert np.allclose([row.p25, row.p50, row.p75], want, atol=0.006, rtol=1e-9)


def test_values_spread_over_the_spans(spark):
    cuts = [float(v) for v in range(10, 100, 10)]
    df = spark.createDataFrame([(v, cuts) for v in (0.0, 10.0, 15.0, 89.9, 90.0, 1e9)], "v double, c array<double>")
    got = [r[0] for r in df.select(profiling._span(F.col("v"), F.col("c"))).collect()]
    assert got == [0, 1, 1, 8, 9, 9]


def test_recovery(flights):
    df = flights({"dep_delay": 10.0, "arr_delay": 4.0}, {"dep_delay": 1.0, "arr_delay": 1.0},
                 {"dep_delay": 1.0, "arr_delay": None})
    row = profiling.recovery(df).first()
    assert (row.pairs, row.recovered) == (2, 1) and round(row.correlation, 6) == 1.0


def test_report_text(flights):
    df = flights({"arr_delay": -3.0}, {"arr_delay": 10.0, "month": 12},
                 {"cancelled": 1, "cancellation_code": "A", "arr_delay": None})
    text = reports.format_stats(reports.carrier_airport_stats(df)).first()
    assert text.Key == "AA,JFK"
    assert text.Value == (
        "Flights Operated: 3 | Min Arr Delay: -3.00 min | Max Arr Delay: 10.00 min"
        " | Avg Arr Delay: 3.50 min | Cancel Rate: 33.33% | Months of operation: [1, 12]"
    )


def test_parse_of_foreign_text(spark):
    lines = [("AA,JFK", "something else"), ("AA", "")]
    df = spark.createDataFrame(lines, "Key string, Value string")
    first, second = reports.parse_stats(df).collect()
    assert (first.op_unique_carrier, first.origin, first.total_flights) == ("AA", "JFK", None)
    assert second.origin is None


def test_large_counts_survive_the_report_text(spark):
    line = "Flights Operated: 3000000000 | Min Arr Delay: 0.00 min | Max Arr Delay: 1.00 min"
    df = spark.createDataFrame([("AA,JFK", line)], "Key string, Value string")
    assert reports.parse_stats(df).first().total_flights == 3_000_000_000


def test_null_in_a_key_has_a_place_of_its_own(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(sampling._key_hash(["x", "y", "z"])).distinct().count() == 2


def test_codes_and_months(spark):
    df = spark.createDataFrame([("A", 1), ("D", 12), ("Z", 0), (None, None)], "c string, m int")
    out = df.select(fn.decode_code("c"), fn.month_name("m"))
    assert rows(out) == [("Carrier", "Jan"), ("Security", "Dec"), ("Unknown", None),
                         ("Unknown", None)]


def test_dataset_sizes(spark):
    names = ["flight_150.parquet", "flight_sample.parquet", "other.csv", "/a/flight_10.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(fn.scale_pct("n")).collect()] == [150, 0, 0, 10]
    assert [r[0] for r in df.select(fn.file_name("n")).collect()][3] == "flight_10.parquet"


def test_rollup_leaves_out_small_airports(spark):
    schema = "op_unique_carrier string, origin string, total_flights int, avg_arr_delay float," \
             "cancelation_rate float"
    rep = spark.createDataFrame(
        [("A", "X", 1000, 1.5, 10.0), ("B", "Y", 999, 50.0, 0.0), ("A", "Z", 2000, 2.5, 100.0)],
        schema,
    )
    got = rollups.airport_delay_rollup(rep).collect()
    # No valid flight leaves the mean unknown; it sorts last.
    assert [(r.origin, r.global_avg_delay) for r in got] == [("X", 1.5), ("Z", None)]
    rates = {r.op_unique_carrier: r.global_cancel_rate for r in
             rollups.carrier_cancel_rollup(rep).collect()}
    assert rates == {"A": 70.0, "B": 0.0}


def test_heatmap_counts_unknown_band_with_zero_minutes(spark):
    rep = spark.createDataFrame(
        [("X", 1, "LOW", 30, 10.0), ("X", 1, "UNKNOWN", 10, None)],
        "origin string, month int, delay_band string, total_flights long, avg_dep_delay double",
    )
    row = rollups.month_heatmap(rep).first()
    assert row.m01 == 7.5 and row.m02 is None
    shares = rollups.band_share(rep).first()
    assert (shares.low_pct, shares.high_pct) == (100.0, None)


def test_top_k_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", None)], "k string, v int")
    assert [r.k for r in selection.top_k(df, "v", 2, ["k"]).collect()] == ["b", "c"]
    assert [r.k for r in selection.top_k(df, "v", 4, ["k"], descending=False).collect()] == [
        "a", "b", "c", "d"]


def test_hash_sample_limits(spark):
    df = spark.range(100)
    assert sampling.hash_sample(df, ["id"], 1.0).count() == 100
    assert sampling.hash_sample(df, ["id"], 0.0).count() == 0
    for bad in (-0.1, 1.1):
        with pytest.raises(ValueError):
            sampling.hash_sample(df, ["id"], bad)
    with pytest.raises(ValueError):
        sampling.replicate(df, 0)
