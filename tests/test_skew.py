"""Hot groups: one key holds a third of all rows, and copies do too."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aeropunct.operators import cleaning, profiling, reports, trends
from aeropunct.schema import CLEAN_COLUMNS


@pytest.fixture(scope="module")
def skewed(spark, cleaned):
    """A third of all flights leave one airport with one carrier; a third are one copy."""
    n = cleaned.count()
    hot = cleaned.withColumn("origin", F.lit("HOT")).withColumn("op_unique_carrier", F.lit("HH"))
    one = cleaned.orderBy(*CLEAN_COLUMNS).limit(1)
    same = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("i")).drop("i")
    return cleaned.union(hot).union(same)


@pytest.fixture(scope="module")
def frame(skewed):
    return skewed.toPandas()


def test_copies_collapse(skewed, frame):
    assert cleaning.dedup(skewed).count() == len(frame.drop_duplicates())
    row = profiling.exact_dups(skewed).first()
    assert row.total_rows == len(frame)
    assert row.duplicates == len(frame) - len(frame.drop_duplicates())


def test_ranking_by_brute_force(skewed, frame):
    g = frame.groupby(["origin", "op_unique_carrier"])
    expected = pd.DataFrame(
        {"total_flights": g.size(), "avg": g["dep_delay"].mean().astype(float)}
    ).reset_index()
    airport = frame.groupby("origin")["dep_delay"].mean().astype(float)
    got = reports.carrier_ranking(skewed).toPandas()
    merged = got.merge(expected, on=["origin", "op_unique_carrier"], validate="1:1")
    assert len(merged) == len(expected)
    assert (merged.total_flights_x == merged.total_flights_y).all()
    known = merged[merged.avg.notna()]
    assert (abs(known.avg_dep_delay - known.avg) < 0.00501).all()
    assert (abs(got.airport_avg_dep_delay - got.origin.map(airport)) < 0.00501).all()
    ranks = got.groupby("origin")["avg_dep_delay"].rank(method="min", na_option="top")
    assert (ranks == got.carrier_rank).all()


def test_statistics_by_brute_force(skewed, frame):
    flown = frame[frame.cancelled != 1].assign(d=lambda f: f.arr_delay.fillna(0).astype(float))
    g = flown.groupby(["op_unique_carrier", "origin"])["d"]
    expected = pd.DataFrame({"low": g.min(), "high": g.max(), "mean": g.mean()}).reset_index()
    months = frame.groupby(["op_unique_carrier", "origin"])["month"].agg(lambda m: sorted(set(m)))
    for r in reports.carrier_airport_stats(skewed).collect():
        e = expected[
            (expected.op_unique_carrier == r.op_unique_carrier) & (expected.origin == r.origin)
        ]
        low, high, mean = (0.0, 0.0, 0.0) if e.empty else e.iloc[0][["low", "high", "mean"]]
        assert (r.min_arr_delay, r.max_arr_delay) == (low, high)
        assert r.avg_arr_delay == pytest.approx(mean)
        assert r.months_of_operation == months[r.op_unique_carrier, r.origin]


def test_band_report_by_brute_force(skewed, frame):
    def band(d):
        if pd.isna(d):
            return "UNKNOWN"
        return "LOW" if d < 15 else "MEDIUM" if d <= 60 else "HIGH"

    labels = ["CARRIER", "WEATHER", "NAS", "SECURITY", "LATE_AIRCRAFT"]

    def cause(row):
        if row.cancelled == 1:
            return f"CANCELLED_{row.cancellation_code}"
        minutes = [row.carrier_delay, row.weather_delay, row.nas_delay, row.security_delay,
                   row.late_aircraft_delay]
        return labels[minutes.index(max(minutes))] if max(minutes) > 0 else "NONE"

    frame = frame.assign(
        band=[band(d) for d in frame.dep_delay], cause=[cause(r) for r in frame.itertuples()]
    )
    got = {(r.origin, r.month, r.delay_band): r for r in reports.band_report(skewed).collect()}
    groups = frame.groupby(["origin", "month", "band"])
    assert len(got) == len(groups)
    for key, part in groups:
        counts = part[part.cause != "NONE"].groupby("cause").size()
        top = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))][:3]
        row = got[key]
        assert row.total_flights == len(part)
        assert [row.top_cause_1, row.top_cause_2, row.top_cause_3] == top + [None] * (3 - len(top))


def test_exact_quartiles_by_brute_force(skewed, frame):
    import numpy as np

    values = frame.distance.dropna().to_numpy(dtype="float64")
    row = profiling.describe_exact(skewed, ["distance"]).first()
    expected = [round(float(x), 2) for x in np.percentile(values, [25, 50, 75])]
    assert [row.p25, row.p50, row.p75] == expected


def test_extremes_by_brute_force(skewed, frame):
    pairs = frame[["dep_delay", "arr_delay"]].dropna()
    wanted = set()
    for order in (["dep_delay", "arr_delay"], ["arr_delay", "dep_delay"]):
        for up in (True, False):
            head = pairs.sort_values(order, ascending=up).head(50)
            wanted |= set(head.itertuples(index=False, name=None))
    got = {tuple(r) for r in profiling.extremes(skewed).collect()}
    assert got == wanted


def test_hourly_means_by_brute_force(skewed, frame):
    flown = frame[(frame.cancelled == 0) & frame.hour.between(0, 23)]
    expected = flown.groupby("hour")["dep_delay"].mean().astype(float)
    for r in trends.delay_by_hour(skewed).collect():
        assert r.avg_dep_delay == pytest.approx(expected[r.hour], rel=1e-6)


@pytest.fixture
def settings(spark):
    """Session settings for one test."""
    kept = {}

    def apply(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            kept[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield apply
    for name, value in kept.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_hot_order_is_split_in_the_join(spark, settings):
    from compare import TABLES, difference, duck
    from conftest import SF_DIR

    from aeropunct.checks.registry import VIEWS
    from aeropunct.session import scratch_dir
    from aeropunct.sources.star import raw_flights

    tables = scratch_dir(spark, "hot")
    for t in TABLES:
        df = spark.read.parquet(f"{SF_DIR}/{t}.parquet")
        if t == "lineitem":
            df = df.union(df.withColumn("l_orderkey", F.lit(7).cast("bigint")))
        df.coalesce(1).write.parquet(f"{tables}/{t}.parquet")

    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="16KB",
        adaptive__coalescePartitions__enabled="false",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        shuffle__partitions="16",
    )
    report = raw_flights(spark, tables).groupBy("origin", "dest").agg(
        F.count("*").alias("flights"), F.sum("dep_delay").alias("minutes")
    )
    got = report.toPandas()
    assert "SortMergeJoin(skew=true)" in report._jdf.queryExecution().executedPlan().toString()

    con = duck(SF_DIR)
    for t in TABLES:
        con.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    expected = con.sql(
        "SELECT origin, dest, count(*) AS flights, sum(dep_delay) AS minutes"
        f" FROM ({VIEWS['raw']}) AS raw GROUP BY origin, dest"
    )
    assert difference(got, expected.df()) is None
