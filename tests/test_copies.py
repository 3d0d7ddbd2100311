"""Copies by digest and the whole profile, against grouping on all columns."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from aeropunct.operators import cleaning, copies, profiling
from aeropunct.operators.whole_profile import whole_profile
from aeropunct.schema import LOGICAL_KEY
from aeropunct.session import scratch_dir
from aeropunct.sources import readers, writers

KINDS = "a string, b string, c double, d int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]


def brute(df, flag=None):
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    out = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    return (*out, groups.filter(flag).count()) if flag else tuple(out)


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    values = [
        (rnd.choice(["x", "y", None, ""]), rnd.choice(["x", None]), rnd.choice([0.0, -0.0, float("nan"), None, 1.5]),
         rnd.randint(0, 3)) for _ in range(400)
    ]
    values += [("hot", "row", 1.0, 1)] * 300 + [(f"single{i}", None, float(i), i) for i in range(200)]
    return spark.createDataFrame(values, KINDS).repartition(5)


def clashing(columns):
    return F.lit(1), F.lit(2)


def half_clashing(columns):
    """Digests that many different rows share."""
    return F.pmod(F.col("d"), F.lit(2)).cast("long"), F.lit(0)


@pytest.mark.parametrize("digest", [copies.digests, clashing, half_clashing])
def test_counts_whatever_the_digest(rows, digest):
    flags = {"even": F.col("d") % 2 == 0, "small": F.col("c") < 2}
    got = copies.count_copies(rows, flags=flags, digest=digest).first()
    assert (got.total_rows, got.distinct_rows) == brute(rows)
    assert got.even == brute(rows, "d % 2 = 0")[2]
    assert got.small == brute(rows, "coalesce(c < 2, false)")[2]


def test_nulls_keep_their_places(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), ("x", None), (None, None)], "a string, b string")
    first = df.select(*[d.alias(f"d{i}") for i, d in enumerate(copies.digests(df.columns))])
    assert first.distinct().count() == 3
    got = copies.count_copies(df).first()
    assert (got.total_rows, got.distinct_rows) == (4, 3)
    assert tuple(copies.count_copies(df.limit(0)).first()) == (0, 0)


def test_many_columns(spark):
    wide = spark.range(20).select(*[F.when(F.col("id") % 7 != i % 7, F.lit(1)).alias(f"c{i}") for i in range(130)])
    got = copies.count_copies(wide).first()
    assert (got.total_rows, got.distinct_rows) == (20, 7)


def test_only_digests_cross_the_network_for_all_rows(raw):
    found = copies.count_copies(raw)
    found.collect()
    text = found._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)", plan(found))
    wide = [e for e in exchanges if "fl_date" in e]
    # The only exchange of whole records comes after the join with repeated digests.
    assert len(wide) == 1 and any(copies.DIGEST[0] in e for e in exchanges)
    assert "ReusedExchange" in text


def test_row_accounting_against_cleaning(raw):
    steps = {r.step: (r.before, r.after, r.dropped) for r in cleaning.row_accounting(raw).collect()}
    n, distinct, kept = raw.count(), raw.distinct().count(), cleaning.clean(raw).count()
    assert steps == {
        "duplicates": (n, distinct, n - distinct),
        "quality": (distinct, kept, distinct - kept),
        "total": (n, kept, n - kept),
    }


def test_unrelated_ids_with_equal_counts(spark):
    df = spark.range(2000).select(
        (F.col("id") % 40).alias("origin_airport_id"), (F.col("id") % 41 % 40).cast("string").alias("origin"),
        F.col("id").alias("Dest_ID"), F.concat(F.lit("d"), "id").alias("dest"), F.col("id").alias("lone_id"),
    )
    assert profiling.id_pairs(df.columns) == {"origin_airport_id": "origin", "Dest_ID": "dest"}
    found = {r.column: r.redundant for r in profiling.redundant_ids(df).collect()}
    assert found == {"origin_airport_id": False, "Dest_ID": True}


def test_a_few_broken_pairs_are_tolerated(spark):
    df = spark.range(1000).select(
        F.col("id").alias("x_id"), F.when(F.col("id") < 5, "same").otherwise(F.col("id").cast("string")).alias("x")
    )
    assert profiling.redundant_ids(df).first().redundant
    assert not profiling.redundant_ids(df, tolerance=0.004).first().redundant


def long_rows(df):
    return {(r.report, r.label, r.item): None if r.value is None else round(r.value, 6) for r in df.collect()}


@pytest.fixture(scope="module")
def profiled(spark, raw):
    """The raw table with an id column, stored, and its whole profile."""
    path = scratch_dir(spark, "stored")
    kept = raw.withColumn("origin_id", F.hash("origin"))
    writers.write_parquet(kept, path)
    table = readers.read_flights(spark, path)
    return table, whole_profile(table, scratch_dir(spark, "whole"))


def test_whole_profile_agrees_with_its_parts(profiled):
    table, found = profiled
    got = long_rows(found)
    single = {
        "exact_copies": profiling.exact_dups(table),
        "logical_copies": profiling.logical_dups(table),
        "sparse_rows": profiling.sparse_rows(table),
        "recovery": profiling.recovery(table),
        "shape": profiling.shape(table),
    }
    for report, df in single.items():
        want = {(report, "table", k): round(float(v), 6) for k, v in df.first().asDict().items()}
        assert want == {k: v for k, v in got.items() if k[0] == report}
    by_label = {
        "description": (profiling.describe_exact(table), "column"),
        "columns": (profiling.profile(table), "column"),
        "row_accounting": (cleaning.row_accounting(table), "step"),
        "redundant_ids": (profiling.redundant_ids(table), "column"),
    }
    for report, (df, label) in by_label.items():
        want = {
            (report, row[label], k): round(float(v), 6)
            for row in df.collect() for k, v in row.asDict().items() if k not in (label, "base")
        }
        assert want == {k: v for k, v in got.items() if k[0] == report}
    pairs = {(r.dep_delay, r.arr_delay) for r in profiling.extremes(table).collect()}
    listed = {}
    for (report, label, item), value in got.items():
        if report == "extreme_pairs":
            listed.setdefault(label, {})[item] = value
    assert {(x["dep_delay"], x["arr_delay"]) for x in listed.values()} == pairs
    assert len(listed) == got["extremes", "table", "pairs"] <= 200


def test_whole_profile_of_an_empty_table(spark, raw):
    got = long_rows(whole_profile(raw.limit(0), scratch_dir(spark, "none")))
    assert got["shape", "table", "total_rows"] == got["exact_copies", "table", "distinct_rows"] == 0
    assert got["row_accounting", "total", "dropped"] == 0


def test_whole_profile_reads_the_table_three_times(spark, raw, monkeypatch):
    """Every read of the table is in one of the three written steps, none in the result."""
    path = scratch_dir(spark, "thrice")
    writers.write_parquet(raw, path)
    table = readers.read_flights(spark, path)
    scans = []
    write = writers.write_parquet

    def counted(df, target):
        scans.append(len(re.findall(r"FileScan parquet", plan(df))) - plan(df).count("/counts"))
        write(df, target)

    monkeypatch.setattr("aeropunct.operators.whole_profile.write_parquet", counted)
    found = whole_profile(table, scratch_dir(spark, "steps"))
    assert scans == [1, 1, 1]
    assert path.rsplit("/", 1)[1] not in found._jdf.queryExecution().optimizedPlan().toString()
    assert path.rsplit("/", 1)[1] not in plan(found)


def test_clashing_digests_in_the_whole_profile(raw, spark, monkeypatch):
    want = long_rows(whole_profile(raw, scratch_dir(spark, "a")))
    monkeypatch.setattr(copies, "digests", lambda columns: (F.pmod("crs_dep_time", F.lit(3)).cast("long"), F.lit(0)))
    got = long_rows(whole_profile(raw, scratch_dir(spark, "b")))
    assert got == want and LOGICAL_KEY
