"""Steps whose cost must not outgrow their input."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrameWriter

from aeropunct.checks.profiles import sample_bounds
from aeropunct.operators import whole_profile
from aeropunct.session import scratch_dir
from aeropunct.sources import readers, writers

# The JVM compiles no longer method.
LONGEST_METHOD = 8000


def _longest_method(df) -> int:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    # Without whole-stage code the expressions are cut into short methods.
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text)), default=0)


@pytest.fixture
def raw_text(spark, raw):
    path = scratch_dir(spark, "methods")
    writers.write_raw_csv(raw.limit(5), path)
    return path


def test_a_checked_read_is_short_enough_to_compile(spark, raw_text):
    assert _longest_method(readers.read_raw(spark, raw_text, checked=True)) < LONGEST_METHOD


def test_blank_and_unreadable_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("month,dep_delay,origin\n1,late, \nx, ,y\n3.0,,\n1,2\n")
    rows = readers.read_raw(spark, str(tmp_path), checked=True)
    got = [(r.month, r.dep_delay, r._unconverted, r._broken_line) for r in rows.collect()]
    assert got == [(1, None, 1, None), (None, None, 1, None), (3, None, 0, None), (1, 2.0, 0, "1,2")]
    rejected = readers.rejected_cells(spark, str(tmp_path))
    found = {(r.row, r.column, r.value) for r in rejected.collect()}
    assert found == {(1, "dep_delay", "late"), (2, "month", "x"), (4, None, "1,2")}


def test_sample_bounds_group_once(spark):
    def table(*rows):
        return spark.createDataFrame([*rows], "a int, b string")

    base = table((1, "x"), (1, "x"), (None, None))
    named = {
        "same": (base, 1.0, 0),
        "twice": (base.union(base), 2.0, 2),
        "more": (table((1, "x"), (1, "x"), (1, "x")), 1.0, 0),
        "other": (table((2, "x"), (1, "x"), (None, None)), 1.0, 0),
    }
    bounds = sample_bounds(base, named)
    got = {r.dataset: (r.base_rows, r.size_within_bounds, r.rows_from_base) for r in bounds.collect()}
    # A fraction above the whole copies allows a copy more.
    assert got == {
        "same": (3, True, True),
        "twice": (3, True, True),
        "more": (3, True, False),
        "other": (3, True, False),
    }
    plan = bounds._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_side_by_side_tables_are_not_sorted(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"t{i % 7}") for i in range(70)], "v int, t string")
    before, seen, parquet = spark.conf.get(writers.OPEN_FILES, None), [], DataFrameWriter.parquet

    def watched(self, *args, **kwargs):
        seen.append(int(spark.conf.get(writers.OPEN_FILES, "0")))
        return parquet(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    try:
        spark.conf.unset(writers.OPEN_FILES)
        paths = writers.write_datasets(rows, "t", [f"t{i}" for i in range(7)], scratch_dir(spark, "open"))
        # Spark sorts from the file on that reaches the number.
        assert seen[0] > 7
        assert int(spark.conf.get(writers.OPEN_FILES, "0")) == 0
    finally:
        if before is not None:
            spark.conf.set(writers.OPEN_FILES, before)
    assert [spark.read.parquet(p).count() for p in paths.values()] == [10] * 7


def test_digests_that_occur_once_are_counted_not_listed(spark, raw):
    scratch, n = scratch_dir(spark, "once"), raw.count()
    whole_profile.whole_profile(raw, scratch)
    counts = spark.read.parquet(f"{scratch}/counts").filter("kind = 'record'").collect()
    single = [r for r in counts if r.n == 1]
    assert sum(r.n * r.groups for r in counts) == n
    assert len(single) <= 2 and all(r._digest_1 is None for r in single)
    assert all(r.groups == 1 and r._digest_1 is not None for r in counts if r.n > 1)
