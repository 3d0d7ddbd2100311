"""Steps whose files must not pile up beside those of the next step."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from aeropunct.checks import analytics, scans  # noqa: F401
from aeropunct.checks.profiles import sample_bounds
from aeropunct.checks.registry import CHECKS
from aeropunct.operators.copies import DIGEST
from aeropunct.session import scratch_dir
from aeropunct.sources import readers, star, writers

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]


def _files_below(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(f.getPath().getName()) for f in system.listStatus(folder)]


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("kind", ["parquet", "csv", "datasets"])
def test_a_write_leaves_no_shuffle_files(spark, monkeypatch, kind):
    rows = spark.range(5000).select((F.col("id") % 900).alias("v"), F.lit("a").alias("t"))
    grouped = rows.groupBy("v", "t").agg(F.count("*").alias("n"))
    write = {
        "parquet": lambda path: writers.write_parquet(grouped, path),
        "csv": lambda path: writers.write_raw_csv(grouped, path),
        "datasets": lambda path: writers.write_datasets(grouped, "t", ["a"], path),
    }[kind]
    seen, setting = [], spark.conf.get(writers.FREE_SHUFFLES, None)
    method = "csv" if kind == "csv" else "parquet"
    original = getattr(DataFrameWriter, method)

    def watched(self, *args, **kwargs):
        seen.append(spark.conf.get(writers.FREE_SHUFFLES, None))
        return original(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, method, watched)
    before = _shuffle_files(spark)
    write(scratch_dir(spark, f"freed{kind}"))
    for _ in range(50):  # the files go a moment after the write
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and set(seen) == {"true"}
    assert spark.conf.get(writers.FREE_SHUFFLES, None) == setting


def test_raw_text_is_compressed_in_bounded_files(spark, raw, monkeypatch):
    monkeypatch.setattr(writers, "RAW_FILE_RECORDS", 40)
    few, path = raw.limit(100).coalesce(1), scratch_dir(spark, "packed")
    writers.write_raw_csv(few, path)
    files = [f for f in _files_below(spark, path) if f.startswith("part")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    back = readers.read_raw(spark, path)
    assert back.count() == 100
    assert few.exceptAll(back).isEmpty() and back.exceptAll(few).isEmpty()


def test_no_shuffle_of_lines_carries_nation_names(spark):
    raw = star.raw_flights(spark, SF_DIR, copies=True)
    lines = raw._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {
        column: [len(re.match(r"[\s:+-]*", x)[0]) for x in lines if "Relation" in x and column in x]
        for column in ("n_name", "l_partkey", "s_suppkey", "o_orderkey")
    }
    names = depth.pop("n_name")
    assert len(names) == 2 and all(max(names) < min(d) for d in depth.values())


def test_nations_joined_last_keep_the_rows(spark, tmp_path):
    """Repeated, null and unknown nation keys, against the lookups joined first."""
    tables = {
        "nation": ([(1, "A", 7), (1, "B", 7), (2, "C", 8), (None, "D", 9)], "n_nationkey long, n_name string, n_regionkey long"),
        "supplier": ([(1, 1), (2, None), (3, 2), (3, 2), (4, 5)], "s_suppkey long, s_nationkey long"),
        "customer": ([(1, 1), (2, 2), (3, None), (None, 1)], "c_custkey long, c_nationkey long"),
        "orders": ([(1, 1), (2, 2), (3, 3), (4, None)], "o_orderkey long, o_custkey long"),
        "part": ([(1, "p"), (2, None)], "p_partkey long, p_brand string"),
        "lineitem": (
            [(o, 1 + o % 2, s, 1, 3.0) for o in range(1, 5) for s in range(1, 5)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double",
        ),
    }
    read = {}
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if name == "lineitem":
            df = df.withColumn("l_shipdate", F.lit("2024-01-05").cast("date"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        read[name] = df
    nation = read["nation"].select("n_nationkey", "n_name")
    origins = read["supplier"].join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    dests = read["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    dests = read["orders"].join(dests, F.col("o_custkey") == F.col("c_custkey"))
    want = (
        read["lineitem"]
        .join(read["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(origins.select("s_suppkey", F.col("n_name").alias("a")), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(dests.select("o_orderkey", F.col("n_name").alias("dest")), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    got = star.raw_flights(spark, str(tmp_path))
    keys = ["l_orderkey", "dest"]
    number = F.col("op_carrier_fl_num").cast("long")
    found = got.select(number, "dest").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want.select(*keys).collect()))
    assert len(found) > 10


@pytest.mark.parametrize("name", ["q6_whole_profile", "q1_clean", "q1_step_accounting", "s13_run_metrics"])
def test_raw_text_goes_when_its_job_is_done(spark, monkeypatch, name):
    paths, write = [], writers.write_raw_csv

    def noted(df, path):
        paths.append(path)
        write(df.limit(200), path)

    monkeypatch.setattr(writers, "write_raw_csv", noted)
    assert CHECKS[name].run(spark, SF_DIR).count() > 0
    folder = spark._jvm.org.apache.hadoop.fs.Path(paths[0])
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert len(paths) == 1 and not system.exists(folder)


def test_samples_are_compared_by_digest(spark):
    rows = [(1, "x", -0.0), (1, "x", 0.0), (None, "y", float("nan")), (2, None, None), (None, None, 2.0)]
    base = spark.createDataFrame(rows, "a int, b string, c double")
    moved = spark.createDataFrame([(None, "y", None), (2, None, None)], base.schema)
    bounds = sample_bounds(base, {"same": (base, 1.0, 1), "moved": (moved, 0.5, 0)})
    got = {r.dataset: (r.base_rows, r.rows_from_base) for r in bounds.collect()}
    assert got == {"same": (5, True), "moved": (5, False)}
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)", _plan(bounds))
    assert dealt and all(DIGEST[0] in e for e in dealt)
    assert not any(re.search(r"\bb#", e) for e in dealt)
