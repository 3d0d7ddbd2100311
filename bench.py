"""Times the jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

The raw CSV is prepared first and not timed. Each job then reads files, computes
and writes files, as its users run it: cleaning reads the CSV, the others read
the cleaned Parquet table. ``value`` is the sum. ``$BENCH_FACTOR`` repeats the
records under other flight numbers, to see how the times grow.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from aeropunct.operators import profiling, reports, trends  # noqa: E402
from aeropunct.plans import jobs  # noqa: E402
from aeropunct.session import build_session, scratch_dir  # noqa: E402
from aeropunct.sources import readers, star, writers  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
FACTOR = int(os.environ.get("BENCH_FACTOR", "1"))


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        CPUS,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))

    def new(label: str) -> str:
        return scratch_dir(spark, label)

    raw_csv, table = new("raw"), new("table")
    raw = star.raw_flights(spark, SF_DIR, copies=True)
    if FACTOR > 1:
        number = F.explode(F.sequence(F.lit(1), F.lit(FACTOR)))
        raw = raw.select(*raw.columns, number.alias("i")).repartition(CPUS)
        raw = raw.withColumn("op_carrier_fl_num", F.col("op_carrier_fl_num") + F.col("i") * 1e6)
    writers.write_raw_csv(raw.drop("i"), raw_csv)

    out: dict[str, str] = {
        x: new(x) for x in ("airport", "route", "band", "single", "ranking", "scaled")
    }
    noop = lambda df: df.write.format("noop").mode("overwrite").save()

    def rollups() -> None:
        noop(
            jobs.report_rollups(
                reports.parse_stats(readers.read_keyed_text(spark, out["airport"])),
                reports.parse_stats(readers.read_keyed_text(spark, out["route"]), "route"),
                readers.read_delimited(spark, out["single"]),
                readers.read_flights(spark, out["ranking"]),
            )
        )

    def profile() -> None:
        text = readers.read_raw_text(spark, raw_csv)
        noop(profiling.profile(text))

    steps = {
        "q1_clean": lambda: jobs.run_cleaning(spark, raw_csv, table, "bench"),
        "q2_scale_datasets": lambda: jobs.run_scaling(spark, table, out["scaled"], "bench"),
        "q3_airport_report": lambda: jobs.run_carrier_report(
            spark, table, out["airport"], "bench"
        ),
        "q3_route_report": lambda: jobs.run_carrier_report(
            spark, table, out["route"], "bench", level="route"
        ),
        "q3_both_reports": lambda: jobs.run_carrier_reports(spark, table, new("both"), "bench"),
        "q4_band_report": lambda: jobs.run_band_report(
            spark, table, out["band"], "bench", single_csv=out["single"]
        ),
        "q5_carrier_ranking": lambda: jobs.run_ranking(spark, table, out["ranking"], "bench"),
        "q6_profile": profile,
        "q6_describe_exact": lambda: noop(
            profiling.describe_exact(readers.read_raw(spark, raw_csv))
        ),
        "q6_logical_dups": lambda: noop(profiling.logical_dups(readers.read_raw(spark, raw_csv))),
        "q7_trends": lambda: noop(trends.trends(readers.read_raw(spark, raw_csv))),
        "q8_report_rollups": rollups,
    }
    seconds = {}
    for name, step in steps.items():
        start = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - start, 3)
    rows = readers.read_flights(spark, table).count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total job time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name,
                "cleaned_rows": rows,
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
