"""Command line: ``python -m aeropunct JOB INPUT OUTPUT ENVIRONMENT``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from aeropunct.plans import jobs
from aeropunct.session import build_session

JOBS = {
    "clean": jobs.run_cleaning,
    "scale": jobs.run_scaling,
    "airport-report": jobs.run_carrier_report,
    "route-report": jobs.run_carrier_report,
    "carrier-reports": jobs.run_carrier_reports,
    "band-report": jobs.run_band_report,
    "ranking": jobs.run_ranking,
    "profile": jobs.run_profile,
    "trends": jobs.run_trends,
    "rollups": jobs.run_rollups,
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="aeropunct")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("environment")
    parser.add_argument("--metrics", help="folder for the run-metrics rows")
    parser.add_argument("--single-csv", help="band report: also write one CSV file here")
    parser.add_argument(
        "--single-file", action="store_true", help="carrier reports: one sorted file each"
    )
    parser.add_argument(
        "--shuffle-partitions", type=int, help="initial shuffle partitions of the session"
    )
    parser.add_argument("--rejects", help="clean: list cells that do not convert here, as Parquet")
    parser.add_argument("--keys", nargs="+", help="scale: choose samples by hash of these columns")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    special = {
        "clean": {"rejects_path": args.rejects},
        "scale": {"keys": args.keys},
        "airport-report": {"single_file": args.single_file},
        "route-report": {"level": "route", "single_file": args.single_file},
        "carrier-reports": {"single_file": args.single_file},
        "band-report": {"single_csv": args.single_csv},
    }
    JOBS[args.job](
        spark,
        args.input,
        args.output,
        args.environment,
        args.metrics,
        **special.get(args.job, {}),
    )


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(
        f"aeropunct-{args.job}", shuffle_partitions=args.shuffle_partitions
    )
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
