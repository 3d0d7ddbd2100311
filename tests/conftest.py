from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from aeropunct.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
        },
    )
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(shared))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """The raw view of the smallest data set, as a table of its own."""
    from aeropunct.session import scratch_dir
    from aeropunct.sources.star import raw_flights

    path = scratch_dir(spark, "raw")
    raw_flights(spark, SF_DIR, copies=True).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def cleaned(spark, raw):
    from aeropunct.operators.cleaning import clean
    from aeropunct.session import scratch_dir

    path = scratch_dir(spark, "clean")
    clean(raw).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def flights(spark):
    """Makes cleaned flight rows from a few given values."""
    from aeropunct.schema import CLEAN_FIELDS, CLEAN_SCHEMA

    plain = {
        "distance": 500.0,
        "dep_delay": 0.0,
        "arr_delay": 0.0,
        "month": 1,
        "cancelled": 0,
        "carrier_delay": 0,
        "weather_delay": 0,
        "nas_delay": 0,
        "security_delay": 0,
        "late_aircraft_delay": 0,
        "op_unique_carrier": "AA",
        "origin": "JFK",
        "dest": "LAX",
        "cancellation_code": None,
        "hour": 8,
    }

    def make(*rows):
        values = [[{**plain, **row}[name] for name, _ in CLEAN_FIELDS] for row in rows]
        return spark.createDataFrame(values, CLEAN_SCHEMA)

    return make
