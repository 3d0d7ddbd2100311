"""Flight records derived from a star schema of orders.

One flight per order line: the supplier's nation is the origin, the customer's
nation the destination, the part's brand the carrier. Every figure is integer
arithmetic on ``k``, a mix of the line's keys, so that any SQL engine derives
the same records. The expressions below are plain SQL that Spark and other
engines share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropunct.schema import RAW_COLUMNS

# ---------------------------------------------------------------------------
# The derivation rule of the test records.
# ---------------------------------------------------------------------------
KEY_EXPR = (
    "l_orderkey*7919 + l_partkey*10473 + l_suppkey*1299 + l_linenumber*155"
    " + CAST(l_quantity AS INT)*3245"
)

# First stage, on the joined tables plus k.
STAGE_ONE = {
    "dd": "CASE WHEN k%53=0 THEN NULL ELSE k%101-20"
    " + CASE WHEN k%11=0 THEN k%301 ELSE 0 END END",
}
# Second stage, on the first plus dd.
STAGE_TWO = {"ad": "CASE WHEN k%401=0 THEN NULL ELSE dd+k%31-18 END"}

RAW_EXPRS = {
    "year": "CAST(year(l_shipdate) AS INT)",
    "month": "CAST(month(l_shipdate) AS INT)",
    "day_of_month": "CAST(day(l_shipdate) AS INT)",
    "day_of_week": "CAST(k%7+1 AS INT)",
    "fl_date": "CAST(l_shipdate AS DATE)",
    "op_unique_carrier": "p_brand",
    "op_carrier_fl_num": "CAST(l_orderkey AS DOUBLE)",
    "origin": "CASE WHEN k%701=0 THEN NULL ELSE origin_name END",
    "origin_city_name": "origin_name || ', R' || CAST(origin_region AS STRING)",
    "origin_state_nm": "'Region ' || CAST(origin_region AS STRING)",
    "dest": "dest_name",
    "dest_city_name": "dest_name || ', R' || CAST(dest_region AS STRING)",
    "dest_state_nm": "'Region ' || CAST(dest_region AS STRING)",
    "crs_dep_time": "CAST(CASE WHEN k%997=0 THEN 2400 ELSE (k%24)*100+k%60 END AS INT)",
    "dep_time": "CAST(CASE WHEN dd IS NOT NULL THEN (k%24)*100+(k+7)%60 END AS DOUBLE)",
    "dep_delay": "CAST(dd AS DOUBLE)",
    "taxi_out": "CAST(CASE WHEN dd IS NOT NULL THEN 5+k%40 END AS DOUBLE)",
    "wheels_off": "CAST(CASE WHEN dd IS NOT NULL THEN (k%24)*100+(k+19)%60 END AS DOUBLE)",
    "wheels_on": "CAST(CASE WHEN ad IS NOT NULL THEN ((k+3)%24)*100+(k+31)%60 END AS DOUBLE)",
    "taxi_in": "CAST(CASE WHEN ad IS NOT NULL THEN 3+k%20 END AS DOUBLE)",
    "crs_arr_time": "CAST(((k+2)%24)*100+(k+41)%60 AS INT)",
    "arr_time": "CAST(CASE WHEN ad IS NOT NULL THEN ((k+3)%24)*100+(k+43)%60 END AS DOUBLE)",
    "arr_delay": "CAST(ad AS DOUBLE)",
    "cancelled": "CAST(CASE WHEN k%53=0 THEN 1 ELSE 0 END AS INT)",
    "cancellation_code": "CASE WHEN (k%53=0 AND k%7<>0) OR k%1009=0 THEN"
    " CASE k%4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END END",
    "diverted": "CAST(CASE WHEN k%401=0 AND k%53<>0 THEN 1 ELSE 0 END AS INT)",
    "crs_elapsed_time": "CAST(80+k%300 AS DOUBLE)",
    "actual_elapsed_time": "CAST(CASE WHEN ad IS NOT NULL THEN 86+k%300 END AS DOUBLE)",
    "air_time": "CAST(CASE WHEN ad IS NOT NULL THEN 60+k%300 END AS DOUBLE)",
    "distance": "CAST(CASE WHEN k%503=0 THEN 0 ELSE 100+k%2500 END AS DOUBLE)",
    "carrier_delay": "CAST(CASE WHEN ad>=15 THEN k%3*10 END AS INT)",
    "weather_delay": "CAST(CASE WHEN ad>=15 THEN k%5*5 END AS INT)",
    "nas_delay": "CAST(CASE WHEN ad>=15 THEN k%4*8 END AS INT)",
    "security_delay": "CAST(CASE WHEN ad>=15 THEN k%17 END AS INT)",
    "late_aircraft_delay": "CAST(CASE WHEN ad>=15 THEN k%7*6 END AS INT)",
}
# Numeric twins of the airport columns, for the redundancy check.
ID_EXPRS = {
    "origin_airport_id": "CASE WHEN k%701=0 THEN NULL ELSE origin_key END",
    "dest_airport_id": "dest_key",
}
# Records that occur twice in the view with copies.
COPY_RULE = "k%211=0"

# Run metrics derived from the event table, one per event.
RUN_EXPRS = {
    "Framework": "CASE event_id%3 WHEN 0 THEN 'MapReduce' WHEN 1 THEN 'Hive' ELSE 'Spark' END",
    "Environment": "CASE user_id%4 WHEN 0 THEN 'Local_1' WHEN 1 THEN 'AWS_4Nodes'"
    " WHEN 2 THEN 'AWS_8Nodes' ELSE 'AWS_16Nodes' END",
    "Dataset": "CASE (event_id*7+user_id)%9 WHEN 0 THEN 'flight_sample.parquet'"
    " WHEN 1 THEN 'flight_10.parquet' WHEN 2 THEN 'flight_25.parquet'"
    " WHEN 3 THEN 'flight_50.parquet' WHEN 4 THEN 'flight_75.parquet'"
    " WHEN 5 THEN 'flight_100.parquet' WHEN 6 THEN 'flight_150.parquet'"
    " WHEN 7 THEN 'flight_200.parquet' ELSE 'flight_300.parquet' END",
    "Execution_Time_Sec": "value",
}
# ---------------------------------------------------------------------------


def _aliased(exprs: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in exprs.items()]


def raw_flights(
    spark: SparkSession, sf_dir: str, copies: bool = False, ids: bool = False
) -> DataFrame:
    """The 35-column raw view; ``copies`` adds exact duplicates, ``ids`` id columns.

    Both lookup sides are joined down to one narrow row per key first, so an
    order line is shuffled at most once per key (part, supplier, order) and
    never again for the customer; the nations are joined last. No join is hinted: Spark
    broadcasts a side only when its known size is under the session's limit,
    otherwise adaptive execution splits skewed sort-merge partitions.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def nation(side: str) -> DataFrame:
        return table("nation").selectExpr(
            f"n_nationkey AS {side}_key", f"n_name AS {side}_name", f"n_regionkey AS {side}_region"
        )

    origins = table("supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey AS origin_key")
    dests = (
        table("orders")
        .selectExpr("o_orderkey AS l_orderkey", "o_custkey AS c_custkey")
        .join(table("customer").selectExpr("c_custkey", "c_nationkey AS dest_key"), "c_custkey")
        .drop("c_custkey")
    )
    carriers = table("part").selectExpr("p_partkey AS l_partkey", "p_brand")

    # k and both delays are generated, not just projected: Spark then evaluates
    # them once per line and lets later filters refer to them, where it would
    # otherwise repeat their formulas inside every filter it pushes down. Such
    # filters still run below the joins.
    lines = table("lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        F.inline(F.array(F.struct(F.expr(KEY_EXPR).alias("k")))),
    )
    # A copied record is a second row from the same scan, not a union that would
    # scan and join everything twice.
    times = F.when(F.expr(COPY_RULE), 2).otherwise(1) if copies else F.lit(1)
    delays = F.struct("dd", *[F.expr(e).alias(n) for n, e in STAGE_TWO.items()])
    lines = lines.selectExpr("*", *_aliased(STAGE_ONE)).select(
        *lines.columns, F.inline(F.array_repeat(delays, times))
    )
    trips = lines.join(carriers, "l_partkey").join(origins, "l_suppkey").join(dests, "l_orderkey")
    # Names come last, so that no shuffle carries them.
    trips = trips.join(nation("origin"), "origin_key").join(nation("dest"), "dest_key")
    exprs = {**RAW_EXPRS, **ID_EXPRS} if ids else RAW_EXPRS
    return trips.selectExpr(*_aliased(exprs))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-metrics rows derived from the event table."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*_aliased(RUN_EXPRS))


def _select_list(exprs: dict[str, str], indent: str = "    ") -> str:
    return f",\n{indent}".join(_aliased(exprs))


def raw_flights_sql(copies: bool = False, ids: bool = False) -> str:
    """The same raw view as one standalone SQL query."""
    exprs = {**RAW_EXPRS, **ID_EXPRS} if ids else RAW_EXPRS
    base = f"""
  SELECT l_orderkey, l_shipdate, p_brand,
    ns.n_name AS origin_name, ns.n_regionkey AS origin_region, ns.n_nationkey AS origin_key,
    nc.n_name AS dest_name, nc.n_regionkey AS dest_region, nc.n_nationkey AS dest_key,
    {KEY_EXPR} AS k
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation ns ON s_nationkey = ns.n_nationkey
  JOIN nation nc ON c_nationkey = nc.n_nationkey"""
    one = f"SELECT *, {_select_list(STAGE_ONE)} FROM ({base}) AS joined_lines"
    two = f"SELECT *, {_select_list(STAGE_TWO)} FROM ({one}) AS with_departure"
    if copies:
        two = f"SELECT * FROM ({two}) AS a UNION ALL SELECT * FROM ({two}) AS b WHERE {COPY_RULE}"
    return f"SELECT {_select_list(exprs)}\nFROM ({two}) AS trips"


def run_metrics_sql() -> str:
    return f"SELECT {_select_list(RUN_EXPRS)} FROM events"


assert tuple(RAW_EXPRS) == RAW_COLUMNS
