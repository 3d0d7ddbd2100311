"""Roll-ups of the finished reports.

They read a report several times, so give them a written one: a report that is
still a plan over the flights would be computed from the flights as often.

Report figures have two decimals, so sums are taken over decimals: they are
exact and do not depend on the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropunct.functions.columns import BAND_UNKNOWN, BANDS, scale_pct
from aeropunct.operators.cleaning import exclude
from aeropunct.operators.selection import keep_top, min_volume, top_groups, top_k

# List lengths and the smallest airport of the roll-ups.
TOP_CARRIERS = 10
TOP_AIRPORTS = 10
TOP_ROUTES = 10
MATRIX_AIRPORTS = 15
MATRIX_CARRIERS = 10
MIN_AIRPORT_FLIGHTS = 1000
FULL_DATASET = "flight_100.parquet"
SCALE_UP_ENVIRONMENT = "AWS_8Nodes"


def _figure(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def _with_volumes(rep: DataFrame) -> DataFrame:
    """Cancelled and valid flights and total delay minutes, derived from the rates."""
    flights = F.col("total_flights").cast("decimal(18,0)")
    gone = (flights * _figure("cancelation_rate") * F.lit(0.01).cast("decimal(3,2)")).cast(
        "decimal(22,4)"
    )
    valid = (flights - F.col("cancelled_flights")).cast("decimal(22,4)")
    minutes = (F.col("valid_flights") * _figure("avg_arr_delay")).cast("decimal(28,6)")
    return (
        rep.withColumn("cancelled_flights", gone)
        .withColumn("valid_flights", valid)
        .withColumn("total_delay_min", minutes)
    )


def _volume_sums(rep: DataFrame, key: str) -> DataFrame:
    return _with_volumes(rep).groupBy(key).agg(
        F.sum(F.col("total_flights").cast("bigint")).alias("total_flights"),
        F.sum("cancelled_flights").alias("cancelled_flights"),
        F.sum("valid_flights").alias("valid_flights"),
        F.sum("total_delay_min").alias("total_delay_min"),
    )


def carrier_cancel_rollup(rep: DataFrame, k: int = TOP_CARRIERS) -> DataFrame:
    """Carriers with the highest share of cancelled flights over all their airports."""
    rate = _ratio(F.col("cancelled_flights") * 100, F.col("total_flights"))
    sums = _volume_sums(rep, "op_unique_carrier").select(
        "op_unique_carrier", "total_flights", rate.alias("global_cancel_rate")
    )
    return top_k(sums, "global_cancel_rate", k, ["op_unique_carrier"])


def airport_delay_rollup(
    rep: DataFrame, k: int = TOP_AIRPORTS, min_flights: int = MIN_AIRPORT_FLIGHTS
) -> DataFrame:
    """Airports with the highest mean arrival delay, weighted by valid flights."""
    delay = _ratio(F.col("total_delay_min"), F.col("valid_flights"))
    sums = _volume_sums(rep, "origin").select(
        "origin", "total_flights", delay.alias("global_avg_delay")
    )
    return top_k(min_volume(sums, min_flights), "global_avg_delay", k, ["origin"])


def route_rollup(rep: DataFrame, k: int = TOP_ROUTES) -> DataFrame:
    """Busiest routes with their weighted mean arrival delay."""
    delay = _ratio(F.col("total_delay_min"), F.col("valid_flights"))
    sums = _volume_sums(rep, "route").select(
        "route", "total_flights", delay.alias("global_avg_delay")
    )
    return top_k(sums, "total_flights", k, ["route"])


def month_heatmap(rep: DataFrame, k: int = TOP_AIRPORTS) -> DataFrame:
    """Weighted mean departure delay by month for the busiest airports, a column per month.

    A band without a mean delay (cancelled flights) counts with 0 minutes, so
    cancellations dilute the mean. That is the published definition.
    """
    top = keep_top(rep, "origin", "total_flights", k)
    minutes = F.coalesce(_figure("avg_dep_delay"), F.lit(0)) * F.col("total_flights")
    sums = top.groupBy("origin").pivot("month", list(range(1, 13))).agg(
        F.sum(minutes).alias("minutes"), F.sum("total_flights").alias("flights")
    )
    return sums.select(
        "origin",
        *[
            _ratio(F.col(f"{m}_minutes"), F.col(f"{m}_flights")).alias(f"m{m:02d}")
            for m in range(1, 13)
        ],
    )


def band_share(rep: DataFrame, k: int = TOP_AIRPORTS) -> DataFrame:
    """Share of each delay band at the busiest airports, flights without band left out."""
    known = exclude(keep_top(rep, "origin", "total_flights", k), "delay_band", BAND_UNKNOWN)
    wide = known.groupBy("origin").pivot("delay_band", list(BANDS)).agg(F.sum("total_flights"))
    total = sum((F.coalesce(F.col(b), F.lit(0)) for b in BANDS), F.lit(0))
    return wide.select(
        "origin", *[(F.col(b) * 100.0 / total).alias(f"{b.lower()}_pct") for b in BANDS]
    )


def diff_cells(
    rep: DataFrame, airports: int = MATRIX_AIRPORTS, carriers: int = MATRIX_CARRIERS
) -> DataFrame:
    """Difference of each of the busiest carriers at each of the busiest airports.

    Both lists are taken from the whole ranking, not one after the other.
    """
    busiest = top_groups(rep, "origin", "total_flights", airports)
    largest = top_groups(rep, "op_unique_carrier", "total_flights", carriers)
    return (
        rep.join(busiest, "origin", "left_semi")
        .join(largest, "op_unique_carrier", "left_semi")
        .select("origin", "op_unique_carrier", "diff_from_airport_avg")
    )


def diff_matrix(
    rep: DataFrame, airports: int = MATRIX_AIRPORTS, carriers: int = MATRIX_CARRIERS
) -> DataFrame:
    """The same as a matrix, a row per airport and a column per carrier.

    The column names are the busiest carriers: at most ``carriers`` names reach
    the driver.
    """
    heads = top_groups(rep, "op_unique_carrier", "total_flights", carriers)
    names = sorted(r.op_unique_carrier for r in heads.collect())
    cells = diff_cells(rep, airports, carriers)
    return cells.groupBy("origin").pivot("op_unique_carrier", names).agg(
        F.max("diff_from_airport_avg")
    )


def diff_matrix_cells(
    rep: DataFrame, airports: int = MATRIX_AIRPORTS, carriers: int = MATRIX_CARRIERS
) -> DataFrame:
    """The matrix cell by cell, empty cells too: row, column, place of the column, value."""
    wide = diff_matrix(rep, airports, carriers)
    names = wide.columns[1:]
    if not names:
        kinds = "origin string, column_place int, op_unique_carrier string, diff_from_airport_avg double"
        return rep.sparkSession.createDataFrame([], kinds)
    cells = F.array(
        *[
            F.struct(
                F.lit(at).alias("column_place"),
                F.lit(name).alias("op_unique_carrier"),
                F.col(f"`{name}`").alias("diff_from_airport_avg"),
            )
            for at, name in enumerate(names, 1)
        ]
    )
    return wide.select("origin", F.inline(cells))


def carrier_diff_rollup(rep: DataFrame) -> DataFrame:
    """Carriers by their difference to the airport averages, weighted by flights."""
    flights = F.col("total_flights").cast("decimal(18,0)")
    sums = rep.groupBy("op_unique_carrier").agg(
        F.sum((_figure("diff_from_airport_avg") * flights).cast("decimal(28,2)")).alias("weighted"),
        F.sum("total_flights").alias("total_flights"),
    )
    return sums.select(
        "op_unique_carrier",
        "total_flights",
        _ratio(F.col("weighted"), F.col("total_flights")).alias("global_avg_diff"),
    ).orderBy(F.asc_nulls_last("global_avg_diff"), "op_unique_carrier")


def scale_out(metrics: DataFrame, dataset: str = FULL_DATASET) -> DataFrame:
    """Mean run time per framework and environment on one data set."""
    return (
        metrics.filter(F.col("Dataset") == dataset)
        .groupBy("Framework", "Environment")
        .agg(F.avg("Execution_Time_Sec").alias("avg_sec"))
    )


def scale_up(metrics: DataFrame, environment: str = SCALE_UP_ENVIRONMENT) -> DataFrame:
    """Mean run time per framework and data set size in one environment, samples left out."""
    return (
        metrics.filter(F.col("Environment") == environment)
        .withColumn("scale_pct", scale_pct("Dataset"))
        .filter(F.col("scale_pct") > 0)
        .groupBy("Framework", "scale_pct")
        .agg(F.avg("Execution_Time_Sec").alias("avg_sec"))
    )


def run_summary(
    metrics: DataFrame, dataset: str = FULL_DATASET, environment: str = SCALE_UP_ENVIRONMENT
) -> DataFrame:
    """Both views of the run metrics: (view, Framework, label, avg_sec)."""
    out = scale_out(metrics, dataset).select(
        F.lit("scale_out").alias("view"),
        "Framework",
        F.col("Environment").alias("label"),
        "avg_sec",
    )
    up = scale_up(metrics, environment).select(
        F.lit("scale_up").alias("view"),
        "Framework",
        F.col("scale_pct").cast("string").alias("label"),
        "avg_sec",
    )
    return out.unionByName(up)
