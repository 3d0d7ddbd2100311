"""Aggregates, joins and rankings behind the punctuality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aeropunct.functions.columns import (
    CAUSE_NONE,
    delay_band,
    has_cause,
    primary_cause,
    stats_field,
    stats_text,
)

# Fields without which the statistics skip a row, and group keys.
AIRPORT_REQUIRED = ("op_unique_carrier", "origin", "cancelled", "month")
ROUTE_REQUIRED = ("op_unique_carrier", "origin", "dest", "cancelled", "month")
BAND_KEYS = ("origin", "month", "delay_band")
CAUSE_KEYS = (*BAND_KEYS, "primary_cause")
LEVEL_KEYS = {
    "airport": ("op_unique_carrier", "origin"),
    "route": ("op_unique_carrier", "origin", "dest"),
}
TOP_CAUSES = 3


# -- carrier statistics per airport and per route ----------------------------


def _punctuality_parts() -> list[Column]:
    """Mergeable parts: the statistics of a larger group follow from those of its parts.

    Rows are grouped by month too, in fixed-width buffers; the months of a larger
    group are then collected from these few rows, whatever numbers they are.

    A flight that was not cancelled counts with its arrival delay, or with 0
    when that is unknown.
    """
    flown = F.when(
        F.col("cancelled") != 1, F.coalesce("arr_delay", F.lit(0.0)).cast("double")
    )
    return [
        F.count("cancelled").alias("flights"),
        F.count_if(F.col("cancelled") == 1).alias("cancellations"),
        F.count(flown).alias("flown"),
        F.sum(flown).alias("delay_sum"),
        F.min(flown).alias("delay_min"),
        F.max(flown).alias("delay_max"),
    ]


def _merged_parts() -> list[Column]:
    """The parts of a group, from the parts of its sub-groups."""
    merge = {
        "flights": F.sum,
        "cancellations": F.sum,
        "flown": F.sum,
        "delay_sum": F.sum,
        "delay_min": F.min,
        "delay_max": F.max,
    }
    months = F.array_sort(F.collect_set("month")).alias("months")
    return [*[f(name).alias(name) for name, f in merge.items()], months]


def _punctuality_columns() -> list[Column]:
    zero = F.lit(0.0)
    return [
        F.col("flights").alias("total_flights"),
        F.coalesce("delay_min", zero).alias("min_arr_delay"),
        F.coalesce("delay_max", zero).alias("max_arr_delay"),
        F.coalesce(F.try_divide("delay_sum", "flown"), zero).alias("avg_arr_delay"),
        (F.col("cancellations") * 100.0 / F.col("flights")).alias("cancelation_rate"),
        F.col("months").alias("months_of_operation"),
    ]


def _complete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    # Plain IS NOT NULL tests, which reach the Parquet scan.
    for c in required:
        df = df.filter(F.col(c).isNotNull())
    return df


def route_name() -> Column:
    return F.concat_ws("-", "origin", "dest")


def carrier_airport_stats(df: DataFrame) -> DataFrame:
    """Punctuality of each carrier at each origin airport.

    Flights (cancelled ones too), lowest, highest and mean arrival delay, share
    cancelled in percent and months of operation. A group without a flight that
    took off shows delays of 0.
    """
    keys = ("op_unique_carrier", "origin")
    return stats_of_parts(punctuality_parts(_complete(df, AIRPORT_REQUIRED), keys), keys)


def carrier_route_stats(df: DataFrame) -> DataFrame:
    """As :func:`carrier_airport_stats` for each carrier and route."""
    keys = ("op_unique_carrier", "origin", "dest")
    stats = stats_of_parts(punctuality_parts(_complete(df, ROUTE_REQUIRED), keys), keys)
    return _with_route(stats)


def _with_route(stats: DataFrame) -> DataFrame:
    measures = [c for c in stats.columns if c not in ("op_unique_carrier", "origin", "dest")]
    return stats.select("op_unique_carrier", route_name().alias("route"), *measures)


def punctuality_parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts per group and month. Rows that miss a required field are only counted.

    ``skipped`` has the rows of a group whose cancellation flag is null; groups with
    a null key or month hold skipped rows only.
    """
    known = F.col("cancelled").isNotNull()
    measured = df.select(
        *keys,
        "month",
        "arr_delay",
        "cancelled",
        known.alias("known"),
    )
    parts = [*_punctuality_parts(), F.count_if(~F.col("known")).alias("skipped")]
    return measured.groupBy(*keys, "month").agg(*parts)


def stats_of_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Statistics of the groups whose rows have every required field."""
    whole = _complete(parts.filter("flights > 0"), [*keys, "month"])
    return whole.groupBy(*keys).agg(*_merged_parts()).select(*keys, *_punctuality_columns())


def skipped_rows(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of rows that the statistics leave out."""
    missing = F.lit(False)
    for c in (*keys, "month"):
        missing = missing | F.col(c).isNull()
    lost = F.col("skipped") + F.when(missing, F.col("flights")).otherwise(0)
    return parts.agg(F.coalesce(F.sum(lost), F.lit(0)).alias("skipped_rows"))


def report_of_parts(parts: DataFrame, level: str) -> DataFrame:
    """Report text of one level from the parts by route (or, for airports, by airport)."""
    keys = LEVEL_KEYS[level]
    stats = stats_of_parts(parts, keys)
    return format_stats(_with_route(stats), "route") if level == "route" else format_stats(stats)


def carrier_report(df: DataFrame, level: str) -> DataFrame:
    """Report text of one level from one scan."""
    if level == "route":
        return format_stats(carrier_route_stats(df), "route")
    return format_stats(carrier_airport_stats(df))


def carrier_stats_by_level(df: DataFrame) -> DataFrame:
    """Both statistics from one scan, told apart by ``level`` (airport or route).

    Rows are aggregated to routes once; the airport level merges these few rows.
    Rows without a destination count for their airport only.
    """
    keys = LEVEL_KEYS["route"]
    parts = punctuality_parts(_complete(df, AIRPORT_REQUIRED), keys)
    # One grouping-sets step over the route parts gives both levels.
    levels = parts.groupingSets(
        [[F.col(c) for c in keys], [F.col(c) for c in keys[:2]]], *[F.col(c) for c in keys]
    ).agg(*_merged_parts(), F.grouping("dest").alias("is_airport"))
    is_airport = F.col("is_airport") == 1
    return levels.filter(is_airport | F.col("dest").isNotNull()).select(
        F.when(is_airport, "airport").otherwise("route").alias("level"),
        "op_unique_carrier",
        F.when(is_airport, F.col("origin")).otherwise(route_name()).alias("place"),
        *_punctuality_columns(),
    )


def format_stats(df: DataFrame, place: str = "origin") -> DataFrame:
    """Statistics as report text: ``Key`` is ``carrier,place`` and ``Value`` one line."""
    return df.select(
        F.concat_ws(",", "op_unique_carrier", place).alias("Key"), stats_text().alias("Value")
    )


def parse_stats(text: DataFrame, place: str = "origin") -> DataFrame:
    """Report text back to columns; lines with another shape give nulls."""
    key = F.split("Key", ",")
    numbers = ("min_arr_delay", "max_arr_delay", "avg_arr_delay", "cancelation_rate")
    return text.select(
        F.get(key, F.lit(0)).alias("op_unique_carrier"),
        F.get(key, F.lit(1)).alias(place),
        stats_field("Value", "total_flights").try_cast("bigint").alias("total_flights"),
        *[stats_field("Value", n).try_cast("float").alias(n) for n in numbers],
        stats_field("Value", "months_of_operation").alias("months_of_operation"),
    )


# -- delay bands and causes per airport and month ----------------------------


def flight_base(df: DataFrame) -> DataFrame:
    """Delay band and primary cause of each flight."""
    return df.select(
        "origin",
        "month",
        "dep_delay",
        "arr_delay",
        delay_band("dep_delay").alias("delay_band"),
        primary_cause().alias("primary_cause"),
    )


def band_stats(df: DataFrame) -> DataFrame:
    """Flights and mean delays per airport, month and band."""
    return (
        flight_base(df)
        .groupBy(*BAND_KEYS)
        .agg(
            F.count("*").alias("total_flights"),
            F.avg("dep_delay").alias("avg_dep_delay"),
            F.avg("arr_delay").alias("avg_arr_delay"),
        )
    )


def cause_counts(df: DataFrame) -> DataFrame:
    """Frequency of each cause per airport, month and band, without NONE."""
    named = flight_base(df.filter(has_cause()))
    return named.groupBy(*CAUSE_KEYS).agg(F.count("*").alias("cause_freq"))


def rank_causes(counts: DataFrame) -> DataFrame:
    """Number the causes of each group by frequency; the label settles ties."""
    order = Window.partitionBy(*BAND_KEYS).orderBy(F.desc("cause_freq"), "primary_cause")
    return counts.withColumn("rnk", F.row_number().over(order))


def join_causes(stats: DataFrame, ranked: DataFrame) -> DataFrame:
    """Band statistics with their ranked causes; groups without a cause stay."""
    return stats.join(ranked, list(BAND_KEYS), "left")


def _cause_at(rank: int) -> Column:
    return F.max(F.when(F.col("rnk") == rank, F.col("primary_cause"))).alias(f"top_cause_{rank}")


def pivot_top(joined: DataFrame, n: int = TOP_CAUSES) -> DataFrame:
    """One row per group with its n most frequent causes as columns."""
    stats = ("total_flights", "avg_dep_delay", "avg_arr_delay")
    wide = joined.groupBy(*BAND_KEYS, *stats).agg(*[_cause_at(i + 1) for i in range(n)])
    return wide.select(
        *BAND_KEYS,
        "total_flights",
        *[F.round(c, 2).alias(c) for c in stats[1:]],
        *[f"top_cause_{i + 1}" for i in range(n)],
    )


def band_report_joined(df: DataFrame) -> DataFrame:
    """The band report in its join form: two aggregates of the table, then a left join."""
    return pivot_top(join_causes(band_stats(df), rank_causes(cause_counts(df))))


def band_report(df: DataFrame, n: int = TOP_CAUSES) -> DataFrame:
    """Flights, mean delays and the n most frequent causes per airport, month and band.

    One scan and no join: flights are aggregated per cause, the few causes of a
    group are numbered with NONE last, and their parts are merged. The window
    and the second aggregate share one exchange of that small result.
    """
    per_cause = (
        flight_base(df)
        .groupBy(*CAUSE_KEYS)
        .agg(
            F.count("*").alias("flights"),
            F.sum("dep_delay").alias("dep_sum"),
            F.count("dep_delay").alias("dep_n"),
            F.sum("arr_delay").alias("arr_sum"),
            F.count("arr_delay").alias("arr_n"),
        )
    )
    is_none = F.col("primary_cause") == CAUSE_NONE
    order = Window.partitionBy(*BAND_KEYS).orderBy(is_none, F.desc("flights"), "primary_cause")
    # An equality join never matches null keys, so such groups show no causes.
    named = ~is_none & F.col("origin").isNotNull() & F.col("month").isNotNull()
    ranked = per_cause.withColumn("rnk", F.row_number().over(order)).withColumn(
        "primary_cause", F.when(named, F.col("primary_cause"))
    )
    return (
        ranked.groupBy(*BAND_KEYS)
        .agg(
            F.sum("flights").alias("total_flights"),
            F.round(F.try_divide(F.sum("dep_sum"), F.sum("dep_n")), 2).alias("avg_dep_delay"),
            F.round(F.try_divide(F.sum("arr_sum"), F.sum("arr_n")), 2).alias("avg_arr_delay"),
            *[_cause_at(i + 1) for i in range(n)],
        )
        .orderBy(*BAND_KEYS)
    )


# -- carriers against the average of their airport ---------------------------


def carrier_stats(df: DataFrame) -> DataFrame:
    """Flights, mean delays and share cancelled per airport and carrier, rounded."""
    return df.groupBy("origin", "op_unique_carrier").agg(
        F.count("*").alias("total_flights"),
        F.round(F.avg("dep_delay"), 2).alias("avg_dep_delay"),
        F.round(F.avg("arr_delay"), 2).alias("avg_arr_delay"),
        _cancel_rate(F.sum("cancelled"), F.count("cancelled")).alias("cancellation_rate"),
    )


def _cancel_rate(cancellations: Column, flights: Column) -> Column:
    # Scaled before dividing: the quotient is then rounded only once.
    return F.round(F.try_divide(cancellations * 100.0, flights), 2)


def airport_stats(df: DataFrame) -> DataFrame:
    """Mean departure delay of each airport over all its flights, rounded."""
    return df.groupBy("origin").agg(
        F.round(F.avg("dep_delay"), 2).alias("airport_avg_dep_delay")
    )


def join_airport(carriers: DataFrame, airports: DataFrame) -> DataFrame:
    """Carrier statistics with the average of their airport."""
    return carriers.join(airports, "origin", "inner")


def difference() -> Column:
    """Carrier minus airport, from the rounded averages and rounded again."""
    return F.round(F.col("avg_dep_delay") - F.col("airport_avg_dep_delay"), 2)


def rank_carriers(df: DataFrame) -> DataFrame:
    """Rank the carriers of each airport by rounded delay: an unknown average comes
    first, equal ones share a rank and leave a gap."""
    order = Window.partitionBy("origin").orderBy(F.asc_nulls_first("avg_dep_delay"))
    return df.withColumn("carrier_rank", F.rank().over(order))


def carrier_ranking_joined(df: DataFrame) -> DataFrame:
    """The ranking in its join form, which scans the table twice."""
    joined = join_airport(carrier_stats(df), airport_stats(df))
    with_diff = joined.withColumn("diff_from_airport_avg", difference())
    return rank_carriers(with_diff).orderBy("origin", "carrier_rank", "op_unique_carrier")


def carrier_ranking(df: DataFrame) -> DataFrame:
    """Carriers ranked against the average of their airport, from one scan.

    The airport's sums are windows over the sums of its carriers. Both windows
    have the airport as key and see one row per carrier, however many flights a
    single airport has.
    """
    sums = (
        df.filter(F.col("origin").isNotNull())
        .groupBy("origin", "op_unique_carrier")
        .agg(
            F.count("*").alias("total_flights"),
            F.sum("dep_delay").alias("dep_sum"),
            F.count("dep_delay").alias("dep_n"),
            F.round(F.avg("arr_delay"), 2).alias("avg_arr_delay"),
            _cancel_rate(F.sum("cancelled"), F.count("cancelled")).alias("cancellation_rate"),
        )
    )
    airport = Window.partitionBy("origin")
    airport_avg = F.try_divide(F.sum("dep_sum").over(airport), F.sum("dep_n").over(airport))
    compared = sums.select(
        "origin",
        "op_unique_carrier",
        "total_flights",
        F.round(F.try_divide("dep_sum", "dep_n"), 2).alias("avg_dep_delay"),
        "avg_arr_delay",
        "cancellation_rate",
        F.round(airport_avg, 2).alias("airport_avg_dep_delay"),
    ).withColumn("diff_from_airport_avg", difference())
    return rank_carriers(compared).orderBy("origin", "carrier_rank", "op_unique_carrier")
