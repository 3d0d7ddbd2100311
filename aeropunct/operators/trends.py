"""One- and two-variable statistics of delays and cancellations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aeropunct.functions.columns import (
    CAUSE_TITLES,
    as_float,
    as_int,
    delay_bracket,
    hour_of,
    month_name,
)
from aeropunct.operators.cleaning import cancelled, operated, with_delay

MILLION = 1_000_000


def _minutes(df: DataFrame) -> list[Column]:
    """The causes as numbers; in a table of text they may be anything."""
    kinds = dict(df.dtypes)
    return [
        (F.col(c).try_cast("double") if kinds[c] == "string" else F.col(c)).alias(c)
        for c in CAUSE_TITLES
    ]


def cause_minutes(df: DataFrame) -> DataFrame:
    """Total minutes per cause, the largest first, also in millions."""
    minutes = df.select(*_minutes(df))
    totals = minutes.agg(*[F.sum(c).alias(title) for c, title in CAUSE_TITLES.items()])
    titles = list(CAUSE_TITLES.values())
    long = totals.unpivot([], titles, "delay_cause", "total_minutes")
    return long.withColumn("total_millions", F.col("total_minutes") / MILLION).orderBy(
        F.desc("total_minutes"), "delay_cause"
    )


def delay_by_carrier(df: DataFrame) -> DataFrame:
    """Mean departure delay per carrier, the largest first."""
    return (
        with_delay(df, "dep_delay")
        .groupBy("op_unique_carrier")
        .agg(F.avg("dep_delay").alias("avg_dep_delay"))
        .orderBy(F.desc("avg_dep_delay"), "op_unique_carrier")
    )


def delay_by_month(df: DataFrame) -> DataFrame:
    """Mean departure delay per month, in calendar order."""
    return (
        with_delay(df, "dep_delay")
        .groupBy(as_int("month").alias("month_num"))
        .agg(F.avg("dep_delay").alias("avg_delay"))
        .withColumn("month_name", month_name("month_num"))
        .orderBy("month_num")
    )


def delay_by_hour(df: DataFrame) -> DataFrame:
    """Mean departure delay of operated flights per scheduled hour, 0 to 23.

    The cleaned table has the hour; the raw one only the clock time.
    """
    hour = F.col("hour") if "hour" in df.columns else hour_of("crs_dep_time")
    return (
        operated(df)
        .select(hour.alias("hour"), as_float("dep_delay").alias("dep_delay"))
        .filter(F.col("hour").between(0, 23))
        .groupBy("hour")
        .agg(F.avg("dep_delay").alias("avg_dep_delay"))
        .orderBy("hour")
    )


def cancellations_by_code(df: DataFrame) -> DataFrame:
    """Cancelled flights per code, the most frequent first; those without code are left out."""
    return (
        cancelled(df)
        .filter(F.col("cancellation_code").isNotNull())
        .groupBy("cancellation_code")
        .agg(F.count("*").alias("flights"))
        .orderBy(F.desc("flights"), "cancellation_code")
    )


def bracket_share(df: DataFrame) -> DataFrame:
    """Flights per departure bracket and their share of all known delays."""
    counts = (
        with_delay(df, "dep_delay")
        .groupBy(delay_bracket("dep_delay").alias("bracket"))
        .agg(F.count("*").alias("flights"))
    )
    # The window sees one row per bracket, four in all.
    total = F.sum("flights").over(Window.partitionBy())
    return counts.withColumn("share_pct", F.col("flights") * 100.0 / total)


def trends(df: DataFrame) -> DataFrame:
    """All of the above as (report, label, flights, value), from one scan.

    Flights are aggregated once to a cube of carrier, month, hour, bracket and
    code, whose size depends on these few values only. Grouping sets over the
    cube then give every report.
    """
    hour = F.col("hour") if "hour" in df.columns else hour_of("crs_dep_time")
    delay = as_float("dep_delay")
    axes = ("carrier", "month", "hour", "bracket", "code", "state")
    cube = df.select(
        F.col("op_unique_carrier").alias("carrier"),
        as_int("month").alias("month"),
        hour.alias("hour"),
        F.when(F.col("dep_delay").isNotNull(), delay_bracket(delay)).alias("bracket"),
        F.col("cancellation_code").alias("code"),
        F.col("cancelled").alias("state"),
        F.col("dep_delay").isNotNull().cast("int").alias("known"),
        delay.alias("delay"),
        *_minutes(df),
    )
    cube = cube.groupBy(*axes).agg(
        F.count("*").alias("flights"),
        F.sum("known").alias("known"),
        F.sum("delay").alias("delay_sum"),
        F.count("delay").alias("delay_n"),
        *[F.sum(c).alias(c) for c in CAUSE_TITLES],
    )
    flown, called_off = F.col("state") == 0, F.col("state") == 1
    groups = cube.groupingSets(
        [[F.col(a)] for a in axes[:5]] + [[]], *[F.col(a) for a in axes[:5]]
    ).agg(
        F.grouping_id().alias("gid"),
        F.sum("known").alias("known"),
        F.sum("delay_sum").alias("delay_sum"),
        F.sum("delay_n").alias("delay_n"),
        F.sum(F.when(flown, F.col("delay_sum"))).alias("flown_delay_sum"),
        F.sum(F.when(flown, F.col("delay_n"))).alias("flown_delay_n"),
        F.coalesce(F.sum(F.when(flown, F.col("known"))), F.lit(0)).alias("flown_known"),
        F.sum("flights").alias("flights"),
        F.coalesce(F.sum(F.when(flown, F.col("flights"))), F.lit(0)).alias("flown"),
        F.coalesce(F.sum(F.when(called_off, F.col("flights"))), F.lit(0)).alias("cancelled"),
        *[F.sum(c).alias(c) for c in CAUSE_TITLES],
    )

    def entry(report: str, label: Column, flights: Column, value: Column) -> Column:
        return F.struct(
            F.lit(report).alias("report"),
            label.cast("string").alias("label"),
            flights.alias("flights"),
            value.cast("double").alias("value"),
        )

    mean = F.try_divide("delay_sum", "delay_n")
    # A grouping set that keeps only axis i leaves the bits of the other axes set.
    only = {axis: 31 - (1 << (4 - i)) for i, axis in enumerate(axes[:5])}
    gid, none = F.col("gid"), F.array().cast(
        "array<struct<report:string,label:string,flights:bigint,value:double>>"
    )
    in_day = F.col("hour").between(0, 23) & (F.col("flown") > 0)
    has_code = F.col("code").isNotNull() & (F.col("cancelled") > 0)
    has_delay = F.col("known") > 0
    rows = (
        F.when(
            (gid == only["carrier"]) & has_delay,
            F.array(entry("delay_by_carrier", F.col("carrier"), F.col("known"), mean)),
        )
        .when(
            (gid == only["month"]) & has_delay,
            F.array(entry("delay_by_month", month_name("month"), F.col("known"), mean)),
        )
        .when(
            (gid == only["hour"]) & in_day,
            F.array(
                entry(
                    "delay_by_hour",
                    F.col("hour"),
                    F.col("flown_known"),
                    F.try_divide("flown_delay_sum", "flown_delay_n"),
                )
            ),
        )
        .when(
            (gid == only["bracket"]) & F.col("bracket").isNotNull(),
            F.array(entry("bracket_share", F.col("bracket"), F.col("known"), F.lit(None))),
        )
        .when(
            (gid == only["code"]) & has_code,
            F.array(
                entry(
                    "cancellations_by_code", F.col("code"), F.col("cancelled"), F.col("cancelled")
                )
            ),
        )
        .when(
            gid == 31,
            F.array(
                *[
                    entry("cause_minutes", F.lit(title), F.col("flights"), F.col(c))
                    for c, title in CAUSE_TITLES.items()
                ]
            ),
        )
        .otherwise(none)
    )
    # A few dozen rows from here on; the bracket shares need the sum of their report.
    all_flights = F.sum("flights").over(Window.partitionBy("report"))
    share = F.when(F.col("report") == "bracket_share", F.col("flights") * 100.0 / all_flights)
    return groups.select(F.inline(rows)).withColumn("value", F.coalesce("value", share))
