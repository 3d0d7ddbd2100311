"""Projections, filters and scalar functions, each over the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeropunct.checks.registry import (
    BAND_CASE,
    CAUSE_CASE,
    DEP_SUM,
    PEAK,
    check,
    cleaned,
    comparable,
    comparable_sql,
    finished,
    raw,
    rounded,
)
from aeropunct.functions import columns as fn
from aeropunct.operators import cleaning, reports, rollups, selection, trends
from aeropunct.schema import CAUSE_COLUMNS, FLOAT_COLUMNS, INT_COLUMNS, KEPT_COLUMNS
from aeropunct.sources import star

BRACKET_CASE = """CASE WHEN dep_delay <= 0 THEN 'On Time / Early'
  WHEN dep_delay <= 15 THEN 'Slight (<15m)'
  WHEN dep_delay <= 60 THEN 'Medium (15-60m)' ELSE 'Severe (>60m)' END"""
CODE_CASE = """CASE cancellation_code WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather'
  WHEN 'C' THEN 'National Air System' WHEN 'D' THEN 'Security' ELSE 'Unknown' END"""
MONTH_CASE = "CASE month " + " ".join(
    f"WHEN {i} THEN '{m}'" for i, m in enumerate(fn.MONTH_NAMES, 1)
) + " END"
SCALE_CASE = """CASE WHEN Dataset LIKE '%sample%' THEN 0
  ELSE CAST(regexp_extract(Dataset, 'flight_([0-9]+)', 1) AS INT) END"""


# -- P: projections and filters -----------------------------------------------


@check("p1_prune", f"SELECT {comparable_sql(KEPT_COLUMNS)} FROM raw")
def _(spark, sf_dir):
    return comparable(cleaning.prune(raw(spark, sf_dir)))


def _kept_type(column: str) -> str:
    return "FLOAT" if column in FLOAT_COLUMNS else "INT" if column in INT_COLUMNS else "VARCHAR"


@check(
    "p2_cast_columns",
    f"SELECT {comparable_sql(KEPT_COLUMNS)} FROM (SELECT "
    + ", ".join(f"CAST({c} AS {_kept_type(c)}) AS {c}" for c in KEPT_COLUMNS)
    + " FROM raw) AS casted",
)
def _(spark, sf_dir):
    # From text, where a whole number may be written with decimals.
    text = raw(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in KEPT_COLUMNS])
    return comparable(cleaning.cast_columns(text))


@check(
    "p3_with_hour",
    "SELECT crs_dep_time, CAST(floor(crs_dep_time/100) AS INT) AS hour FROM raw",
)
def _(spark, sf_dir):
    return cleaning.with_hour(raw(spark, sf_dir).select("crs_dep_time"))


@check(
    "p4_fill_causes",
    "SELECT " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in CAUSE_COLUMNS) + " FROM raw",
)
def _(spark, sf_dir):
    return cleaning.fill_causes(raw(spark, sf_dir).select(*CAUSE_COLUMNS))


@check("p5_drop_column", "SELECT * FROM shaped")
def _(spark, sf_dir):
    # The clock column is read for the hour and then dropped.
    return cleaning.shape_columns(raw(spark, sf_dir))


@check("p6_quality_filter", "SELECT * FROM clean")
def _(spark, sf_dir):
    return cleaning.quality_filter(cleaning.shape_columns(raw(spark, sf_dir)))


@check("p7_delay_band", f"SELECT origin, dep_delay, {BAND_CASE} AS delay_band FROM clean")
def _(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    return df.select("origin", "dep_delay", fn.delay_band("dep_delay").alias("delay_band"))


@check(
    "p8_primary_cause",
    f"""SELECT cancelled, cancellation_code, {', '.join(CAUSE_COLUMNS)},
  {CAUSE_CASE} AS primary_cause FROM clean""",
)
def _(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "cancelled", "cancellation_code", *CAUSE_COLUMNS, fn.primary_cause().alias("primary_cause")
    )


@check(
    "p9_exclude",
    """SELECT origin, month, delay_band, primary_cause FROM base
WHERE primary_cause <> 'NONE' AND delay_band <> 'UNKNOWN'""",
)
def _(spark, sf_dir):
    df = reports.flight_base(cleaned(spark, sf_dir))
    named = cleaning.exclude(df, "primary_cause", fn.CAUSE_NONE)
    known = cleaning.exclude(named, "delay_band", fn.BAND_UNKNOWN)
    return known.select("origin", "month", "delay_band", "primary_cause")


@check(
    "p10_select_rename",
    """SELECT origin AS airport, op_unique_carrier AS carrier, total_flights AS flights,
  carrier_rank AS place FROM ranking""",
)
def _(spark, sf_dir):
    return reports.carrier_ranking(cleaned(spark, sf_dir)).select(
        F.col("origin").alias("airport"),
        F.col("op_unique_carrier").alias("carrier"),
        F.col("total_flights").alias("flights"),
        F.col("carrier_rank").alias("place"),
    )


@check(
    "p11_with_delay",
    """SELECT op_unique_carrier, CAST(dep_delay AS FLOAT) AS dep_delay FROM raw
WHERE dep_delay IS NOT NULL""",
)
def _(spark, sf_dir):
    df = raw(spark, sf_dir).select("op_unique_carrier", "dep_delay")
    return cleaning.with_delay(df, "dep_delay")


@check(
    "p12_complete_rows",
    "SELECT dep_delay, arr_delay FROM raw WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL",
)
def _(spark, sf_dir):
    return cleaning.complete_rows(raw(spark, sf_dir), ["dep_delay", "arr_delay"])


@check("p13_cancelled", f"SELECT {comparable_sql()} FROM raw WHERE cancelled = 1")
def _(spark, sf_dir):
    return comparable(cleaning.cancelled(raw(spark, sf_dir)))


@check(
    "p13_operated",
    "SELECT op_unique_carrier, origin, dep_delay FROM raw WHERE cancelled = 0",
)
def _(spark, sf_dir):
    df = raw(spark, sf_dir).select("op_unique_carrier", "origin", "dep_delay", "cancelled")
    return cleaning.operated(df).drop("cancelled")


@check(
    "p14_hour_range",
    """SELECT origin, CAST(floor(crs_dep_time/100) AS INT) AS hour FROM raw
WHERE floor(crs_dep_time/100) BETWEEN 0 AND 23""",
)
def _(spark, sf_dir):
    df = cleaning.with_hour(raw(spark, sf_dir).select("origin", "crs_dep_time"))
    return df.filter(F.col("hour").between(0, 23)).select("origin", "hour")


@check(
    "p15_delay_bracket",
    f"SELECT dep_delay, {BRACKET_CASE} AS bracket FROM raw WHERE dep_delay IS NOT NULL",
)
def _(spark, sf_dir):
    df = raw(spark, sf_dir).select("dep_delay").dropna()
    return df.withColumn("bracket", fn.delay_bracket("dep_delay"))


@check(
    "p16_min_volume",
    """SELECT origin, sum(total_flights)::BIGINT AS total_flights FROM ranking
GROUP BY origin HAVING sum(total_flights) >= 1000""",
)
def _(spark, sf_dir):
    rep = reports.carrier_ranking(cleaned(spark, sf_dir))
    sums = rep.groupBy("origin").agg(F.sum("total_flights").alias("total_flights"))
    return selection.min_volume(sums, rollups.MIN_AIRPORT_FLIGHTS)


@check(
    "p17_keep_top",
    """SELECT origin, month, delay_band, total_flights FROM band_report WHERE origin IN (
  SELECT origin FROM band_report GROUP BY origin
  ORDER BY sum(total_flights) DESC, origin LIMIT 10)""",
)
def _(spark, sf_dir):
    rep = finished(spark, reports.band_report(cleaned(spark, sf_dir)), "p17")
    top = selection.keep_top(rep, "origin", "total_flights", 10)
    return top.select("origin", "month", "delay_band", "total_flights")


@check(
    "p18_skip_bad",
    """SELECT count(*) FILTER (WHERE origin IS NOT NULL) AS kept_rows,
  count(*) FILTER (WHERE origin IS NULL) AS skipped_rows,
  (SELECT count(*) FROM (SELECT DISTINCT op_unique_carrier, origin FROM raw
    WHERE origin IS NOT NULL) AS g) AS groups
FROM raw WHERE op_unique_carrier IS NOT NULL AND cancelled IS NOT NULL AND month IS NOT NULL""",
)
def _(spark, sf_dir):
    kept, counts = cleaning.skip_bad(raw(spark, sf_dir), reports.AIRPORT_REQUIRED)
    groups = kept.select("op_unique_carrier", "origin").distinct()
    return counts.withColumn("groups", groups.agg(F.count("*").alias("groups")).scalar())


@check(
    "p19_decode_code",
    f"""SELECT origin, cancellation_code, {CODE_CASE} AS reason FROM raw WHERE cancelled = 1""",
)
def _(spark, sf_dir):
    return cleaning.cancelled(raw(spark, sf_dir)).select(
        "origin", "cancellation_code", fn.decode_code("cancellation_code").alias("reason")
    )


@check(
    "p20_month_name",
    f"SELECT fl_date::VARCHAR AS fl_date, month, {MONTH_CASE} AS month_name FROM raw",
)
def _(spark, sf_dir):
    df = comparable(raw(spark, sf_dir))
    return df.select("fl_date", "month", fn.month_name("month").alias("month_name"))


@check("p21_scale_pct", f"SELECT Dataset, {SCALE_CASE} AS scale_pct FROM runs")
def _(spark, sf_dir):
    runs = star.run_metrics(spark, sf_dir)
    return runs.select("Dataset", fn.scale_pct("Dataset").alias("scale_pct"))


@check(
    "p22_unit_scaling",
    " UNION ALL ".join(
        f"SELECT '{title}' AS delay_cause, sum({c})::DOUBLE/1000000 AS total_millions FROM raw"
        for c, title in fn.CAUSE_TITLES.items()
    ),
)
def _(spark, sf_dir):
    return trends.cause_minutes(raw(spark, sf_dir)).select("delay_cause", "total_millions")


# -- F: scalar functions ------------------------------------------------------


@check(
    "f1_round",
    f"SELECT op_unique_carrier, {rounded(DEP_SUM, 'count(dep_delay)')} AS avg_dep_delay"
    " FROM clean GROUP BY op_unique_carrier",
)
def _(spark, sf_dir):
    df = cleaned(spark, sf_dir).groupBy("op_unique_carrier")
    return df.agg(F.round(F.avg("dep_delay"), 2).alias("avg_dep_delay"))


@check(
    "f2_arithmetic",
    """SELECT dep_delay - arr_delay AS made_up, abs(arr_delay) AS size,
  CAST(dep_delay AS DOUBLE) / CAST(distance AS DOUBLE) AS per_mile,
  CAST(cancelled AS DOUBLE) * 100 AS pct FROM clean""",
)
def _(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        (F.col("dep_delay") - F.col("arr_delay")).alias("made_up"),
        F.abs("arr_delay").alias("size"),
        (F.col("dep_delay").cast("double") / F.col("distance").cast("double")).alias("per_mile"),
        (F.col("cancelled").cast("double") * 100).alias("pct"),
    )


@check(
    "f3_casts",
    """SELECT CAST(distance AS VARCHAR) AS text, CAST(distance AS FLOAT) AS number,
  CAST(floor(distance/100) AS INT) AS whole, CAST(NULL AS FLOAT) AS no_number FROM raw""",
)
def _(spark, sf_dir):
    df = raw(spark, sf_dir).select(F.col("distance").cast("string").alias("text"), "dest")
    return df.select(
        "text",
        fn.as_float("text").alias("number"),
        (fn.as_int("text") / 100).cast("int").alias("whole"),
        fn.as_float("dest").alias("no_number"),
    )


@check("f4_case", f"SELECT dep_delay, {BAND_CASE} AS band, {BRACKET_CASE} AS bracket FROM clean")
def _(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "dep_delay",
        fn.delay_band("dep_delay").alias("band"),
        fn.delay_bracket("dep_delay").alias("bracket"),
    )


@check("f5_greatest", f"SELECT {', '.join(CAUSE_COLUMNS)}, {PEAK} AS peak FROM clean")
def _(spark, sf_dir):
    df = cleaned(spark, sf_dir).select(*CAUSE_COLUMNS)
    return df.withColumn("peak", F.greatest(*CAUSE_COLUMNS))


@check("f6_coalesce", "SELECT coalesce(cancellation_code, 'UNKNOWN') AS code FROM raw")
def _(spark, sf_dir):
    code = F.coalesce("cancellation_code", F.lit("UNKNOWN"))
    return raw(spark, sf_dir).select(code.alias("code"))


@check(
    "f7_concat",
    """SELECT op_unique_carrier || ',' || origin AS airport_key,
  op_unique_carrier || ',' || origin || '-' || dest AS route_key FROM clean""",
)
def _(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        F.concat_ws(",", "op_unique_carrier", "origin").alias("airport_key"),
        F.concat_ws(",", "op_unique_carrier", reports.route_name()).alias("route_key"),
    )


@check(
    "f8_split",
    """SELECT split_part(origin_city_name, ', ', 1) AS city,
  split_part(origin_city_name, ', ', 2) AS state FROM raw""",
)
def _(spark, sf_dir):
    parts = F.split("origin_city_name", ", ")
    return raw(spark, sf_dir).select(
        parts.getItem(0).alias("city"), parts.getItem(1).alias("state")
    )


@check(
    "f9_regexp_extract",
    """SELECT op_unique_carrier, CAST(regexp_extract(op_unique_carrier, '#([0-9]+)', 1) AS INT)
  AS number FROM raw""",
)
def _(spark, sf_dir):
    digits = F.regexp_extract("op_unique_carrier", r"#(\d+)", 1).try_cast("int")
    return raw(spark, sf_dir).select("op_unique_carrier", digits.alias("number"))


@check(
    "f10_format",
    """SELECT printf('%d', month) || ' ' || printf('%.2f', CAST(distance AS DOUBLE)) || ' 100%'
  AS text FROM clean""",
)
def _(spark, sf_dir):
    text = F.format_string("%d %.2f 100%%", "month", F.col("distance").cast("double"))
    return cleaned(spark, sf_dir).select(text.alias("text"))


@check(
    "f11_months_text",
    """SELECT dest, '[' || array_to_string(list_sort(list(DISTINCT month)), ', ') || ']' AS months
FROM clean GROUP BY dest""",
)
def _(spark, sf_dir):
    pairs = cleaned(spark, sf_dir).select("dest", "month").distinct()
    months = pairs.groupBy("dest").agg(F.array_sort(F.collect_set("month")).alias("months"))
    return months.select("dest", fn.months_text("months").alias("months"))


@check(
    "f12_null_tests",
    """SELECT count(*) FILTER (WHERE cancellation_code IS NULL) AS null_codes,
  count(*) FILTER (WHERE cancellation_code IS NOT NULL) AS known_codes,
  count(*) FILTER (WHERE coalesce(origin, '') = '') AS missing_origins FROM raw""",
)
def _(spark, sf_dir):
    code = F.col("cancellation_code")
    origin = F.coalesce("origin", F.lit(""))
    return raw(spark, sf_dir).select(code, origin.alias("origin")).agg(
        F.count_if(code.isNull()).alias("null_codes"),
        F.count_if(code.isNotNull()).alias("known_codes"),
        F.count_if(fn.is_missing("origin")).alias("missing_origins"),
    )


@check(
    "f13_text_to_number",
    "SELECT dep_delay, coalesce(dep_delay, 0.0) AS number, 0.0::DOUBLE AS no_number FROM raw",
)
def _(spark, sf_dir):
    return raw(spark, sf_dir).select(
        "dep_delay",
        fn.number_or_zero(F.col("dep_delay").cast("string")).alias("number"),
        fn.number_or_zero("dest").alias("no_number"),
    )


@check("f14_file_name", "SELECT '/data/' || Dataset AS path, Dataset AS file FROM runs")
def _(spark, sf_dir):
    path = F.concat(F.lit("/data/"), "Dataset")
    paths = star.run_metrics(spark, sf_dir).select(path.alias("path"))
    return paths.withColumn("file", fn.file_name("path"))
