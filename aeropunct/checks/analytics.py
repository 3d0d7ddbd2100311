"""Joins, aggregates, windows, top-k lists, set operations and whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeropunct.checks.profiles import (
    DESCRIPTION,
    EXTREMES,
    RECOVERY,
    copies,
    per_column,
    sample_bounds,
    sample_bounds_sql,
    sparse_rows_sql,
    surplus_sql,
)
from aeropunct.checks.projections import BRACKET_CASE, MONTH_CASE, SCALE_CASE
from aeropunct.checks.registry import (
    ARR_SUM,
    DEP_SUM,
    check,
    cleaned,
    finished,
    hundredths,
    raw,
    rounded,
)
from aeropunct.checks.scans import BAND_REPORT, RANKING, clean_parquet, raw_csv, text_lines
from aeropunct.functions import columns as fn
from aeropunct.operators import profiling, reports, rollups, sampling, selection, trends
from aeropunct.plans import jobs
from aeropunct.schema import CLEAN_COLUMNS, LOGICAL_KEY, RANKING_FIELDS
from aeropunct.session import remove, scratch_dir
from aeropunct.sources import readers, star, writers

# -- J: joins -----------------------------------------------------------------

_CARRIERS = """origin, op_unique_carrier, total_flights, dep100/100.0 AS avg_dep_delay,
  avg_arr_delay, cancellation_rate"""


@check(
    "j1_join_airport",
    f"""SELECT {_CARRIERS}, airport100/100.0 AS airport_avg_dep_delay
FROM carriers JOIN airports USING (origin)""",
)
def _(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    return reports.join_airport(reports.carrier_stats(df), reports.airport_stats(df))


@check(
    "j2_join_causes",
    """SELECT origin, month, delay_band, total_flights, primary_cause,
  CAST(cause_freq AS DOUBLE) AS cause_freq, CAST(rnk AS DOUBLE) AS rnk
FROM band_stats LEFT JOIN ranked_causes USING (origin, month, delay_band)""",
)
def _(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    ranked = reports.rank_causes(reports.cause_counts(df))
    joined = reports.join_causes(reports.band_stats(df), ranked)
    return joined.select(
        *reports.BAND_KEYS,
        "total_flights",
        "primary_cause",
        *[F.col(c).cast("double").alias(c) for c in ("cause_freq", "rnk")],
    )


@check(
    "j3_left_semi",
    """SELECT origin, op_unique_carrier, total_flights FROM ranking WHERE op_unique_carrier IN (
  SELECT op_unique_carrier FROM ranking GROUP BY op_unique_carrier
  ORDER BY sum(total_flights) DESC, op_unique_carrier LIMIT 10)""",
)
def _(spark, sf_dir):
    rep = finished(spark, reports.carrier_ranking(cleaned(spark, sf_dir)), "j3")
    top = selection.keep_top(rep, "op_unique_carrier", "total_flights", 10)
    return top.select("origin", "op_unique_carrier", "total_flights")


# -- A: aggregates ------------------------------------------------------------


def _stats(place: str) -> str:
    return f"""SELECT op_unique_carrier, {place}, total_flights, low AS min_arr_delay,
  high AS max_arr_delay, coalesce(CAST(delay_sum AS DOUBLE)/nullif(flown, 0), 0.0) AS avg_arr_delay,
  CAST(gone AS DOUBLE)*100/total_flights AS cancelation_rate, months AS months_of_operation"""


def _months_as_text(df):
    return df.withColumn("months_of_operation", fn.months_text("months_of_operation"))


@check("a1_carrier_airport_stats", f"{_stats('origin')} FROM airport_parts")
def _(spark, sf_dir):
    return _months_as_text(reports.carrier_airport_stats(cleaned(spark, sf_dir)))


@check("a2_carrier_route_stats", f"{_stats('route')} FROM route_parts")
def _(spark, sf_dir):
    return _months_as_text(reports.carrier_route_stats(cleaned(spark, sf_dir)))


@check(
    "a2_stats_by_level",
    f"""{_stats("'airport' AS level, origin AS place")} FROM airport_parts
UNION ALL {_stats("'route' AS level, route AS place")} FROM route_parts""",
)
def _(spark, sf_dir):
    return _months_as_text(reports.carrier_stats_by_level(cleaned(spark, sf_dir)))


@check(
    "a3_distinct_months",
    """SELECT op_unique_carrier, dest, unnest(list_sort(list(DISTINCT month))) AS month
FROM clean GROUP BY op_unique_carrier, dest""",
)
def _(spark, sf_dir):
    return cleaned(spark, sf_dir).select("op_unique_carrier", "dest", "month").distinct()


@check("a4_carrier_stats", f"SELECT {_CARRIERS} FROM carriers")
def _(spark, sf_dir):
    return reports.carrier_stats(cleaned(spark, sf_dir))


@check("a5_airport_stats", "SELECT origin, airport100/100.0 AS airport_avg_dep_delay FROM airports")
def _(spark, sf_dir):
    return reports.airport_stats(cleaned(spark, sf_dir))


@check(
    "a6_band_stats",
    f"""SELECT origin, month, delay_band, count(*) AS total_flights,
  CAST({DEP_SUM} AS DOUBLE)/nullif(count(dep_delay), 0) AS avg_dep_delay,
  CAST({ARR_SUM} AS DOUBLE)/nullif(count(arr_delay), 0) AS avg_arr_delay
FROM base GROUP BY origin, month, delay_band""",
)
def _(spark, sf_dir):
    return reports.band_stats(cleaned(spark, sf_dir))


@check("a7_cause_counts", "SELECT * FROM causes")
def _(spark, sf_dir):
    return reports.cause_counts(cleaned(spark, sf_dir))


@check("a8_pivot_top", BAND_REPORT)
def _(spark, sf_dir):
    return reports.band_report_joined(cleaned(spark, sf_dir))


_CAUSES = " UNION ALL ".join(
    f"SELECT '{title}' AS delay_cause, sum({c})::BIGINT AS total_minutes FROM raw"
    for c, title in fn.CAUSE_TITLES.items()
)


@check(
    "a9_cause_minutes",
    f"""SELECT delay_cause, total_minutes, total_minutes::DOUBLE/1000000 AS total_millions
FROM ({_CAUSES}) AS c""",
)
def _(spark, sf_dir):
    return trends.cause_minutes(raw(spark, sf_dir))


@check(
    "a10_delay_by_carrier",
    """SELECT op_unique_carrier, avg(dep_delay) AS avg_dep_delay FROM raw
WHERE dep_delay IS NOT NULL GROUP BY op_unique_carrier""",
)
def _(spark, sf_dir):
    return trends.delay_by_carrier(raw(spark, sf_dir))


_HOUR = "CAST(floor(crs_dep_time/100) AS INT)"


@check(
    "a11_delay_by_hour",
    f"""SELECT {_HOUR} AS hour, avg(dep_delay) AS avg_dep_delay FROM raw
WHERE cancelled = 0 AND {_HOUR} BETWEEN 0 AND 23 GROUP BY 1""",
)
def _(spark, sf_dir):
    return trends.delay_by_hour(raw(spark, sf_dir))


@check(
    "a12_delay_by_month",
    f"""SELECT month AS month_num, {MONTH_CASE} AS month_name, avg(dep_delay) AS avg_delay FROM raw
WHERE dep_delay IS NOT NULL GROUP BY month""",
)
def _(spark, sf_dir):
    return trends.delay_by_month(raw(spark, sf_dir))


@check(
    "a13_cancellations_by_code",
    """SELECT cancellation_code, count(*) AS flights FROM raw
WHERE cancelled = 1 AND cancellation_code IS NOT NULL GROUP BY cancellation_code""",
)
def _(spark, sf_dir):
    return trends.cancellations_by_code(raw(spark, sf_dir))


@check(
    "a14_bracket_share",
    f"""SELECT {BRACKET_CASE} AS bracket, count(*) AS flights,
  count(*)::DOUBLE * 100 / sum(count(*)) OVER () AS share_pct
FROM raw WHERE dep_delay IS NOT NULL GROUP BY 1""",
)
def _(spark, sf_dir):
    return trends.bracket_share(raw(spark, sf_dir))


@check(
    "a15_global_aggregates",
    """SELECT count(*) AS flights, min(dep_delay) AS low, max(dep_delay) AS high,
  sum(dep_delay) AS minutes, sum(cancelled)::BIGINT AS cancelled FROM raw""",
)
def _(spark, sf_dir):
    return raw(spark, sf_dir).agg(
        F.count("*").alias("flights"),
        F.min("dep_delay").alias("low"),
        F.max("dep_delay").alias("high"),
        F.sum("dep_delay").alias("minutes"),
        F.sum("cancelled").alias("cancelled"),
    )


# Reports as the roll-ups see them: figures in hundredths.
_AIRPORT_FIGURES = f"""SELECT op_unique_carrier, origin, total_flights AS n,
  {hundredths("delay_sum", "flown")} AS avg100, {hundredths("100*gone", "total_flights")} AS rate100
FROM airport_parts"""
_ROUTE_FIGURES = _AIRPORT_FIGURES.replace("origin", "route").replace("airport_parts", "route_parts")
# Valid flights in ten-thousandths and delay minutes in millionths.
_VALID = "sum(CAST(10000*n - n*rate100 AS HUGEINT))"
_MINUTES = "sum(CAST((10000*n - n*rate100)*avg100 AS HUGEINT))"
_MEAN = f"(CAST({_MINUTES} AS DOUBLE)/1e6) / (CAST({_VALID} AS DOUBLE)/1e4)"

CANCEL_ROLLUP = f"""SELECT op_unique_carrier, sum(n)::BIGINT AS total_flights,
  CAST(sum(n*rate100) AS DOUBLE)/100 / sum(n) AS global_cancel_rate
FROM ({_AIRPORT_FIGURES}) AS f GROUP BY op_unique_carrier
ORDER BY global_cancel_rate DESC, op_unique_carrier LIMIT 10"""
AIRPORT_ROLLUP = f"""SELECT origin, sum(n)::BIGINT AS total_flights, {_MEAN} AS global_avg_delay
FROM ({_AIRPORT_FIGURES}) AS f GROUP BY origin HAVING sum(n) >= 1000
ORDER BY global_avg_delay DESC, origin LIMIT 10"""
ROUTE_ROLLUP = f"""SELECT route, sum(n)::BIGINT AS total_flights, {_MEAN} AS global_avg_delay
FROM ({_ROUTE_FIGURES}) AS f GROUP BY route ORDER BY total_flights DESC, route LIMIT 10"""


def _airport_text(spark, sf_dir):
    """The airport report after its way through text."""
    stats = reports.carrier_airport_stats(cleaned(spark, sf_dir))
    return reports.parse_stats(reports.format_stats(stats))


def _route_text(spark, sf_dir):
    stats = reports.carrier_route_stats(cleaned(spark, sf_dir))
    return reports.parse_stats(reports.format_stats(stats, "route"), "route")


@check("a17_carrier_cancel_rollup", CANCEL_ROLLUP)
def _(spark, sf_dir):
    return rollups.carrier_cancel_rollup(_airport_text(spark, sf_dir))


@check("a18_airport_delay_rollup", AIRPORT_ROLLUP)
def _(spark, sf_dir):
    return rollups.airport_delay_rollup(_airport_text(spark, sf_dir))


@check("a19_route_rollup", ROUTE_ROLLUP)
def _(spark, sf_dir):
    return rollups.route_rollup(_route_text(spark, sf_dir))


_BUSY = """(SELECT * FROM band_stats WHERE origin IN (SELECT origin FROM band_stats
  GROUP BY origin ORDER BY sum(total_flights) DESC, origin LIMIT 10)) AS busy"""
HEATMAP = "SELECT origin, " + ", ".join(
    f"""CAST(sum(coalesce(dep100, 0)*total_flights) FILTER (WHERE month = {m}) AS DOUBLE)/100
  / sum(total_flights) FILTER (WHERE month = {m}) AS m{m:02d}"""
    for m in range(1, 13)
) + f" FROM {_BUSY} GROUP BY origin"
BAND_SHARE = "SELECT origin, " + ", ".join(
    f"""CAST(sum(total_flights) FILTER (WHERE delay_band = '{b}') AS DOUBLE) * 100
  / sum(total_flights) AS {b.lower()}_pct"""
    for b in fn.BANDS
) + f" FROM {_BUSY} WHERE delay_band <> 'UNKNOWN' GROUP BY origin"


@check("a20_month_heatmap", HEATMAP)
def _(spark, sf_dir):
    rep = finished(spark, reports.band_report(cleaned(spark, sf_dir)), "a20")
    return rollups.month_heatmap(rep)


@check("a21_band_share", BAND_SHARE)
def _(spark, sf_dir):
    rep = finished(spark, reports.band_report(cleaned(spark, sf_dir)), "a21")
    return rollups.band_share(rep)


def _top(key: str, k: int) -> str:
    return f"""{key} IN (SELECT {key} FROM ranking GROUP BY {key}
  ORDER BY sum(total_flights) DESC, {key} LIMIT {k})"""


DIFF_CELLS = f"""SELECT origin, op_unique_carrier, diff_from_airport_avg FROM ranking
WHERE {_top("origin", 15)} AND {_top("op_unique_carrier", 10)}"""
CARRIER_DIFF = """SELECT op_unique_carrier, sum(total_flights)::BIGINT AS total_flights,
  CAST(sum(diff100*total_flights) AS DOUBLE)/100 / sum(total_flights) AS global_avg_diff
FROM ranking GROUP BY op_unique_carrier"""


@check("a22_diff_cells", DIFF_CELLS)
def _(spark, sf_dir):
    rep = finished(spark, reports.carrier_ranking(cleaned(spark, sf_dir)), "a22")
    return rollups.diff_cells(rep)


@check(
    "a22_diff_matrix",
    f"""SELECT o.origin, column_place, h.op_unique_carrier, diff_from_airport_avg
FROM (SELECT DISTINCT origin FROM ({DIFF_CELLS}) AS d) AS o
CROSS JOIN (SELECT op_unique_carrier, CAST(row_number() OVER (ORDER BY op_unique_carrier) AS INT)
  AS column_place FROM (SELECT DISTINCT op_unique_carrier FROM ranking
    WHERE {_top("op_unique_carrier", 10)}) AS c) AS h
LEFT JOIN ({DIFF_CELLS}) AS x
  ON x.origin = o.origin AND x.op_unique_carrier = h.op_unique_carrier""",
)
def _(spark, sf_dir):
    rep = finished(spark, reports.carrier_ranking(cleaned(spark, sf_dir)), "a22m")
    return rollups.diff_matrix_cells(rep)


@check("a23_carrier_diff_rollup", CARRIER_DIFF)
def _(spark, sf_dir):
    return rollups.carrier_diff_rollup(reports.carrier_ranking(cleaned(spark, sf_dir)))


@check(
    "a24_run_summary",
    f"""SELECT view, Framework, label, round(avg_sec, 4) AS avg_sec FROM (
  SELECT 'scale_out' AS view, Framework, Environment AS label,
    avg(Execution_Time_Sec) AS avg_sec
  FROM runs WHERE Dataset = 'flight_100.parquet' GROUP BY Framework, Environment
  UNION ALL
  SELECT 'scale_up', Framework, CAST({SCALE_CASE} AS VARCHAR), avg(Execution_Time_Sec)
  FROM runs WHERE Environment = 'AWS_8Nodes' AND Dataset NOT LIKE '%sample%' GROUP BY ALL
) AS views""",
)
def _(spark, sf_dir):
    summary = rollups.run_summary(star.run_metrics(spark, sf_dir))
    return summary.withColumn("avg_sec", F.round("avg_sec", 4))


# -- W: windows ---------------------------------------------------------------


@check(
    "w1_rank_causes",
    """SELECT origin, month, delay_band, primary_cause, cause_freq, CAST(rnk AS INT) AS rnk
FROM ranked_causes""",
)
def _(spark, sf_dir):
    return reports.rank_causes(reports.cause_counts(cleaned(spark, sf_dir)))


@check(
    "w2_rank_carriers",
    """SELECT origin, op_unique_carrier, dep100/100.0 AS avg_dep_delay,
  CAST(rank() OVER (PARTITION BY origin ORDER BY dep100 ASC NULLS FIRST) AS INT) AS carrier_rank
FROM carriers""",
)
def _(spark, sf_dir):
    ranked = reports.rank_carriers(reports.carrier_stats(cleaned(spark, sf_dir)))
    return ranked.select("origin", "op_unique_carrier", "avg_dep_delay", "carrier_rank")


# -- O: sorts and top-k -------------------------------------------------------


@check("o1_sort_by_keys", f"SELECT {_CARRIERS} FROM carriers ORDER BY origin, op_unique_carrier")
def _(spark, sf_dir):
    return reports.carrier_stats(cleaned(spark, sf_dir)).orderBy("origin", "op_unique_carrier")


@check(
    "o2_sort_by_aggregate",
    """SELECT dest, count(*) AS flights FROM raw GROUP BY dest ORDER BY flights DESC, dest""",
)
def _(spark, sf_dir):
    counts = raw(spark, sf_dir).groupBy("dest").agg(F.count("*").alias("flights"))
    return counts.orderBy(F.desc("flights"), "dest")


_TIES = [c for c in CLEAN_COLUMNS if c != "dep_delay"]
_ENDS = " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{side}' AS side, * FROM clean
  ORDER BY dep_delay {direction} NULLS LAST, {", ".join(f"{c} ASC NULLS FIRST" for c in _TIES)}
  LIMIT 25) AS {side}"""
    for side, direction in (("top", "DESC"), ("bottom", "ASC"))
)


@check("o3_top_and_bottom_k", _ENDS)
def _(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    top = selection.top_k(df, "dep_delay", 25, _TIES)
    bottom = selection.top_k(df, "dep_delay", 25, _TIES, descending=False)
    return top.withColumn("side", F.lit("top")).unionByName(
        bottom.withColumn("side", F.lit("bottom"))
    )


@check(
    "o4_top_groups",
    """SELECT op_unique_carrier, sum(distance)::DOUBLE AS total_weight FROM clean
GROUP BY op_unique_carrier ORDER BY total_weight DESC, op_unique_carrier LIMIT 10""",
)
def _(spark, sf_dir):
    return selection.top_groups(cleaned(spark, sf_dir), "op_unique_carrier", "distance", 10)


@check("o5_byte_order", f"SELECT Key FROM ({text_lines('route_parts', 'route')}) AS t")
def _(spark, sf_dir):
    stats = reports.carrier_route_stats(cleaned(spark, sf_dir))
    return reports.format_stats(stats, "route").orderBy("Key").select("Key")


# -- U: set operations --------------------------------------------------------


@check(
    "u1_union_all",
    """SELECT origin AS airport, month FROM clean UNION ALL SELECT dest, month FROM clean""",
)
def _(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    leaving = df.select(F.col("origin").alias("airport"), "month")
    return leaving.union(df.select("dest", "month"))


@check("u2_union_distinct", "SELECT origin AS airport FROM clean UNION SELECT dest FROM clean")
def _(spark, sf_dir):
    df = cleaned(spark, sf_dir)
    return df.select(F.col("origin").alias("airport")).union(df.select("dest")).distinct()


# -- T: report text -----------------------------------------------------------


@check("t1_format_stats", text_lines("airport_parts", "origin"))
def _(spark, sf_dir):
    return reports.format_stats(reports.carrier_airport_stats(cleaned(spark, sf_dir)))


@check(
    "t2_parse_stats",
    f"""SELECT op_unique_carrier, route, CAST(total_flights AS BIGINT) AS total_flights,
  CAST(low AS FLOAT) AS min_arr_delay, CAST(high AS FLOAT) AS max_arr_delay,
  CAST(coalesce({rounded("delay_sum", "flown")}, 0) AS FLOAT) AS avg_arr_delay,
  CAST({rounded("100*gone", "total_flights")} AS FLOAT) AS cancelation_rate,
  replace(replace(months, '[', ''), ']', '') AS months_of_operation FROM route_parts""",
)
def _(spark, sf_dir):
    return _route_text(spark, sf_dir)


# -- Q: whole jobs ------------------------------------------------------------


@check("q1_clean", "SELECT * FROM clean_distinct")
def _(spark, sf_dir):
    source, out, metrics = (scratch_dir(spark, f"q1{x}") for x in ("raw", "clean", "metrics"))
    writers.write_raw_csv(copies(spark, sf_dir), source)
    found = jobs.run_cleaning(spark, source, out, "check", metrics)
    remove(spark, source)
    return found


@check(
    "q1_step_accounting",
    """SELECT 'check' AS Environment, a AS Duplicates_Before_Records, b AS Duplicates_After_Records,
  a - b AS Duplicates_Dropped_Records, b AS Quality_Before_Records, c AS Quality_After_Records,
  b - c AS Quality_Dropped_Records, a AS Initial_Records, c AS Final_Records,
  a - c AS Dropped_Records, CAST(0 AS BIGINT) AS Broken_Records,
  CAST(0 AS BIGINT) AS Unconverted_Cells
FROM (SELECT (SELECT count(*) FROM raw_copies) AS a,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_copies) AS d) AS b,
  (SELECT count(*) FROM clean_distinct) AS c) AS counts""",
)
def _(spark, sf_dir):
    source, out, metrics = (scratch_dir(spark, f"q1s{x}") for x in ("raw", "clean", "metrics"))
    writers.write_raw_csv(copies(spark, sf_dir), source)
    jobs.run_cleaning(spark, source, out, "check", metrics)
    remove(spark, source)
    row = writers.read_run_metrics(spark, metrics).drop("Dataset", "Execution_Time_Sec")
    return row.select(*[F.col(c).cast("bigint").alias(c) if c != "Environment" else c for c in row.columns])


def _scaled_paths(spark, sf_dir, keys=None):
    base, out, metrics = (
        clean_parquet(spark, sf_dir, "q2base"),
        scratch_dir(spark, "q2out"),
        scratch_dir(spark, "q2metrics"),
    )
    return base, jobs.run_scaling(spark, base, out, "check", metrics, keys)


def _scaled(spark, sf_dir, keys):
    paths = _scaled_paths(spark, sf_dir, keys)[1]
    counts = [
        readers.read_flights(spark, path).agg(
            F.lit(name).alias("dataset"), F.count("*").alias("flights")
        )
        for name, path in paths.items()
    ]
    combined = counts[0]
    for part in counts[1:]:
        combined = combined.unionByName(part)
    return combined


_SCALES = (*sampling.SUB_SIZES, *sampling.OVER_SIZES)


@check("q2_scale_datasets", sample_bounds_sql([f"flight_{pct}" for pct in _SCALES]))
def _(spark, sf_dir):
    base, paths = _scaled_paths(spark, sf_dir)
    named = {}
    for name, path in paths.items():
        pct = int(name.split("_")[1])
        named[name] = (readers.read_flights(spark, path), pct / 100, pct // 100)
    return sample_bounds(readers.read_flights(spark, base), named)


_ROW_PARTS = ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '{sampling.NULL_KEY}')" for c in CLEAN_COLUMNS
)
_ROW_HASH = f"substr(md5(concat_ws('|', {_ROW_PARTS})), 1, 8)"


def _scaled_sql(pct: int) -> str:
    whole, part = divmod(pct, 100)
    sample = f"count(*) FILTER (WHERE {_ROW_HASH} < '{sampling.hash_limit(part / 100)}')"
    return f"SELECT 'flight_{pct}' AS dataset, {whole}*count(*) + {sample} AS flights FROM clean"


@check(
    "q2_scale_datasets_by_hash",
    " UNION ALL ".join(_scaled_sql(p) for p in _SCALES),
)
def _(spark, sf_dir):
    return _scaled(spark, sf_dir, CLEAN_COLUMNS)


@check("q3_airport_report", text_lines("airport_parts", "origin"))
def _(spark, sf_dir):
    base, out = clean_parquet(spark, sf_dir, "q3"), scratch_dir(spark, "q3out")
    metrics = scratch_dir(spark, "q3metrics")
    return jobs.run_carrier_report(spark, base, out, "check", metrics)


@check("q3_route_report", text_lines("route_parts", "route"))
def _(spark, sf_dir):
    base, out = clean_parquet(spark, sf_dir, "q3r"), scratch_dir(spark, "q3rout")
    metrics = scratch_dir(spark, "q3rmetrics")
    return jobs.run_carrier_report(spark, base, out, "check", metrics, level="route")


@check(
    "q3_reports_by_level",
    f"""SELECT 'airport' AS level, Key, Value FROM ({text_lines("airport_parts", "origin")}) AS a
UNION ALL SELECT 'route', Key, Value FROM ({text_lines("route_parts", "route")}) AS r""",
)
def _(spark, sf_dir):
    base, out = clean_parquet(spark, sf_dir, "q3b"), scratch_dir(spark, "q3bout")
    texts = jobs.run_carrier_reports(spark, base, out, "check", scratch_dir(spark, "q3bmetrics"))
    airport, route = [
        texts[level].select(F.lit(level).alias("level"), "Key", "Value")
        for level in ("airport", "route")
    ]
    return airport.unionByName(route)


@check("q4_band_report", BAND_REPORT)
def _(spark, sf_dir):
    return reports.band_report(cleaned(spark, sf_dir))


@check("q4_band_report_job", BAND_REPORT)
def _(spark, sf_dir):
    base, out = clean_parquet(spark, sf_dir, "q4"), scratch_dir(spark, "q4out")
    one, metrics = scratch_dir(spark, "q4one"), scratch_dir(spark, "q4metrics")
    jobs.run_band_report(spark, base, out, "check", metrics, single_csv=one)
    return readers.read_delimited(spark, one)


@check("q5_carrier_ranking", RANKING)
def _(spark, sf_dir):
    return reports.carrier_ranking(cleaned(spark, sf_dir))


@check("q5_carrier_ranking_joined", RANKING)
def _(spark, sf_dir):
    return reports.carrier_ranking_joined(cleaned(spark, sf_dir)).select(*RANKING_FIELDS)


@check("q5_carrier_ranking_job", RANKING)
def _(spark, sf_dir):
    base, out = clean_parquet(spark, sf_dir, "q5"), scratch_dir(spark, "q5out")
    return jobs.run_ranking(spark, base, out, "check", scratch_dir(spark, "q5metrics"))


@check(
    "q6_profile",
    per_column(
        """c AS "column", total AS rows, total - n AS nulls,
  (total - n)::DOUBLE * 100 / total AS null_pct, z AS zero_variance,
  (total - n)*100.0/total > 80 AS sparse"""
    ),
)
def _(spark, sf_dir):
    text = readers.read_raw_text(spark, raw_csv(spark, sf_dir, "q6"))
    return profiling.profile(text)


def _long(report: str, body: str, items: str, label: str = "'table'") -> str:
    """A row per item of each row of ``body``."""
    rows = ", ".join(
        f"{{'item': '{i}', 'value': round(CAST(\"{i}\" AS DOUBLE), 6)}}" for i in items.split()
    )
    return f"""SELECT '{report}' AS report, {label} AS label, unnest([{rows}], recursive := true)
FROM ({body}) AS {report}"""


_STEPS = """SELECT 'duplicates' AS step, a AS before, b AS after, a - b AS dropped FROM counts
UNION ALL SELECT 'quality', b, c, b - c FROM counts
UNION ALL SELECT 'total', a, c, a - c FROM counts""".replace(
    "FROM counts",
    """FROM (SELECT (SELECT count(*) FROM raw) AS a,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM raw) AS d) AS b,
  (SELECT count(*) FROM clean) AS c) AS counts""",
)
_WHOLE_PROFILE = (
    _long("shape", "SELECT count(*) AS total_rows, 35 AS total_columns FROM raw", "total_rows total_columns"),
    _long(
        "columns",
        per_column(
            """c, total AS rows, total - n AS nulls, (total - n)::DOUBLE * 100 / total AS null_pct,
  CAST(z AS INT) AS zero_variance, CAST((total - n)*100.0/total > 80 AS INT) AS sparse"""
        ),
        "rows nulls null_pct zero_variance sparse",
        "c",
    ),
    _long("exact_copies", surplus_sql("*", "raw"), "total_rows distinct_rows duplicates"),
    _long(
        "logical_copies",
        surplus_sql(", ".join(LOGICAL_KEY), "raw"),
        "total_rows distinct_rows duplicates",
    ),
    _long("sparse_rows", sparse_rows_sql(80), "sparse_rows"),
    _long("description", DESCRIPTION, "count min p25 p50 p75 max mean", '"column"'),
    _long(
        "extremes",
        f"""SELECT count(*) AS pairs, min(dep_delay) AS min_dep_delay, max(dep_delay) AS max_dep_delay,
  min(arr_delay) AS min_arr_delay, max(arr_delay) AS max_arr_delay FROM ({EXTREMES}) AS x""",
        "pairs min_dep_delay max_dep_delay min_arr_delay max_arr_delay",
    ),
    _long(
        "extreme_pairs",
        EXTREMES,
        "dep_delay arr_delay",
        "printf('%.2f/%.2f', dep_delay, arr_delay)",
    ),
    _long("row_accounting", _STEPS, "before after dropped", "step"),
    _long("recovery", RECOVERY, "pairs recovered correlation"),
)


@check("q6_whole_profile", " UNION ALL ".join(_WHOLE_PROFILE))
def _(spark, sf_dir):
    source, out = raw_csv(spark, sf_dir, "q6whole"), scratch_dir(spark, "q6out")
    found = jobs.run_profile(spark, source, out, "check", scratch_dir(spark, "q6metrics"))
    remove(spark, source)
    return found.withColumn("value", F.round("value", 6))


@check(
    "q7_trends",
    f"""
SELECT 'delay_by_carrier' AS report, op_unique_carrier AS label, count(*) AS flights,
  avg(dep_delay) AS value FROM raw WHERE dep_delay IS NOT NULL GROUP BY op_unique_carrier
UNION ALL
SELECT 'delay_by_month', {MONTH_CASE}, count(*), avg(dep_delay) FROM raw
WHERE dep_delay IS NOT NULL GROUP BY month
UNION ALL
SELECT 'delay_by_hour', CAST({_HOUR} AS VARCHAR), count(dep_delay), avg(dep_delay) FROM raw
WHERE cancelled = 0 AND {_HOUR} BETWEEN 0 AND 23 GROUP BY 2
UNION ALL
SELECT 'cancellations_by_code', cancellation_code, count(*), count(*)::DOUBLE FROM raw
WHERE cancelled = 1 AND cancellation_code IS NOT NULL GROUP BY cancellation_code
UNION ALL
SELECT 'bracket_share', {BRACKET_CASE}, count(*),
  count(*)::DOUBLE * 100 / sum(count(*)) OVER () FROM raw WHERE dep_delay IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'cause_minutes', delay_cause, (SELECT count(*) FROM raw), total_minutes::DOUBLE
FROM ({_CAUSES}) AS c""",
)
def _(spark, sf_dir):
    return trends.trends(raw(spark, sf_dir))


_HEAT_ROWS = " UNION ALL ".join(
    f"SELECT 'month_heatmap' AS report, origin AS label, 'm{m:02d}' AS item, m{m:02d} AS value"
    f" FROM ({HEATMAP}) AS h WHERE m{m:02d} IS NOT NULL"
    for m in range(1, 13)
)
_SHARE_ROWS = " UNION ALL ".join(
    f"SELECT 'band_share', origin, '{b.lower()}_pct', {b.lower()}_pct"
    f" FROM ({BAND_SHARE}) AS s WHERE {b.lower()}_pct IS NOT NULL"
    for b in fn.BANDS
)


@check(
    "q8_report_rollups",
    f"""{_HEAT_ROWS} UNION ALL {_SHARE_ROWS}
UNION ALL SELECT 'carrier_cancel_rate', op_unique_carrier, NULL, global_cancel_rate
FROM ({CANCEL_ROLLUP}) AS a
UNION ALL SELECT 'airport_delay', origin, NULL, global_avg_delay FROM ({AIRPORT_ROLLUP}) AS b
UNION ALL SELECT 'route_delay', route, NULL, global_avg_delay FROM ({ROUTE_ROLLUP}) AS c
UNION ALL SELECT 'carrier_airport_diff', origin, op_unique_carrier, diff_from_airport_avg
FROM ({DIFF_CELLS}) AS d
UNION ALL SELECT 'carrier_diff', op_unique_carrier, NULL, global_avg_diff
FROM ({CARRIER_DIFF}) AS e""",
)
def _(spark, sf_dir):
    # The finished reports are files, as a reader of them finds them.
    base = clean_parquet(spark, sf_dir, "q8")
    out = {x: scratch_dir(spark, f"q8{x}") for x in ("airport", "route", "band", "one", "rank")}
    airport = jobs.run_carrier_report(spark, base, out["airport"], "check")
    route = jobs.run_carrier_report(spark, base, out["route"], "check", level="route")
    jobs.run_band_report(spark, base, out["band"], "check", single_csv=out["one"])
    return jobs.report_rollups(
        reports.parse_stats(airport),
        reports.parse_stats(route, "route"),
        readers.read_delimited(spark, out["one"]),
        jobs.run_ranking(spark, base, out["rank"], "check"),
    )
