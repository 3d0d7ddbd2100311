"""Deduplication, sampling and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeropunct.checks.registry import check, cleaned, comparable, comparable_sql, raw, rounded
from aeropunct.checks.scans import clean_parquet
from aeropunct.operators import cleaning, profiling, sampling
from aeropunct.operators.copies import DIGEST, digests
from aeropunct.schema import CLEAN_COLUMNS, LOGICAL_KEY, RAW_COLUMNS
from aeropunct.sources import readers, star

_KEY_PARTS = ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '{sampling.NULL_KEY}')"
    for c in (
        "fl_date",
        "crs_dep_time",
        "op_unique_carrier",
        "CAST(op_carrier_fl_num AS BIGINT)",
        "origin",
        "dest",
    )
)
KEY_HASH = f"substr(md5(concat_ws('|', {_KEY_PARTS})), 1, 8)"


def key_columns():
    """The logical key as text-stable columns."""
    return [F.col(c).cast("bigint") if c == "op_carrier_fl_num" else F.col(c) for c in LOGICAL_KEY]


def copies(spark, sf_dir):
    return star.raw_flights(spark, sf_dir, copies=True)


@check("d1_dedup", f"SELECT {comparable_sql()} FROM (SELECT DISTINCT * FROM raw_copies) AS d")
def _(spark, sf_dir):
    return comparable(cleaning.dedup(copies(spark, sf_dir)))


def surplus_sql(columns: str, source: str = "raw_copies") -> str:
    return f"""SELECT count(*) AS total_rows,
  (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source}) AS d) AS distinct_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source}) AS d) AS duplicates
FROM {source}"""


@check("d2_exact_dups", surplus_sql("*"))
def _(spark, sf_dir):
    return profiling.exact_dups(copies(spark, sf_dir))


@check("d3_logical_dups", surplus_sql(", ".join(LOGICAL_KEY)))
def _(spark, sf_dir):
    return profiling.logical_dups(copies(spark, sf_dir))


def sample_bounds(base, named):
    """Size and content of random samples as facts that hold for any seed.

    ``named`` maps a name to (sample, fraction, whole copies of the base in it). A
    sample may deviate by six standard deviations, and no row may come more often
    than the base and the whole copies allow.

    Rows are told apart by a 128-bit digest of all columns, which is what is shuffled.
    Sound samples pass whatever the digest; only a clash could hide a row too many.
    """
    columns = base.columns
    digest = [d.alias(c) for c, d in zip(DIGEST, digests(columns), strict=True)]
    # Rows of the base and of all samples meet in one grouping, part 0 being the base.
    tagged = base.select(*digest, F.lit(0).alias("part"))
    for i, (df, _, _) in enumerate(named.values(), 1):
        tagged = tagged.unionByName(df.select(*digest, F.lit(i).alias("part")))
    counts = [F.count_if(F.col("part") == i).alias(f"n_{i}") for i in range(len(named) + 1)]
    merged = tagged.groupBy(*DIGEST).agg(*counts)
    figures = []
    for i, (_, fraction, whole) in enumerate(named.values(), 1):
        most = F.col("n_0") * (whole + (1 if fraction > whole else 0))
        # A row of neither the base nor this sample says nothing about it.
        within = F.when(F.col("n_0") + F.col(f"n_{i}") > 0, F.col(f"n_{i}") <= most)
        figures += [F.sum(f"n_{i}").alias(f"got_{i}"), F.bool_and(within).alias(f"within_{i}")]
    wide = merged.agg(F.sum("n_0").alias("n"), *figures)
    n, rows = F.coalesce("n", F.lit(0)), []
    for i, (name, (_, fraction, whole)) in enumerate(named.items(), 1):
        got = F.coalesce(f"got_{i}", F.lit(0))
        spread = 6 * F.sqrt(n * (fraction - whole) * (1 + whole - fraction)) + 1
        rows.append(
            F.struct(
                F.lit(name).alias("dataset"),
                n.alias("base_rows"),
                (F.abs(got - n * fraction) <= spread).alias("size_within_bounds"),
                F.col(f"within_{i}").alias("rows_from_base"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def sample_bounds_sql(names) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS dataset, count(*) AS base_rows, true AS size_within_bounds,
  true AS rows_from_base FROM clean"""
        for name in names
    )


@check("d4_random_sample", sample_bounds_sql(["sample"]))
def _(spark, sf_dir):
    # From a written table: its rows keep their places when a task runs again.
    base = readers.read_flights(spark, clean_parquet(spark, sf_dir, "d4"))
    return sample_bounds(base, {"sample": (sampling.sample(base, 0.10), 0.10, 0)})


@check(
    "d4_hash_sample",
    f"SELECT {comparable_sql()} FROM raw WHERE {KEY_HASH} < '{sampling.hash_limit(0.10)}'",
)
def _(spark, sf_dir):
    return comparable(sampling.hash_sample(raw(spark, sf_dir), key_columns(), 0.10))


@check("d5_sub_samples", sample_bounds_sql([f"flight_{pct}" for pct in sampling.SUB_SIZES]))
def _(spark, sf_dir):
    base = readers.read_flights(spark, clean_parquet(spark, sf_dir, "d5"))
    family = sampling.sub_samples(base)
    return sample_bounds(base, {n: (df, int(n.split("_")[1]) / 100, 0) for n, df in family.items()})


@check(
    "d5_hash_sub_samples",
    " UNION ALL ".join(
        f"SELECT {pct} AS sample_pct, op_unique_carrier, origin, count(*) AS flights FROM raw"
        f" WHERE {KEY_HASH} < '{sampling.hash_limit(pct / 100)}' GROUP BY op_unique_carrier, origin"
        for pct in sampling.SUB_SIZES
    ),
)
def _(spark, sf_dir):
    samples = sampling.hash_sub_samples(raw(spark, sf_dir), key_columns())
    return samples.groupBy("sample_pct", "op_unique_carrier", "origin").agg(
        F.count("*").alias("flights")
    )


@check("d6_oversample_150", sample_bounds_sql(["flight_150"]))
def _(spark, sf_dir):
    base = readers.read_flights(spark, clean_parquet(spark, sf_dir, "d6"))
    return sample_bounds(base, {"flight_150": (sampling.oversample_150(base), 1.5, 1)})


@check(
    "d6_hash_oversample_150",
    f"""SELECT {comparable_sql()} FROM raw UNION ALL
SELECT {comparable_sql()} FROM raw WHERE {KEY_HASH} < '{sampling.hash_limit(0.5)}'""",
)
def _(spark, sf_dir):
    return comparable(sampling.oversample_150(raw(spark, sf_dir), keys=key_columns()))


@check("d7_replicate_200", "SELECT * FROM clean UNION ALL SELECT * FROM clean")
def _(spark, sf_dir):
    return sampling.replicate(cleaned(spark, sf_dir), 2)


_CLEAN = ", ".join(CLEAN_COLUMNS)


@check("d7_replicate_300", f"SELECT {_CLEAN}, 3*count(*) AS n FROM clean GROUP BY {_CLEAN}")
def _(spark, sf_dir):
    tripled = sampling.replicate(cleaned(spark, sf_dir), 3)
    return tripled.groupBy(*CLEAN_COLUMNS).agg(F.count("*").alias("n"))


@check("d8_shape", "SELECT count(*) AS total_rows, 35 AS total_columns FROM raw")
def _(spark, sf_dir):
    return profiling.shape(raw(spark, sf_dir))


# One row with every column's figures, then a row per column: DuckDB would
# otherwise derive the whole view once per column.
_FIGURES = ", ".join(
    f"count({c}) AS n_{c}, (min({c}) IS NOT DISTINCT FROM max({c})) AS z_{c}" for c in RAW_COLUMNS
)


def per_column(select: str, names=RAW_COLUMNS, where: str = "") -> str:
    """SQL with a row per column; ``select`` may use c (name), n (known values), z, total."""
    rows = ", ".join(f"{{'c': '{c}', 'n': n_{c}, 'z': z_{c}}}" for c in names)
    return f"""SELECT {select} FROM (
  SELECT total, unnest([{rows}], recursive := true)
  FROM (SELECT count(*) AS total, {_FIGURES} FROM raw) AS figures) AS listed {where}"""


@check("d9_zero_variance", per_column('c AS "column", z AS zero_variance'))
def _(spark, sf_dir):
    return profiling.zero_variance(raw(spark, sf_dir))


@check(
    "d10_redundant_ids",
    " UNION ALL ".join(
        f"""SELECT '{base}_airport_id' AS "column", '{base}' AS base,
  greatest(ids, bases, pairs) - least(ids, bases, pairs) < 0.01 * ids AS redundant
FROM (SELECT count(DISTINCT {base}_airport_id) AS ids, count(DISTINCT {base}) AS bases,
    count(DISTINCT {base}_airport_id || '/' || {base}) AS pairs
  FROM raw_ids WHERE {base}_airport_id IS NOT NULL AND {base} IS NOT NULL) AS {base}_counts"""
        for base in ("origin", "dest")
    ),
)
def _(spark, sf_dir):
    return profiling.redundant_ids(star.raw_flights(spark, sf_dir, ids=True))


@check(
    "d10_unrelated_ids",
    """SELECT 'distance_id' AS "column", 'crs_arr_time' AS base,
  greatest(ids, bases, pairs) - least(ids, bases, pairs) < 0.01 * ids AS redundant
FROM (SELECT count(DISTINCT distance) AS ids, count(DISTINCT crs_arr_time) AS bases,
    count(DISTINCT distance || '/' || crs_arr_time) AS pairs
  FROM raw WHERE distance IS NOT NULL AND crs_arr_time IS NOT NULL) AS counts""",
)
def _(spark, sf_dir):
    df = raw(spark, sf_dir).withColumn("distance_id", F.col("distance"))
    return profiling.redundant_ids(df, {"distance_id": "crs_arr_time"})


@check("d11_null_counts", per_column('c AS "column", total - n AS nulls'))
def _(spark, sf_dir):
    return profiling.null_counts(raw(spark, sf_dir))


_PCT = "(total - n)::DOUBLE * 100 / total AS null_pct"


@check(
    "d12_sparse_columns",
    per_column(
        f'c AS "column", total - n AS nulls, {_PCT}', where="WHERE (total - n)*100.0/total > 80"
    ),
)
def _(spark, sf_dir):
    return profiling.sparse_columns(raw(spark, sf_dir))


_MISSING = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in RAW_COLUMNS)


def sparse_rows_sql(pct: int) -> str:
    return f"""SELECT count(*) AS sparse_rows FROM raw
WHERE ({_MISSING})*100.0/35 > {pct} AND cancelled = 0"""


@check("d13_sparse_rows", sparse_rows_sql(80))
def _(spark, sf_dir):
    return profiling.sparse_rows(raw(spark, sf_dir))


@check("d13_sparse_rows_30", sparse_rows_sql(30))
def _(spark, sf_dir):
    return profiling.sparse_rows(raw(spark, sf_dir), 30)


@check(
    "d14_null_report",
    per_column(
        f'c AS "column", total - n AS nulls, {_PCT}', names=profiling.NULL_REPORT_COLUMNS
    ),
)
def _(spark, sf_dir):
    return profiling.null_report(raw(spark, sf_dir))


_EXACT_QUARTILES = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", min({c}) AS min, max({c}) AS max,
  {rounded(f"sum(CAST({c} AS BIGINT))", f"count({c})")} AS mean, true AS quartiles_within_error
FROM raw"""
    for c in profiling.DESCRIBED
)


@check("d15_describe", _EXACT_QUARTILES)
def _(spark, sf_dir):
    # Each sketched quartile must be a value whose rank is near the one asked for: the
    # share of rows below it may be too small, and that up to it too large, by the error.
    df = raw(spark, sf_dir)
    found = profiling.describe(df)
    values = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                    for c in profiling.DESCRIBED
                ]
            )
        )
    ).filter("v IS NOT NULL")
    counted = values.groupBy("column", "v").agg(F.count("*").alias("n"))
    error, near = 0.001, F.lit(True)
    ranks = []
    for name, share in profiling.QUARTILES.items():
        below = F.sum(F.when(F.round("v", 2) < F.col(name), F.col("n")).otherwise(0))
        upto = F.sum(F.when(F.round("v", 2) <= F.col(name), F.col("n")).otherwise(0))
        ranks += [below.alias(f"below_{name}"), upto.alias(f"upto_{name}")]
        near = near & (F.col(f"below_{name}") <= (share + error) * F.col("count") + 1)
        near = near & (F.col(f"upto_{name}") >= (share - error) * F.col("count") - 1)
    keys = ["column", "count", "min", "max", "mean"]
    measured = counted.join(F.broadcast(found), "column").groupBy(*keys).agg(*ranks)
    return measured.select(*keys, near.alias("quartiles_within_error"))


DESCRIPTION = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", min({c}) AS min,
  round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50,
  round(quantile_cont({c}, 0.75), 2) AS p75, max({c}) AS max,
  {rounded(f"sum(CAST({c} AS BIGINT))", f"count({c})")} AS mean FROM raw"""
    for c in profiling.DESCRIBED
)


@check("d15_describe_exact", DESCRIPTION)
def _(spark, sf_dir):
    return profiling.describe_exact(raw(spark, sf_dir))


def _list_of(first: str, second: str, direction: str) -> str:
    return f"""SELECT * FROM (SELECT dep_delay, arr_delay FROM pairs
  ORDER BY {first} {direction}, {second} {direction} LIMIT 50) AS {first}_{direction}"""


_EXTREMES = " UNION ".join(
    _list_of(a, b, d)
    for a, b in (("dep_delay", "arr_delay"), ("arr_delay", "dep_delay"))
    for d in ("ASC", "DESC")
)
_PAIRS = """SELECT CAST(dep_delay AS FLOAT) AS dep_delay, CAST(arr_delay AS FLOAT) AS arr_delay
  FROM raw WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL"""


EXTREMES = f"SELECT * FROM ({_EXTREMES}) AS e".replace("FROM pairs", f"FROM ({_PAIRS}) AS pairs")


@check("d16_extremes", EXTREMES)
def _(spark, sf_dir):
    return profiling.extremes(raw(spark, sf_dir))


@check(
    "d16_extremes_with_sample",
    f"""SELECT * FROM ({_EXTREMES}) AS e UNION
{_PAIRS} AND {KEY_HASH} < '{sampling.hash_limit(0.01)}'""".replace(
        "FROM pairs", f"FROM ({_PAIRS}) AS pairs"
    ),
)
def _(spark, sf_dir):
    df = raw(spark, sf_dir)
    return profiling.extremes(df, sample=sampling.hash_sample(df, key_columns(), 0.01))


@check(
    "d17_row_accounting",
    """SELECT step, before, after, before - after AS dropped FROM (
  SELECT 'duplicates' AS step, a AS before, b AS after FROM counts
  UNION ALL SELECT 'quality', b, c FROM counts
  UNION ALL SELECT 'total', a, c FROM counts) AS steps""".replace(
        "FROM counts",
        """FROM (SELECT (SELECT count(*) FROM raw_copies) AS a,
    (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_copies) AS d) AS b,
    (SELECT count(*) FROM clean_distinct) AS c) AS counts""",
    ),
)
def _(spark, sf_dir):
    return cleaning.row_accounting(copies(spark, sf_dir))


RECOVERY = """SELECT count(*) AS pairs,
  count(*) FILTER (WHERE arr_delay < dep_delay) AS recovered,
  round(corr(dep_delay, arr_delay), 6) AS correlation
FROM raw WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL"""


@check("d19_recovery", RECOVERY)
def _(spark, sf_dir):
    found = profiling.recovery(raw(spark, sf_dir))
    return found.withColumn("correlation", F.round("correlation", 6))


_COUNTED = ("op_unique_carrier", "origin", "dest", "op_carrier_fl_num")


@check(
    "a16_approx_distinct",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS exact_distinct,
  true AS within_error FROM raw"""
        for c in _COUNTED
    ),
)
def _(spark, sf_dir):
    # Three times the relative standard deviation that was asked for.
    df = raw(spark, sf_dir)
    found = profiling.approx_distinct(df, list(_COUNTED), 0.05)
    exact = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
                    for c in _COUNTED
                ]
            )
        )
    )
    counts = exact.groupBy("column").agg(F.count_distinct("v").alias("exact_distinct"))
    apart = F.abs(F.col("approx_distinct") - F.col("exact_distinct"))
    return counts.join(F.broadcast(found), "column").select(
        "column",
        "exact_distinct",
        (apart <= 0.15 * F.col("exact_distinct")).alias("within_error"),
    )
