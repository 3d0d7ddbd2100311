"""Profiling of a table: shape, missing values, constant columns, copies, quartiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aeropunct.functions.columns import as_float, is_missing
from aeropunct.operators.copies import count_copies
from aeropunct.schema import LOGICAL_KEY

# Statistics of the description, and the quartile each stands for.
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
DESCRIBED = ("arr_delay", "distance", "air_time", "actual_elapsed_time")
NULL_REPORT_COLUMNS = ("dep_delay", "arr_delay", "cancelled", "cancellation_code")

# Endings of id columns; what stands before one may name the column it stands for.
ID_ENDINGS = ("_airport_id", "_id")

# The delays whose extremes are listed together.
DELAY_PAIR = ("dep_delay", "arr_delay")

# Value ranges per column in which exact quartiles count rows first.
SPANS = 1000


def _rows_from(wide: DataFrame, names: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn one wide row into a row per column name; ``fields`` maps output to prefix."""
    items = [
        F.struct(
            F.lit(name).alias("column"),
            F.col("row_count").alias("rows"),
            *[F.col(f"{prefix}_{i}").alias(out) for out, prefix in fields.items()],
        )
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*items)))


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count("*").alias("total_rows")).withColumn(
        "total_columns", F.lit(len(df.columns))
    )


def profile(df: DataFrame, sparse_pct: float = 80, nulls_only: bool = False) -> DataFrame:
    """Every per-column check in a single pass with one small buffer per task.

    ``nulls_only`` leaves out the search for constant columns; ``zero_variance`` is
    then false.
    """
    return profile_of(df.agg(*profile_figures(df, nulls_only)), df.columns, sparse_pct)


def profile_figures(df: DataFrame, nulls_only: bool = False) -> list[Column]:
    """Aggregates of the per-column checks."""
    aggs: list[Column] = [F.count("*").alias("row_count")]
    for i, (name, kind) in enumerate(df.dtypes):
        c = F.col(name)
        constant = F.lit(False) if nulls_only else F.min(c).eqNullSafe(F.max(c))
        aggs += [
            F.count_if(is_missing(c, kind == "string")).alias(f"nulls_{i}"),
            constant.alias(f"constant_{i}"),
        ]
    return aggs


def profile_of(wide: DataFrame, names: Sequence[str], sparse_pct: float = 80) -> DataFrame:
    """The per-column checks from their aggregates."""
    long = _rows_from(wide, names, {"nulls": "nulls", "zero_variance": "constant"})
    share = F.try_divide(F.col("nulls") * 100.0, F.col("rows"))
    return long.select(
        "column",
        "rows",
        "nulls",
        share.alias("null_pct"),
        "zero_variance",
        F.coalesce(share > sparse_pct, F.lit(False)).alias("sparse"),
    )


def zero_variance(df: DataFrame) -> DataFrame:
    """Per column, whether min equals max; a column of nulls only also counts."""
    return profile(df).select("column", "zero_variance")


def null_counts(df: DataFrame) -> DataFrame:
    """Null or empty values per column."""
    return _nulls_only(df).select("column", "nulls")


def sparse_columns(df: DataFrame, pct: float = 80) -> DataFrame:
    """Columns with more than ``pct`` percent missing."""
    return _nulls_only(df, pct).filter("sparse").select("column", "nulls", "null_pct")


def null_report(df: DataFrame, columns: Sequence[str] = NULL_REPORT_COLUMNS) -> DataFrame:
    """Missing values of the target columns with their share of all rows."""
    return _nulls_only(df.select(*columns)).select("column", "nulls", "null_pct")


def _nulls_only(df: DataFrame, sparse_pct: float = 80) -> DataFrame:
    return profile(df, sparse_pct, nulls_only=True)


def sparse_rows(df: DataFrame, pct: float = 80) -> DataFrame:
    """Number of rows with more than ``pct`` percent missing that are not cancelled."""
    return df.agg(F.count_if(is_sparse(df, pct)).alias("sparse_rows"))


def is_sparse(df: DataFrame, pct: float = 80) -> Column:
    """True for a row with more than ``pct`` percent missing that is not cancelled."""
    missing = reduce(
        lambda total, c: total + is_missing(c[0], c[1] == "string").cast("int"),
        df.dtypes,
        F.lit(0),
    )
    flown = F.col("cancelled").cast("string") == "0"
    return (missing * 100.0 / len(df.columns) > pct) & flown


def exact_dups(df: DataFrame) -> DataFrame:
    """Number of surplus exact copies, found by digest and confirmed on all columns.

    Reads the table twice; see :func:`aeropunct.operators.copies.count_copies`.
    """
    return surplus_of(count_copies(df))


def logical_dups(df: DataFrame, keys: Sequence[str] = LOGICAL_KEY) -> DataFrame:
    """Number of rows that repeat another row's key."""
    return _surplus(df, keys)


def _surplus(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Counted per key in each task before the shuffle, so hot keys stay cheap.
    groups = df.groupBy(*keys).agg(F.count("*").alias("group_rows"))
    counts = groups.agg(
        F.coalesce(F.sum("group_rows"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_rows"),
    )
    return surplus_of(counts)


def surplus_of(counts: DataFrame) -> DataFrame:
    """Rows, distinct rows and the difference."""
    surplus = F.col("total_rows") - F.col("distinct_rows")
    return counts.select("total_rows", "distinct_rows", surplus.alias("duplicates"))


def approx_distinct(df: DataFrame, columns: Sequence[str], rsd: float = 0.05) -> DataFrame:
    """Approximate distinct values per column, within ``rsd`` relative deviation."""
    wide = df.agg(
        F.count("*").alias("row_count"),
        *[F.approx_count_distinct(c, rsd).alias(f"n_{i}") for i, c in enumerate(columns)],
    )
    return _rows_from(wide, columns, {"approx_distinct": "n"}).drop("rows")


def id_pairs(columns: Sequence[str]) -> dict[str, str]:
    """Id columns by name, and the column of the table that each may stand for."""
    known = {c.lower(): c for c in columns}
    pairs = {}
    for c in columns:
        ending = next((e for e in ID_ENDINGS if c.lower().endswith(e)), None)
        if ending and (base := known.get(c.lower().removesuffix(ending))):
            pairs[c] = base
    return pairs


def redundant_ids(
    df: DataFrame, pairs: Mapping[str, str] | None = None, tolerance: float = 0.01
) -> DataFrame:
    """Id columns that tell no more than the column they stand for.

    ``pairs`` maps ids to their base columns; without it they are found by name, see
    :func:`id_pairs`. Pairs that the table lacks are left out. Redundant means one-to-one:
    the numbers of ids, of base values and of pairs of both that occur together differ by
    less than ``tolerance`` of the ids. Equal numbers alone are not enough. Rows are first
    reduced to the pairs of values that occur; rows that lack either value say nothing.
    """
    pairs = id_pairs(df.columns) if pairs is None else pairs
    found = [(i, base) for i, base in pairs.items() if i in df.columns and base in df.columns]
    if not found:
        return df.sparkSession.createDataFrame([], "column string, base string, redundant boolean")
    values = df.select(F.inline(F.array(*[_id_value(i, base) for i, base in found]))).distinct()
    return redundancy_of(values, tolerance)


def _id_value(i: str, base: str) -> Column:
    return F.struct(
        F.lit(i).alias("column"),
        F.lit(base).alias("base"),
        F.col(f"`{i}`").cast("string").alias("id"),
        F.col(f"`{base}`").cast("string").alias("value"),
    )


def redundancy_of(values: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """One-to-one test over distinct (column, base, id, value).

    Ids and values are counted by grouping twice, never by a set in one buffer: first the
    pairs of an id, which give the ids and the pairs, then those of a value.
    """
    both = values.withColumn("whole", F.col("id").isNotNull() & F.col("value").isNotNull())
    name = ["column", "base"]

    def per(side: str) -> DataFrame:
        groups = both.groupBy(*name, side).agg(F.count_if("whole").alias("met"))
        return groups.groupBy(*name).agg(
            F.sum("met").alias(f"pairs_by_{side}"), F.count_if(F.col("met") > 0).alias(f"{side}s")
        )

    counts = per("id").join(per("value"), name)
    numbers = [F.col(c) for c in ("ids", "values", "pairs_by_id")]
    apart = F.try_divide(F.greatest(*numbers) - F.least(*numbers), F.col("ids"))
    return counts.select(
        "column", "base", F.coalesce(apart < tolerance, F.lit(False)).alias("redundant")
    )


def describe(df: DataFrame, columns: Sequence[str] = DESCRIBED) -> DataFrame:
    """Count, min, quartiles, max and mean per column, rounded to two decimals.

    The quartiles come from a bounded sketch, as in ``DataFrame.summary``: one
    pass and no shuffle of the rows. :func:`describe_exact` gives exact ones.
    """
    floats = df.select(*[as_float(c).alias(c) for c in columns])
    wide = floats.agg(
        F.count("*").alias("row_count"),
        *[a.alias(f"{n}_{i}") for i, c in enumerate(columns) for n, a in _moments(c).items()],
        # One sketch per column serves its three quartiles.
        *[
            F.percentile_approx(c, list(QUARTILES.values())).alias(f"quartiles_{i}")
            for i, c in enumerate(columns)
        ],
    )
    wide = wide.select(
        "*",
        *[
            F.get(f"quartiles_{i}", F.lit(j)).alias(f"{n}_{i}")
            for i in range(len(columns))
            for j, n in enumerate(QUARTILES)
        ],
    )
    fields = [*_moments("x"), *QUARTILES]
    long = _rows_from(wide, columns, {n: n for n in fields})
    return _rounded(long)


def _moments(c: str) -> dict[str, Column]:
    return {"count": F.count(c), "min": F.min(c), "max": F.max(c), "mean": F.avg(c)}


def _rounded(long: DataFrame) -> DataFrame:
    shown = ["min", *QUARTILES, "max", "mean"]
    return long.select(
        "column", "count", *[F.round(F.col(c).cast("double"), 2).alias(c) for c in shown]
    )


def describe_exact(df: DataFrame, columns: Sequence[str] = DESCRIBED) -> DataFrame:
    """As :func:`describe` with exact, interpolated quartiles.

    Rows are first counted per distinct value, which partial aggregation does
    inside each task. Ranks are then found in two steps, so no window holds a
    whole column: a running count over value ranges, then one inside each range.
    The ranges come from a bounded sketch of the distinct values, so there are at
    most ``SPANS`` of them and none holds much more than its share.
    """
    values = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), as_float(c).alias("v")) for c in columns])
        )
    ).filter("v IS NOT NULL")
    return description_of(values.groupBy("column", "v").agg(F.count("*").alias("n")))


def description_of(counts: DataFrame) -> DataFrame:
    """Exact description from (column, v, n), the rows of each distinct value."""
    shares = [k / SPANS for k in range(1, SPANS)]
    cuts = counts.groupBy("column").agg(
        F.array_distinct(F.percentile_approx("v", shares)).alias("cuts")
    )
    # One row a column, of at most SPANS numbers.
    counted = counts.join(F.broadcast(cuts), "column").select(
        "column", "v", "n", _span(F.col("v"), F.col("cuts")).alias("span")
    )
    spans = counted.groupBy("column", "span").agg(F.sum("n").alias("span_rows"))
    per_column = Window.partitionBy("column")
    before = per_column.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "column",
        "span",
        F.coalesce(F.sum("span_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("span_rows").over(per_column).alias("column_rows"),
    )
    inside = (
        Window.partitionBy("column", "span")
        .orderBy("v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counted.join(spans, ["column", "span"]).withColumn(
        "last_rank", F.col("rows_before") + F.sum("n").over(inside)
    )

    def at_rank(rank: Column) -> Column:
        """Value that holds the 1-based rank: the smallest whose last rank reaches it."""
        return F.min(F.when(F.col("last_rank") >= rank, F.col("v").cast("double")))

    aggs = []
    for name, q in QUARTILES.items():
        position = (F.col("column_rows") - 1) * q
        aggs += [
            at_rank(F.floor(position) + 1).alias(f"{name}_low"),
            at_rank(F.ceil(position) + 1).alias(f"{name}_high"),
            F.max(position - F.floor(position)).alias(f"{name}_part"),
        ]
    long = ranked.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        (F.sum(F.col("v").cast("double") * F.col("n")) / F.sum("n")).alias("mean"),
        *aggs,
    )
    for name in QUARTILES:
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        long = long.withColumn(name, low + (high - low) * F.col(f"{name}_part"))
    return _rounded(long)


def _span(value: Column, cuts: Column) -> Column:
    """Number of the range between ascending ``cuts`` that holds the value, by bisection."""
    steps = F.sequence(F.lit(0), F.lit(SPANS.bit_length()))
    halve = lambda s, _: F.when(s["low"] >= s["high"], s).otherwise(
        F.when(
            F.get(cuts, F.floor((s["low"] + s["high"]) / 2).cast("int")) <= value,
            F.struct(
                (F.floor((s["low"] + s["high"]) / 2) + 1).cast("int").alias("low"),
                s["high"].alias("high"),
            ),
        ).otherwise(
            F.struct(
                s["low"].alias("low"),
                F.floor((s["low"] + s["high"]) / 2).cast("int").alias("high"),
            )
        )
    )
    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    return F.aggregate(steps, start, halve, lambda s: s["low"])


def extremes(df: DataFrame, k: int = 50, sample: DataFrame | None = None) -> DataFrame:
    """Distinct delay pairs of the k highest and k lowest rows by each delay.

    ``sample`` adds the pairs of another table. Rows are counted per pair once,
    so the four lists read that small result and not the table; a pair with n
    rows takes n of the k places. The other delay settles ties.
    """
    floats = [as_float(c).alias(c) for c in DELAY_PAIR]
    pairs = df.select(*floats).dropna().groupBy(*DELAY_PAIR).agg(F.count("*").alias("n"))
    more = sample.select(*floats).dropna() if sample is not None else None
    return extremes_of(pairs, k, more)


def extremes_of(pairs: DataFrame, k: int = 50, more: DataFrame | None = None) -> DataFrame:
    """The extremes from (dep_delay, arr_delay, n), the rows of each distinct pair."""
    pair = DELAY_PAIR

    def outermost(first: str, second: str, descending: bool) -> DataFrame:
        order = [F.desc(c) if descending else F.asc(c) for c in (first, second)]
        # Each pair stands for at least one row, so k pairs are always enough;
        # the window then runs over these k only.
        head = pairs.orderBy(*order).limit(k)
        earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        places = F.coalesce(F.sum("n").over(earlier), F.lit(0))
        head = head.withColumn("places", places).filter(F.col("places") < k)
        # New names keep the four branches alike below, so that they share one
        # exchange of the counted pairs.
        return head.select(*[F.col(c).alias(f"extreme_{c}") for c in pair])

    parts = [
        outermost("dep_delay", "arr_delay", True),
        outermost("dep_delay", "arr_delay", False),
        outermost("arr_delay", "dep_delay", True),
        outermost("arr_delay", "dep_delay", False),
    ]
    if more is not None:
        parts.append(more)
    return reduce(DataFrame.union, parts).distinct().toDF(*pair)


def recovery(df: DataFrame) -> DataFrame:
    """Flights with both delays, how many made up time, and how the delays correlate."""
    return df.agg(*recovery_figures())


def recovery_figures() -> list[Column]:
    """Aggregates of the recovery; rows that lack either delay do not count."""
    dep, arr = as_float("dep_delay"), as_float("arr_delay")
    return [
        F.count_if(dep.isNotNull() & arr.isNotNull()).alias("pairs"),
        F.count_if(arr < dep).alias("recovered"),
        F.corr(dep, arr).alias("correlation"),
    ]


def dictionary_of(df: DataFrame) -> DataFrame:
    """Data dictionary of a table: column, type and percentage missing."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    kinds = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return _nulls_only(df).select(
        "column",
        kinds[F.col("column")].alias("dtype"),
        F.round("null_pct", 2).alias("null_pct"),
    )
