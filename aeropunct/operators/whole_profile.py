"""The whole profile of a stored table in three reads.

The first read aggregates every figure that merges: shape, nulls, constant columns, sparse
rows, recovery. The second counts, in one grouped pass over stacked keys, the values to
describe, the pairs of delays, the pairs of ids, and the digests of whole records and of
logical keys. The third compares the rows whose digest occurs more than once. All reports
follow from the small tables that the first two write.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropunct.functions.columns import as_float
from aeropunct.operators import copies, profiling
from aeropunct.operators.cleaning import accounting_of, passes_quality
from aeropunct.schema import LOGICAL_KEY
from aeropunct.sources.readers import read_flights
from aeropunct.sources.writers import write_parquet

# What a stacked key counts.
PAIR, RECORD, LOGICAL = "pair", "record", "logical"
PASSES = "consistent"

KEY = ("kind", "name", "first", "second", "id", "value", *copies.DIGEST, "_flag_" + PASSES)


def _key(kind: str, **parts: Column) -> Column:
    """One stacked key; the parts it does not use are null."""
    types = dict.fromkeys(KEY, "string") | {"first": "float", "second": "float"}
    types |= dict.fromkeys(copies.DIGEST, "long") | {KEY[-1]: "boolean"}
    parts = {"kind": F.lit(kind), **parts}
    return F.struct(
        *[parts.get(k, F.lit(None)).cast(t).alias(k) for k, t in types.items()]
    )


def _stacked(df: DataFrame, described: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Every key of every row."""
    dep, arr = (as_float(c) for c in profiling.DELAY_PAIR)
    passes = F.coalesce(passes_quality(df.columns), F.lit(False))
    stacked = [
        F.when(as_float(c).isNotNull(), _key("value", name=F.lit(c), first=as_float(c)))
        for c in described
    ]
    stacked.append(
        F.when(dep.isNotNull() & arr.isNotNull(), _key(PAIR, first=dep, second=arr))
    )
    for i, base in profiling.id_pairs(df.columns).items():
        cells = {"id": F.col(f"`{i}`"), "value": F.col(f"`{base}`")}
        stacked.append(_key("ids", name=F.lit(f"{i}\t{base}"), **cells))
    for kind, columns in ((RECORD, df.columns), (LOGICAL, keys)):
        one, two = copies.digests(columns)
        digest = dict(zip(copies.DIGEST, (one, two), strict=True))
        flag = passes if kind == RECORD else F.lit(False)
        stacked.append(_key(kind, **digest, **{KEY[-1]: flag}))
    return df.select(F.inline(F.array_compact(F.array(*stacked))))


def _counted(stacked: DataFrame) -> DataFrame:
    """Every key with its n rows, and digests that occur once as one row per kind and flag.

    ``groups`` is the number of keys of a row. Only repeated digests are listed, so that
    the table stays small where copies are few.
    """
    counts = stacked.groupBy(*KEY).agg(F.count("*").alias("n"))
    single = F.col("kind").isin(RECORD, LOGICAL) & (F.col("n") == 1)
    shown = [F.when(~single, F.col(k)).alias(k) if k in copies.DIGEST else k for k in KEY]
    return counts.groupBy(*shown, "n").agg(F.count("*").alias("groups"))


def _equal_rows(df: DataFrame, repeated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(kind, flag, n) of rows equal on all columns, or on the logical key, in one read.

    A row takes part for its record, for its key, or for both, as their digests occur
    more than once; for its key the other columns are null.
    """
    passes = F.coalesce(passes_quality(df.columns), F.lit(False))
    sides = []
    for kind, columns in ((RECORD, df.columns), (LOGICAL, keys)):
        one, two = copies.digests(columns)
        flag = passes if kind == RECORD else F.lit(False)
        sides.append(
            F.struct(
                F.lit(kind).alias("kind"),
                one.alias(copies.DIGEST[0]),
                two.alias(copies.DIGEST[1]),
                flag.alias(KEY[-1]),
            )
        )
    rows = df.select(F.inline(F.array(*sides)), *copies.quoted(df.columns))
    join = ["kind", *copies.DIGEST, KEY[-1]]
    met = rows.join(repeated.select(*join), join, "left_semi")
    cells = [
        F.col(f"`{c}`") if c in keys else F.when(F.col("kind") == RECORD, F.col(f"`{c}`"))
        for c in df.columns
    ]
    groups = met.groupBy("kind", KEY[-1], *[c.alias(f"_{i}") for i, c in enumerate(cells)])
    return groups.agg(F.count("*").alias("n")).select("kind", KEY[-1], "n")


def _long(report: str, df: DataFrame, label: Column) -> DataFrame:
    """(report, label, item, value) of every number of each row."""
    values = [c for c, kind in df.dtypes if c not in ("column", "step", "base", "_label")]
    stacked = F.array(
        *[F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in values]
    )
    return df.select(F.lit(report).alias("report"), label.alias("label"), F.inline(stacked))


def whole_profile(
    df: DataFrame,
    scratch: str,
    described: Sequence[str] = profiling.DESCRIBED,
    keys: Sequence[str] = LOGICAL_KEY,
) -> DataFrame:
    """Every figure of the profile of a stored raw table as (report, label, item, value).

    Shape, per-column figures, id columns, copies, sparse rows, description with exact
    quartiles, the extreme pairs of delays and their bounds, row accounting and recovery.
    Two small tables are written below ``scratch`` and read by the result.
    """
    spark, table = df.sparkSession, F.lit("table")
    figures, counted = f"{scratch}/figures", f"{scratch}/counts"
    write_parquet(
        df.agg(
            *profiling.profile_figures(df),
            F.count_if(profiling.is_sparse(df)).alias("sparse_rows"),
            *profiling.recovery_figures(),
        ),
        figures,
    )
    stacked = _stacked(df, described, keys)
    write_parquet(_counted(stacked), counted)
    wide, counts = read_flights(spark, figures), read_flights(spark, counted)

    def of(kind: str) -> DataFrame:
        return counts.filter(F.col("kind") == kind)

    repeated = counts.filter(F.col("kind").isin(RECORD, LOGICAL) & (F.col("n") > 1))
    equal = f"{scratch}/equal"
    # Counted by group size, so that this table stays small however many copies there are.
    sizes = _equal_rows(df, repeated, keys).groupBy("kind", KEY[-1], "n")
    write_parquet(sizes.agg(F.count("*").alias("groups")), equal)
    same = read_flights(spark, equal)

    def surplus(kind: str) -> DataFrame:
        single = of(kind).filter("n = 1").select("kind", KEY[-1], "n", "groups")
        groups = single.unionByName(same.filter(F.col("kind") == kind))
        return groups.agg(
            F.coalesce(F.sum(F.col("n") * F.col("groups")), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum("groups"), F.lit(0)).alias("distinct_rows"),
            F.coalesce(F.sum(F.when(F.col(KEY[-1]), F.col("groups"))), F.lit(0)).alias(PASSES),
        )

    values = of("value").select(F.col("name").alias("column"), F.col("first").alias("v"), "n")
    pairs = of(PAIR).select(
        *[F.col(k).alias(c) for k, c in zip(("first", "second"), profiling.DELAY_PAIR, strict=True)], "n"
    )
    ids = of("ids").select(
        F.split("name", "\t")[0].alias("column"), F.split("name", "\t")[1].alias("base"), "id", "value"
    )
    # At most 200 pairs; they are named by their delays, which no two of them share.
    extremes = profiling.extremes_of(pairs)
    name = F.concat_ws("/", *[F.format_string("%.2f", F.col(c).cast("double")) for c in profiling.DELAY_PAIR])
    ends = extremes.agg(
        F.count("*").alias("pairs"),
        *[
            f(c).alias(f"{n}_{c}")
            for c in profiling.DELAY_PAIR
            for n, f in (("min", F.min), ("max", F.max))
        ],
    )
    shape = wide.select(
        F.col("row_count").alias("total_rows"), F.lit(len(df.columns)).alias("total_columns")
    )
    parts = [
        _long("shape", shape, table),
        _long("columns", profiling.profile_of(wide, df.columns), F.col("column")),
        _long("redundant_ids", profiling.redundancy_of(ids), F.col("column")),
        _long("exact_copies", profiling.surplus_of(surplus(RECORD)), table),
        _long("logical_copies", profiling.surplus_of(surplus(LOGICAL)), table),
        _long("sparse_rows", wide.select("sparse_rows"), table),
        _long("description", profiling.description_of(values), F.col("column")),
        _long("extremes", ends, table),
        _long("extreme_pairs", extremes.withColumn("_label", name), F.col("_label")),
        _long("row_accounting", accounting_of(surplus(RECORD)), F.col("step")),
        _long("recovery", wide.select("pairs", "recovered", "correlation"), table),
    ]
    return reduce(DataFrame.unionByName, parts)
