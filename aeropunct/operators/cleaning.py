"""Raw flights to the cleaned table, and the filters the reports use."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropunct.functions.columns import as_float, as_int, hour_of
from aeropunct.operators.copies import count_copies
from aeropunct.schema import (
    CAUSE_COLUMNS,
    CLEAN_COLUMNS,
    FLOAT_COLUMNS,
    INT_COLUMNS,
    KEPT_COLUMNS,
    RAW_EXTRAS,
    STRING_COLUMNS,
)

CAST_GROUPS = {"float": FLOAT_COLUMNS, "int": INT_COLUMNS, "string": STRING_COLUMNS}


def dedup(df: DataFrame) -> DataFrame:
    """Drop exact copies. Call it before pruning, so that only true copies go.

    This becomes a hash aggregate keyed on every column: copies collapse inside
    each task before the shuffle, so a record copied a billion times costs one
    row per task. Later filters on plain columns are pushed below it by Spark.
    """
    return df.dropDuplicates()


def prune(df: DataFrame, columns: Sequence[str] = KEPT_COLUMNS) -> DataFrame:
    return df.select(*columns)


def cast_columns(df: DataFrame, groups: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Cast groups of columns to float, int or string in one projection.

    A value that does not convert becomes null, whatever the session's ANSI mode.
    """
    casts = {"float": as_float, "int": as_int, "string": lambda c: F.col(c).cast("string")}
    target = {c: t for t, cols in (groups or CAST_GROUPS).items() for c in cols}
    present = dict(df.dtypes)

    def cast(c: str) -> Column:
        if target.get(c, present[c]) == present[c]:
            return F.col(c)
        return casts[target[c]](c).alias(c)

    return df.select(*[cast(c) for c in df.columns])


def with_hour(df: DataFrame) -> DataFrame:
    """Add the scheduled departure hour."""
    return df.withColumn("hour", hour_of("crs_dep_time"))


def fill_causes(df: DataFrame) -> DataFrame:
    """No recorded cause means zero minutes."""
    return df.fillna(0, subset=list(CAUSE_COLUMNS))


def is_operated() -> Column:
    return F.col("cancelled") == 0


def is_cancelled() -> Column:
    return F.col("cancelled") == 1


def is_consistent(columns: Mapping[str, Column] | None = None) -> Column:
    """The quality rule of a flight record, on the table's columns or on given ones.

    It needs a positive distance and both airports, and must either have flown
    (no cancellation code, both delays known) or be cancelled with a code.
    """
    c = columns or {name: F.col(name) for name in KEPT_COLUMNS}
    code = c["cancellation_code"]
    delays_known = c["dep_delay"].isNotNull() & c["arr_delay"].isNotNull()
    flown = (c["cancelled"] == 0) & code.isNull() & delays_known
    called_off = (c["cancelled"] == 1) & code.isNotNull()
    located = c["origin"].isNotNull() & c["dest"].isNotNull()
    return (c["distance"] > 0) & located & (flown | called_off)


def quality_filter(df: DataFrame) -> DataFrame:
    return df.filter(is_consistent())


def shape_columns(raw: DataFrame) -> DataFrame:
    """Every step of cleaning that keeps the row count."""
    return fill_causes(with_hour(cast_columns(prune(raw)))).select(*CLEAN_COLUMNS)


def clean(raw: DataFrame, drop_copies: bool = True) -> DataFrame:
    """Raw records to the cleaned 15-column table."""
    source = dedup(raw) if drop_copies else raw
    return quality_filter(shape_columns(source))


def passes_quality(columns: Sequence[str]) -> Column:
    """The quality rule on raw columns, as a function of the record: unknown is false."""
    raw = {c: F.col(f"`{c}`") for c in columns}
    known = {
        "distance": as_float(raw["distance"]),
        "cancelled": as_int(raw["cancelled"]),
        "dep_delay": as_float(raw["dep_delay"]),
        "arr_delay": as_float(raw["arr_delay"]),
    }
    return F.coalesce(is_consistent({**raw, **known}), F.lit(False))


def row_accounting(raw: DataFrame) -> DataFrame:
    """Rows before, after and dropped for each cleaning step.

    Counted from the data, not with accumulators: those can count a task twice
    when an executor is lost and its stage runs again. Copies are found by digest, see
    :func:`aeropunct.operators.copies.count_copies`.
    """
    return accounting_of(count_copies(raw, flags={"consistent": passes_quality(raw.columns)}))


def accounting_of(counts: DataFrame) -> DataFrame:
    """The steps from total_rows, distinct_rows and consistent, the distinct rows that pass."""

    def step(label: str, before: str, after: str) -> Column:
        return F.struct(
            F.lit(label).alias("step"),
            F.col(before).alias("before"),
            F.col(after).alias("after"),
            (F.col(before) - F.col(after)).alias("dropped"),
        )

    return counts.select(
        F.inline(
            F.array(
                step("duplicates", "total_rows", "distinct_rows"),
                step("quality", "distinct_rows", "consistent"),
                step("total", "total_rows", "consistent"),
            )
        )
    )


def clean_with_counts(raw: DataFrame, measures: dict[str, Column] | None = None) -> DataFrame:
    """Cleaned columns of every distinct record with its counts, for one read of the raw table.

    ``copies`` is the number of rows of the record, ``consistent`` whether it passes the
    quality rule; the columns of a record that does not are null. ``measures`` are sums
    over the record's rows. The counts are columns of the groups themselves, so a task
    that runs twice cannot count twice.
    """
    keys = [c for c in raw.columns if c not in RAW_EXTRAS]
    sums = [F.sum(m).alias(name) for name, m in (measures or {}).items()]
    groups = raw.groupBy(*keys).agg(F.count("*").alias("copies"), *sums)
    counts = ["copies", *(measures or {})]
    marked = groups.select(*KEPT_COLUMNS, *counts, passes_quality(keys).alias("consistent"))
    shaped = fill_causes(with_hour(cast_columns(marked)))
    return shaped.select(
        *[F.when(F.col("consistent"), F.col(c)).alias(c) for c in CLEAN_COLUMNS],
        "consistent",
        *counts,
    )


def has_required(required: Sequence[str]) -> Column:
    """True when none of the columns is null."""
    present = F.lit(True)
    for c in required:
        present = present & F.col(c).isNotNull()
    return present


def skip_bad(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that hold every required field, and a one-row count of kept and skipped."""
    good = has_required(required)
    counts = df.agg(
        F.count_if(good).alias("kept_rows"),
        F.count_if(~good).alias("skipped_rows"),
    )
    return df.filter(good), counts


def exclude(df: DataFrame, column: str, label: str) -> DataFrame:
    """Rows whose label is another one."""
    return df.filter(F.col(column) != label)


def cancelled(df: DataFrame) -> DataFrame:
    return df.filter(is_cancelled())


def operated(df: DataFrame) -> DataFrame:
    return df.filter(is_operated())


def with_delay(df: DataFrame, column: str) -> DataFrame:
    """Rows where the delay is known, with the delay as float."""
    return df.filter(F.col(column).isNotNull()).withColumn(column, as_float(column))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns, rows without any null among them."""
    return df.select(*columns).dropna()
