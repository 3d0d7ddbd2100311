"""Copies of rows, counted by digest.

Rows are grouped by a 128-bit digest of their columns, so that 16 bytes a row cross the
network. Digests that occur once stand for one row each. Only rows of digests that occur
more often are read again and compared on all columns, so a clash of digests costs time
and never a wrong count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Digest = Callable[[Sequence[str]], tuple[Column, Column]]
Flags = Mapping[str, Column]

DIGEST = ("_digest_1", "_digest_2")


def digests(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of the columns, seeded apart.

    The hash function passes over nulls; their places are hashed as an array of flags.
    """
    places = F.array(*[F.isnull(c) for c in quoted(columns)])
    cells = quoted(columns)
    first, second = (F.xxhash64(F.lit(seed), places, *cells) for seed in (0x5EED, 0xC0FFEE))
    return first, second


def quoted(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def flag_columns(flags: Flags | None) -> dict[str, Column]:
    """The flags under names that no table has; unknown counts as false."""
    return {f"_flag_{name}": F.coalesce(f, F.lit(False)) for name, f in (flags or {}).items()}


def with_digest(
    df: DataFrame, columns: Sequence[str], flags: Flags | None = None, digest: Digest = digests
) -> DataFrame:
    """(digest, flags, columns) of every row."""
    first, second = digest(columns)
    marked = [f.alias(name) for name, f in flag_columns(flags).items()]
    return df.select(
        first.alias(DIGEST[0]), second.alias(DIGEST[1]), *marked, *quoted(columns)
    )


def equal_rows(
    rows: DataFrame, repeated: DataFrame, columns: Sequence[str], flags: Sequence[str] = ()
) -> DataFrame:
    """(flags, n): groups of rows equal on all columns, among those of repeated digests."""
    met = rows.join(repeated.select(*DIGEST, *flags), [*DIGEST, *flags], "left_semi")
    return met.groupBy(*quoted(columns), *flags).agg(F.count("*").alias("n")).select(*flags, "n")


def summed(groups: Sequence[DataFrame], flags: Sequence[str] = ()) -> DataFrame:
    """One row of total_rows, distinct_rows, and the distinct rows of each flag."""
    figures = [
        g.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.count("*").alias("distinct_rows"),
            *[F.count_if(F.col(f)).alias(f) for f in flags],
        )
        for g in groups
    ]
    both = figures[0]
    for more in figures[1:]:
        both = both.unionByName(more)
    return both.agg(*[F.sum(c).alias(c.removeprefix("_flag_")) for c in both.columns])


def count_copies(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    flags: Flags | None = None,
    digest: Digest = digests,
) -> DataFrame:
    """One row: total_rows, distinct_rows on the columns, and distinct rows by flag.

    ``flags`` are functions of the columns. They are part of the key, so that a group
    has one value of each. Reads ``df`` twice; an empty table counts zero.
    """
    columns, names = list(columns or df.columns), list(flag_columns(flags))
    rows = with_digest(df, columns, flags, digest)
    # Both uses below aggregate alike, so that they share one exchange.
    groups = rows.groupBy(*DIGEST, *names).agg(F.count("*").alias("n"))
    repeated = equal_rows(rows, groups.filter("n > 1"), columns, names)
    return summed([groups.filter("n = 1"), repeated], names)
