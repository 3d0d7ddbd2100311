"""Sorts, top-k lists and set membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in a stated order: each task keeps n rows, then they merge."""
    return df.orderBy(*order).limit(n)


def top_k(
    df: DataFrame, by: str, k: int, ties: Sequence[str], descending: bool = True
) -> DataFrame:
    """The k rows with the largest (or smallest) value; ``ties`` settles equal ones."""
    first = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return df.orderBy(first, *ties).limit(k)


def top_groups(df: DataFrame, key: str, weight: str, k: int) -> DataFrame:
    """The k groups with the largest sum of ``weight``."""
    sums = df.groupBy(key).agg(F.sum(weight).alias("total_weight"))
    return top_k(sums, "total_weight", k, [key])


def keep_top(df: DataFrame, key: str, weight: str, k: int) -> DataFrame:
    """All rows of the k heaviest groups."""
    return df.join(top_groups(df, key, weight, k).select(key), key, "left_semi")


def min_volume(df: DataFrame, n: int, column: str = "total_flights") -> DataFrame:
    """Groups with at least ``n`` rows behind them."""
    return df.filter(F.col(column) >= n)
