"""Scaled data sets: samples, over-samples and replicas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sizes in percent of the base table, and the seed.
SUB_SIZES = (10, 25, 50, 75)
OVER_SIZES = (150, 200, 300)
SEED = 42

# Scaled data sets by name, with their size in percent.
SCALES = {f"flight_{pct}": pct for pct in (*SUB_SIZES, *OVER_SIZES)}
# Column that marks the data set of a row.
DATASET = "_dataset"

_HASH_SPACE = 16**8


# Stands for null in the hashed key.
NULL_KEY = "\\N"


def sample(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Random rows without replacement, by seed and place within a partition.

    Take it from a stored table. Other partitions give other rows for the same
    seed; :func:`hash_sample` does not depend on them.
    """
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def _key_hash(keys: Sequence[str | Column]) -> Column:
    """Eight hex digits that depend on the key only; null is a value of its own."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY)) for c in columns]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)


def hash_limit(fraction: float) -> str:
    """The hash that a share of all keys stays below."""
    if not 0 <= fraction <= 1:
        raise ValueError("a fraction lies between 0 and 1")
    return format(int(fraction * _HASH_SPACE), "08x")


def _hash_below(keys: Sequence[str | Column], fraction: float) -> Column:
    return F.lit(True) if fraction == 1 else _key_hash(keys) < hash_limit(fraction)


def hash_sample(df: DataFrame, keys: Sequence[str | Column], fraction: float) -> DataFrame:
    """Rows whose key hash is below ``fraction``: no shuffle, and the same rows on
    every run, partitioning and retry. Rows that share a key stay together."""
    return df.filter(_hash_below(keys, fraction))


def sub_samples(
    df: DataFrame, seed: int = SEED, keys: Sequence[str | Column] | None = None
) -> dict[str, DataFrame]:
    """The 10, 25, 50 and 75 percent samples by data set name, random or by key hash."""
    return {
        f"flight_{pct}": hash_sample(df, keys, pct / 100) if keys else sample(df, pct / 100, seed)
        for pct in SUB_SIZES
    }


def hash_sub_samples(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """All sub-samples by key hash from one scan: each row once per sample that
    holds it, the sample's size in ``sample_pct``. Smaller samples lie in larger ones."""
    h = _key_hash(keys)
    sizes = [F.when(h < hash_limit(p / 100), p) for p in SUB_SIZES]
    return df.withColumn("sample_pct", F.explode(F.array_compact(F.array(*sizes))))


def _repeat(df: DataFrame, times: Column) -> DataFrame:
    """Each row ``times`` times, from one scan of the table."""
    copies = df.withColumn("copy_number", F.explode(F.sequence(F.lit(1), times)))
    return copies.drop("copy_number")


def oversample_150(
    df: DataFrame, seed: int = SEED, keys: Sequence[str | Column] | None = None
) -> DataFrame:
    """All rows and half of them a second time, chosen at random (see :func:`sample`)
    or by key hash."""
    again = _hash_below(keys, 0.5) if keys else F.rand(seed) < 0.5
    return _repeat(df, F.when(again, 2).otherwise(1))


def replicate(df: DataFrame, n: int) -> DataFrame:
    """Every row ``n`` times."""
    if n < 1:
        raise ValueError("a table can only be repeated once or more")
    return _repeat(df, F.lit(n))


def over_samples(
    df: DataFrame, seed: int = SEED, keys: Sequence[str | Column] | None = None
) -> dict[str, DataFrame]:
    """The 150, 200 and 300 percent tables by data set name."""
    return {
        "flight_150": oversample_150(df, seed, keys),
        "flight_200": replicate(df, 2),
        "flight_300": replicate(df, 3),
    }


def scaled_family(
    df: DataFrame, seed: int = SEED, keys: Sequence[str | Column] | None = None
) -> DataFrame:
    """Rows of all seven scaled data sets from one scan, each with its data set's name.

    A row's place in [0, 1), from its key hash or drawn once, decides all samples: the
    smaller ones lie in the larger ones, and the half that comes twice at 150 percent is
    the 50 percent sample.
    """
    if keys:
        place, within = _key_hash(keys), lambda share: F.col("_place") < hash_limit(share)
    else:
        place, within = F.rand(seed), lambda share: F.col("_place") < share
    times = [
        F.array_repeat(
            F.lit(name), F.lit(pct // 100) + F.when(within(pct % 100 / 100), 1).otherwise(0)
        )
        for name, pct in SCALES.items()
    ]
    marked = df.withColumn("_place", place)
    return marked.withColumn(DATASET, F.explode(F.flatten(F.array(*times)))).drop("_place")
