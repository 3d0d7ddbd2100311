"""Connected components and global ranks as plain joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeropunct.llm.common import Scratch


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours become neighbours of its smallest one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.filter("v > u")
        .join(least, "u")
        .select(F.col("v").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours become neighbours of the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links(a, b)``: the smallest id it can reach.

    Alternating large-star and small-star steps (Kiveris et al., 2014). The edges
    never grow in number, each step is written to the shared folder, and only
    their count and a checksum reach the driver.
    """
    edges = scratch.keep(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _signature(edges)
    while True:
        after = scratch.keep(_small_star(_large_star(edges)), "edges")
        scratch.drop(edges)
        edges, now = after, _signature(after)
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)


def ranked(scratch: Scratch, df: DataFrame, *order: Column | str) -> DataFrame:
    """Adds ``_rank``, the row's place from 0 in the order of all rows.

    The rows are dealt out by ranges and written, so that a lost task cannot deal
    them anew; a range is then numbered from the rows of the ranges before it,
    whose counts are one row a range.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = scratch.keep(
        df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        dealt.join(F.broadcast(offsets), "_part")
        .withColumn("_rank", F.col("_before") + inside - 1)
        .drop("_part", "_before")
    )
