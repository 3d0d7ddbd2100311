"""A training corpus from raw documents: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropunct.llm.common import Scratch, ship_package, table
from aeropunct.llm.minhash import near_duplicates
from aeropunct.llm.pareto_mix import plan_mix
from aeropunct.llm.queries import packed
from aeropunct.llm.string_kernel import DECISION, toxicity
from aeropunct.llm.weak_pii import masked


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity classifier does not reject, all columns as they are."""
    ship_package(spark)
    rows = docs.select("text", F.struct("*").alias("_row"))
    scored = toxicity(rows, docs, table(spark, sf_dir, "labels"))
    return scored.filter(F.col("_toxicity") < DECISION).select("_row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Rows that share an id are one document: one of their rows stays. Rows without an
    id are in no group and stay.
    """
    ship_package(spark)
    found = Scratch(spark, "groups").keep(
        near_duplicates(docs).filter("doc_id IS NOT NULL").select("doc_id", "kept"), "found"
    )
    gone = found.filter("NOT kept").select("doc_id").distinct()
    repeated = found.filter("kept").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    left = docs.join(gone.unionByName(repeated), "doc_id", "left_anti").select(docs.columns)
    # Of a repeated id the row with the smallest hash stays, found without gathering the rows.
    order = F.struct(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.col("text"))
    one = (
        docs.join(repeated, "doc_id", "left_semi")
        .select(docs.columns)
        .groupBy("doc_id")
        .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), order).alias("_row"))
        .select("_row.*")
    )
    return left.unionByName(one)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return masked(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document as often as its copies, 0 to 2 times."""
    mix, _ = plan_mix(docs, Scratch(spark, "mix"))
    rows = mix.copies(docs.select("doc_id", "source", "text", F.struct("*").alias("_row")))
    return (
        rows.filter("_copies > 0")
        .select(F.explode(F.array_repeat("_row", F.col("_copies"))).alias("_row"))
        .select("_row.*")
    )


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    ship_package(spark)
    return packed(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("personal_data", without_personal_data),
    ("source_mix", mixed_sources),
    ("packing", packed_sequences),
]

# The stages learn classifiers and follow links to any depth, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads the table that the one before wrote."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
