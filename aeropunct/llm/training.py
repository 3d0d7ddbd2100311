"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm.common import in_training


def class_counts(labels: DataFrame, label: str) -> tuple[int, int]:
    """How many documents that may be learnt from have label 0 and 1."""
    usable = _usable(labels, label)
    row = usable.agg(F.expr("count_if(label = 0)"), F.expr("count_if(label = 1)")).first()
    return row[0], row[1]


def _usable(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the training folds; a document labelled both ways counts as 0."""
    return (
        labels.filter(in_training(F.col("doc_id")) & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
    )


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int
) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of either label.

    The ids with the smallest hashes are taken, so reruns agree. At most
    ``2 * per_class`` ids are broadcast, and as many texts of at most ``max_chars``
    characters come out, however often an id repeats.
    """
    usable = _usable(labels, label)
    by_hash = [F.xxhash64(F.lit(label), F.col("doc_id")), F.col("doc_id")]
    ids = [
        usable.filter(F.col("label") == value).orderBy(*by_hash).limit(per_class)
        for value in (0, 1)
    ]
    found = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .filter(F.length("text") <= max_chars)
        .join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")
    )
    return found.orderBy(*by_hash, "text").limit(2 * per_class)
