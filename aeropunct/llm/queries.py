"""The operators as registered queries, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropunct.llm.attention_quality import quality_scores
from aeropunct.llm.block_codes import ORACLE as BLOCK_CODES_SQL
from aeropunct.llm.block_codes import block_codes
from aeropunct.llm.common import ship_package, table
from aeropunct.llm.iterative_quantisation import linked_vectors
from aeropunct.llm.minhash import near_duplicates
from aeropunct.llm.packing import pack
from aeropunct.llm.pareto_mix import ORACLE as PARETO_SQL
from aeropunct.llm.pareto_mix import mixed
from aeropunct.llm.repetition import repetition
from aeropunct.llm.string_kernel import toxicity_scores
from aeropunct.llm.text_density import extracted_pages
from aeropunct.llm.token_alignment import aligned_tokens
from aeropunct.llm.token_counts import token_counts
from aeropunct.llm.warc import archived_pages
from aeropunct.llm.weak_pii import personal_data

PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def op2_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Packed pieces with the checksum of their ids in place of the ids."""
    pieces = pack(docs, public_tokenizers.path(WORD_TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op4_indexed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(spark, table(spark, sf_dir, "pages")).drop("url")


def op5_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op6_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quantised_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


def op8_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op10_min_max_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4)


def op11_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_pages(table(spark, sf_dir, "pages"))


def op12_arrow_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aligned_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_TOKENIZER),
        public_tokenizers.path(PIECE_MODEL),
        whole_groups=False,
    )
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_hilbert_block_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_codes(table(spark, sf_dir, "embeddings"))


Query = Callable[[SparkSession, str], DataFrame]


def _with_package(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _with_package(query)
    for query in (
        op1_pareto_mix,
        op2_suffix_repetition,
        op3_bounded_packing,
        op4_indexed_warc,
        op5_weak_supervision_pii,
        op6_string_kernel_toxicity,
        op7_quantised_near_duplicates,
        op8_attention_quality,
        op9_token_counts,
        op10_min_max_near_duplicates,
        op11_text_density,
        op12_arrow_alignment,
        op13_hilbert_block_codes,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_pareto_mix": PARETO_SQL,
    "op13_hilbert_block_codes": BLOCK_CODES_SQL,
}
