"""Token counts by a sentencepiece model, most of them without running it."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm import arrays
from aeropunct.llm.pretokens import PieceCounts

CONTEXT_TOKENS = 4096


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounts:
    """One per Python worker and model; its cache serves all tasks of the worker."""
    return PieceCounts(path)


def token_counts(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = CONTEXT_TOKENS,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text.

    ``model`` is the path of a sentencepiece model, present on every executor. A
    word whose vocabulary string was shown to encode alone as one token counts as
    one; only other words are merged, each once per cache. A model whose pieces or
    normalisation reach across words is refused.

    Null and empty texts have 0 bytes and tokens. Repeated rows are counted each;
    other columns are not read. Nothing is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for batch in arrays.chunks(batches):
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            counts = pa.array(counter.count(texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), counts],
                [batch.schema.names[0], "n_bytes", "n_tokens"],
            )

    text = F.col(text_col)
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    narrow = docs.select(F.col(id_col), text.alias("text"), n_bytes.alias("n_bytes"))
    kind = narrow.schema[0].dataType.simpleString()
    counted = narrow.mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
