"""Packing of token ids into sequences of fixed length, with few windows open at a time."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm import arrays
from aeropunct.llm.common import Scratch
from aeropunct.llm.pretokens import WordIds

SEQUENCE_TOKENS = 2048
END_OF_DOCUMENT = 1
# Windows open at a time in a task, and open windows merged at a time in the end.
OPEN_WINDOWS = 128
MERGE_WINDOWS = 256
# Bytes of text encoded at once: the larger, the fewer words are looked up anew.
ENCODED_BYTES = 4 << 20

_PIECE = pa.schema(
    [
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("window", pa.int64()),
        ("offset", pa.int64()),
        ("left_open", pa.bool_()),
    ]
)


class Packer:
    """Bounded-space best fit: at most ``most`` windows are open at any time."""

    def __init__(self, size: int, most: int, first: int):
        self.size, self.most, self.next = size, most, first
        self.open: list[tuple[int, int]] = []  # (fill, window), the fullest last
        self.pieces: dict[int, list[tuple]] = {}

    def add(self, doc: object, ids: bytes) -> Iterator[tuple]:
        """Places a document; yields the pieces of all windows closed by that."""
        n = len(ids) // 4
        whole = n - n % self.size
        for start in range(0, whole, self.size):
            cut = ids[4 * start : 4 * (start + self.size)]
            yield (doc, start, self.size, cut, n, self.next, 0, False)
            self.next += 1
        if n > whole:
            yield from self._place(doc, whole, n - whole, ids[4 * whole :], n)

    def _place(self, doc: object, start: int, length: int, ids: bytes, n: int) -> Iterator[tuple]:
        at = bisect_right(self.open, (self.size - length, self.next)) - 1
        if at >= 0:
            fill, window = self.open.pop(at)
        else:
            if len(self.open) == self.most:
                yield from self._close(self.open.pop()[1], False)
            fill, window = 0, self.next
            self.next += 1
        pieces = self.pieces.setdefault(window, [])
        pieces.append((doc, start, length, ids, n, window, fill))
        if fill + length == self.size:
            yield from self._close(window, False)
        else:
            insort(self.open, (fill + length, window))

    def _close(self, window: int, left_open: bool) -> Iterator[tuple]:
        for piece in self.pieces.pop(window):
            yield (*piece, left_open)

    def rest(self) -> Iterator[tuple]:
        for _, window in self.open:
            yield from self._close(window, True)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordIds:
    """One per Python worker and tokenizer; its caches serve all tasks of the worker."""
    return WordIds(path)


def _merge_windows(size: int):
    """Best fit of whole windows, the fullest first; ties by window, so reruns agree."""

    def merge(windows: pd.DataFrame) -> pd.DataFrame:
        windows = windows.sort_values(["fill", "window"], ascending=[False, True])
        open_: list[tuple[int, int]] = []
        out = []
        for window, length in zip(windows["window"].tolist(), windows["fill"].tolist(), strict=True):
            at = bisect_right(open_, (size - length, 2**63)) - 1
            fill, sequence = open_.pop(at) if at >= 0 else (0, window)
            out.append((window, sequence, fill))
            insort(open_, (fill + length, sequence))
        return pd.DataFrame(out, columns=["window", "sequence_id", "shift"])

    return merge


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE_TOKENS,
    end_id: int = END_OF_DOCUMENT,
    open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """Every document's token ids, and ``end_id``, cut into pieces of sequences.

    ``tokenizer`` is the path of a tokenizer file, present on every executor. A task
    cuts off full sequences and places what remains best-fit into one of its
    ``open_windows`` windows; when none fits, the fullest is emitted and a new one
    opened. The windows that tasks leave open are merged best-fit in groups.

    Returns a row a piece: id, start, length, ids (little-endian 32-bit), doc_tokens,
    sequence_id, offset. Pieces of a sequence follow each other without a gap.

    Null and empty texts are one piece of ``end_id`` alone. Rows with the same or a
    null id are packed each by itself; other columns are not read. A task holds a few
    megabytes of text and ``open_windows`` windows. It reads its rows in file order,
    and its pieces are written before the windows are merged, so a lost executor
    repeats the same cuts. ``docs`` should therefore be read from files.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    narrow = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    kind = narrow.schema[0].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer), end_id.to_bytes(4, "little")
        packer = Packer(size, open_windows, TaskContext.get().partitionId() << 40)
        schema = None
        for batch in arrays.chunks(batches, size=ENCODED_BYTES):
            schema = schema or pa.schema([batch.schema.field(0), *_PIECE])
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            done: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.ids(texts), strict=True):
                done.extend(packer.add(doc, ids + end))
            yield _pieces(done, schema)
        if schema:
            yield _pieces(list(packer.rest()), schema)

    fields = (
        "start long, length long, ids binary, doc_tokens long, window long, offset long, "
        "left_open boolean"
    )
    pieces = scratch.keep(narrow.mapInArrow(cut, f"`{id_col}` {kind}, {fields}"), "pieces", "zstd")

    left = pieces.filter("left_open")
    fills = left.groupBy("window").agg(F.sum("length").alias("fill"))
    groups = max(1, fills.count() // MERGE_WINDOWS)
    merged = (
        fills.withColumn("group", F.pmod(F.xxhash64("window"), F.lit(groups)))
        .groupBy("group")
        .applyInPandas(_merge_windows(size), "window long, sequence_id long, shift long")
    )
    moved = left.join(merged, "window").withColumn("offset", F.col("offset") + F.col("shift"))
    columns = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    closed = pieces.filter("NOT left_open").withColumn("sequence_id", F.col("window"))
    return closed.select(*columns).unionByName(moved.select(*columns))


def _pieces(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
