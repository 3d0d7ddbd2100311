"""Product codes of vectors by exact integer clustering over Hilbert-sorted flat blocks.

Each part position of the vectors is clustered apart. Points of a part are sorted along
a Hilbert curve and kept in flat blocks with their bounding box and their sums. A round
compares boxes with the codebook's entries: an entry farther from the box than another
entry's farthest corner cannot be nearest to any point inside, so each block has a short
list. A block with one entry left is settled by its sums alone; the others are evaluated
point by point over their short lists only. All arithmetic is on integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropunct.llm.common import Scratch

# Fixed values of the code: parts of a vector, entries of a codebook, rounds, scale.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256

# Integers are held within this bound, so that every sum of squares fits 64 bits.
LARGEST = 1 << 25
# Points in a block, vectors in a chunk of blocks, and components in a chunk.
BLOCK, CHUNK_ROWS, CHUNK_CELLS = 32, 8192, 1 << 19
# Distances evaluated at once.
KERNEL_CELLS = 1 << 20


# -- blocks -------------------------------------------------------------------


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component, padded with zeros to whole parts."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    values = np.clip(scaled, -LARGEST, LARGEST).astype(np.int64)
    return np.pad(values, ((0, 0), (0, -vectors.shape[1] % PARTS)))


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Place of each point along a Hilbert curve through the points' bounding box.

    The curve has as many bits per axis as fit one integer; of more than 62 axes it
    takes the first 62. Keys only decide which points share a block.
    """
    n, axes = points.shape[0], min(points.shape[1], 62)
    bits = max(1, min(8, 62 // axes))
    low = points[:, :axes].min(axis=0)
    span = np.maximum(points[:, :axes].max(axis=0) - low, 1)
    x = ((points[:, :axes] - low) * ((1 << bits) - 1) // span).T.copy()
    # Gray-code walk: undo the excess turns from the highest bit down.
    bit = 1 << (bits - 1)
    while bit > 1:
        lower = bit - 1
        for axis in range(axes):
            turned = (x[axis] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[axis]) & lower)
            x[0] ^= np.where(turned, lower, swap)
            x[axis] ^= swap
        bit >>= 1
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(n, np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((x[axes - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= flip
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = (key << 1) | ((x[axis] >> b) & 1)
    return key


class Blocks:
    """The points of one part position: sorted, cut into blocks, with boxes and sums."""

    def __init__(self, points: np.ndarray):
        n, width = points.shape
        self.order = np.argsort(hilbert_keys(points), kind="stable")
        self.starts = np.arange(0, n, BLOCK)
        self.sizes = np.diff(np.append(self.starts, n))
        ordered = points[self.order]
        self.low = np.minimum.reduceat(ordered, self.starts, axis=0)
        self.high = np.maximum.reduceat(ordered, self.starts, axis=0)
        self.sums = np.add.reduceat(ordered, self.starts, axis=0)
        # The last block is filled up with its last point; sizes tell how many count.
        fill = np.repeat(ordered[-1:], len(self.starts) * BLOCK - n, axis=0)
        self.points = np.concatenate([ordered, fill]).reshape(-1, BLOCK, width)

    FIELDS = ("order", "sizes", "low", "high", "sums", "points")

    def stored(self) -> list[bytes]:
        """The arrays as bytes, in the smallest integer type that holds them."""
        return [_packed(getattr(self, name)) for name in self.FIELDS]

    @classmethod
    def restored(cls, fields: list[bytes], width: int) -> Blocks:
        self = cls.__new__(cls)
        for name, data in zip(cls.FIELDS, fields, strict=True):
            setattr(self, name, _unpacked(data))
        self.low, self.high, self.sums = (
            a.reshape(-1, width) for a in (self.low, self.high, self.sums)
        )
        self.points = self.points.reshape(-1, BLOCK, width)
        return self


_KINDS = (np.int16, np.int32, np.int64)


def _packed(values: np.ndarray) -> bytes:
    top = int(np.abs(values).max(initial=0))
    code = next(i for i, k in enumerate(_KINDS) if top <= np.iinfo(k).max)
    return bytes([code]) + values.astype(_KINDS[code]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, _KINDS[data[0]], offset=1).astype(np.int64)


# -- one round ----------------------------------------------------------------


def short_lists(blocks: Blocks, entries: np.ndarray) -> np.ndarray:
    """(block, entry): whether the entry may be nearest to a point inside the box.

    It may not when its distance to the box exceeds the least of all entries'
    distances to their farthest corner. Equal distances stay, since ties go by index.
    """
    below = blocks.low[:, None, :] - entries[None]
    above = entries[None] - blocks.high[:, None, :]
    nearest = np.maximum(np.maximum(below, above), 0)
    farthest = np.maximum(np.abs(below), np.abs(above))
    least = (nearest * nearest).sum(axis=2)
    most = (farthest * farthest).sum(axis=2).min(axis=1)
    return least <= most[:, None]


def nearest_entries(
    blocks: Blocks, entries: np.ndarray, errors: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each point by block, its squared distance or 0, blocks settled at once).

    Points of settled blocks get their distance only when ``errors`` asks for it.
    """
    lists = short_lists(blocks, entries)
    lengths = lists.sum(axis=1)
    first = lists.argmax(axis=1)
    # Entries in ascending order, then the others: equal distances go to the lower index.
    ranked = np.argsort(~lists, axis=1, kind="stable")
    chosen = np.repeat(first[:, None], BLOCK, axis=1)
    distance = np.zeros(chosen.shape, np.int64)
    settled = lengths == 1
    width = 1
    while width < 2 * entries.shape[0]:
        # Blocks with lists of about one length together; short lists end in repeats.
        some = np.flatnonzero((lengths <= width) & (lengths > width // 2))
        if width > 1 or errors:
            take = min(width, entries.shape[0])
            step = max(1, KERNEL_CELLS // (take * BLOCK * entries.shape[1]))
            for at in range(0, len(some), step):
                part = some[at : at + step]
                last = np.minimum(np.arange(take)[None], lengths[part, None] - 1)
                listed = np.take_along_axis(ranked[part], last, axis=1)
                apart = blocks.points[part][:, :, None, :] - entries[listed][:, None]
                squares = np.einsum("bpew,bpew->bpe", apart, apart)
                best = squares.argmin(axis=2)
                chosen[part] = np.take_along_axis(listed, best, axis=1)
                distance[part] = np.take_along_axis(squares, best[..., None], axis=2)[..., 0]
        width *= 2
    return chosen, distance, settled


def tally(blocks: Blocks, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and number of the points nearest to each entry."""
    chosen, _, settled = nearest_entries(blocks, entries, errors=False)
    sums, counts = np.zeros_like(entries), np.zeros(len(entries), np.int64)
    np.add.at(sums, chosen[settled, 0], blocks.sums[settled])
    np.add.at(counts, chosen[settled, 0], blocks.sizes[settled])
    real = np.arange(BLOCK)[None] < blocks.sizes[:, None]
    real &= ~settled[:, None]
    which = chosen[real]
    points = blocks.points[real]
    for axis in range(points.shape[1]):
        # Sums below 2**53 are exact in the bins' doubles; larger ones are added as integers.
        if len(points) * LARGEST < 1 << 53:
            binned = np.bincount(which, points[:, axis], len(entries))
            sums[:, axis] += binned.astype(np.int64)
        else:
            np.add.at(sums[:, axis], which, points[:, axis])
    counts += np.bincount(which, minlength=len(entries))
    return sums, counts


# -- tasks --------------------------------------------------------------------


def _chunk_rows(dimension: int) -> int:
    return max(BLOCK, min(CHUNK_ROWS, CHUNK_CELLS // max(dimension, 1)))


def _block_writer(dimension: int) -> Callable:
    """Rows (id, label, vector) to one row a chunk: ids, labels, and 16 sets of blocks."""
    names = [f"{name}_{p}" for p in range(PARTS) for name in Blocks.FIELDS]
    most = _chunk_rows(dimension)

    def chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        flat = table.column(2).chunk(0).flatten().to_numpy(zero_copy_only=False)
        values = whole_numbers(flat.reshape(len(table), dimension))
        width = values.shape[1] // PARTS
        columns = [_one_list(table.column(i).chunk(0)) for i in (0, 1)]
        for p in range(PARTS):
            blocks = Blocks(np.ascontiguousarray(values[:, p * width : (p + 1) * width]))
            columns += [pa.array([data], pa.binary()) for data in blocks.stored()]
        return pa.RecordBatch.from_arrays(columns, ["ids", "labels", *names])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        room = most
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, room)
                held.append(piece)
                at += piece.num_rows
                room -= piece.num_rows
                if not room:
                    yield chunk(held)
                    held, room = [], most
        if held:
            yield chunk(held)

    return write


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _parts(batch: pa.RecordBatch, row: int, width: int) -> list[Blocks]:
    def field(name: str) -> bytes:
        return batch.column(batch.schema.get_field_index(name))[row].as_py()

    return [
        Blocks.restored([field(f"{name}_{p}") for name in Blocks.FIELDS], width)
        for p in range(PARTS)
    ]


def _tallies(books: np.ndarray) -> Callable:
    """Chunks to (part, entry, axis, total, points) of one task, for entries with points."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, blocks in enumerate(_parts(batch, row, books.shape[2])):
                    more = tally(blocks, books[p])
                    sums[p] += more[0]
                    counts[p] += more[1]
        part, entry, axis = (i.ravel() for i in np.indices(books.shape))
        points = np.repeat(counts.ravel(), books.shape[2])
        used = points > 0
        columns = [part, entry, axis, sums.ravel(), points]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[used].astype(np.int64)) for c in columns],
            ["part", "entry", "axis", "total", "points"],
        )

    return count


_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), "S2")


def _coder(books: np.ndarray) -> Callable:
    """Chunks to (id, label, code, error) of each vector."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = (batch.column(i)[row].values for i in (0, 1))
                codes = np.empty((len(ids), PARTS), np.int64)
                errors = np.zeros(len(ids), np.int64)
                for p, blocks in enumerate(_parts(batch, row, books.shape[2])):
                    chosen, distance, _ = nearest_entries(blocks, books[p], errors=True)
                    codes[blocks.order, p] = chosen.ravel()[: len(ids)]
                    errors[blocks.order] += distance.ravel()[: len(ids)]
                text = np.ascontiguousarray(_HEX[codes]).view(f"S{2 * PARTS}").ravel()
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(text.astype(str)), pa.array(errors)],
                    ["id", "label", "code", "error"],
                )

    return code


# -- the job ------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components, of one or more."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def _next_books(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries after a round: floor of the mean of their points, or as they were."""
    parts = blocks.mapInArrow(
        _tallies(books), "part long, entry long, axis long, total long, points long"
    )
    # At most one row for each component of the codebooks, whatever the table's size.
    merged = parts.groupBy("part", "entry", "axis").agg(F.sum("total"), F.sum("points"))
    after = books.copy()
    for part, entry, axis, total, points in merged.collect():
        after[part, entry, axis] = total // points
    return after


def block_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    rounds: int = ROUNDS,
    entries: int = ENTRIES,
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every usable vector.

    Vectors that are null or empty or hold null or non-finite components are dropped. So
    are vectors of another length than that of the smallest id; a length that 16 does not
    divide is padded with zeros. Integers beyond 2**25 are held there. Codebooks start
    from the ``entries`` (at most 256) smallest ids (null last; rows that share an id in order of their vectors),
    fewer where the table has fewer; repeated rows each count. ``label_error`` sums equal
    labels, nulls together; it is null where 64 bits cannot hold it. An empty table gives
    an empty result. Other columns are not read.

    Blocks are made inside tasks and written once; a round reads them and shuffles one
    small row per codebook component and task.
    """
    spark = vectors.sparkSession
    kept = vectors.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{label_col}`").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    ).filter(usable(F.col("vector")))
    kinds = dict(kept.dtypes)
    seeds = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    dimension = len(seeds[0].vector) if seeds else PARTS
    seeds = [s.vector for s in seeds if len(s.vector) == dimension]
    books = whole_numbers(np.array(seeds, np.float64).reshape(len(seeds), dimension))
    books = np.stack(np.split(books, PARTS, axis=1))

    scratch = Scratch(spark, "codes")
    fields = ", ".join(f"{name}_{p} binary" for p in range(PARTS) for name in Blocks.FIELDS)
    blocks = scratch.keep(
        kept.filter(F.size("vector") == dimension).mapInArrow(
            _block_writer(dimension),
            f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, {fields}",
        ),
        "blocks",
    )
    for _ in range(rounds):
        books = _next_books(blocks, books)
    coded = scratch.keep(
        blocks.mapInArrow(
            _coder(books), f"id {kinds['id']}, label {kinds['label']}, code string, error long"
        ),
        "codes",
    )
    scratch.drop(blocks)
    # One row a label: summed in the tasks first, so a hot label is a row a task.
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(
        F.try_sum("error").alias("label_error")
    )
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        F.col("id").alias(id_col),
        "code",
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


def _round_sql(n: int) -> str:
    """Assignment to the entries of round ``n`` and the entries that follow."""
    return f"""
near{n} AS (
  SELECT rid, p, any_value(x) AS x, min(64 * list_sum(list_transform(list_zip(x, c),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT + e) AS best
  FROM parts JOIN book{n} USING (p) GROUP BY rid, p),
mean{n} AS (
  SELECT p, best % 64 AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
  FROM near{n}, range(1, 1 + (SELECT max(len(x)) FROM parts)) AS axis(i) GROUP BY ALL),
book{n + 1} AS (
  SELECT p, e, coalesce(f.c, b.c) AS c FROM book{n} b LEFT JOIN (
    SELECT p, e, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY i) AS c
    FROM mean{n} GROUP BY p, e) f USING (p, e)),"""


ORACLE = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x
  FROM kept, range(16) AS position(p)),
book0 AS (SELECT p, rid - 1 AS e, x AS c FROM parts WHERE rid <= 64),
{_round_sql(0)}
{_round_sql(1)}
near2 AS MATERIALIZED (
  SELECT rid, p, min(64 * list_sum(list_transform(list_zip(x, c),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT + e) AS best
  FROM parts JOIN book2 USING (p) GROUP BY rid, p),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', (best % 64)::INT), '' ORDER BY p) AS code,
    sum(best // 64)::BIGINT AS error
  FROM near2 JOIN kept USING (rid) GROUP BY rid, vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book2)
    AS codebooks_sha256
FROM coded
"""
