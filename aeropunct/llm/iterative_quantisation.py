"""Near-duplicate vectors: binary codes by iterative quantisation, multi-index tables, rerank."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm.common import Scratch
from aeropunct.llm.components import connected_components, ranked

# Vectors the rotation is learnt from, at most.
FIT_VECTORS = 20_000
# A pair at cosine 0.9 differs in a bit with probability 0.144, so all of 20 tables of
# 12 bits miss it in 3 of 100 cases, (1 - 0.856**12)**20. For 1e9 vectors take 60
# tables of 20 bits: buckets keep their size and the recall. That holds for vectors about
# the origin; with a common mean centred pairs lie further apart, see ``fitted``.
TABLES, TABLE_BITS = 20, 12
THRESHOLD = 0.9
# Share of the pairs at the threshold that must meet in a bucket, in the measurement at
# fitting. Below it tables are added, up to so many times those asked for, then narrowed.
RECALL = 0.95
MORE_TABLES = 4
MEASURED_PAIRS = 2_000
BLOCK = 256


class Quantiser:
    """Rotations that turn centred vectors into balanced bits (Gong and Lazebnik, 2011).

    Vectors are projected on principal directions; a rotation is then improved by
    turns: bits from the rotated vectors, rotation from the bits. When vectors have
    fewer dimensions than bits are asked for, several rotations from other starts
    share the work.
    """

    def __init__(self, sample: np.ndarray, bits: int, rounds: int = 30):
        self.mean = sample.mean(0)
        centred = sample - self.mean
        _, directions = np.linalg.eigh(centred.T @ centred)
        directions = directions[:, ::-1][:, :bits]
        base = centred @ directions
        parts, left, seed = [], bits, 0
        while left > 0:
            k = min(left, base.shape[1])
            turn = np.random.default_rng(seed).normal(size=(base.shape[1],) * 2)
            turn = np.linalg.qr(turn)[0]
            for _ in range(rounds):
                u, _, v = np.linalg.svd(np.sign(base @ turn).T @ base)
                turn = (u @ v).T
            parts.append(directions @ turn[:, :k])
            left, seed = left - k, seed + 1
        self.matrix = np.concatenate(parts, axis=1)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Bits of each vector, packed eight to a byte."""
        return np.packbits((vectors - self.mean) @ self.matrix > 0, axis=1)


def pairs_at(sample: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at cosine ``threshold``, made from the sample in two ways.

    The second vector is the first one turned about the sample's mean towards another
    vector of the sample, or the first one with noise of no direction.
    """
    rng = np.random.default_rng(11)
    x = sample[rng.integers(len(sample), size=MEASURED_PAIRS)]
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    length = np.sqrt((noise**2).sum(1, keepdims=True))
    even = length[:, 0] > 1e-9
    y = threshold * x[even] + np.sqrt(1 - threshold**2) * noise[even] / length[even]
    found = [(x[even], y)]

    mean = sample.mean(0)
    a, b = x - mean, sample[rng.integers(len(sample), size=len(x))] - mean
    size = np.sqrt((a**2).sum(1, keepdims=True))
    b -= (b * a).sum(1, keepdims=True) / np.maximum(size, 1e-9) ** 2 * a
    length = np.sqrt((b**2).sum(1, keepdims=True))
    turns = (size[:, 0] > 1e-6) & (length[:, 0] > 1e-6)
    x, a, b = x[turns], a[turns], (b * size / np.maximum(length, 1e-9))[turns]

    def turned(angle: np.ndarray) -> np.ndarray:
        out = mean + np.cos(angle)[:, None] * a + np.sin(angle)[:, None] * b
        return out / np.maximum(np.sqrt((out**2).sum(1, keepdims=True)), 1e-9)

    # Half a turn at most: where the mean is longer than all the rest, no pair is as far
    # apart as the threshold, and the pair furthest apart is taken.
    low, high = np.zeros(len(x)), np.full(len(x), np.pi)
    for _ in range(40):
        middle = (low + high) / 2
        near = (turned(middle) * x).sum(1) >= threshold
        low, high = np.where(near, middle, low), np.where(near, high, middle)
    return [p for p in (*found, (x, turned(low))) if len(p[0])]


def _differing(model: Quantiser, pairs: tuple[np.ndarray, np.ndarray], bits: int) -> np.ndarray:
    x, y = (np.unpackbits(model.codes(v), axis=1)[:, :bits] for v in pairs)
    return x != y


def fitted(sample: np.ndarray, threshold: float, tables: int, table_bits: int) -> tuple[Quantiser, int, int, int]:
    """Quantiser, tables, bits of a table, and the most bits in which a pair is compared.

    ``tables`` and ``table_bits`` hold when at least ``RECALL`` of the pairs at the
    threshold meet in a bucket. Else there are more tables, and when that does not
    suffice narrower ones, so that recall costs comparisons and not pairs. The last
    number is five standard deviations beyond the mean of the differing bits.
    """
    pairs = pairs_at(sample, threshold)
    most = MORE_TABLES * tables
    while True:
        model = Quantiser(sample, tables * table_bits)
        apart = [_differing(model, p, tables * table_bits) for p in pairs]
        met = [~d.reshape(len(d), tables, table_bits).any(2) for d in apart]
        if all(m.any(1).mean() >= RECALL for m in met) or table_bits == 1:
            break
        if tables < most:
            tables = min(most, tables + -(-tables // 2))
        else:
            table_bits -= 1
    counts = [d.sum(1) for d in apart]
    limit = max((int(np.ceil(c.mean() + 5 * c.std())) for c in counts), default=tables * table_bits)
    return model, tables, table_bits, limit


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as unit rows in double precision, filled up or cut to ``width``."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column.to_pylist()):
        whole = np.array(v, float)
        whole = whole / np.abs(whole).max()
        whole /= np.sqrt(whole @ whole)
        out[i, : len(v)] = whole[:width]
    return out


def _encoder(model: Quantiser, tables: int, table_bits: int):
    shift = np.arange(table_bits - 1, -1, -1)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = model.codes(_rows(batch.column(1), len(model.mean)))
            bits = np.unpackbits(codes, axis=1)[:, : tables * table_bits]
            value = (bits.reshape(-1, tables, table_bits).astype(np.int64) << shift).sum(2)
            size = np.array(batch.column(2).to_pylist(), np.int64)
            # Vectors of unlike length meet in no bucket.
            bucket = ((size[:, None] * tables + np.arange(tables)) << table_bits) + value
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(list(bucket), pa.list_(pa.int64())),
                ],
                ["id", "code", "buckets"],
            )

    return encode


def _candidates(table: pa.Table, most_bits: int) -> np.ndarray:
    """Pairs of a cell to rerank: same bucket, no bucket of an earlier table in common,
    few differing bits. Row number of the smaller place first."""
    side, bucket = table["side"].to_numpy(), table["bucket"].to_numpy()
    codes = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(len(side), -1)
    pairs = []
    single = side.min() == side.max()
    right = np.arange(len(side)) if single else np.flatnonzero(side == 1)
    left = right if single else np.flatnonzero(side == 0)
    for x in left.tolist():
        ys = right[bucket[right] == bucket[x]]
        if single:
            ys = ys[ys > x]
        if len(ys):
            apart = np.bitwise_count(codes[ys] ^ codes[x]).sum(1, dtype=np.int64)
            ys = ys[apart <= most_bits]
            pairs.append(np.stack([np.full(len(ys), x), ys], axis=1))
    return np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)


def _first_meeting(table: pa.Table, pairs: np.ndarray, tables: int, table_bits: int) -> np.ndarray:
    """The pairs whose codes agree in no table before the one of their bucket."""
    bits = np.unpackbits(
        np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(len(table), -1), axis=1
    )[:, : tables * table_bits].reshape(-1, tables, table_bits)
    at = (table["bucket"].to_numpy() >> table_bits) % tables
    keep = np.zeros(len(pairs), bool)
    for start in range(0, len(pairs), 4096):
        x, y = pairs[start : start + 4096].T
        same = (bits[x] == bits[y]).all(2)
        keep[start : start + 4096] = same.argmax(1) == at[x]
    return pairs[keep]


def _shortlister(tables: int, table_bits: int, most_bits: int):
    def shortlist(table: pa.Table) -> pa.Table:
        """Rows of a cell that have a pair to rerank."""
        pairs = _first_meeting(table, _candidates(table, most_bits), tables, table_bits)
        return table.take(pa.array(np.unique(pairs), pa.int64()))

    return shortlist


def _reranker(tables: int, table_bits: int, most_bits: int, threshold: float):
    def rerank(table: pa.Table) -> pa.Table:
        """Links found in a cell: how many each vector gains, and edges that span them."""
        pairs = _first_meeting(table, _candidates(table, most_bits), tables, table_bits)
        lists = table["embedding"].to_pylist()
        unit = _rows(table["embedding"], max(map(len, lists), default=1))
        keep = np.zeros(len(pairs), bool)
        for start in range(0, len(pairs), 8192):
            x, y = pairs[start : start + 8192].T
            keep[start : start + 8192] = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
        pairs = pairs[keep]
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        gain = np.zeros(len(ids), np.int64)
        np.add.at(gain, pairs[:, 0], copies[pairs[:, 1]])
        np.add.at(gain, pairs[:, 1], copies[pairs[:, 0]])
        parent = list(range(len(ids)))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        root = np.arange(len(ids))
        for x, y in pairs.tolist():
            a, b = find(x), find(y)
            if a != b:
                parent[a] = b
                root[a] = b
        has = np.flatnonzero(gain)
        return pa.table(
            {
                "id": pa.array(ids[has], pa.int64()),
                "other": pa.array(ids[root[has]], pa.int64()),
                "gain": pa.array(gain[has], pa.int64()),
            }
        )

    return rerank


def linked_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    table_bits: int = TABLE_BITS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors(vec_id, embedding)``.

    Equal vectors form a class with a count. The classes' codes are cut into
    ``tables`` substrings, or more and narrower ones where ``fitted`` needs them; classes that agree in a substring meet in its bucket.
    Buckets are laid out in blocks and compared block by block: codes first, then,
    for those with a close code, the vectors in double precision. A pair counts in the
    first table in which it meets. A block pair returns counts and a spanning forest,
    so no pair of a hot bucket becomes a row. Every vector is indexed; the rotation
    is learnt from at most ``FIT_VECTORS`` of them.

    Vectors that are null, empty, zero, or hold null or non-finite components, and
    rows without an id, link with nothing; so do vectors of unlike length. Rows that
    repeat an id count as vectors of their own. Other columns are not read.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    whole = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = scratch.keep(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("embedding")), "rows"
    )
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    usable = rows.filter(
        F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )
    classes = scratch.keep(
        usable.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "classes"
    )
    by_hash = classes.orderBy(F.xxhash64("id", "embedding"), "id").limit(FIT_VECTORS)
    sample = [r.embedding for r in by_hash.select("embedding").collect()]
    width = max(map(len, sample), default=1)
    unit = _rows(pa.array(sample, pa.list_(pa.float64())), width) if sample else np.eye(1)
    model, tables, table_bits, most_bits = fitted(unit, threshold, tables, table_bits)

    codes = classes.select("id", "embedding", F.size("embedding").alias("size")).mapInArrow(
        _encoder(model, tables, table_bits), "id long, code binary, buckets array<long>"
    )
    entries = codes.select(F.explode("buckets").alias("bucket"), "id", "code")
    placed = scratch.keep(
        ranked(scratch, entries, "bucket", "id").select(
            "bucket", "id", "code", F.floor(F.col("_rank") / BLOCK).alias("block")
        ),
        "placed",
    )
    spans = scratch.keep(
        placed.groupBy("bucket")
        .agg(F.min("block").alias("low"), F.max("block").alias("high"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "spans",
    )
    cells = (
        placed.join(spans, "bucket")
        .select("bucket", "id", "code", "block", F.explode(F.sequence("low", "high")).alias("other"))
        .select(
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"),
            "bucket",
            "id",
            "code",
        )
    )
    close = scratch.keep(
        cells.groupBy("i", "j").applyInArrow(_shortlister(tables, table_bits, most_bits), cells.schema), "close"
    )
    found = scratch.keep(
        close.join(classes, "id")
        .groupBy("i", "j")
        .applyInArrow(_reranker(tables, table_bits, most_bits, threshold), "id long, other long, gain long"),
        "found",
    )
    gains = found.groupBy("id").agg(F.sum("gain").alias("gain"))
    parts = connected_components(scratch, found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    links = scratch.keep(
        classes.join(gains, "id", "left")
        .join(parts, "id", "left")
        .select(
            "embedding",
            (F.col("copies") - 1 + F.coalesce("gain", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        ),
        "links",
    )
    scratch.drop_all_but(rows, links)
    linked = usable.join(links, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter(
        F.col("vec_id").isNull() | ~F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    ).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
