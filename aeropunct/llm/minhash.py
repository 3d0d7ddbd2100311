"""Near-duplicate texts by min-max hashing, every link confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm import arrays
from aeropunct.llm.common import Scratch
from aeropunct.llm.components import connected_components, ranked

# A pair at the threshold of 0.8 is missed by all 40 bands of 6 values in 5 of a
# million cases, (1 - 0.8**6)**40; 120 permutations give the 240 values.
BANDS, BAND_VALUES = 40, 6
PERMUTATIONS = BANDS * BAND_VALUES // 2
SHINGLE_WORDS, THRESHOLD_PERCENT = 5, 80
# Documents of a block when the documents of a family are compared with each other.
BLOCK = 256

_rng = np.random.default_rng(40_961)
_FACTORS = _rng.integers(0, 2**64, PERMUTATIONS, np.uint64, endpoint=False) | np.uint64(1)
_SHIFTS = _rng.integers(0, 2**64, PERMUTATIONS, np.uint64, endpoint=False)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text, A-Z lower-cased.

    A text of fewer than ``k`` words has its whole sequence as the only one.
    """
    data, offsets = arrays.utf8(column)
    data = arrays.lower_ascii(data)
    starts, ends, doc = arrays.words(data, offsets)
    word = arrays.hashes(data, starts, ends)
    window, owner = arrays.window_hashes(word, doc, k)
    n = len(offsets) - 1
    cuts, word_cuts = arrays.bounds(owner, n), arrays.bounds(doc, n)
    sets = []
    for i in range(n):
        own = window[cuts[i] : cuts[i + 1]]
        words = word[word_cuts[i] : word_cuts[i + 1]]
        if len(words) and not len(own):
            own = np.array([len(words)], np.uint64)
            for h in words:
                own = arrays.mix(own * np.uint64(0x2545F4914F6CDD1D) + h)
        sets.append(np.unique(own))
    return sets


def min_max(shingles: np.ndarray) -> np.ndarray:
    """The minimum and the maximum of the set under each permutation.

    Both ends of one permutation agree between two sets with the probability of
    their Jaccard similarity, so ``PERMUTATIONS`` evaluations give twice as many values.
    """
    low = np.full(PERMUTATIONS, 2**64 - 1, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * _FACTORS + _SHIFTS
        np.minimum(low, part.min(0), out=low)
        np.maximum(high, part.max(0), out=high)
    return np.concatenate([low, high])


def bands(shingles: np.ndarray) -> np.ndarray:
    """One hash for each band of the signature; the band's number is part of it."""
    values = min_max(shingles).reshape(BANDS, BAND_VALUES)
    out = arrays.mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for k in range(BAND_VALUES):
        out = arrays.mix(out * np.uint64(31) + values[:, k])
    return out


def _signer(k: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.chunks(batches):
            sets = shingle_sets(batch.column(1), k)
            keys = [
                [int(np.sum(arrays.mix(s ^ np.uint64(c)), dtype=np.uint64)) for s in sets]
                for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)
            ]
            signed = [bands(s).view(np.int64) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in keys),
                    pa.array(signed, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "key_a", "key_b", "bands"],
            )

    return sign


def _set_reader(k: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.chunks(batches):
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(1), k)]
            n = pa.array([len(s) for s in sets], pa.int64())
            shingles = pa.array(sets, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), n, shingles], ["id", "n", "shingles"])

    return read


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _linker(percent: int):
    """Compares the documents of two blocks, or of one, and gives the links that join.

    Within a family all pairs are decided exactly, but for those already joined. The
    links returned are fewer than the documents.
    """

    def link(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        ids, family, n = (table[c].to_numpy() for c in ("id", "family", "n"))
        lists = table["shingles"].combine_chunks()
        cut = lists.offsets.to_numpy()
        values = np.unique(lists.values.to_numpy()[cut[0] : cut[-1]], return_inverse=True)[1]
        cut = cut - cut[0]
        owner = np.repeat(np.arange(len(ids)), np.diff(cut))
        by = np.argsort(values, kind="stable")
        first = np.searchsorted(values[by], np.arange(values.max(initial=-1) + 2))
        holders = owner[by]
        groups = np.unique(table["label"].to_numpy(), return_inverse=True)[1]
        leader: dict[int, int] = {}
        parent = [leader.setdefault(g, i) for i, g in enumerate(groups.tolist())]
        single = side.min() == side.max()
        links = []
        for x in np.argsort(n, kind="stable")[::-1].tolist():
            roots = np.array([_find(parent, i) for i in range(len(ids))])
            other = (family == family[x]) & (roots != roots[x])
            other &= (100 * n >= percent * n[x]) & (n <= n[x])
            if not single:
                other &= side != side[x]
            if not other.any():
                continue
            own = values[cut[x] : cut[x + 1]]
            size = first[own + 1] - first[own]
            at = np.repeat(first[own] - np.cumsum(size) + size, size) + np.arange(size.sum())
            shared = np.bincount(holders[at], minlength=len(ids))
            near = other & (100 * shared >= percent * (n + n[x] - shared))
            for y in np.flatnonzero(near).tolist():
                a, b = _find(parent, x), _find(parent, y)
                if a != b:
                    parent[a] = b
                    links.append((ids[x], ids[y]))
        columns = list(zip(*links, strict=True)) or [[], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip("ab", columns, strict=True)})

    return link


def _family_links(
    scratch: Scratch, shared: DataFrame, near: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links between documents of a bucket that the pivots have not joined.

    Buckets whose documents are not all joined connect documents to families. A
    family is laid out in blocks and compared block by block, so no task holds a
    family and no pair becomes a row.
    """
    up = near.select(F.col("a").alias("b"), F.col("b").alias("top"))
    joined = near.join(up, "b", "left").select(
        F.col("a").alias("id"), F.coalesce("top", "b").alias("label")
    )
    joined = scratch.keep(joined, "labels")
    marked = shared.join(joined, "id", "left").withColumn("label", F.coalesce("label", "id"))
    open_buckets = scratch.keep(
        marked.groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low <> high")
        .select("bucket"),
        "open",
    )
    pairs = shared.join(open_buckets, "bucket").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    families = connected_components(scratch, pairs)
    items = (
        families.withColumnRenamed("component", "family")
        .join(joined, "id", "left")
        .withColumn("label", F.coalesce("label", "id"))
        .join(sets.select("id", "n").distinct(), "id")
    )
    placed = scratch.keep(
        ranked(scratch, items, "family", "label", "n", "id").select(
            "id", "family", "label", F.floor(F.col("_rank") / BLOCK).alias("block")
        ),
        "placed",
    )
    spans = placed.groupBy("family").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    cells = (
        spans.select("high", F.explode(F.sequence("low", "high")).alias("i"))
        .select("i", F.explode(F.sequence("i", "high")).alias("j"))
        .distinct()
    )
    marks = placed.groupBy("block").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    left = marks.select(F.col("block").alias("i"), F.col("low").alias("li"), F.col("high").alias("hi"))
    right = marks.select(F.col("block").alias("j"), F.col("low").alias("lj"), F.col("high").alias("hj"))
    # Two blocks whose documents all have the same label hold nothing to decide.
    cells = scratch.keep(
        cells.join(left, "i").join(right, "j").filter("NOT (li = hi AND lj = hj AND li = lj)").select("i", "j"),
        "cells",
    )
    sides = cells.select("i", "j", F.col("i").alias("block"), F.lit(0).alias("side")).unionByName(
        cells.filter("i < j").select("i", "j", F.col("j").alias("block"), F.lit(1).alias("side"))
    )
    rows = placed.join(sets, "id").join(sides, "block")
    return (
        rows.select("i", "j", "side", "id", "family", "label", "n", "shingles")
        .groupBy("i", "j")
        .applyInArrow(_linker(percent), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    threshold_percent: int = THRESHOLD_PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Texts with equal shingle sets form a class, represented by its smallest id. The
    representatives' min-max signatures are banded; a document is compared with the
    smallest id it shares a bucket with, and what stays apart inside a bucket is
    compared block by block. Each comparison uses the full sets. ``component_id`` is
    the smallest id that links reach, and ``kept`` tells whether it is the document's.

    Texts without words and null texts have no shingles and link with nothing. Rows
    that share an id are one node: any of their texts may link, and each keeps its
    own ``n_shingles``. Rows without an id link with nothing, have no component and
    are kept. Other columns are not read. Class joins and pivot joins are plain joins
    of written tables, which adaptive execution splits where a key is hot.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keys = ["n_shingles", "key_a", "key_b"]
    signed = scratch.keep(
        narrow.mapInArrow(
            _signer(shingle_words),
            "doc_id long, n_shingles long, key_a long, key_b long, bands array<long>",
        ),
        "signed",
    )
    usable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = scratch.keep(
        usable.groupBy(*keys)
        .agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
        .filter("rep < last")
        .select(*keys, "rep"),
        "classes",
    )
    members = scratch.keep(
        usable.drop("bands")
        .join(classes, keys, "left")
        .select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")),
        "members",
    )
    entries = (
        usable.join(classes, keys, "left")
        .filter("rep IS NULL OR rep = doc_id")
        .select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("id"))
    )
    pivots = scratch.keep(
        entries.groupBy("bucket")
        .agg(F.min("id").alias("pivot"), F.max("id").alias("last"))
        .filter("pivot < last")
        .select("bucket", "pivot"),
        "pivots",
    )
    shared = scratch.keep(entries.join(pivots, "bucket"), "shared")
    wanted = shared.select(F.col("id").alias("doc_id")).distinct()
    sets = scratch.keep(
        narrow.join(wanted, "doc_id", "left_semi").mapInArrow(
            _set_reader(shingle_words), "id long, n long, shingles array<long>"
        ),
        "sets",
    )
    first = shared.filter("id <> pivot").groupBy("id").agg(F.min("pivot").alias("pivot"))
    other = sets.select(F.col("id").alias("pivot"), F.col("n").alias("m"), F.col("shingles").alias("others"))
    inner = F.size(F.array_intersect("shingles", "others"))
    near = scratch.keep(
        scratch.keep(first, "first")
        .join(sets, "id")
        .join(other, "pivot")
        .filter(100 * F.least("n", "m") >= threshold_percent * F.greatest("n", "m"))
        .filter(100 * inner >= threshold_percent * (F.col("n") + F.col("m") - inner))
        .select(F.col("id").alias("a"), F.col("pivot").alias("b"))
        .distinct(),
        "near",
    )
    rest = _family_links(scratch, shared, near, sets, threshold_percent)
    # An id with several texts ties the classes of these together.
    several = (
        members.groupBy("doc_id")
        .agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        .filter("low < high")
    )
    tied = members.join(several, "doc_id", "left_semi").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")
    )
    found = connected_components(scratch, near.unionByName(rest).unionByName(tied))
    found = scratch.keep(found.select(F.col("id").alias("rep"), "component"), "components")
    scratch.drop_all_but(signed, members, found)
    linked = members.join(found, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    alone = signed.filter("doc_id IS NULL OR n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
