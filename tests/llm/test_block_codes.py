"""Block codes against clustering of every point with every entry, in whole numbers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from aeropunct.llm import block_codes as codes

KINDS = "vec_id long, embedding array<float>, label int, code string, error string"


def plain(rows, entries=64, rounds=2):
    """The definition, point by point in Python integers."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dimension = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dimension]
    width = -(-dimension // 16)
    whole = [[math.floor(256 * float(np.float32(x))) for x in r[1]] + [0] * (16 * width - dimension) for r in kept]
    parts = [[v[p * width : (p + 1) * width] for p in range(16)] for v in whole]
    books = [[row[p] for row in parts[:entries]] for p in range(16)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for row in parts:
                members.setdefault(nearest(row[p], book)[1], []).append(row[p])
            books[p] = [
                [sum(c) // len(c) for c in zip(*members[e], strict=True)] if e in members else c
                for e, c in enumerate(book)
            ]
    out = []
    for r, row in zip(kept, parts, strict=True):
        found = [nearest(row[p], books[p]) for p in range(16)]
        out.append((r[0], r[2], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    totals = {}
    for _, label, _, error in out:
        totals[label] = totals.get(label, 0) + error
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, totals[label], digest) for i, label, c, e in out), key=str)


def vectors(n, dimension, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        vector = [rng.choice([0.0, 0.5, -0.25]) if rng.random() < 0.3 else rng.gauss(0, 0.4) for _ in range(dimension)]
        rows.append((i, vector, rng.choice([1, 2, None]), "x", "y"))
    inf, nan = float("inf"), float("nan")
    odd = [None, [], [inf] * dimension, [nan] * dimension, [None] + [1.0] * (dimension - 1), [1.0] * (dimension + 16)]
    rows += [(5000 + k, v, 1, "x", "y") for k, v in enumerate(odd)]
    return rows + [rows[3]] * 80 + [(None, rows[4][1], None, "x", "y"), (7, rows[9][1], 2, "x", "y")]


@pytest.mark.parametrize(("n", "dimension"), [(300, 32), (20, 20), (150, 8), (400, 64)])
def test_against_every_point_with_every_entry(spark, monkeypatch, n, dimension):
    rows = vectors(n, dimension)
    table = spark.createDataFrame(rows, KINDS).repartition(3)
    got = codes.block_codes(table).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_empty_table(spark):
    table = spark.createDataFrame([], KINDS)
    assert codes.block_codes(table).count() == 0
    assert codes.block_codes(spark.createDataFrame([(1, None, 1, "x", "y")], KINDS)).count() == 0


def test_large_components_are_held(spark):
    rows = [(i, [1e30 if i % 3 else -1e30, *([float(i)] * 15)], 1, "x", "y") for i in range(90)]
    got = codes.block_codes(spark.createDataFrame(rows, KINDS)).collect()
    assert len(got) == 90 and all(r.error >= 0 for r in got)


@pytest.mark.parametrize("width", [1, 2, 4, 9, 40, 70])
def test_short_lists_lose_no_nearest_entry(width):
    rng = np.random.default_rng(width)
    points = np.concatenate([rng.integers(-300, 300, (500, width)), rng.integers(-9, 9, (500, width))])
    entries = points[rng.integers(0, 1000, 64)]
    blocks = codes.Blocks(points)
    chosen, distance, settled = codes.nearest_entries(blocks, entries, errors=True)
    squares = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    want = squares.argmin(axis=1)[blocks.order]
    assert (chosen.ravel()[:1000] == want).all()
    assert (distance.ravel()[:1000] == squares.min(axis=1)[blocks.order]).all()
    assert codes.short_lists(blocks, entries).sum() < 64 * len(blocks.starts)
    sums, counts = codes.tally(blocks, entries)
    assert (counts == np.bincount(want, minlength=64)).all()
    for e in range(64):
        assert (sums[e] == points[squares.argmin(axis=1) == e].sum(axis=0)).all()


def test_hilbert_neighbours_are_near():
    side = np.arange(16)
    points = np.stack(np.meshgrid(side, side), axis=-1).reshape(-1, 2)
    ordered = points[np.argsort(codes.hilbert_keys(points))]
    steps = np.abs(np.diff(ordered, axis=0)).sum(axis=1)
    assert steps.max() == 1


def test_stored_blocks_come_back():
    points = np.random.default_rng(1).integers(-(1 << 25), 1 << 25, (333, 4))
    blocks = codes.Blocks(points)
    again = codes.Blocks.restored(blocks.stored(), 4)
    for name in codes.Blocks.FIELDS:
        assert (getattr(again, name) == getattr(blocks, name)).all()
