"""Near-duplicates against comparing all pairs of shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from aeropunct.llm import minhash
from aeropunct.llm.common import Scratch
from aeropunct.llm.components import connected_components, ranked

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, component_id string"


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3)))


def brute(rows):
    sets = [(i, shingles(t)) for i, t, _ in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    out = []
    for i, a in sets:
        component = None if i is None else find(i)
        out.append((i, len(a), component, i is None or component == i))
    return sorted(out, key=repr)


def corpus():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    make = lambda n: rnd.choices(vocabulary, k=n)
    texts = [" ".join(make(rnd.choice([1, 2, 3, 4, 5, 30, 90]))) for _ in range(60)]
    for changes in (1, 2, 3, 4):  # copies of one text at similarities around the limit
        base = make(120)
        for _ in range(25):
            words = list(base)
            for _ in range(rnd.randint(0, changes)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
    drifting = make(100)
    for _ in range(30):  # a chain: neighbours link, the ends do not
        drifting = [*drifting[4:], *make(4)]
        texts.append(" ".join(drifting))
    texts += [texts[3]] * 40 + [texts[70].upper()] * 5 + ["", None, " \n", "a b c", "A  b\tc", "a b", "é É"]
    rnd.shuffle(texts)
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return rows + [(None, texts[0], "x"), (None, None, "x"), (5, texts[5], "x"), (6, texts[80], "x")]


@pytest.mark.parametrize("block", [256, 7])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus()
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), shingle_words=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text(spark):
    words = [f"w{i * i % 9973}x{i % 13}" for i in range(100_000)]
    rows = [(1, " ".join(words), ""), (2, " ".join(words[500:]), ""), (3, " ".join(words[::-1]), "")]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_signature_values_are_unbiased():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**64, 900, np.uint64, endpoint=False)
    a, b = pool[:600], pool[300:]
    agree = np.mean([np.mean(minhash.min_max(a ^ s) == minhash.min_max(b ^ s)) for s in pool[:30]])
    assert abs(agree - 1 / 3) < 0.03


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(90)] + [(2000, 2001 + i) for i in range(200)]
    parent = {x: x for pair in links for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    frame = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, connected_components(Scratch(spark, "test"), frame).collect()))
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def test_ranks(spark):
    rnd = random.Random(1)
    values = [rnd.randrange(50) for _ in range(500)]
    frame = spark.createDataFrame(list(enumerate(values)), "k long, v long")
    got = ranked(Scratch(spark, "test"), frame, "v", "k").collect()
    order = sorted(range(500), key=lambda k: (values[k], k))
    assert {r.k: r._rank for r in got} == {k: at for at, k in enumerate(order)}
