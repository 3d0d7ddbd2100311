"""Suffix-array repetition against counting every word window."""

from __future__ import annotations

import random
import re

from aeropunct.llm.repetition import repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least=6, share=0.4, most=100):
    words = WORD.findall(text or "")
    n = len(words)

    def repeated(k):
        seen = {}
        for i in range(n - k + 1):
            seen.setdefault(tuple(words[i : i + k]), []).append(i)
        starts = [i for places in seen.values() if len(places) > 1 for i in places]
        return len({j for i in starts for j in range(i, i + k)})

    longest = max([k for k in range(1, n) if repeated(k)], default=0)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    again = repeated(3)
    failed = n < 50 or 100 * again > 50 * n
    over = repeated(least) > share * n or longest > most
    return (
        n,
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        again,
        repeated(least),
        longest,
        failed,
        not failed and not over,
    )


def texts():
    rnd = random.Random(5)
    vocabulary = ["a", "b", "é|", "日本", "dd#", "e"]
    for size in (0, 1, 2, 3, 7, 60, 120):
        for spread in (1, 2, 6):
            words = [rnd.choice(vocabulary[:spread]) for _ in range(size)]
            yield "".join(w + rnd.choice([" ", "\n", "\t ", "\n\n"]) for w in words)
    passage = " ".join(f"w{i}" for i in range(30))
    yield f"{passage} x y z {passage} " + " ".join(f"v{i}" for i in range(90))
    yield f"{passage} {passage}\n{passage} " + " ".join(f"v{i}" for i in range(90))
    long_passage = " ".join(f"w{i}" for i in range(120))
    yield f"{long_passage} " + " ".join(f"v{i}" for i in range(500)) + f" {long_passage}"
    yield " ".join(f"w{i}" for i in range(70))
    yield "\x0b\x0c \x1c a\x85b\xa0c"
    yield None


def test_matches_brute_force(spark):
    rows = [(i, t, 9) for i, t in enumerate(texts())] + [(3, "x y", 9), (3, "x y", 9), (None, "q", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = sorted(map(tuple, repetition(docs).collect()), key=repr)
    want = sorted(((i, *brute(t)) for i, t, _ in rows), key=repr)
    assert got == want


def test_very_long_text(spark):
    text = "again and " * 200_000
    row = repetition(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_covered, row.longest_repeat) == (400_000, 400_000, 399_998)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repetition(docs).count() == 0
