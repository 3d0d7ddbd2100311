"""Mixing and personal data: base spans by regular expressions, the mix by its SQL."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from aeropunct.llm import pareto_mix, weak_pii
from aeropunct.llm.common import Scratch

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DOCS = "doc_id long, text string, source string, spans string, target string"


def luhn(match):
    digits = [int(c) for c in match if c.isdigit()][::-1]
    doubled = [2 * d - 9 if d > 4 else 2 * d for d in digits]
    return sum(doubled[i] if i % 2 else d for i, d in enumerate(digits)) % 10 == 0


def holds(kind, match):
    n = len(re.sub("[^0-9]", "", match))
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 16 <= n <= 19 and luhn(match)
    return kind == "email" or 8 <= n <= 15


def base(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if holds(kind, m.group())
    ]


def card(prefix, size=16):
    return next(c for d in "0123456789" if luhn(c := prefix + "0" * (size - 1 - len(prefix)) + d))


def texts():
    rnd = random.Random(6)
    made = [
        "a@b.c_x@d.e a@b.c@d.e x@y @z.w q@r. q@r..s é@b.co 🙂 me@x-y.museum",
        "1.2.3.4.5.6.7.8.9 256.1.1.1 01.002.0003.0255 1.2.3 .1.2.3.4. ٣.1.2.3.4",
        f"{card('4')} {card('5')}-1 x{card('37', 17)}y {card('4')[:4]}-{card('4')[4:]} {card('6', 19)}",
        "1" * 40 + " 4-2 4 - 4 1234 5678 9012 3456 " + "0" * 16,
        "+1 (743) 555-3824, +49-30-1234 +1234567 +12345678 ++123456789 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
        "", None, " \n", "no digits here",
        "9" * 120_000, "a." * 60_000 + "@b.c", "x@" + "a." * 60_000 + "z", "1 " * 50_000, "1.1." * 20_000,
    ]
    alphabet = "12345@.+- ()axé\n"
    made += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80))) for _ in range(600)]
    return made


@pytest.fixture(scope="module")
def rows():
    made = [(i, t, "s", "x", "y") for i, t in enumerate(texts())]
    return made + [(2, made[2][1], "s", "x", "y"), (None, "me@x.com", "s", "x", "y")]


def test_base_spans(spark, rows):
    got = weak_pii.personal_data(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
    want = {}
    for doc_id, text, *_ in rows:
        spans = base(text)
        counts = tuple(sum(s.startswith(k) for s in spans) for k in PATTERNS)
        want[doc_id] = (counts, hashlib.sha256(",".join(spans).encode()).hexdigest(), set(spans))
    assert len(got) == len(rows)
    for r in got:
        counts, digest, spans = want[r.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == counts, r.doc_id
        assert r.base_sha256 == digest
        assert spans <= set(r.spans.split(","))


def test_method_adds_spans(spark):
    rnd = random.Random(2)
    number = lambda: f"{rnd.randint(200, 989)}) 555-{rnd.randint(1000, 9999)}"
    docs = [(i, f"the words go call +1 ({number()}. end", "s", "x", "y") for i in range(200)]
    docs += [(200 + i, f"the words go call ({number()}. end", "s", "x", "y") for i in range(5)]
    docs += [(300 + i, f"order token {4 * 10**15 + 7 * i} sha=1.2.{i}.999 end", "s", "x", "y") for i in range(99)]
    got = {r.doc_id: r for r in weak_pii.personal_data(spark.createDataFrame(docs, DOCS)).collect()}
    assert all(got[i].n_phone == 0 and got[i].spans.startswith("phone:18:32") for i in range(200, 205))
    for i in range(300, 399):
        assert got[i].spans == ",".join(base(docs[i - 95][1]))
    empty = spark.createDataFrame([], DOCS)
    assert weak_pii.personal_data(empty).count() == 0


def test_reliabilities_tell_good_labelers(spark):
    rnd = random.Random(8)
    votes = []
    for _ in range(4000):
        truth = 1 if rnd.random() < 0.4 else -1
        noisy = lambda p, t=truth: t if rnd.random() < p else -t
        votes.append(("ip", [noisy(0.95), noisy(0.9), noisy(0.55), noisy(0.8), 0], 1))
    frame = spark.createDataFrame(votes, "kind string, votes array<int>, n long")
    model = weak_pii.reliabilities(frame).first().model
    right = [model.yes[3 * k + 2] for k in range(4)]
    assert [abs(a - b) < 0.05 for a, b in zip(right, (0.95, 0.9, 0.55, 0.8), strict=True)] == [True] * 4
    assert abs(model.prior - 0.4) < 0.05


def mix_rows():
    rnd = random.Random(9)
    word = lambda n: " ".join(rnd.choice(["a", "bé", "cc c"]) for _ in range(n))
    sources = ["b", "B", "ä", None, "", "𐀀", "￮", "a"]
    made = [
        (i, word(rnd.choice([0, 1, 30, 49, 50, 200])), rnd.choice(sources[:3] * 6 + sources), "x", "y")
        for i in range(1500)
    ]
    made += [(5000, word(20_000), "huge", "x", "y"), (5001, "", "none", "x", "y"), (5002, None, "none", "x", "y")]
    return made + [(None, "a b", "b", "x", "y"), made[7], made[7]]


def test_mix_matches_its_sql(spark):
    from compare import difference

    docs = spark.createDataFrame(mix_rows(), DOCS)
    got = pareto_mix.mixed(docs.repartition(5)).toPandas()
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    want = con.sql(pareto_mix.ORACLE).df().astype({"doc_id": float})
    assert difference(got.astype({"doc_id": float}), want) is None


def test_mix_targets(spark):
    got = pareto_mix.mixed(spark.createDataFrame(mix_rows(), DOCS)).toPandas()
    total = got["size"].sum()
    by_source = got.groupby("source", dropna=False).agg(
        size=("size", "sum"), largest=("size", "max"), target=("target", "first"), taken=("taken", "sum")
    )
    assert abs(by_source.target.sum() - 1.5 * total) < 1e-3
    assert (by_source.target <= 2 * by_source["size"] + 1e-6).all()
    assert ((by_source.taken - by_source.target).abs() <= by_source.largest * 2).all()
    assert (got.taken <= 2 * got["size"]).all()
    # The weights hold between sources that no limit cut.
    order = sorted(by_source.index, key=lambda s: (s is None or s != s, s if isinstance(s, str) else ""))
    level = {
        round(by_source.target[s] / pareto_mix.WEIGHTS[k % 3], 3)
        for k, s in enumerate(order)
        if isinstance(s, str) and by_source.target[s] < 2 * by_source["size"][s] - 1e-6
    }
    assert len(level) <= 1


@pytest.mark.parametrize("intervals", [pareto_mix.INTERVALS, 4])
def test_one_row_repeated_a_thousand_times(spark, monkeypatch, intervals):
    """The target is met within a document, also where it ends among equal rows."""
    from compare import difference

    monkeypatch.setattr(pareto_mix, "INTERVALS", intervals)
    for copied in range(2):
        rows = [(i, "w " * 100, "a", "x", "y") for i in range(1000)]
        rows += [(5000 + copied, "w " * 100, "a", "x", "y")] * 1000
        rows += [(9000 + i, "w " * 10, "b", "x", "y") for i in range(300)] + [(9999, "w " * 10, "b", "x", "y")] * 500
        docs = spark.createDataFrame(rows, DOCS).repartition(6)
        got = pareto_mix.mixed(docs).toPandas()
        by_source = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
        assert ((by_source.taken - by_source.target).abs() <= by_source.most).all()
        con = duckdb.connect()
        con.register("documents", docs.select("doc_id", "text", "source").toPandas())
        assert difference(got, con.sql(pareto_mix.ORACLE).df()) is None


def test_likelier_documents_are_taken_more(spark):
    rows = [(i, "w " * (60 if i % 2 else 10), s, "x", "y") for i in range(4000) for s in ("a", "b")]
    got = pareto_mix.mixed(spark.createDataFrame(rows, DOCS)).toPandas()
    b = got[got.source == "b"]
    assert b.copies[b["size"] == 60].mean() > 1.5 * b.copies[b["size"] == 10].mean()


def test_mix_odd_tables(spark):
    assert pareto_mix.mixed(spark.createDataFrame([], DOCS)).count() == 0
    none = pareto_mix.mixed(spark.createDataFrame([(1, None, None, "x", "y")], DOCS)).collect()
    assert [(r.doc_id, r.size, r.target, r.taken) for r in none] == [(1, 0, 0.0, 0)]


def test_copies_of_whole_rows(spark):
    docs = spark.createDataFrame(mix_rows(), DOCS)
    mix, _ = pareto_mix.plan_mix(docs, Scratch(spark, "test"))
    rows = mix.copies(docs)
    assert set(docs.columns) <= set(rows.columns)
    got = sorted((r.doc_id or -1, r._copies) for r in rows.collect())
    assert not [c for c in rows.columns if c in ("_own", "_upto", "_digest")]
    assert got == sorted((r.doc_id or -1, r.copies) for r in pareto_mix.mixed(docs).collect())


