"""Vector links against all pairs; archives against the pages they were written from."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest

from aeropunct.llm import iterative_quantisation as itq
from aeropunct.llm import warc
from aeropunct.llm.common import Scratch

VECTORS = "vec_id long, embedding array<float>, n_links string"
PAGES = "page_id long, url string, html string, payload_bytes string"


def vector_rows():
    """Random vectors, tight groups, and pairs all around the threshold."""
    rng = np.random.default_rng(7)
    vectors = list(rng.normal(size=(300, 24)))
    centre = rng.normal(size=24)
    vectors += [centre + rng.normal(size=24) * 0.1 for _ in range(90)]
    for cosine in np.linspace(0.86, 0.96, 120):
        a, b = rng.normal(size=(2, 24))
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        vectors += [3 * a, 0.5 * (cosine * a + np.sqrt(1 - cosine**2) * b)]
    vectors += [vectors[5]] * 7 + [vectors[6] * 2]
    rows = [(i, [float(x) for x in np.float32(v)], "x") for i, v in enumerate(vectors)]
    inf, nan = float("inf"), float("nan")
    odd = [None, [], [0.0] * 24, [inf] + [1.0] * 23, [nan] + [1.0] * 23, [None] + [1.0] * 23, rows[3][1] + [0.0]]
    rows += [(2000 + i, v, "x") for i, v in enumerate(odd)]
    return rows + [(9, rows[9][1], "x"), (None, rows[9][1], "x")]


def brute(rows, threshold=0.9):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, float)
        return a / np.linalg.norm(a)

    units = [unit(v) if i is not None else None for i, v, _ in rows]
    parent = {i: i for i, _, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for x, a in enumerate(units):
        for y, b in enumerate(units[:x]):
            if a is not None and b is not None and len(a) == len(b) and a @ b >= threshold:
                links[x] += 1
                links[y] += 1
                low, high = sorted((find(rows[x][0]), find(rows[y][0])))
                parent[high] = low
    return links, {i: find(i) for i in parent}


@pytest.mark.parametrize("block", [256, 16])
def test_links_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(itq, "BLOCK", block)
    rows = vector_rows()
    want, component = brute(rows)
    got = itq.linked_vectors(spark.createDataFrame(rows, VECTORS).repartition(3)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for (i, _, _), n in zip(rows, want, strict=True):
        by_id.setdefault(i, []).append(n)
    found, total, off = 0, sum(want), 0
    for r in got:
        most = max(by_id[r.vec_id])
        assert r.n_links <= most
        found += r.n_links
        off += r.component_id != component.get(r.vec_id)
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)
    assert found >= 0.99 * total
    assert off <= 6


def test_odd_vectors_alone(spark):
    rows = [r for r in vector_rows() if r[0] is None or r[0] >= 2000]
    got = itq.linked_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert {(r.n_links, r.component_id == r.vec_id or r.vec_id is None, r.kept) for r in got} == {(0, True, True)}
    assert itq.linked_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def shifted_pairs(common, pairs=150, width=64):
    """Pairs at cosines of 0.9 to 0.93 among vectors whose mean cosine is ``common``."""
    rng = np.random.default_rng(3)
    mean = np.zeros(width)
    mean[0] = np.sqrt(common)

    def directions(n):
        v = rng.normal(size=(n, width))
        v[:, 0] = 0
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    a, b = directions(pairs), directions(pairs)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = (rng.uniform(0.9005, 0.93, size=(pairs, 1)) - common) / (1 - common)
    near = near * a + np.sqrt(1 - near**2) * b
    rest = np.sqrt(1 - common)
    return np.concatenate([mean + rest * a, mean + rest * near, mean + rest * directions(1500)])


@pytest.mark.parametrize("common", [0.0, 0.5, 0.64])
def test_recall_with_a_common_mean(spark, common):
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(shifted_pairs(common))]
    got = itq.linked_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert sum(r.n_links for r in got if r.vec_id < 300) >= 0.9 * 300


def test_pairs_of_long_codes_are_compared(spark):
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(shifted_pairs(0.0, 60)[:400])]
    got = itq.linked_vectors(spark.createDataFrame(rows, VECTORS), tables=60, table_bits=20).collect()
    assert sum(r.n_links for r in got) >= 0.9 * 120


def test_bits_are_balanced():
    sample = np.random.default_rng(1).normal(size=(4000, 24)) @ np.diag(np.linspace(1, 3, 24))
    bits = np.unpackbits(itq.Quantiser(sample, 48).codes(sample), axis=1)
    assert bits.shape == (4000, 48)
    assert np.abs(bits.mean(0) - 0.5).max() < 0.05


def page_rows():
    rnd = random.Random(3)
    htmls = ["<p>é日本</p>\r\n\r\nx", "", None, "plain", "long " * 40_000, "WARC/1.1\r\nWARC-Type: x\r\n\r\n"]
    urls = ["http://a/b?c=1", None, "", "http://x/\r\nInjected: y", "http://ü/ä: b"]
    rows = [(i, rnd.choice(urls), rnd.choice(htmls), "x") for i in range(3, 90)]
    rows += [(100 + i, "u", f"own {i}", "x") for i in range(40)]
    rows += [(3, "again", rows[0][2], "x"), (None, "n", "plain", "x"), (None, None, "no id here", "x")]
    return rows


def expected(rows):
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        least = first.get(html or "")
        again = least is not None and (i is None or i > least)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if again else "response", least if again else None))
    return sorted(out, key=repr)


def test_pages_come_back(spark):
    rows = page_rows()
    got = warc.archived_pages(spark, spark.createDataFrame(rows, PAGES).repartition(3)).drop("url")
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)
    assert warc.archived_pages(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_selected_records_only(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_GAP", 10)
    rows = [(2**60 + i, f"http://h/{i}", f"page {i} " * 50, "x") for i in range(60)]
    pages = spark.createDataFrame(rows, PAGES).select("page_id", "url", "html")
    index = warc.write_archives(pages, Scratch(spark, "test"))
    assert index.filter("offset >= 0 AND length > 0").count() == 60
    some = index.filter("url LIKE '%7'")
    got = {(r.page_id, r.url) for r in warc.read_records(some).collect()}
    assert got == {(2**60 + i, f"http://h/{i}") for i in range(60) if i % 10 == 7}


def test_record_layout():
    data = warc.zlib.decompress(warc.record(4, "http://h/", b"body", "D", None), 31)
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"body\r\n\r\n")
    fields, http, payload = warc.parse(data)
    assert payload == b"body" and fields["WARC-Target-URI"] == "http://h/" and b"Content-Length: 4" in http
    fields, _, payload = warc.parse(warc.zlib.decompress(warc.record(9, None, b"body", "D", 4), 31))
    assert payload == b"" and fields["WARC-Refers-To"] == "<urn:page:4>" and "WARC-Target-URI" not in fields
