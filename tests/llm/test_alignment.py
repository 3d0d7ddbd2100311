"""Alignment of two tokenizers against a loop over the libraries' tokens."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from conftest import SF_DIR

from aeropunct.llm import token_alignment as align
from aeropunct.llm.queries import BYTE_TOKENIZER, PIECE_MODEL

A, B = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL)
ODD = ["", None, " ", "a▁b", "<s> x", "  two  spaces ", "tab\tx\n\ny", "<|endoftext|> z", "\x00\x01"]
ODD += ["x\n", "\n", "\n\nab\n c", "é　ü  ", " lead", "a\x1cb c", "don't 's x's", "<0x41>", "日本 語", "🙂 x"]


def plain(text):
    """(ids of A, ids of B, links, groups) by the libraries, a token at a time."""
    encoder = align._encoder(A, B)
    if not text:
        return [], [], [], ""
    want = (" " + text).encode()
    a = encoder.a_model.encode(" " + text, add_special_tokens=False).ids
    b = encoder.b_model.encode(text)
    for ids, side in ((a, encoder.a), (b, encoder.b)):
        if b"".join(side.tokens[i] for i in ids) != want:
            return [], [], [], ""
    ends, at = {}, 0
    for k, i in enumerate(a):
        at += len(encoder.a.tokens[i])
        ends[at] = k
    at = from_a = from_b = 0
    links, groups = [], []
    for k, i in enumerate(b):
        at += len(encoder.b.tokens[i])
        if at in ends:
            links.append((a[ends[at]], i))
            left, right = a[from_a : ends[at] + 1], b[from_b : k + 1]
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
            from_a, from_b = ends[at] + 1, k + 1
    return a, b, links, ";".join(groups)


def expected(rows):
    found = [(i, *plain(t)) for i, t in rows]
    counts = Counter(link for row in found for link in row[3])
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (i, len(a), len(b), len(links), groups, len(links),
         sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links))
        for i, a, b, links, groups in found
    ]


def test_against_plain_loop(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    rows += [(None, "no id"), rows[0]]
    given = [(i, t, "clash", 1) for i, t in rows]
    table = spark.createDataFrame(given, "doc_id long, text string, groups string, n_a int")
    want = sorted(expected(rows), key=str)
    whole = align.aligned_tokens(table.repartition(5), A, B).collect()
    assert sorted(map(tuple, whole), key=str) == want
    hashed = align.aligned_tokens(table, A, B, whole_groups=False).collect()
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    want = sorted(((*r[:4], digest(r[4]), *r[5:]) for r in want), key=str)
    assert sorted(map(tuple, hashed), key=str) == want
    assert align.aligned_tokens(table.limit(0), A, B).count() == 0


@pytest.mark.parametrize("words", [3, 40])
def test_words_come_back_after_the_cache_has_aged(monkeypatch, words):
    monkeypatch.setattr(align, "CACHE_WORDS", words)
    encoder = align.Encoder(A, B)
    texts = [f"word{i % 17} other{i} then\n\nmore{i % 5}" for i in range(60)] + ODD
    for at in range(0, len(texts), 4):
        found = align.Alignment(encoder, texts[at : at + 4])
        shown = align._shown(len(encoder.a.tokens), len(encoder.b.tokens))
        assert [g.decode() for g in found.group_texts(*shown)] == [plain(t)[3] for t in texts[at : at + 4]]


def test_pairs_bound_what_can_be_linked():
    encoder = align._encoder(A, B)
    side = {i: t for i, t in enumerate(encoder.a.tokens)}
    for a, b in align.link_counts(["Bounds of pairs, shown by example.", "é\n x"], A, B):
        left, right = side[a], encoder.b.tokens[b]
        assert left.endswith(right) or right.endswith(left)
    assert len(encoder.pairs) < 400_000


def test_task_counts_add_up(monkeypatch):
    monkeypatch.setattr(align, "TALLY_ROWS", 3)
    encoder, tally = align._encoder(A, B), align.Tally()
    texts = ["a b a b c", "a b", "c d e f a"]
    for text in texts:
        tally.add(align.Alignment(encoder, [text]).pairs)
    merged = tally.merged().to_pydict()
    counts = {
        divmod(int(encoder.pairs.packed[p]), encoder.pairs.b_size): n
        for p, n in zip(merged["pair"], merged["links"], strict=True)
    }
    assert counts == dict(align.link_counts(texts, A, B))
