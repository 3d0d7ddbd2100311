"""Token counts and packing against the libraries themselves."""

from __future__ import annotations

import json
import random
import tracemalloc
import zlib
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aeropunct.llm import queries
from aeropunct.llm.packing import SEQUENCE_TOKENS, Packer, pack
from aeropunct.llm.pretokens import (
    _BYTE_ALPHABET,
    SIDE_BY_SIDE,
    Generations,
    Merges,
    PieceCounts,
    WordIds,
)
from aeropunct.llm.token_counts import token_counts

PIECES = public_tokenizers.path(queries.PIECE_MODEL)
WORDS = public_tokenizers.path(queries.WORD_TOKENIZER)
ODD = [
    "", " ", "  ", " a", "a ", "a  b", "  a b   ", "\n", "▁", "▁▁a", "a▁ b", "<s> </s> <0x0A> <unk>",
    "é́ x", "ſ ﬁ Å", "it's 'S they'RE x'd 's't", "<|startoftext|> a<|endoftext|>b", "１２ ²³ ½",
    "İstanbul ΣΑΣ", "\x00\x1c\x85 x", "日本語 text", "a­b", "ß ŉ ǆ ĳ İ ı", "　 x", "🙂🙂",
]


def odd_texts():
    rnd = random.Random(3)
    alphabet = "ab Ż'éß0٣!  \n\t ́日▁<|>sS."
    made = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(30))) for _ in range(1500)]
    return ODD + made


def test_counts_are_the_librarys():
    counter, texts = PieceCounts(PIECES), odd_texts()
    assert counter.count(texts) == [len(counter.model.encode(t)) for t in texts]
    assert counter.count(texts) == counter.count(texts)


@pytest.mark.parametrize("limit", [0, 700, 9000])
def test_counts_survive_a_full_cache(monkeypatch, limit):
    monkeypatch.setattr("aeropunct.llm.pretokens.CACHE_BYTES", limit)
    counter, texts = PieceCounts(PIECES), odd_texts()
    for at in range(0, 300, 7):
        part = texts[at : at + 7]
        assert counter.count(part) == [len(counter.model.encode(t)) for t in part]
    encoder = WordIds(WORDS)
    for at in range(0, 300, 7):
        part = texts[at : at + 7]
        assert encoder.ids(part) == [array("I", e.ids).tobytes() for e in library(part)]


def test_frequent_entries_stay_when_a_cache_ages():
    cache = Generations(limit=1000)
    asked = []
    for i in range(200):
        new = cache.unknown(["often", f"once{i}"])
        asked += new
        cache.learn(dict.fromkeys(new, i))
        assert cache["often"] == 0 and cache[f"once{i}"] == i
        assert cache.size < 1600 and len(cache.old) < 9
    assert asked.count("often") == 1
    with pytest.raises(KeyError):
        cache["once0"]


TOKENIZER = Tokenizer.from_file(WORDS)


def library(texts):
    return TOKENIZER.encode_batch(texts, add_special_tokens=False)


def test_ids_are_the_librarys():
    texts = odd_texts()
    assert WordIds(WORDS).ids(texts) == [array("I", e.ids).tobytes() for e in library(texts)]


def test_token_count_rows(spark):
    rows = [(1, "a b", 5), (1, "a b", 5), (None, None, 5), (2, "word " * 60_000, 5), (3, "é", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {tuple(r) for r in token_counts(docs, PIECES).collect()}
    model = PieceCounts(PIECES).model
    sizes = {t: len(model.encode(t or "")) for _, t, _ in rows}
    assert got == {
        (i, len((t or "").encode()), sizes[t], sizes[t] > 4096) for i, t, _ in rows
    }
    assert token_counts(docs.limit(0), PIECES).count() == 0


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    rnd = random.Random(1)
    vocabulary = ["the", "of", "anthing", "x,", "Été"]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 5, 300, 2500]))) for _ in range(300)]
    rows = [(i % 290, t, "x") for i, t in enumerate(texts)] + [(None, None, "y"), (7, "", "z")]
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5).write.mode(
        "overwrite"
    ).parquet(path)
    return spark.read.parquet(path)


def test_pieces_hold_every_id_once(spark, documents):
    pieces = pack(documents, WORDS, open_windows=4).toPandas()
    rows = documents.collect()
    want = sorted(
        array("I", [*e.ids, 1]).tobytes() for e in library([r.text or "" for r in rows])
    )
    docs: list[bytes] = []
    pieces["doc"] = pieces.doc_id.fillna(-1)
    for _, group in pieces.sort_values(["doc", "doc_tokens", "start"]).groupby("doc"):
        whole = b""
        for piece in group.itertuples():
            assert len(piece.ids) == 4 * piece.length
            whole += piece.ids
            if piece.start + piece.length == piece.doc_tokens and len(group) == 1:
                assert len(whole) == 4 * piece.doc_tokens
        docs.append(whole)
    assert sum(map(len, docs)) == sum(map(len, want))
    single = {i for i, n in documents.groupBy("doc_id").count().collect() if n == 1}
    by_id = {r.doc_id: r.text for r in rows if r.doc_id in single}
    for doc_id, text in by_id.items():
        own = pieces[pieces.doc.eq(-1 if doc_id is None else doc_id)].sort_values("start")
        expected = array("I", [*library([text or ""])[0].ids, 1]).tobytes()
        assert b"".join(own.ids) == expected


def test_sequences_are_gapless_and_full(documents):
    pieces = pack(documents, WORDS, open_windows=4).toPandas()
    fills = []
    for _, sequence in pieces.groupby("sequence_id"):
        at = 0
        for piece in sequence.sort_values("offset").itertuples():
            assert piece.offset == at
            at += piece.length
        assert at <= SEQUENCE_TOKENS
        fills.append(at)
    assert sum(fills) > 0.9 * SEQUENCE_TOKENS * (len(fills) - 1)


def plain_packing(sizes, size, most):
    """(document, start, length, window, offset) by looking at every open window."""
    fills, out, number = {}, [], 0
    for doc, n in enumerate(sizes):
        start = 0
        while n - start >= size:
            out.append((doc, start, size, number, 0))
            start, number = start + size, number + 1
        length = n - start
        if not length:
            continue
        fitting = [(fill, w) for w, fill in fills.items() if fill + length <= size]
        if fitting:
            window = max(fitting)[1]
        else:
            if len(fills) == most:
                del fills[max((fill, w) for w, fill in fills.items())[1]]
            window, number = number, number + 1
            fills[window] = 0
        out.append((doc, start, length, window, fills[window]))
        fills[window] += length
        if fills[window] == size:
            del fills[window]
    return sorted(out), fills


@pytest.mark.parametrize("most", [1, 3, 20])
def test_placement_is_that_of_a_plain_bounded_best_fit(most):
    rnd = random.Random(most)
    sizes = [rnd.choice([1, 3, 17, 40, 63, 64, 65, 200, rnd.randint(1, 90)]) for _ in range(900)]
    packer = Packer(64, most, 0)
    pieces = [p for doc, n in enumerate(sizes) for p in packer.add(doc, b"abcd" * n)]
    left = list(packer.rest())
    got = sorted((doc, start, length, window, fill) for doc, start, length, _, _, window, fill, _ in pieces + left)
    want, fills = plain_packing(sizes, 64, most)
    assert got == want
    assert {p[5] for p in left} == set(fills) and all(p[7] for p in left) and not any(p[7] for p in pieces)


def test_packing_query(spark, documents):
    got = queries.packed(documents).toPandas()
    ids = pack(documents, WORDS).toPandas()
    assert sorted(got.ids_crc32) == sorted(zlib.crc32(x) for x in ids.ids)
    assert queries.packed(documents.limit(0)).count() == 0


def test_a_batch_looks_every_distinct_word_up_once():
    encoder, seen = WordIds(WORDS), []

    class Watched(Generations):
        def __getitem__(self, key):
            seen.append(key)
            return super().__getitem__(key)

    encoder.words = Watched()
    text = " one two\tone\n" * 50
    want = array("I", encoder.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    assert encoder.ids([text, text.upper(), ""]) == [want, want, b""]
    assert sorted(seen) == ["", "one", "two"]


def test_an_encoder_keeps_less_than_a_generation_of_the_cache(monkeypatch):
    monkeypatch.setattr("aeropunct.llm.pretokens.CACHE_BYTES", 3 << 20)
    encoder, letters = WordIds(WORDS), "abcdefghijklmnop"
    words = ["".join(letters[(i >> k) & 15] for k in (0, 4, 8, 12)) + "," for i in range(1 << 16)]
    assert encoder.ids([words[-1]]) == [array("I", e.ids).tobytes() for e in library(words[-1:])]
    tracemalloc.start()
    try:
        for at in range(0, len(words), 1024):
            part = " ".join(words[at : at + 1024])
            ids = encoder.ids([part])
            if at % 8192 == 0:
                assert ids == [array("I", e.ids).tobytes() for e in library([part])]
        del ids, part
        assert tracemalloc.get_traced_memory()[0] < 3 << 20
    finally:
        tracemalloc.stop()


def test_plain_words_are_merged_side_by_side(monkeypatch):
    rnd, encoder, apart = random.Random(5), WordIds(WORDS), []
    merge = WordIds._merge
    monkeypatch.setattr(WordIds, "_merge", lambda self, t: apart.append(t) or merge(self, t))
    alphabets = ["aab", "thein", "ée&&%%%1", "aA1.,é<>|ßµ²ªĀįģ", "etaoinshrdlucmfwypvbgkqjxz"]
    words = [
        "".join(rnd.choices(rnd.choice(alphabets), k=rnd.randint(1, 64)))
        for _ in range(SIDE_BY_SIDE + 3000)
    ]
    words = [w for w in words if "<|" not in w]
    texts = [" ".join(words[at : at + 999]) for at in range(0, len(words), 999)]
    want = [array("I", e.ids).tobytes() for e in library(texts)]
    assert encoder.ids(texts) == want and not apart
    odd = "it's " + "a" * 65 + "."
    assert encoder.ids([odd]) == [array("I", e.ids).tobytes() for e in library([odd])]
    assert sorted(apart)[:2] == ["'s", "a" * 65]
    # Without the merges all words go through the model.
    encoder = WordIds(WORDS)
    encoder.merges = None
    assert encoder.ids(texts) == want


def test_only_merges_in_the_models_order_run_side_by_side():
    letters = _BYTE_ALPHABET.values()
    tokens = [*letters, *(c + "$" for c in letters), "ab", "abc$"]
    vocabulary = {t: i for i, t in enumerate(tokens)}
    merges = [("a", "b"), ("ab", "c$")]
    Merges(vocabulary, merges, "$")
    with pytest.raises(ValueError):
        Merges(vocabulary, merges[::-1], "$")
    for merges, suffix, more in [
        (merges[::-1], "$", {}), (merges, "$", {"unk_token": "a"}), ([("a", "b")], "#", {}), ([], "$", {}),
    ]:
        model = {"type": "BPE", "vocab": vocabulary, "merges": merges, "end_of_word_suffix": suffix}
        assert Merges.of(Model(model | more)) is None
    assert Merges.of(TOKENIZER)


class Model:
    """Stands for a tokenizer of which only the model is read."""

    def __init__(self, model: dict):
        self.to_str = lambda: json.dumps({"model": model})
