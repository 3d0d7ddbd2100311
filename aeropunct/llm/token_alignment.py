"""Alignment of two tokenizers over the same text, on whole Arrow columns.

Tokens of both sides lie in list columns, one list a text. Their lists are flattened with
parent indices, byte lengths become ends by cumulative sums inside each text, and a hash
join on (text, end) finds the offsets at which both sides end a token. These cut the text
into groups and give one link each. Links are counted by a grouped table in each task and
the tasks' counts are merged by Spark.

Texts are cut into words before encoding, each encoded once per cache: neither tokenizer
has a token across a word's bound. Texts for which that is not certain are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm import arrays
from aeropunct.llm.common import Scratch
from aeropunct.llm.pretokens import _BYTE_ALPHABET

# Words whose tokens a Python worker keeps, in each of two generations.
CACHE_WORDS = 240_000
# Rows of partial counts that a task holds before it adds them up.
TALLY_ROWS = 600_000

# A word with the space or line ends before it; other white space needs the whole text.
_WORD = re.compile(r"(?: |\n+)?[^ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")


class Vocabulary:
    """Bytes of every token of one tokenizer, and its numbers as text."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.bytes = pa.array(tokens, pa.large_binary())
        self.lengths = pa.array([len(t) for t in tokens], pa.int64())

    def spells(self, ids: pa.ListArray, words: list[bytes]) -> np.ndarray:
        """Whether the tokens' bytes are the word's, for each list and word."""
        flat = pc.list_flatten(ids)
        spelled = self.bytes.take(flat)
        ends = np.concatenate([[0], np.cumsum(self.lengths.take(flat).to_numpy())])
        ends = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])]
        same = np.diff(ends) == np.fromiter(map(len, words), np.int64, len(words))
        data = spelled.buffers()[2]
        data = data.to_pybytes()[: ends[-1]] if data is not None else b""
        if not same.all() or data != b"".join(words):
            cuts = ends.tolist()
            same = np.array(
                [data[i:j] == w for i, j, w in zip(cuts[:-1], cuts[1:], words, strict=True)], bool
            )
        return same


def byte_level_tokens(path: str) -> tuple[object, Vocabulary]:
    """Tokenizer of a byte-level vocabulary file and the bytes of its entries."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    back = {c: b for b, c in _BYTE_ALPHABET.items()}
    tokens = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        known = all(c in back for c in token)
        tokens[i] = bytes(back[c] for c in token) if known else token.encode()
    return tokenizer, Vocabulary(tokens)


def piece_tokens(path: str) -> tuple[object, Vocabulary]:
    """Model of a sentencepiece file and the bytes of its pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            tokens.append(bytes([int(piece[3:5], 16)]))
        else:
            tokens.append(piece.replace("▁", " ").encode())
    inside = [t for t in tokens if b" " in t.lstrip(b" ") or (b"\n" in t and t != b"\n")]
    if inside:
        raise ValueError("this model has pieces across words")
    return model, Vocabulary(tokens)


class Pairs:
    """All pairs of token ids that can ever end together, numbered.

    Two tokens that end at one byte of a text cover the same bytes back to the start of
    the shorter one, so that one is a suffix of the other. The vocabularies therefore
    bound the pairs, whatever the text.
    """

    def __init__(self, a: Vocabulary, b: Vocabulary):
        by_bytes: tuple[dict[bytes, list[int]], ...] = ({}, {})
        for known, side in zip(by_bytes, (a, b), strict=True):
            for i, token in enumerate(side.tokens):
                known.setdefault(token, []).append(i)
        found = {
            (i, j)
            for i, token in enumerate(a.tokens)
            for at in range(len(token))
            for j in by_bytes[1].get(token[at:], ())
        }
        found |= {
            (i, j)
            for j, token in enumerate(b.tokens)
            for at in range(len(token))
            for i in by_bytes[0].get(token[at:], ())
        }
        self.b_size = len(b.tokens)
        packed = np.array([i * self.b_size + j for i, j in found], np.int64)
        self.packed = np.sort(packed)

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.packed, a * self.b_size + b).astype(np.int32)

    def b_ids(self) -> np.ndarray:
        return self.packed % self.b_size

    def __len__(self) -> int:
        return len(self.packed)


class Encoder:
    """Token ids of both sides as Arrow lists, a list a word or a whole text."""

    def __init__(self, a_path: str, b_path: str):
        self.a_model, self.a = byte_level_tokens(a_path)
        self.b_model, self.b = piece_tokens(b_path)
        self.pairs = Pairs(self.a, self.b)
        self.mark = self.b_model.piece_to_id("▁")
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.sides = [pa.array([], pa.list_(pa.int32()))] * 2

    def _whole(self, texts: list[str]) -> list[pa.ListArray]:
        """Ids of whole texts, none where either side's bytes are not the text's."""
        spaced = [" " + t for t in texts]
        encoded = self.a_model.encode_batch_fast(spaced, add_special_tokens=False)
        left, right = [x.ids for x in encoded], self.b_model.encode(texts, num_threads=1)
        return self._checked(left, right, spaced)

    def _words(self, words: list[str]) -> list[pa.ListArray]:
        """Ids of words, each with the space or line ends before it; none where unsure."""
        encoded = self.a_model.encode_batch_fast(words, add_special_tokens=False)
        left = [x.ids for x in encoded]
        # The piece model adds the space itself; before a line end it is not wanted.
        right = self.b_model.encode([w.removeprefix(" ") for w in words], num_threads=1)
        for k, word in enumerate(words):
            if word[0] == "\n":
                right[k] = right[k][1:] if right[k][:1] == [self.mark] else []
        return self._checked(left, right, words)

    def _checked(self, left: list, right: list, words: list[str]) -> list[pa.ListArray]:
        spelled = [w.encode() for w in words]
        lists = [pa.array(ids, pa.list_(pa.int32())) for ids in (left, right)]
        good = self.a.spells(lists[0], spelled) & self.b.spells(lists[1], spelled)
        if good.all():
            return lists
        for ids in (left, right):
            ids[:] = [x if ok else [] for x, ok in zip(ids, good, strict=True)]
        return [pa.array(ids, pa.list_(pa.int32())) for ids in (left, right)]

    def _learn(self, new: list[str]) -> None:
        """Adds words to the younger generation."""
        stored = [[side] for side in self.sides]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            begin = sum(map(len, stored[0]))
            self.young.update(zip(part, range(begin, begin + len(part)), strict=True))
            for side, ids in zip(stored, self._words(part), strict=True):
                side.append(ids)
        self.sides = [pa.concat_arrays(side) for side in stored]

    def _age(self) -> None:
        """The younger generation becomes the older one, which is dropped."""
        kept = pa.array(list(self.young.values()), pa.int64())
        self.sides = [side.take(kept) for side in self.sides]
        self.old, self.young = dict(zip(self.young, range(len(kept)), strict=True)), {}

    def _numbers(self, words: list[str]) -> list[int]:
        """Places of words that are all known; words of the older generation become young."""
        found = list(map(self.young.get, words))
        if None in found:
            for k, number in enumerate(found):
                if number is None:
                    word = words[k]
                    found[k] = self.young[word] = self.old[word]
        return found

    def encode(self, texts: list[str | None]) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """(ids of A, ids of B, text) of each piece of the texts in order, a list a piece."""
        cut: list[list[str] | None] = []
        for text in texts:
            words = None
            if text and not _OTHER_SPACE.search(text):
                spaced = " " + text
                words = _WORD.findall(spaced)
                # Space that no word follows, or twice, is cut by the tokenizers' own rules.
                if sum(map(len, words)) != len(spaced):
                    words = None
            cut.append(words)
        if len(self.young) > CACHE_WORDS:
            self._age()
        young, old = self.young, self.old
        new = {w: None for words in cut if words for w in words if w not in young and w not in old}
        if new:
            self._learn(list(new))
        unsure = pc.equal(pc.list_value_length(self.sides[0]), 0).to_numpy(zero_copy_only=False)
        listed, owner, whole = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for k, words in enumerate(cut):
            if words is not None:
                at = np.array(self._numbers(words), np.int64)
                if not unsure[at].any():
                    listed.append(at)
                    owner.append(np.full(len(at), k))
                    continue
            if texts[k]:
                # Whole texts are numbered behind the words.
                listed.append(np.array([len(unsure) + len(whole)]))
                owner.append(np.array([k]))
                whole.append(texts[k])
        at = pa.array(np.concatenate(listed))
        extra = self._whole(whole) if whole else [side[:0] for side in self.sides]
        a, b = (
            pa.concat_arrays(pair).take(at) for pair in zip(self.sides, extra, strict=True)
        )
        return a, b, np.concatenate(owner)


@lru_cache(maxsize=2)
def _encoder(a_path: str, b_path: str) -> Encoder:
    """One per Python worker and pair of files; its cache serves all tasks of the worker."""
    return Encoder(a_path, b_path)


class Side:
    """Flat tokens of one tokenizer: id, text number, and end inside the text in bytes."""

    def __init__(self, lists: pa.ListArray, owner: np.ndarray, vocabulary: Vocabulary, texts: int):
        self.ids = pc.list_flatten(lists)
        self.text = pa.array(owner).take(pc.list_parent_indices(lists))
        running = pc.cumulative_sum(vocabulary.lengths.take(self.ids)).to_numpy()
        number = self.text.to_numpy()
        # Where each text's tokens begin; the sum before them is taken off their ends.
        self.first = np.searchsorted(number, np.arange(texts + 1))
        before = np.concatenate([[0], running])[self.first[:-1]]
        self.end = pa.array(running - before[number])

    def table(self, side: str) -> pa.Table:
        return pa.table(
            {"text": self.text, "end": self.end, side: np.arange(len(self.ids), dtype=np.int32)}
        )


class Alignment:
    """Groups and links of a batch of texts."""

    def __init__(self, encoder: Encoder, texts: list[str | None]):
        lists_a, lists_b, owner = encoder.encode(texts)
        n = len(texts)
        self.a = Side(lists_a, owner, encoder.a, n)
        self.b = Side(lists_b, owner, encoder.b, n)
        keys = ["text", "end"]
        joined = self.a.table("a").join(
            self.b.table("b"), keys, join_type="inner", use_threads=False
        )
        # A text's tokens end in order, so the place of A's token orders the links.
        order = pc.sort_indices(joined.column("a"))
        self.last_a = joined.column("a").take(order).to_numpy()
        self.last_b = joined.column("b").take(order).to_numpy()
        self.text = joined.column("text").take(order).to_numpy()
        self.first_link = np.searchsorted(self.text, np.arange(n + 1))
        a, b = self.a.ids.to_numpy(), self.b.ids.to_numpy()
        self.pairs = encoder.pairs.numbers(
            a[self.last_a].astype(np.int64), b[self.last_b].astype(np.int64)
        )

    def group_texts(self, shown: pa.Array, b_start: int) -> list[bytes]:
        """Groups of each text as ``a1,a2|b1;a3|b2``, empty where it has no tokens.

        ``shown`` holds each token number twice, with the sign that follows it inside its
        side of a group and the one at its end: all of A, then from ``b_start`` on of B.
        """
        a, b = self.a.ids.to_numpy(), self.b.ids.to_numpy()
        out = np.empty(len(a) + len(b), np.int64)
        last = np.zeros(len(a), np.int64)
        last[self.last_a] = 1
        group = np.cumsum(last) - last
        b_before = np.concatenate([[0], self.last_b + 1])
        out[np.arange(len(a)) + b_before[group]] = 2 * a.astype(np.int64) + last
        last = np.zeros(len(b), np.int64)
        last[self.last_b] = 1
        group = np.cumsum(last) - last
        a_upto = np.concatenate([self.last_a + 1, [0]])
        out[np.arange(len(b)) + a_upto[group]] = b_start + 2 * b.astype(np.int64) + last
        text = shown.take(pa.array(out))
        _, bounds, data = text.buffers()
        ends = np.frombuffer(bounds, np.int64)[: len(text) + 1]
        cuts = ends[self.a.first + self.b.first]
        view = memoryview(data) if data is not None else memoryview(b"")
        # Without the separator after the last group.
        return [
            bytes(view[i : j - 1]) if j > i else b""
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        ]


@lru_cache(maxsize=2)
def _shown(a_size: int, b_size: int) -> tuple[pa.Array, int]:
    signs = [(a_size, ",|"), (b_size, ",;")]
    texts = [f"{i}{s}" for size, pair in signs for i in range(size) for s in pair]
    return pa.array(texts, pa.large_string()), 2 * a_size


class Tally:
    """Counts of pairs met by one task."""

    def __init__(self):
        self.tables: list[pa.Table] = []

    def add(self, pairs: np.ndarray) -> None:
        met = pa.table({"pair": pa.array(pairs, pa.int32())})
        counted = met.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        self.tables.append(counted.rename_columns(["pair", "links"]))
        if sum(map(len, self.tables)) > TALLY_ROWS:
            self.tables = [self.merged()]

    def merged(self) -> pa.Table:
        all_of = pa.concat_tables(self.tables)
        summed = all_of.group_by("pair", use_threads=False).aggregate([("links", "sum")])
        return summed.rename_columns(["pair", "links"])


_FIELDS = (
    "n_a long, n_b long, n_groups long, groups string, "
    "pairs array<int>, met array<int>, links array<long>"
)


def _aligner(a_path: str, b_path: str, whole_groups: bool):
    """(id, text) to a row a text and, at the end of a task, one row of its pair counts."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(a_path, b_path)
        shown = _shown(len(encoder.a.tokens), len(encoder.b.tokens))
        tally, names, kind = Tally(), None, None
        for batch in arrays.chunks(batches):
            names = [batch.schema.names[0], *(f.split()[0] for f in _FIELDS.split(", "))]
            kind = batch.column(0).type
            found = Alignment(encoder, batch.column(1).to_pylist())
            tally.add(found.pairs)
            groups = found.group_texts(*shown)
            if not whole_groups:
                groups = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
            else:
                groups = [g.decode() for g in groups]
            n = batch.num_rows
            lists = pa.ListArray.from_arrays(
                pa.array(found.first_link.astype(np.int32)), pa.array(found.pairs)
            )
            counts = [np.diff(x) for x in (found.a.first, found.b.first, found.first_link)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(c.astype(np.int64)) for c in counts],
                    pa.array(groups, pa.string()),
                    lists,
                    pa.nulls(n, pa.list_(pa.int32())),
                    pa.nulls(n, pa.list_(pa.int64())),
                ],
                names,
            )
            # What the columns of a batch took goes back before the next one is read.
            del found, groups, lists, counts
            pa.default_memory_pool().release_unused()
        if names:
            merged = tally.merged().combine_chunks()
            one = [
                pa.ListArray.from_arrays(
                    pa.array([0, len(merged)], pa.int32()),
                    pc.cast(merged.column(c).combine_chunks(), t),
                )
                for c, t in (("pair", pa.int32()), ("links", pa.int64()))
            ]
            empty = [pa.nulls(1, t) for t in (kind, *[pa.int64()] * 3, pa.string())]
            empty.append(pa.nulls(1, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*empty, *one], names)

    return align


def _scorer(shared):
    """Link numbers to the sums of their counts and the number of best links."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            pairs = batch.column(batch.num_columns - 1)
            flat = pc.list_flatten(pairs).to_numpy()
            first = np.concatenate([[0], np.cumsum(pc.list_value_length(pairs).to_numpy())])
            totals = [
                np.diff(np.concatenate([[0], np.cumsum(values[flat])])[first])
                for values in (best.astype(np.int64), counts)
            ]
            rest = [pa.array(t.astype(np.int64)) for t in (np.diff(first), *totals)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *rest],
                [*batch.schema.names[:-1], "n_links", "n_best", "count_sum"],
            )

    return score


def aligned_tokens(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    whole_groups: bool = True,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, groups, n_links, n_best, count_sum) of every text.

    A is the byte-level vocabulary of ``a_path`` over a space and the text, B the
    sentencepiece model of ``b_path``, which adds the space; both files are present on
    every executor. ``groups`` is the text of the groups, ``a1,a2|b1;a3|b2,b3``, or its
    SHA-256 in hex when ``whole_groups`` is false; without tokens it is empty. A text that
    is null or empty, or whose bytes either side does not give back, has no tokens: zeros.
    Repeated rows count each; other columns are not read; an empty table gives none.

    Texts are read and encoded once. What crosses the network is one list of pair counts
    a task, never longer than the vocabularies' possible pairs; the merged counts, under
    the same bound (about 330,000 pairs for two vocabularies of 50,000 and 32,000), are
    broadcast.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = narrow.schema[0].dataType.simpleString()
    scratch = Scratch(spark, "alignment")
    aligned = scratch.keep(
        narrow.mapInArrow(_aligner(a_path, b_path, whole_groups), f"id {kind}, {_FIELDS}"),
        "links",
        codec="zstd",
    )
    met = aligned.filter("met IS NOT NULL").select(
        F.inline(F.arrays_zip(F.col("met").alias("pair"), "links"))
    )
    merged = met.groupBy("pair").agg(F.sum("links").alias("links")).toPandas()
    pairs = Pairs(byte_level_tokens(a_path)[1], piece_tokens(b_path)[1])
    counts = np.zeros(len(pairs), np.int64)
    counts[merged["pair"].to_numpy(np.int64)] = merged["links"].to_numpy(np.int64)
    highest = np.zeros(pairs.b_size, np.int64)
    np.maximum.at(highest, pairs.b_ids(), counts)
    best = counts == highest[pairs.b_ids()]
    shared = spark.sparkContext.broadcast((counts, best))
    rows = aligned.filter("pairs IS NOT NULL").drop("met", "links")
    return rows.mapInArrow(
        _scorer(shared),
        f"id {kind}, n_a long, n_b long, n_groups long, groups string, "
        "n_links long, n_best long, count_sum long",
    ).withColumnRenamed("id", id_col)


def link_counts(texts: list[str | None], a_path: str, b_path: str) -> Counter:
    """Counts of linked id pairs of a few texts, for use without a session."""
    encoder = _encoder(a_path, b_path)
    found = Alignment(encoder, texts)
    return Counter(
        divmod(int(p), encoder.pairs.b_size) for p in encoder.pairs.packed[found.pairs]
    )
