"""Token ids and counts of words, merging only what a table cannot answer.

Both tokenizers cut a text into pre-tokens that are merged apart from each other.
A vocabulary string that is shown once, by encoding it alone, to be one token
therefore is one token wherever it is a whole pre-token.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Bytes that one generation of a cache may take in a Python worker, counted with so many
# for each entry besides its key.
CACHE_BYTES, ENTRY_BYTES = 72 << 20, 200
# Words that are merged at once, so that their arrays stay in the processor's cache.
SIDE_BY_SIDE = 10_000


class Generations(dict):
    """A cache of bounded size whose frequent entries stay.

    When the younger generation has grown to its limit it becomes the older one, and the
    older one goes. An entry of the older one becomes young again when it is used.
    """

    def __init__(self, limit: int | None = None):
        self.limit = CACHE_BYTES if limit is None else limit
        self.size, self.old = 0, {}

    def __missing__(self, key: str):
        self[key] = value = self.old[key]
        self.size += ENTRY_BYTES + len(key)
        return value

    def learn(self, entries: dict) -> None:
        self.update(entries)
        self.size += ENTRY_BYTES * len(entries) + sum(map(len, entries))

    def unknown(self, keys: Iterable[str]) -> set[str]:
        """Keys of neither generation. Ages the cache first when it is full."""
        if self.size > self.limit:
            self.old = dict(self)
            self.clear()
            self.size = 0
        return set(keys).difference(self).difference(self.old)


def _byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


_BYTE_ALPHABET = _byte_alphabet()


class PieceCounts:
    """Token counts under a sentencepiece model whose pieces never join two words."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self._require_word_pieces(pieces)
        self.known = self.single_token_words(pieces)
        self.cache = Generations()

    def _require_word_pieces(self, pieces: list[str]) -> None:
        """No piece has the word mark after another character, and nothing is normalised."""
        joins = [p for p in pieces if "▁" in p.lstrip("▁")]
        samples = ["aä̈  b", "Å ﬁ 　x", " a\tb\n"]
        kept = all(
            self.model.normalize(s) == "▁" + s.replace(" ", "▁") for s in samples
        )
        if joins or not kept:
            raise ValueError("this model's pieces or normalisation cross word bounds")

    def single_token_words(self, pieces: list[str]) -> dict[str, int]:
        """Words that alone, after the word mark, are one token: shown by encoding each."""
        words = [
            p[1:] for p in pieces if p.startswith("▁") and len(p) > 1 and p[1] != "▁"
        ]
        counts = map(len, self.model.encode(words, num_threads=1))
        return {word: 1 for word, n in zip(words, counts, strict=True) if n == 1}

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text: known words at once, the rest merged once per cache."""
        known, cache, split = self.known, self.cache, []
        for text in texts:
            text = text.replace("▁", " ")
            split.append(text.split(" ") if text else [])
        new = cache.unknown(chain.from_iterable(split)).difference(known)
        new = sorted(new - {""})
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            counts = map(len, self.model.encode(part, num_threads=1))
            cache.learn(dict(zip(part, counts, strict=True)))
        return [self._total(words) for words in split]

    def _total(self, words: list[str]) -> int:
        known, cache = self.known, self.cache
        if "" not in words:
            return sum([known.get(w) or cache[w] for w in words])
        # Runs of spaces are merged with the word that follows them.
        total, spaces = 0, 0
        for word in words:
            if not word:
                spaces += 1
            elif spaces:
                total += len(self.model.encode(" " * spaces + word))
                spaces = 0
            else:
                total += known.get(word) or cache[word]
        return total + (self._trailing(spaces) if spaces else 0)

    @lru_cache(maxsize=4096)  # noqa: B019  one object per worker
    def _trailing(self, spaces: int) -> int:
        """Tokens of word marks that no word follows."""
        return len(self.model.encode("a" + " " * spaces)) - len(self.model.encode("a"))


class Merges:
    """Pair merges of a byte-level model, applied to many pre-tokens side by side.

    In each round every pre-token merges its best pair, wherever it stands, from the left.
    That is the model's own order if no pair outranks those that its parts are made of.
    """

    _NONE = np.int32(2**31 - 1)

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        letters = [_BYTE_ALPHABET[b] for b in range(256)]
        self.inner = np.array([vocabulary[c] for c in letters], np.int32)
        self.last = np.array([vocabulary[c + suffix] for c in letters], np.int32)
        left, right, made = (
            np.array([vocabulary[t] for t in tokens], np.int64)
            for tokens in (*zip(*merges, strict=True), [a + b for a, b in merges])
        )
        rank = np.arange(len(made))
        born = np.full(max(vocabulary.values()) + 1, -1)
        born[made] = rank
        bytes_made = np.isin(made, [self.inner, self.last]).any()
        later = (np.maximum(born[left], born[right]) >= rank).any()
        if bytes_made or later or len(np.unique(made)) < len(made):
            raise ValueError("pairs outrank those their parts are made of")
        self.pairs, self.made = pd.Index(left << 32 | right), made.astype(np.int32)

    @classmethod
    def of(cls, tokenizer) -> Merges | None:
        """None for a model that does more than merge, or in another order."""
        model = json.loads(tokenizer.to_str())["model"]
        more = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(key) for key in more):
            return None
        try:
            return cls(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        except (KeyError, ValueError):
            return None

    def _ranks(self, ids: np.ndarray, group: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``at``; the last place of a group begins none."""
        after = np.minimum(at + 1, len(ids) - 1)
        rank = self.pairs.get_indexer(ids[at].astype(np.int64) << 32 | ids[after])
        merges = (rank >= 0) & (group[after] == group[at]) & (after > at)
        return np.where(merges, rank, self._NONE).astype(np.int32)

    def merged(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens and the pre-token each belongs to.

        ``data`` are their bytes, side by side; ``ends`` marks the last byte of each.
        """
        ids = np.where(ends, self.last[data], self.inner[data])
        group = (np.cumsum(ends) - ends).astype(np.int32)
        rank = self._ranks(ids, group, np.arange(len(ids)))
        done = []
        while len(ids):
            first = np.flatnonzero(np.diff(group, prepend=-1))
            best = np.minimum.reduceat(rank, first)
            best = np.repeat(best, np.diff(first, append=len(ids)))
            live = best < self._NONE
            over = np.flatnonzero(~live)
            done.append((ids[over], group[over]))
            at = np.flatnonzero((rank == best) & live)
            # Of overlapping pairs, as in a run of one letter, every other one is merged.
            follows = np.diff(at, prepend=-2) == 1
            number = np.arange(len(at))
            run = np.maximum.accumulate(np.where(follows, 0, number))
            at = at[(number - run) % 2 == 0]
            ids[at] = self.made[rank[at]]
            live[at + 1] = False
            at = np.cumsum(live)[at] - 1
            left = np.flatnonzero(live)
            ids, group, rank = ids[left], group[left], rank[left]
            at = np.concatenate([at, at[at > 0] - 1])
            rank[at] = self._ranks(ids, group, at)
        ids, group = (np.concatenate(parts) for parts in zip(*done, strict=True))
        order = np.argsort(group, kind="stable")
        return ids[order], group[order]


class WordIds:
    """Token ids under a lower-casing tokenizer that merges each pre-token apart.

    White space separates pre-tokens, so a text is looked up word by word; words
    not met before are cut into pre-tokens, and pre-tokens not met before merged.
    """

    # Characters whose lower case, normal form and class every library agrees on.
    _PLAIN = re.compile(r"[^\t\n\r\x20-\x7e¡-¬®-į]|<\|")
    # The same characters as single bytes, for texts that have no others.
    _PLAIN_BYTES = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)])
    # The tokenizer's own pre-token pattern (fixed value).
    _PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    # What that pattern tells apart among the plain characters: white space is 0.
    _LETTER, _NUMBER, _OTHER = 1, 2, 3
    _KIND = np.full(0x130, _OTHER, np.int8)
    for _kind, _class in [(0, r"\s"), (_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}")]:
        _KIND[[ord(c) for c in regex.findall(_class, "".join(map(chr, range(0x130))))]] = _kind
    # Longest word, in characters, that is merged beside others: rounds are as many as its merges.
    _SIDE = 64

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.merges = Merges.of(self.tokenizer)
        # Words, and pre-tokens of those merged apart: a pre-token by itself is a word of one
        # pre-token. Most distinct words of a corpus come once or twice, so a larger cache
        # finds few more.
        self.words = Generations(CACHE_BYTES // 3)

    def _plain(self, text: str) -> bool:
        """Whether every library reads the characters of the text alike."""
        try:
            odd = text.encode("latin-1").translate(None, self._PLAIN_BYTES)
        except UnicodeEncodeError:
            return not self._PLAIN.search(text)
        return not odd and "<|" not in text

    def _encode(self, texts: list[str]) -> list[bytes]:
        out = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in out]

    def _merge(self, pretoken: str) -> bytes:
        """Ids of one pre-token by the tokenizer's model, in its byte alphabet."""
        # Printable ASCII stands for itself there, and no pre-token holds white space.
        text = pretoken
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(_BYTE_ALPHABET)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _learn(self, words: set[str]) -> None:
        """Fills the cache for words not met before."""
        apart = words
        if self.merges:
            apart = {w for w in words if not 0 < len(w) <= self._SIDE or "'" in w}
        self._learn_apart(sorted(apart))
        beside = list(words - apart)
        for at in range(0, len(beside), SIDE_BY_SIDE):
            part = beside[at : at + SIDE_BY_SIDE]
            self.words.learn(dict(zip(part, self._spell(part), strict=True)))

    def _learn_apart(self, words: list[str]) -> None:
        """The same by the tokenizer's model, one pre-token after the other."""
        # Letters alone are one pre-token.
        cuts = [[word] if word.isalpha() else self._PRETOKEN.findall(word) for word in words]
        known = self.words
        known.learn({t: self._merge(t) for t in known.unknown(chain.from_iterable(cuts))})
        known.learn(
            {
                word: b"".join([known[t] for t in cut])
                for word, cut in zip(words, cuts, strict=True)
                if cut != [word]
            }
        )

    def _spell(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain characters without an apostrophe, merged side by side."""
        text = " ".join(words) + " "
        points = np.frombuffer(text.encode("utf-16-le"), np.uint16)
        kind = self._KIND[points]
        ends = (kind != 0) & ((kind != np.roll(kind, -1)) | (kind == self._NUMBER))
        # From characters to bytes: the last byte of a character stands for it.
        data = np.frombuffer(text.encode(), np.uint8)
        inside, last = data != 0x20, np.zeros(len(data), bool)
        last[np.cumsum(1 + (points > 0x7F))[ends] - 1] = True
        ids, pretoken = self.merges.merged(data[inside], last[inside])
        word = np.cumsum(kind == 0)[ends]
        stops = 4 * np.cumsum(np.bincount(word[pretoken], minlength=len(words)))
        laid, stops = ids.tobytes(), stops.tolist()
        return [laid[i:j] for i, j in zip([0, *stops], stops, strict=False)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        plain = [self._plain(text) for text in texts]
        whole = iter(self._encode([t for t, p in zip(texts, plain, strict=True) if not p]))
        split = iter(self._split_ids([t.lower() for t, p in zip(texts, plain, strict=True) if p]))
        return [next(split if p else whole) for p in plain]

    def _split_ids(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts in lower case, word by word.

        Arrow cuts the texts and numbers their distinct words, so that only these pass
        through the cache; a text's ids are a slice of all words' ids laid side by side.
        """
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        numbered = words.flatten().dictionary_encode()
        distinct = _strings(numbered.dictionary)
        new = self.words.unknown(distinct)
        if new:
            self._learn(new)
        known = pa.array(map(self.words.__getitem__, distinct), pa.large_binary())
        spelled = known.take(numbered.indices)
        _, ends, data = spelled.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(spelled) + 1]
        cuts = ends[words.offsets.to_numpy()].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        return [bytes(view[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _strings(words: pa.Array) -> list[str]:
    """The words, none with a blank, as Python strings: one string cut is faster than many."""
    blank = pa.scalar(" ", words.type)
    joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), blank)
    return joined[0].as_py().split(" ") if len(words) else []
