"""Quality rule: how much of a text repeats, from a suffix array of its words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm import arrays

# Production limits: repeats of at least so many words count; they may cover at most
# this share of the words; none may be longer than this many words.
MIN_REPEAT_WORDS = 6
MAX_COVERED = 0.4
MAX_REPEAT_WORDS = 100

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def longest_matches(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest word sequence that starts there and
    also starts at another word of the same text.

    Prefix doubling sorts the suffixes of all texts at once; a text's number is part
    of the first key, so suffixes of different texts never tie. The ranks of every
    level are kept and give the common prefix of neighbours in the suffix array.
    """
    n = len(h)
    if n < 2:
        return np.zeros(n, np.int64)
    key = h ^ arrays.mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    levels = [_ranks(key[order], order, n)]
    last = np.flatnonzero(np.diff(doc)) + 1
    stop = np.append(last, n)[np.searchsorted(last, np.arange(n), "right")]
    tied = _tied(levels[0], order)
    step = 1
    while len(tied):
        rank = levels[-1].copy()
        at = order[tied]
        second = np.full(len(at), -1, np.int64)
        inside = at + step < stop[at]
        second[inside] = rank[at[inside] + step]
        pair = rank[at] * (n + 1) + second + 1
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[tied] = at
        fresh = np.append(True, pair[1:] != pair[:-1])
        rank[at] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        levels.append(rank)
        tied = tied[_tied(rank, at)]
        step *= 2
    return _neighbour_prefixes(order, levels, stop)


def _ranks(key: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    """Rank of each suffix: the place at which its group of ties begins."""
    fresh = np.append(True, key[1:] != key[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return rank


def _tied(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places in ``at`` whose suffix ties with the one before or after."""
    same = rank[at[1:]] == rank[at[:-1]]
    return np.flatnonzero(np.append(False, same) | np.append(same, False))


def _neighbour_prefixes(order: np.ndarray, levels: list, stop: np.ndarray) -> np.ndarray:
    """The longer of the common prefixes with both neighbours in the suffix array."""
    a, b = order[:-1], order[1:]
    close = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[close], b[close]
    prefix = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + prefix, b + prefix
        inside = np.flatnonzero((i < stop[a]) & (j < stop[b]))
        i, j = i[inside], j[inside]
        # equal rank at level k: the next 2**k words are equal, and all lie inside
        equal = inside[(levels[k][i] == levels[k][j])]
        prefix[equal] += 1 << k
    longest = np.zeros(len(order), np.int64)
    np.maximum.at(longest, a, prefix)
    np.maximum.at(longest, b, prefix)
    return longest


def covered(longest: np.ndarray, least: int, length: np.ndarray | int) -> np.ndarray:
    """Words in the union of the spans that start at words with a match of ``least``."""
    starts = np.flatnonzero(longest >= least)
    ends = starts + (length if isinstance(length, int) else length[starts])
    change = np.bincount(starts, minlength=len(longest) + 1)[: len(longest) + 1]
    change = change - np.bincount(ends, minlength=len(longest) + 1)[: len(longest) + 1]
    return np.cumsum(change)[:-1] > 0


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(flags, dtype=np.int64))
    return total[bounds[1:]] - total[bounds[:-1]]


def _measure(column: pa.Array, min_repeat: int) -> dict[str, np.ndarray]:
    data, offsets = arrays.utf8(column)
    n = len(offsets) - 1
    starts, ends, doc = arrays.words(data, offsets)
    bounds = arrays.bounds(doc, n)
    longest = longest_matches(arrays.hashes(data, starts, ends), doc)
    in_word = ~arrays.is_space(data)
    lines, line_ends, line_doc = arrays.runs(data != ord("\n"), offsets)
    with_word = np.append(0, np.cumsum(in_word, dtype=np.int64))
    full = with_word[line_ends] > with_word[lines]
    lines, line_ends, line_doc = lines[full], line_ends[full], line_doc[full]
    line = arrays.hashes(data, lines, line_ends)
    line ^= arrays.mix(line_doc.astype(np.uint64) + np.uint64(1))
    again = np.ones(len(line), bool)
    again[np.unique(line, return_index=True)[1]] = False
    longest_repeat = np.zeros(n, np.int64)
    np.maximum.at(longest_repeat, doc, longest)
    return {
        "n_words": np.diff(bounds),
        "word_chars": _per_text(in_word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": _per_text(again, arrays.bounds(line_doc, n)),
        "n_repeat_words": _per_text(covered(longest, 3, 3), bounds),
        "n_covered": _per_text(covered(longest, min_repeat, longest), bounds),
        "longest_repeat": longest_repeat,
    }


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_covered long, longest_repeat long"
)


def repetition(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_repeat: int = MIN_REPEAT_WORDS,
    max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT_WORDS,
) -> DataFrame:
    """Repetition measures of every whole text and the verdict on it.

    The maximal repeated word sequences of a text are the common prefixes of
    neighbours in its suffix array. Those of at least ``min_repeat`` words are
    united to ``n_covered`` words; ``longest_repeat`` is the longest of any length.
    A text fails if they cover more than ``max_covered`` of its words or one is
    longer than ``max_repeat``. Texts under 50 words, or with more than half their
    words in three-word windows that occur again, fail before (``base_failed``).

    Null and empty texts have no words: all measures are 0 and they fail. Repeated
    rows are measured each by itself; other columns are not read. Nothing is
    shuffled, and a task holds some megabytes of text or one text at a time.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.chunks(batches):
            found = _measure(batch.column(1), min_repeat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.int64()) for v in found.values())],
                [batch.schema.names[0], *found],
            )

    narrow = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    kind = narrow.schema[0].dataType.simpleString()
    measured = narrow.mapInArrow(measure, f"`{id_col}` {kind}, {MEASURES}")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passed = (F.col("n_covered") <= max_covered * F.col("n_words")) & (
        F.col("longest_repeat") <= max_repeat
    )
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & passed)
