"""Toxicity: a subsequence string kernel on sentences, Nyström landmarks and a linear SVM.

The kernel of two sentences adds up, over all their words, the letter subsequences of
length 3 and 4 they share, each occurrence damped by the span it covers, so letters
inserted into or left out of a word cost some similarity and not all of it. The landmarks
are labelled sentences; executors compute the kernel rows of the sample's sentences, and
the machine is solved on these rows. A landmark has few subsequences: the decision
function, a weighted sum of kernels with the landmarks, is therefore a table from
subsequences to weights, and scoring looks up the subsequences of a text in that table,
which gives the same number as the kernels.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm.arrays import CHUNK_BYTES, chunks
from aeropunct.llm.common import Scratch, held_out
from aeropunct.llm.training import class_counts, training_sample

# Bounds of the training sample: documents of either label, characters of each.
PER_CLASS = 2500
MAX_CHARS = 40_000
# Bounds of the sentences to learn from, of the landmarks, and of the telling words that
# choose the first sentences.
MAX_SENTENCES = 12_000
LANDMARKS = 384
TELLING = 12_000
ROUNDS = 2
DECAY = 0.6
COST = 20.0
# Kernel rows that a step of the solver holds in double precision at once.
SVM_BLOCK = 1000
# A sentence is so many units in a row. Parts of the sample that calibrate each other.
SENTENCE = 3
FOLDS = 3
# Copies of a text's strongest sentence with a letter inserted into each longer unit.
INSERTIONS = 3
# Words longer than this, and spaced-out runs longer than a window, are read through
# windows. In a run one begins at every letter, as a word may; in a long word every third.
MAX_UNIT, WINDOW, STEP = 24, 10, 3
DECISION = 0.5

# Letter codes: 0 ends a word, 1 to 26 are Latin letters without accents, 31 the beginning
# of a unit; other letters are their code point and 32.
BASE = 32
BEGIN = 31
_SKIP = -1
GAPS = [g for k in (2, 3) for g in product((1, 2, 3), repeat=k) if sum(g) <= (4 if k == 2 else 5)]
# Latin subsequences have a place each in the table, those with other letters share 2**20.
LATIN = BASE**3 + BASE**4
OTHER_BITS = 20
TABLE = LATIN + (1 << OTHER_BITS)


def _letter_code(point: int) -> int:
    """Code of a character by its compatibility form, without case and accents."""
    char = chr(point)
    if char.isspace():
        return 0
    plain = unicodedata.normalize("NFKD", char.lower())[0].lower()
    if not (char.isalpha() or plain.isalpha()):
        return _SKIP
    return ord(plain) - 96 if "a" <= plain <= "z" else 32 + ord(plain)


@lru_cache(maxsize=1)
def _letter_codes() -> np.ndarray:
    return np.array([_letter_code(point) for point in range(0x10000)], np.int32)


def _codes(points: np.ndarray) -> np.ndarray:
    """Letter codes of all characters; the few beyond U+FFFF are looked up one by one."""
    codes = _letter_codes()[np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    if len(far):
        distinct, which = np.unique(points[far], return_inverse=True)
        codes[far] = np.array([_letter_code(int(p)) for p in distinct], np.int32)[which]
    return codes


def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all texts, where each unit begins in them, and each unit's text.

    A unit is a word without its signs and accents, or a run of single letters that
    spaces separate; each begins with a mark. Long ones are read through windows that
    overlap, so that a word in them is whole in one and not diluted by all the others.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    codes = _codes(points)
    doc = np.repeat(np.arange(len(texts)), sizes)
    used = np.flatnonzero(codes != _SKIP)
    codes, doc = codes[used], doc[used]
    letter = codes != 0
    fresh = letter.copy()
    if len(codes):
        fresh[1:] &= ~letter[:-1] | (doc[1:] != doc[:-1])
    word = np.cumsum(fresh)[letter] - 1
    letters, doc = codes[letter], doc[letter]
    if not len(letters):
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    size = np.diff(np.append(first, len(letters)))
    single = size == 1
    joined = np.append(False, single[1:] & single[:-1] & (doc[first][1:] == doc[first][:-1]))
    run = np.append(joined[1:], False)[~joined]
    first = first[~joined]
    size = np.diff(np.append(first, len(letters)))
    # Windows of long units, until the end is covered.
    long, step = size > np.where(run, WINDOW, MAX_UNIT), np.where(run, 1, STEP)
    windows = np.where(long, 1 - (WINDOW - size) // step, 1)
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    ahead = nth * np.repeat(step, windows)
    first, left = np.repeat(first, windows) + ahead, np.repeat(size, windows) - ahead
    size = np.where(np.repeat(long, windows), np.minimum(left, WINDOW), left)
    begin = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), BEGIN, np.int32)
    inside = np.repeat(first - begin - 1, size + 1) + np.arange(len(out))
    marks = np.zeros(len(out), bool)
    marks[begin] = True
    out[~marks] = letters[inside[~marks]]
    return out, begin, doc[first]


def occurrences(letters: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Subsequences of all units by gap pattern: inside one unit, place in the table, damping."""
    unit = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(letters))))
    other = letters >= BASE
    any_other = bool(other.any())
    latin = np.where(other, 0, letters)
    hashed = letters.astype(np.uint32)
    for gaps in GAPS:
        span = sum(gaps)
        if len(letters) <= span:
            continue
        n = len(letters) - span
        code, at = latin[:n], 0
        for gap in gaps:
            at += gap
            code = code * BASE + latin[at : at + n]
        if len(gaps) == 3:
            code = code + BASE**3
        if any_other:
            mixed, foreign, at = hashed[:n] + np.uint32(len(gaps)), other[:n], 0
            for gap in gaps:
                at += gap
                mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x9E3779B1) + hashed[at : at + n]
                foreign = foreign | other[at : at + n]
            mixed = (mixed ^ (mixed >> np.uint32(16))) * np.uint32(0x85EBCA6B)
            place = LATIN + (mixed >> np.uint32(32 - OTHER_BITS)).astype(np.int32)
            code = np.where(foreign, place, code)
        yield unit[:n] == unit[span:], code, DECAY ** (span + 1)


@lru_cache(maxsize=1)
def _norms() -> np.ndarray:
    """What a unit's kernel values are divided by, from its length with the mark."""
    length = np.arange(MAX_UNIT + 2)
    total = sum(np.maximum(length - sum(g), 0) * DECAY ** (2 * sum(g) + 2) for g in GAPS)
    return np.sqrt(np.maximum(total, DECAY**8))


# -- the kernel on sentences ---------------------------------------------------

# A sentence travels as a list of units, a unit as the bytes of its letter codes.
Sentence = list[bytes]


def _entries(rows: list[Sentence]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sentence number, place and damped weight of every subsequence, over the norm."""
    flat = [u for row in rows for u in row]
    size = np.array([len(u) // 4 for u in flat], np.int64)
    letters = np.frombuffer(b"".join(flat), np.int32)
    first = np.cumsum(size) - size
    unit = np.repeat(np.arange(len(first)), size)
    of = np.repeat(np.arange(len(rows)), [len(row) for row in rows])
    norm = np.sqrt(np.bincount(of, _norms()[size] ** 2, len(rows)))
    numbers, codes, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
    for inside, code, damping in occurrences(letters, first):
        number = of[unit[: len(code)][inside]]
        numbers.append(number)
        codes.append(code[inside])
        values.append((damping / norm[number]).astype(np.float32))
    return np.concatenate(numbers), np.concatenate(codes), np.concatenate(values)


class Landmarks:
    """Damped subsequence counts of the landmark sentences, a column each."""

    def __init__(self, rows: list[Sentence]):
        number, code, value = _entries(rows)
        self.codes, row = np.unique(code, return_inverse=True)
        self.counts = np.zeros((len(self.codes), len(rows)), np.float32)
        np.add.at(self.counts, (row, number), value)

    def kernel(self, rows: list[Sentence], at_once: int = 500) -> np.ndarray:
        """Kernel values of all sentences with the landmarks."""
        out = np.zeros((len(rows), self.counts.shape[1]), np.float32)
        if not len(self.codes):
            return out
        for at in range(0, len(rows), at_once):
            number, code, value = _entries(rows[at : at + at_once])
            row = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            known = np.flatnonzero(self.codes[row] == code)
            known = known[np.argsort(number[known], kind="stable")]
            if len(known):
                first = np.flatnonzero(np.append(True, np.diff(number[known]) > 0))
                products = self.counts[row[known]] * value[known, None]
                out[at + number[known][first]] = np.add.reduceat(products, first)
        return out

    def table(self, alphas: np.ndarray) -> np.ndarray:
        """Weights of all subsequences that give the same as ``alphas`` on the kernels."""
        weights = np.zeros(TABLE, np.float32)
        weights[self.codes] = self.counts @ alphas
        return weights


def sums(letters: np.ndarray, first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights of every unit's damped subsequences, added up and not normalised."""
    total = np.zeros(len(letters), np.float32)
    for inside, code, damping in occurrences(letters, first):
        total[: len(code)] += np.where(inside, weights[code], 0) * np.float32(damping)
    return np.add.reduceat(total.astype(float), first) if len(first) else np.zeros(0)


def sentences(doc: np.ndarray) -> np.ndarray:
    """Where sentences begin among the units, given the text number of each unit."""
    return np.flatnonzero((np.arange(len(doc)) - np.searchsorted(doc, doc)) % SENTENCE == 0)


# -- the model -----------------------------------------------------------------

N_FEATURES = 8
NO_WEIGHTS = (np.zeros(0, np.int32), np.zeros(0, np.float32))


@dataclass(frozen=True)
class ToxicityModel:
    codes: np.ndarray  # places of the subsequences with a weight
    values: np.ndarray
    bias: float
    slopes: np.ndarray | None = None  # of the probability in the features of a text
    offset: float = 0.0
    seen: np.ndarray | None = None  # least and largest features it was fitted on

    @cached_property
    def weights(self) -> np.ndarray:
        """Weights of all subsequences by place; made where texts are scored, not sent."""
        table = np.zeros(TABLE, np.float32)
        table[self.codes] = self.values
        return table

    def sentence_scores(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """(scores of all sentences, first unit of each, units as ``units`` returns them)."""
        letters, first, doc = units(texts)
        norm = _norms()[np.diff(np.append(first, len(letters)))]
        raw = sums(letters, first, self.weights)
        begin = sentences(doc)
        if not len(doc):
            return np.zeros(0), begin, letters, first, doc, raw, norm
        scores = np.add.reduceat(raw, begin) / np.sqrt(np.add.reduceat(norm**2, begin)) + self.bias
        return scores, begin, letters, first, doc, raw, norm

    def features(self, texts: list[str]) -> np.ndarray:
        """What the probability is made of, a row a text; NaN for a text without letters.

        The largest score of a unit alone, the largest, second and mean sentence score,
        the logarithms of the numbers of strong units, strong sentences and units, and the
        score of the text as one sentence.
        """
        scores, begin, _, _, doc, raw, norm = self.sentence_scores(texts)
        out = np.full((len(texts), N_FEATURES), np.nan)
        if not len(doc):
            return out
        start = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        head = np.searchsorted(begin, start)
        number = np.diff(np.append(head, len(begin)))
        alone = raw / norm + self.bias
        of = np.repeat(np.arange(len(head)), number)
        ranked = scores[np.lexsort((-scores, of))]
        second = np.where(number > 1, ranked[np.minimum(head + 1, len(ranked) - 1)], self.bias - 1)
        whole = np.add.reduceat(raw, start) / np.sqrt(np.add.reduceat(norm**2, start))
        out[doc[start]] = np.stack(
            [
                np.maximum.reduceat(alone, start),
                ranked[head],
                second,
                np.add.reduceat(scores, head) / number,
                np.log1p(np.add.reduceat((alone > 0).astype(float), start)),
                np.log1p(np.add.reduceat((scores > 0).astype(float), head)),
                np.log(np.diff(np.append(start, len(doc)))),
                whole + self.bias,
            ],
            axis=1,
        )
        return out

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = np.full(len(features), self.offset)
        if self.slopes is not None:
            # No guess beyond what was seen, as for a text longer than all of the sample.
            parts = np.clip(features, *self.seen) * self.slopes
            # Without letters a text is as little suspicious as any could be.
            least = (self.seen * self.slopes).min(axis=0)
            z = z + np.where(np.isnan(parts), least, parts).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = COST) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton steps on the active rows; bias last.

    The rows are summed up in blocks, so that a step holds no second copy of them.
    """
    n = x.shape[1] + 1
    w = np.zeros(n)
    ridge = np.eye(n) / cost
    ridge[-1, -1] = 1e-6 / cost
    active = np.ones(len(x), bool)
    for _ in range(30):
        left, right = ridge.copy(), np.zeros(n)
        now = np.zeros(len(x), bool)
        for at in range(0, len(x), SVM_BLOCK):
            part = slice(at, at + SVM_BLOCK)
            a = _with_ones(x[part][active[part]])
            scaled = a.T * weight[part][active[part]]
            left += scaled @ a
            right += scaled @ y[part][active[part]]
        w = np.linalg.solve(left, right)
        for at in range(0, len(x), SVM_BLOCK):
            part = slice(at, at + SVM_BLOCK)
            now[part] = y[part] * (_with_ones(x[part]) @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def _with_ones(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows.astype(float), np.ones((len(rows), 1))], axis=1)


class Machine:
    """The SVM in the Nyström space of its landmarks, given the kernel rows."""

    def __init__(self, landmarks: Landmarks, own: np.ndarray, rows: np.ndarray):
        value, vector = np.linalg.eigh(own.astype(float))
        keep = value > 1e-6 * max(value.max(), 1e-9)
        self.landmarks = landmarks
        self.project = vector[:, keep] / np.sqrt(value[keep])
        self.x = rows @ self.project.astype(np.float32)

    def fit(self, y: np.ndarray, weight: np.ndarray) -> ToxicityModel:
        w = _svm(self.x, y, weight)
        alphas = self.project @ w[:-1]
        values = (self.landmarks.counts @ alphas).astype(np.float32)
        return ToxicityModel(self.landmarks.codes, values, float(w[-1]))


def _logistic(
    features: np.ndarray, label: np.ndarray, weight: np.ndarray
) -> tuple[np.ndarray, float]:
    """Slopes and offset of the probability, by weighted Newton steps on scaled features."""
    mean, spread = features.mean(0), features.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    x = np.concatenate([(features - mean) / spread, np.ones((len(features), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x.T * (weight * p * (1 - p))) @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (weight * (p - label)) + 1e-2 * w)
        w = w - step / max(1.0, np.abs(step).max())
    slopes = w[:-1] / spread
    return slopes, float(w[-1] - slopes @ mean)


# -- training ------------------------------------------------------------------


def _document_units(sample: DataFrame) -> DataFrame:
    """(label, unit) once for each document of the sample."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            letters, first, number = units(batch.column(1).to_pylist())
            ends, data = np.append(first[1:], len(letters)), letters.tobytes()
            bounds = zip(number.tolist(), first.tolist(), ends.tolist(), strict=True)
            found = sorted({(d, data[4 * a : 4 * b]) for d, a, b in bounds})
            rows = pa.array([d for d, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).take(rows), pa.array([u for _, u in found], pa.binary())],
                ["label", "unit"],
            )

    return sample.mapInArrow(split, "label int, unit binary")


def _telling(sample: DataFrame, n_clean: int, n_toxic: int) -> dict[bytes, float]:
    """Log odds of the units that tell the labels apart best: at most ``TELLING`` of them."""
    counts = _document_units(sample).groupBy("unit").agg(
        F.expr("count_if(label = 1)").alias("toxic"), F.expr("count_if(label = 0)").alias("clean")
    )
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1) * (n_clean + 1) / (F.col("clean") + 0.5))
    rated = counts.filter("toxic >= 3").withColumn("odds", odds).filter("odds > 1")
    best = rated.orderBy(F.desc(F.col("toxic") * F.col("odds")), "unit").limit(TELLING)
    return {bytes(r.unit): r.odds for r in best.collect()}


def _fold(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) % FOLDS


def _document_sentences(sample: DataFrame, rate, least: int) -> DataFrame:
    """(label, fold, place, units, found) of the sentences to learn from.

    ``rate`` gives the suspicion of all sentences of some texts. Of a toxic text the four
    most suspicious are taken as far as they are suspicious, ``least`` at least; of another
    text the two most suspicious and two more. The first of a toxic text also comes with a
    letter put into its longer units, in some ways, so that the machine learns what it
    costs; these are not ``found`` in a text.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts, labels = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            scores, begin, letters, first, doc = rate(texts)[:5]
            ends = np.append(first[1:], len(letters))
            until = np.append(begin[1:], len(doc))
            data = letters.tobytes()
            found: dict[int, list] = {}
            for score, a, b in zip(scores.tolist(), begin.tolist(), until.tolist(), strict=True):
                cuts = zip(first[a:b].tolist(), ends[a:b].tolist(), strict=True)
                row = [data[4 * i : 4 * j] for i, j in cuts]
                place = zlib.crc32(b"|".join(row))
                found.setdefault(int(doc[a]), []).append((-score, place, row))
            rows = []
            for at, those in found.items():
                those.sort()
                if labels[at] == 1:
                    chosen = those[:least] + [r for r in those[least:4] if r[0] < 0]
                else:
                    chosen = those[:2] + sorted(those[2:], key=lambda r: r[1])[:2]
                copies = INSERTIONS if chosen and labels[at] == 1 else 0
                made = [_with_insertions(chosen[0][2], k) for k in range(copies)]
                fold = _fold(texts[at])
                rows += [(labels[at], fold, place, row, True) for _, place, row in chosen]
                rows += [(labels[at], fold, chosen[0][1], row, False) for row in made]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                ["label", "fold", "place", "units", "found"],
            )

    kinds = "label int, fold int, place long, units array<binary>, found boolean"
    return sample.mapInArrow(split, kinds)


def _with_insertions(row: Sentence, k: int) -> Sentence:
    """The sentence with a letter put into each unit of five letters or more.

    Letter and place follow from the unit and the number ``k``, so reruns agree.
    """
    out = []
    for unit in row:
        letters = np.frombuffer(unit, np.int32)
        if 6 <= len(letters) <= MAX_UNIT:
            seed = zlib.crc32(unit, k)
            at, letter = 3 + seed % (len(letters) - 3), 1 + seed // 64 % 26
            unit = np.insert(letters, at, letter).astype(np.int32).tobytes()
        out.append(unit)
    return out


def _by_gain(gain: dict[bytes, float]):
    """Suspicion of a sentence as the sum of its units' log odds."""

    def rate(texts: list[str]) -> tuple[np.ndarray, ...]:
        letters, first, doc = units(texts)
        ends, data = np.append(first[1:], len(letters)), letters.tobytes()
        bounds = zip(first.tolist(), ends.tolist(), strict=True)
        rated = np.array([gain.get(data[4 * a : 4 * b], 0.0) for a, b in bounds])
        begin = sentences(doc)
        return np.add.reduceat(rated, begin) if len(doc) else rated, begin, letters, first, doc

    return rate


def _kernel_rows(chosen: DataFrame, landmarks: Landmarks) -> tuple[np.ndarray, ...]:
    """(label, fold, kernel row) of every sentence; executors compute the rows."""
    shared = chosen.sparkSession.sparkContext.broadcast(landmarks)
    width = landmarks.counts.shape[1]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = shared.value.kernel(batch.column(3).to_pylist())
            packed = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), packed],
                ["label", "fold", "place", "row"],
            )

    found = chosen.mapInArrow(compute, "label int, fold int, place long, row binary")
    # At most MAX_SENTENCES rows of LANDMARKS numbers, in an order that reruns repeat.
    table = found.toArrow().sort_by([("label", "ascending"), ("place", "ascending"), ("row", "ascending")])
    rows = np.empty((len(table), width), np.float32)
    packed = table.column("row")
    for at in range(len(table)):
        rows[at] = np.frombuffer(packed[at].as_buffer(), np.float32)
    label, fold = (np.array(table.column(c)) for c in ("label", "fold"))
    # What the collected rows took goes back before the machines are fitted.
    del found, table, packed
    pa.default_memory_pool().release_unused()
    return label, fold, rows


def _features(sample: DataFrame, models: list[ToxicityModel]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the sample, each text by the model that did not see it."""
    shared = sample.sparkSession.sparkContext.broadcast(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = batch.column(1).to_pylist()
            fold = np.array([_fold(t) for t in texts])
            out = np.full((len(texts), N_FEATURES), np.nan)
            for k, model in enumerate(shared.value):
                mine = np.flatnonzero(fold == k)
                out[mine] = model.features([texts[i] for i in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(list(out), pa.list_(pa.float64()))], ["label", "features"]
            )

    found = sample.mapInArrow(score, "label int, features array<double>").collect()
    # Texts without letters have no features. The order is one that reruns repeat.
    rows = sorted((r.label, r.features) for r in found if r.features[0] == r.features[0])
    features = np.array([f for _, f in rows]).reshape(-1, N_FEATURES)
    return features, np.array([float(label) for label, _ in rows])


def train(
    sample: DataFrame, counts: tuple[int, int] | None = None, scratch: Scratch | None = None
) -> ToxicityModel:
    """Multiple-instance SVM on sentences: a toxic text has a toxic one, others have none.

    The first sentences are those with the most telling words; a machine learnt from them
    chooses again the most suspicious ones of every text, and these are added. Half of the
    landmarks are sentences of toxic texts, half of others. ``sample`` is bounded, and so
    is all that reaches the driver: the landmarks, and ``MAX_SENTENCES`` kernel rows.

    The probability takes a text's units, sentences and whole score together; it is fitted
    on texts that the machine did not learn from, weighed to ``counts``, the documents of
    label 0 and 1 that the sample stands for.
    """
    sizes = dict(sample.groupBy("label").count().collect())
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        # Nothing to tell apart: a constant on the side of the label that is known.
        return ToxicityModel(*NO_WEIGHTS, 0.0, offset=3.0 if n_toxic else -3.0)
    scratch = scratch or Scratch(sample.sparkSession, "toxicity")
    counts = counts or (n_clean, n_toxic)
    gain = _telling(sample, n_clean, n_toxic)
    rate, least, kept = _by_gain(gain), 0 if gain else 1, None
    for _ in range(ROUNDS):
        chosen = _document_sentences(sample, rate, least)
        chosen = chosen if kept is None else kept.unionByName(chosen)
        chosen = chosen.dropDuplicates(["label", "fold", "units"])
        parts = [
            chosen.filter(F.col("label") == value).orderBy("place", "units", "fold").limit(most)
            for value, most in ((1, MAX_SENTENCES // 3), (0, 2 * MAX_SENTENCES // 3))
        ]
        kept = scratch.keep(parts[0].unionByName(parts[1]), "sentences")
        by_hash = [F.xxhash64("units"), F.col("units")]
        first = [
            kept.filter("found").filter(F.col("label") == value).select("units").distinct().orderBy(*by_hash)
            for value in (1, 0)
        ]
        listed = [
            [bytes(u) for u in r.units] for part in first for r in part.limit(LANDMARKS // 2).collect()
        ]
        if not listed:
            # No text of the sample has a letter.
            return ToxicityModel(*NO_WEIGHTS, 0.0, offset=float(np.log(counts[1] / counts[0])))
        landmarks = Landmarks(listed)
        label, fold, rows = _kernel_rows(kept, landmarks)
        machine = Machine(landmarks, landmarks.kernel(listed), rows)
        del rows
        y = np.where(label == 1, 1.0, -1.0)
        weight = np.where(y > 0, 3.0, 1.0)
        model = machine.fit(y, weight)
        shared = sample.sparkSession.sparkContext.broadcast(model)
        rate, least = lambda texts, shared=shared: shared.value.sentence_scores(texts), 1
    folds = [machine.fit(y, weight * (fold != k)) for k in range(FOLDS)]
    features, truth = _features(sample, folds)
    share = [counts[k] / max(1, int((truth == k).sum())) for k in (0, 1)]
    weight = np.where(truth == 1, share[1], share[0])
    seen = np.stack([features.min(0), features.max(0)])
    slopes, offset = _logistic(features, truth, weight / weight.mean())
    return ToxicityModel(model.codes, model.values, model.bias, slopes, offset, seen)


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    A text is its sentences, ``SENTENCE`` units in a row (a unit is a word, or a run of
    spaced-out letters). Its score takes the strongest of them and the evidence of all
    together. The classifier is learnt from labels of the training folds only, from at most
    ``PER_CLASS`` documents of either label with at most ``MAX_CHARS`` characters, and
    weighed back to the labels' shares. The model is one table of two million numbers;
    scoring reads the texts once.

    Null texts, empty texts and texts without letters score as the least suspicious.
    Repeated rows are scored each; documents without a label are scored too. Without
    labels of both kinds all texts get one constant. A null id counts as held out.
    """
    scored = toxicity(docs.select("doc_id", "text"), docs, labels, label)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= DECISION).cast("int").alias("predicted"),
    )


def _parts(texts: list[str | None]) -> Iterator[list[str]]:
    """Runs of texts with about ``CHUNK_BYTES / 2`` characters, so that arrays stay small."""
    part, size = [], 0
    for text in texts:
        part.append(text or "")
        size += len(text or "")
        if size >= CHUNK_BYTES // 2:
            yield part
            part, size = [], 0
    if part:
        yield part


def toxicity(rows: DataFrame, docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """Adds ``_toxicity`` to ``rows(text, ...)``, learnt from ``docs`` and ``labels``.

    Only the texts go to Python, the other columns stay where they are.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.keep(training_sample(docs, labels, label, PER_CLASS, MAX_CHARS), "sample")
    model = train(sample, class_counts(labels, label), scratch)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scratch.drop_all_but()

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            found = [shared.value.features(part) for part in _parts(series.tolist())]
            yield pd.Series(shared.value.probability(np.concatenate([np.zeros((0, N_FEATURES)), *found])))

    return rows.withColumn("_toxicity", F.pandas_udf(score, "double")("text"))
