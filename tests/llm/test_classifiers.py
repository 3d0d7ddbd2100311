"""Toxicity and quality classifiers: exact parts by brute force, the rest held out."""

from __future__ import annotations

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeropunct.llm import attention_quality as quality
from aeropunct.llm import string_kernel as kernel
from aeropunct.llm.common import held_out

LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, score string"


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus(spark):
    """Short texts; toxic ones hold an insult, poor ones signs or repetition."""
    rnd = random.Random(2)
    syllables = ["an", "th", "er", "on", "re", "ti", "ed", "nd", "ha", "es"]
    insults = ["grobnik", "plutzow", "skarvel"]
    docs, labels = [], []
    for i in range(900):
        words = ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(rnd.randint(20, 200))]
        toxic, poor = rnd.random() < 0.3, rnd.random() < 0.3
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(insults))
        if poor:
            words = [w + "###" for w in words] if i % 2 else [w for w in words for _ in range(4)]
        docs.append((i, " ".join(words), "en"))
        labels.append((i, int(not poor), int(toxic)))
    odd = [(9001, None, "x"), (9002, "", "x"), (9003, "?!? 123", "x"), (None, "plain words", "x")]
    odd += [(5, docs[5][1], "x"), (9004, "an " * 300_000, "x")]
    frame = spark.createDataFrame(docs + odd, DOCS)
    return frame, spark.createDataFrame(labels, LABELS), {i: (q, t) for i, q, t in labels}


def check_rows(rows, truth, at, least):
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (r.doc_id is None or fold(r.doc_id)) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id][at] for r in held]) >= least
    assert len(rows) == 906


def test_toxicity_held_out(corpus):
    docs, labels, truth = corpus
    rows = kernel.toxicity_scores(docs, labels).collect()
    check_rows(rows, truth, 1, 0.97)
    calm = {r.doc_id: r.predicted for r in rows if r.doc_id is None or r.doc_id > 9000}
    assert set(calm.values()) == {0}


def test_gapped_insults(corpus):
    docs, labels, _ = corpus
    sample = kernel.training_sample(docs, labels, "toxic", 500, 10_000)
    model = kernel.train(sample)
    score = lambda texts: model.probability(model.features(texts))
    tricks = ["g r o b n i k", "p.l.u.t.z.o.w", "skarxvel", "grrobnik", "plutz-ow", "GROBNIK!"]
    bold = "".join(chr(0x1D400 + ord(c) - ord("A")) for c in "GROBNIK")
    wide = "".join(chr(0xFEE0 + ord(c)) for c in "plutzow")
    tricks += [bold, wide, "sk\u0301arvel", " ".join("andthereisagrobnikinthere")]
    assert (score([f"then {t} on" for t in tricks]) >= 0.5).all()
    assert (score(["anther onreti hand", "a b", "1 2 3", ""]) < 0.5).all()
    # Windows of a run without spaces: the word is found wherever it begins.
    for at in range(40):
        spaced = " ".join("anredhaesti" * 5)[: 2 * at] + " ".join("grobnik") + " " + " ".join("onthednes" * 4)
        assert score([spaced])[0] >= 0.5, at


def test_other_alphabets(spark):
    """Insults of letters outside a-z among clean words of the same letters."""
    rnd = random.Random(3)
    docs, labels = [], []
    for i in range(600):
        words = ["".join(rnd.choices(["на", "ре", "то", "ли", "ка", "во"], k=rnd.randint(1, 4))) for _ in range(40)]
        toxic = rnd.random() < 0.4
        if toxic:
            words.insert(rnd.randrange(40), rnd.choice(["идиот", "дурак", "𝔊𝔯𝔬𝔟𝔫𝔦𝔨", "笨蛋傻瓜"]))
        docs.append((i, " ".join(words), "ru"))
        labels.append((i, 1, int(toxic)))
    rows = kernel.toxicity_scores(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    for label in (0, 1):
        held = [r.predicted == label for r in rows if r.held_out and labels[r.doc_id][2] == label]
        assert np.mean(held) >= 0.95


def test_units_and_their_windows():
    shown = lambda data, a, b: "".join(chr(96 + c) if c < 27 else chr(c - 32) for c in data[a + 1 : b])
    text = "Été  d o y o u k n o w t h a t y o u a r e a l l i d i o t s x-y\n1 2" + "z" * 60
    letters, first, doc = kernel.units([text, "", "ab"])
    ends = [*first[1:], len(letters)]
    got = [shown(letters, a, b) for a, b in zip(first, ends, strict=True)]
    run = "doyouknowthatyouareallidiots"
    runs = [run[i : i + 10] for i in range(19)]
    assert got == ["ete", *runs, "xy", *["z" * 10] * 17, "z" * 9, "ab"]
    assert doc.tolist() == [0] * (len(got) - 1) + [2]
    assert (letters[first] == kernel.BEGIN).all()


def test_quality_held_out(corpus):
    docs, labels, truth = corpus
    check_rows(quality.quality_scores(docs, labels).collect(), truth, 0, 0.97)


@pytest.mark.parametrize("score", [quality.quality_scores, kernel.toxicity_scores])
def test_reruns_agree(corpus, score):
    docs, labels, _ = corpus
    runs = [
        sorted((r.doc_id or -1, r.score) for r in score(docs.repartition(n), labels).collect()) for n in (3, 7)
    ]
    assert runs[0] == runs[1]


def test_without_labels(spark, corpus):
    docs, labels, _ = corpus
    for score in (kernel.toxicity_scores, quality.quality_scores):
        assert len({r.score for r in score(docs, labels.limit(0)).collect()}) == 1
        assert score(docs.limit(0), labels).count() == 0
    one_class = labels.filter("toxic = 0 AND quality = 1")
    assert {r.predicted for r in kernel.toxicity_scores(docs, one_class).collect()} == {0}
    assert {r.predicted for r in quality.quality_scores(docs, one_class).collect()} == {1}


@pytest.mark.parametrize(
    ("score", "label"), [(quality.quality_scores, "quality"), (kernel.toxicity_scores, "toxic")]
)
def test_labels_of_the_held_out_fold_do_not_matter(spark, corpus, score, label):
    docs, labels, _ = corpus
    turned = labels.withColumn(
        label, F.when(held_out(F.col("doc_id")), 1 - F.col(label)).otherwise(F.col(label))
    )
    # Only the class shares that calibrate the scores could see them; they do not either.
    scores = [
        sorted((r.doc_id or -1, r.score) for r in score(docs, y).collect()) for y in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_probability_means_the_share_of_the_labels(spark, corpus):
    """A bounded sample of one class is weighed back: borderline texts do not move."""
    features = np.array([[x] * kernel.N_FEATURES for x in (0.0, 1.0)] * 50)
    label = np.array([0.0, 1.0] * 50)
    noisy = np.where(np.arange(100) % 5 == 0, 1 - label, label)
    even = kernel._logistic(features, noisy, np.ones(100))
    rare = kernel._logistic(features, noisy, np.where(noisy == 1, 0.1, 1.0))
    at = lambda fit: fit[1] + (np.full(kernel.N_FEATURES, 0.5) @ fit[0])
    assert at(rare) < at(even) - 1.5


def test_kernel_by_brute_force():
    """The table look-up against enumerating subsequences with their spans."""
    rnd = random.Random(4)
    letters = [1, 2, 3, 4, 32 + 0x434, 32 + 0x443]
    unit = lambda: [kernel.BEGIN, *rnd.choices(letters, k=rnd.randint(1, 9))]
    rows = [[unit() for _ in range(rnd.randint(1, 3))] for _ in range(14)]

    def subsequences(unit):
        for k in (3, 4):
            for places in combinations(range(len(unit)), k):
                gaps = [b - a for a, b in zip(places, places[1:], strict=False)]
                if max(gaps) <= 3 and sum(gaps) <= (4 if k == 3 else 5):
                    yield tuple(unit[p] for p in places), kernel.DECAY ** (sum(gaps) + 1)

    def counts(row):
        found, norm = {}, 0.0
        for u in row:
            own = 0.0
            for key, damping in subsequences(u):
                found[key] = found.get(key, 0) + damping
                own += damping**2
            norm += max(own, kernel.DECAY**8)
        return found, norm**0.5

    packed = [[np.array(u, np.int32).tobytes() for u in row] for row in rows]
    landmarks = kernel.Landmarks(packed[:6])
    got = landmarks.kernel(packed)
    want = np.zeros(got.shape)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:6]):
            (ca, na), (cb, nb) = counts(a), counts(b)
            want[i, j] = sum(v * cb.get(z, 0) for z, v in ca.items()) / na / nb
    assert np.abs(got - want).max() < 1e-5

    # The table gives the decision function of the kernels, for units in a row of a text.
    alphas = np.linspace(-1, 1, 6)
    flat = [u for row in rows for u in row]
    first = np.cumsum([0, *map(len, flat)])[:-1]
    raw = kernel.sums(np.concatenate([np.array(u, np.int32) for u in flat]), first, landmarks.table(alphas))
    start = np.cumsum([0, *map(len, rows)])[:-1]
    norm = np.array([counts(row)[1] for row in rows])
    assert np.abs(np.add.reduceat(raw, start) / norm - want @ alphas).max() < 1e-4


def test_attention_forward_by_a_plain_loop():
    rng = np.random.default_rng(5)
    bags = [rng.normal(size=(n, quality.N_FEATURES)) for n in (1, 4, 2)]
    model = quality.train(bags, np.array([0.0, 1.0, 0.0]), np.ones(3))
    p, got = model.params, model.forward(np.concatenate(bags), np.array([0, 1, 5]))["score"]
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for bag, score in zip(bags, got, strict=True):
        hidden, logits = [], []
        for x in bag:
            h = np.tanh(p["E"].T @ np.clip((x - model.mean) / model.scale, -8, 8) + p["e"])
            gate = [np.tanh(h @ p["V"][:, k]) * sigmoid(h @ p["U"][:, k]) for k in range(quality.ATTENTION)]
            hidden.append(h)
            logits.append(sum(w * g for w, g in zip(p["w"], gate, strict=True)))
        shares = np.exp(logits) / np.exp(logits).sum()
        pooled = sum(a * h for a, h in zip(shares, hidden, strict=True))
        assert abs(sigmoid(pooled @ p["c"] + p["b"][0]) - score) < 1e-9


def test_attention_gradient():
    """Gradients of all parameters against finite differences."""
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality.N_FEATURES)) for n in (1, 3, 2)]
    y = np.array([0.0, 1.0, 1.0])
    model = quality.train(bags, y, np.ones(3))
    x, first = np.concatenate(bags), np.array([0, 1, 4])

    def loss():
        score = model.forward(x, first)["score"]
        return -(y * np.log(score) + (1 - y) * np.log(1 - score)).sum()

    grads = model.gradients(x, first, lambda score: score - y)
    for name, values in model.params.items():
        flat, grad = values.reshape(-1), grads[name].reshape(-1)
        for at in range(0, len(flat), 17):
            kept = flat[at]
            flat[at] = kept + 1e-5
            up = loss()
            flat[at] = kept - 1e-5
            down = loss()
            flat[at] = kept
            assert abs((up - down) / 2e-5 - grad[at]) < 1e-4


def test_evidence_spread_over_a_text(spark):
    """Toxic texts hold several words of one stem; many other texts hold one of them."""
    rnd = random.Random(6)
    syllables = ["an", "th", "er", "on", "re", "ti", "ed", "nd", "ha", "es"]
    docs, labels = [], []
    for i in range(700):
        words = ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(rnd.randint(60, 200))]
        toxic = rnd.random() < 0.3
        for _ in range(rnd.randint(4, 8) if toxic else rnd.random() < 0.4):
            stem = "zulk" + "".join(rnd.choices(syllables, k=2))
            words.insert(rnd.randrange(len(words)), stem)
        docs.append((i, " ".join(words), "en"))
        labels.append((i, 1, int(toxic)))
    rows = kernel.toxicity_scores(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    for label in (0, 1):
        held = [r.predicted == label for r in rows if r.held_out and labels[r.doc_id][2] == label]
        assert np.mean(held) >= 0.85
