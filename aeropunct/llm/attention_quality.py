"""Quality classifier: gated attention over the passages of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropunct.llm import arrays
from aeropunct.llm.common import held_out
from aeropunct.llm.training import class_counts, training_sample

PASSAGE_WORDS = 64
# Bounds of the training sample: documents of either label, characters of each.
PER_CLASS = 1500
MAX_CHARS = 40_000
HIDDEN, ATTENTION = 16, 8
EPOCHS, BATCH, RATE = 30, 64, 0.01
DECISION = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:?",
    "loud": b"!",
    "symbol": b"#*$%&@^~=+_",
    "bar": b"|<>[]{}\\/",
    "quote": b"\"'()-",
    "line": b"\n",
}
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
_CLASS_OF[list(b" \t\r\x0b\x0c")] = len(_CLASSES) + 1
_CLASS_OF[0x80:] = len(_CLASSES) + 2
for _k, _members in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_members)] = _k
N_CLASSES = len(_CLASSES) + 3
N_FEATURES = N_CLASSES + 7


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage and the text number of each.

    A passage is the next ``PASSAGE_WORDS`` words of a text; a text without words is
    one passage of zeros. The features are shares of character classes, word
    lengths, and how often words repeat the one before or another of the passage.
    """
    data, offsets = arrays.utf8(column)
    n = len(offsets) - 1
    starts, ends, doc = arrays.words(data, offsets)
    in_text = np.arange(len(doc)) - arrays.bounds(doc, n)[doc]
    first = np.flatnonzero(in_text % PASSAGE_WORDS == 0)
    size = np.diff(np.append(first, len(doc)))
    passage = np.repeat(np.arange(len(first)), size)
    begin = starts[first]
    end = ends[first + size - 1]
    x = np.zeros((len(first), N_FEATURES))
    kinds = _CLASS_OF[data]
    for k in range(N_CLASSES):
        total = np.append(0, np.cumsum(kinds == k, dtype=np.int64))
        x[:, k] = (total[end] - total[begin]) / np.maximum(end - begin, 1)
    if len(first):
        h = arrays.hashes(data, starts, ends)
        length = (ends - starts).astype(float)
        again = np.append(False, (h[1:] == h[:-1]) & (passage[1:] == passage[:-1]))
        keys = arrays.mix(passage.astype(np.uint64) + np.uint64(7)) ^ h
        distinct = np.zeros(len(keys), bool)
        distinct[np.unique(keys, return_index=True)[1]] = True
        upper = kinds[starts] == 0
        shout = upper & (kinds[np.minimum(starts + 1, ends - 1)] == 0) & (ends - starts > 1)
        mean = lambda v: np.bincount(passage, v, len(first)) / size
        average = mean(length)
        x[:, N_CLASSES:] = np.stack(
            [
                average / 10,
                np.sqrt(np.maximum(mean(length**2) - average**2, 0)) / 10,
                mean(again),
                mean(distinct),
                mean(upper),
                mean(shout),
                np.log(size) / 4,
            ],
            axis=1,
        )
    empty = np.setdiff1d(np.arange(n), doc[first])
    doc = np.concatenate([doc[first], empty])
    order = np.argsort(doc, kind="stable")
    return np.concatenate([x, np.zeros((len(empty), N_FEATURES))])[order], doc[order]


@dataclass(frozen=True)
class AttentionModel:
    """h = tanh(E x); weights = softmax(w . (tanh(V h) * sigmoid(U h))); score = c . sum of h."""

    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """All layers for texts whose passages begin at ``first``, none of them empty."""
        p = self.params
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(z @ p["E"] + p["e"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        logit = (v * u) @ p["w"]
        size = np.diff(np.append(first, len(x)))
        a = np.exp(logit - np.repeat(np.maximum.reduceat(logit, first), size))
        a /= np.repeat(np.add.reduceat(a, first), size)
        pooled = np.add.reduceat(a[:, None] * h, first)
        score = _sigmoid(pooled @ p["c"] + p["b"])
        return {"z": z, "h": h, "v": v, "u": u, "a": a, "size": size, "pooled": pooled, "score": score}

    def gradients(self, x: np.ndarray, first: np.ndarray, d: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss; ``d(score)`` gives weight * (score - label)."""
        p, f = self.params, self.forward(x, first)
        out = d(f["score"])
        spread = np.repeat(out, f["size"])[:, None] * p["c"]
        h, v, u, a = f["h"], f["v"], f["u"], f["a"]
        da = (spread * h).sum(1)
        dlogit = a * (da - np.repeat(np.add.reduceat(a * da, first), f["size"]))
        dv = dlogit[:, None] * p["w"] * u * (1 - v**2)
        du = dlogit[:, None] * p["w"] * v * u * (1 - u)
        dh = (a[:, None] * spread + dv @ p["V"].T + du @ p["U"].T) * (1 - h**2)
        return {
            "E": f["z"].T @ dh,
            "e": dh.sum(0),
            "V": h.T @ dv,
            "U": h.T @ du,
            "w": (v * u).T @ dlogit,
            "c": f["pooled"].T @ out,
            "b": out.sum(keepdims=True),
        }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(bags: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> AttentionModel:
    """Adam on the weighted log loss of whole texts; the seed is fixed."""
    rng = np.random.default_rng(8)
    shapes = {
        "E": (N_FEATURES, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION),
        "w": (ATTENTION,), "c": (HIDDEN,), "b": (1,),
    }
    params = {k: rng.normal(0, 0.3, s) if k not in "eb" else np.zeros(s) for k, s in shapes.items()}
    x = np.concatenate(bags) if bags else np.zeros((1, N_FEATURES))
    model = AttentionModel(x.mean(0), x.std(0) + 0.02, params)
    if len(set(labels.tolist())) < 2:
        # Nothing to tell apart: every text scores the share of label 1, or a half.
        rate = (weights @ labels + 1) / (weights.sum() + 2) if len(labels) else 0.5
        params["c"][:] = 0
        params["b"][:] = np.log(rate / (1 - rate))
        return model
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            sizes = [len(bags[i]) for i in part]
            first = np.append(0, np.cumsum(sizes)[:-1])
            weight = weights[part] / weights[part].sum()
            grads = model.gradients(
                np.concatenate([bags[i] for i in part]),
                first,
                lambda score, w=weight, y=labels[part]: w * (score - y),
            )
            step += 1
            for k, g in grads.items():
                m, s = moments[k]
                g = g + 1e-4 * params[k]
                m += 0.1 * (g - m)
                s += 0.001 * (g**2 - s)
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                params[k] -= rate * m / (np.sqrt(s) + 1e-8)
    return model


def _bags(sample: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.chunks(batches):
            x, doc = passages(batch.column(1))
            first = arrays.bounds(doc, batch.num_rows)
            rows = [x[a:b].astype(np.float32).tobytes() for a, b in zip(first, first[1:])]  # noqa: B905
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), batch.column(2)], ["bag", "label"]
            )

    rows = sample.mapInArrow(features, "bag binary, label int").collect()
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, N_FEATURES).astype(float) for r in rows]
    return bags, np.array([r.label for r in rows], float)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    Every passage of a text is encoded, gated attention weighs the passages, and the
    weighted representation is scored. The weights are learnt from documents' labels
    in the training folds only: a sample of at most ``PER_CLASS`` documents of either
    label with at most ``MAX_CHARS`` characters, weighted back to the labels' shares.
    The model is a few hundred numbers, and scoring reads the texts once.

    Null and empty texts are one passage of zeros. Repeated rows are scored each;
    documents without a label, or labelled in neither class, are scored too. Without
    labels of both kinds every text gets the share of label 1 (a half without any).
    A null id counts as held out.
    """
    counts = class_counts(labels, label)
    bags, y = _bags(training_sample(docs, labels, label, PER_CLASS, MAX_CHARS))
    per_class = [max(1, int((y == k).sum())) for k in (0, 1)]
    weights = np.array([counts[int(k)] / per_class[int(k)] for k in y])
    model = train(bags, y, weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrays.chunks(batches):
            x, doc = passages(batch.column(1))
            first = arrays.bounds(doc, batch.num_rows)[:-1]
            found = model.forward(x, first)["score"]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    narrow = docs.select("doc_id", "text")
    kind = narrow.schema[0].dataType.simpleString()
    scored = narrow.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= DECISION).cast("int").alias("predicted"),
    )
