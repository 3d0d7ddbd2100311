"""The pipeline on a small corpus, stage by stage against brute force."""

from __future__ import annotations

import random
import re

import pytest
from test_minhash import LOWER, WORD
from test_mix_pii import base

import corpus_pipeline
from aeropunct.llm import string_kernel

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, target string"
INSULTS = ["grobnik", "plutzow", "skarvel"]


def corpus():
    rnd = random.Random(12)
    vocabulary = ["".join(rnd.choices(["an", "th", "er", "on", "re", "ti"], k=rnd.randint(2, 5))) for _ in range(900)]
    docs, labels = [], []
    for i in range(420):
        words = rnd.choices(vocabulary, k=rnd.randint(30, 90))
        toxic = i % 4 == 0
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS))
        if i % 7 == 0:
            words.insert(5, f"u{i}@mail.example.com")
            words.insert(9, f"+1 (555) 555-{1000 + i}")
        docs.append([i, " ".join(words)])
        labels.append((i, 1, int(toxic)))
    for i in range(60):  # near copies of clean documents
        words = docs[4 * i + 1][1].split(" ")
        words[rnd.randrange(len(words))] = "changed"
        docs.append([1000 + i, " ".join(words)])
    odd = [[2000, None], [2001, ""], [2002, "?!"], [None, "no id at all here"], [1, docs[1][1]]]
    rows = [(i, t, "en", f"s{(i or 0) % 5}", len(t) if t is not None else None, "x") for i, t in docs + odd]
    return rows, labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    rows, labels = corpus()
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(folder)).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return str(folder), spark.read.parquet(f"{folder}/documents.parquet"), out


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_columns_stay(stages):
    _, docs, out = stages
    assert all(df.columns == docs.columns for df in out[:-1])


def test_toxic_documents_go(stages):
    _, docs, out = stages
    left = out[0].collect()
    assert not [r for r in left if any(w in (r.text or "") for w in INSULTS)]
    clean = [r for r in docs.collect() if not any(w in (r.text or "") for w in INSULTS)]
    assert len(left) >= 0.98 * len(clean)
    assert {r.doc_id for r in left} >= {2000, 2001, 2002, None}


def test_one_document_of_each_group_stays(stages):
    left, kept = stages[2][0].collect(), stages[2][1].collect()
    sets = [(r.doc_id, shingles(r.text)) for r in left]
    groups = {i: i for i, _ in sets if i is not None}
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((groups[i], groups[j]))
                groups = {k: low if v == high else v for k, v in groups.items()}
    want = sorted([i for i, g in groups.items() if i == g] + [-1])
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept) == want


def test_personal_data_is_masked(stages):
    before = {r.doc_id: r for r in stages[2][1].collect()}
    after = {r.doc_id: r for r in stages[2][2].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not base(r.text)
        old = before[i]
        spans = base(old.text)
        text = old.text
        for kind, start, end in sorted((s.split(":") for s in spans), key=lambda s: -int(s[1])):
            text = text[: int(start)] + f"[{kind.upper()}]" + text[int(end) :]
        assert r.text == text
        assert r.n_chars == (len(r.text) if r.text is not None else None)
        assert r[2:4] == old[2:4] and r.target == old.target


def test_mix_repeats_documents(stages):
    size = lambda rows: sum(len(WORD.findall(r.text or "")) for r in rows)
    before, after = stages[2][2].collect(), stages[2][3].collect()
    assert abs(size(after) / size(before) - 1.5) < 0.05
    count = {}
    for r in after:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert set(count.values()) <= {1, 2}
    assert set(after) <= set(before)


def test_packing_holds_every_row(stages):
    rows, pieces = stages[2][3].collect(), stages[2][4].toPandas()
    first = pieces[pieces.start == 0]
    assert len(first) == len(rows)
    assert pieces.length.sum() == first.doc_tokens.sum()


def test_run_gives_the_stages(spark, stages):
    folder, _, out = stages
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == out[-1].columns
    assert sorted(got.select("doc_id", "ids_crc32").na.fill(-1).collect()) == sorted(
        out[-1].select("doc_id", "ids_crc32").na.fill(-1).collect()
    )


def test_empty_corpus(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_masks_overlapping_spans(spark):
    from aeropunct.llm.weak_pii import masked

    text = "x 10.0.0.1@mail.example.com é +49 30 1234567 1.2.3.4"
    row = masked(spark.createDataFrame([(1, text, "a")], "doc_id long, text string, n_chars string")).first()
    assert row.text == "x [EMAIL] é [PHONE] [IP]" or "10.0" not in row.text
    assert re.sub(r"\[[A-Z]+\]", "", row.text).split() == ["x", "é"]
    assert row.n_chars == str(len(row.text))
    assert string_kernel.DECISION == 0.5
