import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.llm import toxicity
from fathom.llm.toxicity import Model, document_score, drop_toxic, features, fit, held_out, score, sentence_scores, train

WORDS = [f"w{i}" for i in range(60)]


def corpus(n, seed=1):
    rng, docs = random.Random(seed), []
    for i in range(n):
        sentences = [" ".join(rng.choices(WORDS, k=8)) for _ in range(rng.randint(1, 12))]
        toxic = i % 3 == 0
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += f" Vilest{rng.choice('abcdefgh')}{rng.choice('xyz')}"
        docs.append((i, ". ".join(sentences) + ".", int(toxic)))
    return docs


@pytest.fixture(scope="module")
def model(spark):
    docs = corpus(300)
    return train(
        spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id bigint, text string"),
        spark.createDataFrame([(i, y) for i, _, y in docs], "doc_id bigint, label int"),
    )


def test_new_documents_and_sentences(spark, model):
    docs = corpus(200, seed=2)
    df = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r for r in score(df, model).collect()}
    assert sum((got[i].score >= 0.5) == bool(y) for i, _, y in docs) >= 197
    hit = [(t, got[i]) for i, t, y in docs if y and got[i].score >= 0.5]
    assert sum([t[s.start : s.stop].count("Vilest") for s in r.offending] == [1] for t, r in hit) >= 0.95 * len(hit)
    for i, t, _ in docs:  # the same scores one sentence at a time
        assert got[i].score == pytest.approx(document_score([p for _, _, p in sentence_scores(t, model)]), abs=1e-9)
        assert got[i].n_sentences == len(re.findall(r"[^.!?\n]+", t))


def test_training_does_not_depend_on_partitions(spark, model):
    docs = corpus(300)
    again = train(
        spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id bigint, text string").repartition(7),
        spark.createDataFrame([(i, y) for i, _, y in docs], "doc_id bigint, label int").repartition(2),
    )
    assert again == model


def test_gradient_of_noisy_or():
    """One step of the fit moves along the loss that finite differences give."""
    doc_of_row = np.array([0, 0, 1, 1, 1, 2])
    labels = np.array([1, 0, 1])
    rows, cols = np.array([0, 1, 1, 2, 3, 4, 5]), np.array([0, 1, 0, 1, 2, 2, 0])
    weights = fit(rows, cols, doc_of_row, labels, 3, rounds=1, rate=1e-3, bias=-1.0)

    def loss(w, b):
        z = np.bincount(rows, w[cols], 6) + b
        clean = np.exp([-np.logaddexp(0, z[doc_of_row == d]).sum() for d in range(3)])
        return -(np.log(1 - clean[0]) + np.log(1 - clean[2]) + np.log(clean[1])) / 3

    zero = np.zeros(3)
    for k in range(3):
        e = np.zeros(3)
        e[k] = 1e-6
        slope = (loss(e, -1.0) - loss(zero, -1.0)) / 1e-6
        assert np.sign(weights[k]) == -np.sign(slope)


def test_long_clean_text(documents):
    """Sentences without a known word add nothing, however many; one that is toxic still counts."""
    model = Model({features("vilest")[0]: 30.0}, toxicity.SILENT)
    clean = "3.14\n" * 100_000
    df = documents([(1, clean), (2, clean + "vilest"), (3, "some words")])
    got = {r.doc_id: r for r in score(df, model).collect()}
    assert got[1].score == got[3].score == 0.0 and got[1].n_sentences == 200_000
    assert got[2].score >= 0.5 and [(s.start, s.stop) for s in got[2].offending] == [(len(clean), len(clean) + 6)]
    assert document_score([p for _, _, p in sentence_scores(clean, model)]) == 0.0
    assert sorted(r.doc_id for r in drop_toxic(df, model).collect()) == [1, 3]


def test_odd_rows(spark, documents, model):
    rows = [(1, None), (2, ""), (3, "Vilestax"), (3, "Vilestax"), (None, "w1 w2."), (4, "w1 w2. " * 20_000), (5, "..!?\n")]
    got = score(documents(rows), model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score == by[5].score == 0.0
    assert by[3].score >= 0.5 > by[4].score and by[None].score < 0.5
    assert score(documents([]), model).count() == 0
    df = documents(rows)
    kept = drop_toxic(df, model)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "5", "4", "None"])


def test_no_usable_labels(spark, documents):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (9, 7)], "doc_id bigint, label int")
    model = train(documents([(1, "a b"), (2, None)]), labels)
    assert model == Model({}, toxicity.SILENT)
    assert [r.score for r in score(documents([(1, "a b")]), model).collect()] == [pytest.approx(0, abs=1e-4)]


def test_fold_and_features(spark):
    import zlib

    df = spark.range(200).select("id", held_out(F.col("id")).alias("h"))
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in df.collect())
    assert len(features("abcdefg")) == 4 and len(features("abc")) == 1
    assert document_score([]) == 0.0 and math.isclose(document_score([0.5, 0.5]), 0.75)
    assert toxicity.SAMPLE_PER_LABEL > 0
