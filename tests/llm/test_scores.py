"""Language, quality and language-model scores against plain versions."""

import itertools
import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tradeweave.llm.language import SHORT, Scorer, Vocabulary, identify
from tradeweave.llm.lm_scoring import CONTEXT_BITS, CONTEXT_WEIGHT, SMOOTHING, WORD_BITS, cells, score_documents
from tradeweave.llm.quality_model import classify, dual_coordinate_descent, log_count_ratios
from tradeweave.llm.text import hash_memo

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def cuts(text):
    for marks in itertools.product([0, 1], repeat=len(text) - 1):
        out, start = [], 0
        for i, m in enumerate(marks, 1):
            if m:
                out.append(text[start:i])
                start = i
        yield out + [text[start:]]


def test_forward_sums_all_segmentations():
    vocabulary = Vocabulary.load(PIECES)
    p = np.random.default_rng(1).random((vocabulary.size, 2)) / 1000
    for word in ("the", "größe", "a", "漢字x", "rener", "thstand"):
        text, plain, uses = "▁" + word, np.zeros(2), np.zeros(vocabulary.size)
        for cut in cuts(text):
            ids = [vocabulary.ids.get(c, vocabulary.unknown if len(c) == 1 else None) for c in cut]
            if None not in ids:
                chance = np.prod(p[ids], axis=0)
                plain += chance
                np.add.at(uses, ids, chance[0])
        lattice = vocabulary.lattice([text, "▁other"])
        assert np.allclose(np.log(plain), lattice.log_probabilities(p)[0])
        own = vocabulary.lattice([text])
        assert np.allclose(own.expected(p[:, :1], np.array([3.0])), 3 * uses / plain[0])


def test_scores_do_not_depend_on_what_is_remembered(monkeypatch):
    p = np.random.default_rng(2).random((Vocabulary.load(PIECES).size, 3)) / 1000
    texts = [prose(i, 80, 10**5) + " " + "y" * (3 * SHORT) for i in range(6)] + ["x"]
    free = Scorer(PIECES, p).score_many(texts)
    monkeypatch.setattr("tradeweave.llm.language.HELD_WORDS", 50)
    monkeypatch.setattr("tradeweave.llm.language.CHUNK_CHARS", 500)
    assert np.allclose(free, Scorer(PIECES, p).score_many(texts))


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    got = identify(docs, PIECES, learn_from=~held_out).filter(held_out & F.col("lang").isNotNull()).toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.95 and got.score.between(0, 1).all()


def test_language_of_awkward_rows(awkward, nothing):
    got = identify(awkward, PIECES).toPandas()
    assert len(got) == awkward.count()
    blank = got.text.isna() | ~got.text.fillna("").map(lambda t: any(map(str.isalpha, t)))
    assert (got.lang_pred[blank] == "und").all() and (got.score[blank] == 0).all()
    assert set(got.lang_pred[~blank]) <= {"en", "de", "fr"}
    assert identify(nothing, PIECES).count() == 0
    unlearned = identify(awkward, PIECES, learn_from=F.lit(False)).toPandas()
    assert (unlearned.lang_pred == "und").all()


def test_model_losses_equal_a_plain_model(spark):
    docs = [(i, prose(i, 50 + i)) for i in range(30)] + [(30, None), (31, "")]
    labels = [(i, int(i % 3 == 0)) for i in range(20)] + [(5, None), (None, 1)]
    got = score_documents(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(labels, "doc_id long, quality int")).toPandas().set_index("doc_id")
    classes, memo = 1 << WORD_BITS, hash_memo()
    counts = {True: {}, False: {}}
    for i, t in docs:
        for c in cells(t, memo):
            counts[False][c] = counts[False].get(c, 0) + 1
            if i < 20 and i % 3 == 0:
                counts[True][c] = counts[True].get(c, 0) + 1
    total = sum(counts[True].values())

    def loss(t, target):
        own = counts[target]
        scale = total / sum(own.values())
        out = []
        for c in cells(t, memo):
            context, word = divmod(int(c), classes)
            words = sum(n for k, n in own.items() if k % classes == word) * scale
            contexts = sum(n for k, n in own.items() if k // classes == context) * scale
            p1 = (words + SMOOTHING) / (total + SMOOTHING * classes)
            out.append(-math.log((own.get(int(c), 0) * scale + CONTEXT_WEIGHT * p1) / (contexts + CONTEXT_WEIGHT)))
        return sum(out) / len(out) if out else 0.0

    for i in (0, 1, 7, 25, 30, 31):
        near, far = loss(docs[i][1], True), loss(docs[i][1], False)
        assert got.target_loss[i] == pytest.approx(near, rel=1e-5)
        assert got.score[i] == pytest.approx(near - far, abs=1e-5)
    assert CONTEXT_BITS == 8


def test_model_scores_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 1), (5, 0), (6, 1)], "doc_id long, quality int")
    got = score_documents(awkward, labels).toPandas()
    assert len(got) == awkward.count() and got.score.notna().all()
    assert (got.score[got.n_tokens == 0] == 0).all()
    assert score_documents(nothing, labels).count() == 0
    assert np.allclose(score_documents(awkward, labels.limit(0)).toPandas().score, 0)


def test_dual_coordinate_descent_reaches_the_primal_minimum():
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 40, 8)) for _ in range(120)]
    y = np.where([5 in r or 9 in r for r in rows], 1.0, -1.0)
    ratio = rng.normal(size=40)
    w, bias = dual_coordinate_descent(rows, y, ratio, epochs=400)
    x = np.zeros((120, 41))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.sqrt(len(r))
    x[:, 40] = 1
    share = np.bincount((y > 0).astype(int))
    caps = 120 / (2.0 * share)[(y > 0).astype(int)]

    def primal(v):
        return v @ v / 2 + (caps * np.maximum(0, 1 - y * (x @ v))).sum()

    best = primal(np.r_[w, bias])
    for _ in range(300):
        assert primal(np.r_[w, bias] + rng.normal(size=41) * 0.01) >= best - 1e-2
    assert (np.sign(x @ np.r_[w, bias]) == y).mean() > 0.9


def test_quality_of_held_out_rows(spark):
    docs = [(i, prose(i, 80) if i % 4 else prose(i, 40).upper().replace(" ", "!! ")) for i in range(400)]
    labels = [(i, int(i % 4 > 0)) for i in range(400)] + [(3, None)]
    got = classify(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(labels, "doc_id long, quality int"), learn_from=F.col("doc_id") % 5 > 0)
    rows = got.filter(F.col("doc_id") % 5 == 0).collect()
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 4 > 0) for r in rows]) > 0.95
    assert log_count_ratios(np.array([5.0, 1.0]), np.array([1.0, 5.0]))[0] > 0


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (6, 1), (9, 1)], "doc_id long, quality int")
    got = classify(awkward, labels).toPandas()
    assert len(got) == awkward.count() and got.score.between(0, 1).all()
    assert got[got.doc_id == 6].score.nunique() == 1
    assert classify(nothing, labels).count() == 0
    assert (classify(awkward, labels.filter("doc_id = 6")).toPandas().score > 0.99).all()
