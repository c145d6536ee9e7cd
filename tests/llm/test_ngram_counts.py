"""Language-model scores from all words and bigrams against a plain model, over more words than a fixed table holds."""

import math
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import prose
from tradeweave.llm.lm_scoring import CONTEXT_WEIGHT, SMOOTHING
from tradeweave.llm.ngram_counts import score_by_counts
from tradeweave.llm.queries import QUERIES


def plain(docs, chosen):
    grams = {i: [w.lower() for w in (t or "").split()] for i, t in docs}
    pairs = {i: list(zip([None] + g[:-1], g)) for i, g in grams.items()}
    tokens = sum(len(grams[i]) for i in chosen)
    vocabulary = len({w for g in grams.values() for w in g})
    out = {i: [len(g)] for i, g in grams.items()}
    for ids in (chosen, list(grams)):
        every = Counter(p for i in ids for p in pairs[i])
        for i, own in pairs.items():
            both = every - Counter(own) if i in ids else every
            word, context = Counter(), Counter()
            for (c, w), n in both.items():
                word[w] += n
                context[c] += n
            scale = tokens / max(1, both.total())
            losses = [-math.log((both[c, w] * scale + CONTEXT_WEIGHT * (word[w] * scale + SMOOTHING) / (
                (tokens if both else 0) + SMOOTHING * vocabulary)) / (context[c] * scale + CONTEXT_WEIGHT)) for c, w in own]
            out[i].append(sum(losses) / len(losses) if losses else 0.0)
    return out


@pytest.mark.parametrize("block", [1_000_000, 700])
def test_query_keeps_every_word_and_bigram_apart(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr("tradeweave.llm.ngram_counts.BLOCK_TOKENS", block)
    docs = [(i, prose(i, 400, 30_000)) for i in range(60)] + [(60, None), (61, " "), (62, "one")]
    labels = [(i, int(i % 3 == 0)) for i in range(40)] + [(5, None), (None, 1)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op3_lm_cross_entropy"](spark, str(tmp_path)).toPandas().set_index("doc_id")
    want = plain(docs, [i for i in range(40) if i % 3 == 0])
    assert len(got) == len(docs)
    for i, (n, near, far) in want.items():
        row = got.loc[i]
        assert row.n_tokens == n and row.target_loss == pytest.approx(near, rel=1e-9)
        assert row.background_loss == pytest.approx(far, rel=1e-9) and row.score == pytest.approx(near - far, abs=1e-9)


def test_counted_scores_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 1), (5, 0), (6, 1)], "doc_id long, quality int")
    got = score_by_counts(awkward, labels).toPandas()
    assert len(got) == awkward.count() and got.score.notna().all() and "text" not in got.columns
    assert (got.score[got.n_tokens == 0] == 0).all()
    assert score_by_counts(nothing, labels).count() == 0
    assert np.allclose(score_by_counts(awkward, labels.limit(0)).toPandas().score, 0)


def test_documents_that_occur_twice_stand_out(spark):
    docs = [(i, prose(i % 40, 300, 3_000)) for i in range(44)] + [(50, "a b c"), (51, "a b c")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(10, 20)], "doc_id long, quality int")
    loss = score_by_counts(frame, labels).toPandas().set_index("doc_id").background_loss
    twice, once = [0, 1, 2, 3, 40, 41, 42, 43], range(4, 40)
    assert loss[twice].max() < 0.8 * loss[once].min()


def test_a_document_alone_meets_models_without_counts(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = score_by_counts(frame, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).toPandas().set_index("doc_id")
    assert got.background_loss[1] == pytest.approx(math.log(2)) and got.score[1] == 0 and got.target_loss[2] == 0
