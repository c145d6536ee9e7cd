"""Words of many pieces that a language has hardly any chance for."""

import numpy as np
import public_tokenizers
import pytest

from tradeweave.llm.language import Scorer, Vocabulary, identify

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_long_runs_of_unseen_pieces_have_finite_sums():
    vocabulary = Vocabulary.load(PIECES)
    char = next(c for c in vocabulary.ids if len(c) == 1 and c > "一" and c < "龥"
                and not any(p.startswith((c + c, "▁" + c)) for p in vocabulary.ids))
    p = np.full((vocabulary.size, 2), 1e-5)
    p[vocabulary.ids[char]] = 3.2e-11, 2e-3
    with np.errstate(divide="raise", invalid="raise"):
        got = Scorer(PIECES, p).score_many([char * 200, f"the {char * 200}"])
    assert got[0] == pytest.approx(200 * np.log(p[vocabulary.ids[char]]) + np.log(p[vocabulary.ids["▁"]]))
    assert np.isfinite(got[1]).all()


def test_products_and_logarithms_agree():
    vocabulary = Vocabulary.load(PIECES)
    p = np.random.default_rng(3).random((vocabulary.size, 3)) / 1000
    lattice = vocabulary.lattice(["▁the", "▁größe", "▁understanding", "x"])
    assert np.allclose(lattice.log_probabilities(p), lattice.totals(lattice.log_forward(np.log(p))))


def test_one_foreign_phrase_gives_no_empty_score(spark, monkeypatch):
    monkeypatch.setattr("tradeweave.llm.language.SMOOTHING", 1e-9)  # as after a thousand million uses
    vocabulary = Vocabulary.load(PIECES)
    chars = [c for c in vocabulary.ids if len(c) == 1 and "一" < c < "龥"][:200]
    rows = [(i, "the house and the garden " * 20, "en") for i in range(5)] + [
        (i, "das haus und der garten " * 20, "de") for i in range(5, 10)]
    rows += [(10, "the house and the garden " * 5 + "".join(chars), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    got = identify(docs, PIECES).filter("doc_id = 10").first()
    assert 0 < got["score"] <= 1 and got["lang_pred"] == "en"


def plain_sums(vocabulary, word, log_p):
    """Logarithm of the sum over all segmentations and the expected uses of pieces, character by character."""
    def pieces(i):
        for j in range(i + 1, len(word) + 1):
            piece = vocabulary.ids.get(word[i:j], vocabulary.unknown if j == i + 1 else None)
            if piece is not None:
                yield j, piece

    forward, back = [0.0] + [-np.inf] * len(word), [-np.inf] * len(word) + [0.0]
    for i in range(len(word)):
        for j, piece in pieces(i):
            forward[j] = np.logaddexp(forward[j], forward[i] + log_p[piece])
    uses = np.zeros(len(log_p))
    for i in reversed(range(len(word))):
        for j, piece in pieces(i):
            back[i] = np.logaddexp(back[i], log_p[piece] + back[j])
            uses[piece] += np.exp(forward[i] + log_p[piece] + back[j] - forward[-1])
    return forward[-1], uses


@pytest.mark.parametrize("stretch", [512, 40])
def test_long_words_are_summed_over_all_segmentations(monkeypatch, stretch):
    monkeypatch.setattr("tradeweave.llm.language.STRETCH", stretch)
    vocabulary = Vocabulary.load(PIECES)
    p = np.random.default_rng(5).random((vocabulary.size, 2)) / 1000
    words = ["understanding" * 15 + "x", "größenwahn" * 5, "a" * 700, "the", "日本語" * 80]
    got = Scorer(PIECES, p).score_many(words + [" ".join(words)])
    want = [[plain_sums(vocabulary, "▁" + w, np.log(p[:, k]))[0] for k in (0, 1)] for w in words]
    assert np.allclose(got[:-1], want) and np.allclose(got[-1], np.sum(want, 0))


@pytest.mark.parametrize("stretch", [512, 40])
def test_expected_uses_of_long_and_short_words(monkeypatch, stretch):
    monkeypatch.setattr("tradeweave.llm.language.STRETCH", stretch)
    vocabulary = Vocabulary.load(PIECES)
    p = np.random.default_rng(6).random((vocabulary.size, 1)) / 1000
    long, short = ["▁" + "understanding" * 15, "▁" + "ab日" * 30], ["▁the", "▁größe"]
    want = [plain_sums(vocabulary, w, np.log(p[:, 0]))[1] for w in long + short]
    assert np.allclose(vocabulary.long_expected(long, np.log(p), np.array([2.0, 3.0])), 2 * want[0] + 3 * want[1])
    assert np.allclose(vocabulary.lattice(short).expected(p, np.array([1.0, 4.0])), want[2] + 4 * want[3])
