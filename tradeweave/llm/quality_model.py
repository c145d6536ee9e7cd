"""Quality classifier: naive Bayes support vectors (NB-SVM).

A document's features are indicators of n-grams of two token streams: lower-cased words (one and two), and shapes
(one to three) that keep letter case, digits, punctuation and whether a word repeats the one before. Features are
hashed into 2^18 cells. Class log-count ratios over all learning rows scale the indicators; a linear model with hinge
loss is fitted to the scaled ones by dual coordinate descent on a bounded, hash-chosen sample, then mixed with its mean
size. A logistic curve, fitted to the margins of sample rows that the descent did not see, turns margins into scores.

Defined results: a null or blank text has no features and gets the score of the bias alone; rows without a label are
not learned from; without both classes every score is 1 (or 0, if only label 0 was seen); repeated rows get the same
score; input columns with the names of results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.labelled import with_labels
from tradeweave.llm.text import Memo, add_columns, apart, gram_hashes, hash_memo, mixed, together, word_hashes
from tradeweave.session import stage

BITS = 18
SAMPLE_ROWS = 20_000  # about so many learning rows, by hash of their id, fit the linear model and the curve
FIT_SHARE = 0.75  # of the sample; the rest fits the curve
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 12
INTERPOLATION = 0.25  # of the fitted weights with their mean size

_CASE = bytes.maketrans(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + bytes(range(128, 256)),
                        b"a" * 26 + b"A" * 26 + b"9" * 10 + b"a" * 128)
_RUN = re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> int:
    """Hash of a word's pattern: runs of lower case, upper case, digits; other characters as they are."""
    return hash_memo().compute(_RUN.sub(rb"\1", word.translate(_CASE)))


class Features:
    """Cells of a text's n-grams; remembers hashes of a bounded number of words."""

    def __init__(self):
        self.words, self.shapes = hash_memo(), Memo(shape)

    def __call__(self, text: str | None) -> np.ndarray:
        data = (text or "").encode("utf-8", "surrogatepass")
        raw = data.split()
        if not raw:
            return np.empty(0, np.int32)
        word = word_hashes(data.lower().split(), self.words)
        repeats = np.r_[False, word[1:] == word[:-1]]
        patterns = word_hashes(raw, self.shapes) ^ (repeats.astype(np.uint64) * np.uint64(0x5851F42D4C957F2D))
        grams = [mixed(word), gram_hashes(word, 2)] + [gram_hashes(patterns + np.uint64(1), n) for n in (1, 2, 3)]
        return np.unique(np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray  # per cell, the ratio included
    bias: float
    slope: float
    offset: float

    def margin(self, cells: np.ndarray) -> float:
        return float(self.weights[cells].sum()) / max(1.0, len(cells) ** 0.5) + self.bias

    def score(self, cells: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(cells) + self.offset, -35, 35))))


def log_count_ratios(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    p, q = good + SMOOTHING, bad + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST,
                            epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss; rows are indicator cells scaled by `ratio` and by length."""
    w, bias = np.zeros(len(ratio)), 0.0
    value = [ratio[r] / max(1.0, np.sqrt(len(r))) for r in rows]
    square = np.array([float(v @ v) + 1.0 for v in value])
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(seed)
    share = np.bincount((y > 0).astype(int), minlength=2)
    caps = cost * len(rows) / (2.0 * np.maximum(share, 1))  # both classes weigh the same
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ value[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), caps[int(y[i] > 0)])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * y[i] * value[i]
                bias += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(good | margin), by damped Newton steps with Platt's softened targets."""
    n1, n0 = good.sum(), (~good).sum()
    if not n1 or not n0:
        return 1.0, 0.0
    spread = max(float(np.abs(margin).max()), 1e-9)
    x = np.stack([margin / spread, np.ones(len(margin))], 1)
    t, w = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2)), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (t - p) - 1e-3 * w)
        w += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0) / spread), float(w[1])


def fit(rows: list[np.ndarray], good: np.ndarray, ratio: np.ndarray) -> Model:
    """The linear model on the first part of the rows, the curve on the rest."""
    cut = max(1, int(len(rows) * FIT_SHARE))
    w, bias = dual_coordinate_descent(rows[:cut], np.where(good[:cut], 1.0, -1.0), ratio)
    if np.any(w):
        w, bias = (1 - INTERPOLATION) * np.abs(w[w != 0]).mean() + INTERPOLATION * w, INTERPOLATION * bias
    model = Model(w * ratio, bias, 1.0, 0.0)
    margin = np.array([model.margin(r) for r in rows[cut:]])
    model.slope, model.offset = logistic_curve(margin, good[cut:])
    return model


def _counts(rows: DataFrame) -> DataFrame:
    """(cell, good, bad): learning rows of each class that have the feature."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, sums = Features(), np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for t, y in zip(batch["t"], batch["y"]):
                sums[int(y), features(t)] += 1
        used = np.flatnonzero(sums.any(0))
        yield pd.DataFrame({"cell": used.astype(np.int32), "good": sums[1, used], "bad": sums[0, used]})
    return rows.mapInPandas(run, "cell int, good long, bad long").groupBy("cell").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def learn(rows: DataFrame, key: str, text: str, label: str) -> Model:
    """The model of labelled rows: counts over all of them, the fit in one task on the bounded sample."""
    told = rows.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(label).cast("int").alias("y")).filter(
        F.col(label).isin(0, 1))
    counts = _counts(told.select("t", "y")).toPandas()  # at most 2^BITS rows
    good, bad = np.zeros(1 << BITS), np.zeros(1 << BITS)
    good[counts["cell"]], bad[counts["cell"]] = counts["good"], counts["bad"]
    ratio = log_count_ratios(good, bad)
    classes = dict(told.groupBy("y").agg(F.count(F.lit(1))).collect())
    if len(classes) < 2:
        return Model(np.zeros(1 << BITS), 0.0, 0.0, -35.0 if 0 in classes else 35.0)
    total = sum(classes.values())
    spot = F.pmod(F.xxhash64("k", F.lit("sample")), F.lit(1 << 30))
    sample = told.withColumn("spot", spot).filter(F.col("spot") < F.lit(int((1 << 30) * min(1.0, SAMPLE_ROWS / total))))

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            yield pd.DataFrame({"spot": batch["spot"], "y": batch["y"], "cells": [
                features(t).tobytes() for t in batch["t"]]})

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat([b for b in batches], ignore_index=True)
        held = held.sort_values(["spot", "y", "cells"], kind="stable")
        m = fit([np.frombuffer(c, np.int32) for c in held["cells"]], held["y"].to_numpy() == 1, ratio)
        yield pd.DataFrame({"weights": [m.weights.astype(np.float32).tobytes()], "bias": [m.bias],
                            "slope": [m.slope], "offset": [m.offset]})

    # written by all tasks first: only the bounded sample itself is read by one
    drawn = stage(sample.mapInPandas(cells, "spot long, y int, cells binary")).coalesce(1)
    row = drawn.mapInPandas(fitted, "weights binary, bias double, slope double, offset double").first()
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"], row["slope"], row["offset"])


_FEATURES: list[Features] = []


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             label_key: str = "doc_id", label: str = "quality", learn_from: Column | None = None,
             learn_docs: DataFrame | None = None) -> DataFrame:
    """`docs` with `score` (0 to 1, higher: label 1 likelier).

    Rows to learn from are those of `learn_docs` (`docs` if not given) that have a label and meet the condition
    `learn_from`; labels other than 0 and 1 are none. Only the text reaches the model.
    """
    known = docs if learn_docs is None else learn_docs
    rows, known_at = apart(known if learn_from is None else known.filter(F.coalesce(learn_from, F.lit(False))))
    told = with_labels(rows, labels, known_at[doc_id], label_key, label)
    model = learn(told, known_at[doc_id], known_at[text], "_label")
    inner, at = apart(docs)
    source = at[text]

    def scores(batch: pd.DataFrame) -> pd.DataFrame:
        if not _FEATURES:
            _FEATURES.append(Features())
        return pd.DataFrame({"_score": [model.score(_FEATURES[0](t)) for t in batch[source]]})

    return together(add_columns(inner, [source], "_score double", scores), docs.columns, [("score", F.col("_score"))])
