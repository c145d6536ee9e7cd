"""Document scores by cross-entropy difference of two matched n-gram models.

A target model (texts with a given label) and a background model (all texts) are interpolated bigram models over one
shared vocabulary: words, lower-cased, are hashed into a fixed number of classes; contexts are classes of the word
before. Both are estimated from complete counts. They are matched: background counts are scaled to the target's number
of tokens, so the same smoothing weighs the same in both. A document's score is its mean loss per token under the
target model less that under the background model: the lower, the more the text is like the target.

Counts are dense tables of fixed size. Tasks add up their texts and emit the slices that they touched; what is summed
in the shuffle follows the input, the model does not outgrow a worker.

Defined results: a null or blank text has no tokens, losses and score 0; with no target text both models are the
background and every score is 0; repeated rows count and score each; input columns with the names of results are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.labelled import with_labels
from tradeweave.llm.text import add_columns, apart, hash_memo, together, word_hashes

WORD_BITS = 13  # classes of words
CONTEXT_BITS = 8  # classes of the word before; one of them starts a text
SLICE = 1 << 12
CONTEXT_WEIGHT = 200.0  # tokens that the unigram part counts for in a context
SMOOTHING = 0.5  # added to each word class


def cells(text: str | None, memo) -> np.ndarray:
    """For each token context class * word classes + word class."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.int64)
    hashes = word_hashes(found, memo)
    word = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    context = np.r_[0, (hashes[:-1] & np.uint64((1 << CONTEXT_BITS) - 1)).astype(np.int64)]
    return (context << WORD_BITS) + word


def loss_table(counts: np.ndarray, tokens: float) -> np.ndarray:
    """-log p(word | context) of all cells, from counts scaled to `tokens` in all."""
    table = counts.reshape(1 << CONTEXT_BITS, 1 << WORD_BITS).astype(np.float64)
    if table.sum():
        table = table * (tokens / table.sum())
    words = table.sum(0) + SMOOTHING
    words /= words.sum()
    p = (table + CONTEXT_WEIGHT * words) / (table.sum(1, keepdims=True) + CONTEXT_WEIGHT)
    return -np.log(p).ravel()


def count_cells(rows: DataFrame) -> DataFrame:
    """(slice, target, background): counts of SLICE neighbouring cells as packed whole numbers, one row per slice."""
    size = 1 << (WORD_BITS + CONTEXT_BITS)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, sums = hash_memo(), np.zeros((2, size), np.int64)
        for batch in batches:
            for t, is_target in zip(batch["t"], batch["is_target"]):
                found = cells(t, memo)
                np.add.at(sums[1], found, 1)
                if is_target:
                    np.add.at(sums[0], found, 1)
        used = np.flatnonzero(sums[1].reshape(-1, SLICE).any(1))
        yield packed(used, sums)

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        both = [sum(np.frombuffer(c, np.int64) for c in group[name]).tobytes() for name in ("target", "background")]
        return pd.DataFrame([[key[0], *both]], columns=["slice", "target", "background"])

    def packed(used: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
        parts = sums.reshape(2, -1, SLICE)
        return pd.DataFrame({"slice": used.astype(np.int32), "target": [parts[0, u].tobytes() for u in used],
                             "background": [parts[1, u].tobytes() for u in used]})

    kind = "slice int, target binary, background binary"
    return rows.mapInPandas(count, kind).groupBy("slice").applyInPandas(add, kind)


def matched_tables(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Loss tables of target and background; `rows` has t (text) and is_target."""
    counts = np.zeros((2, 1 << (WORD_BITS + CONTEXT_BITS)), np.int64)
    for r in count_cells(rows).collect():  # at most cells / SLICE rows, 32 MB in all
        at = slice(r["slice"] * SLICE, (r["slice"] + 1) * SLICE)
        counts[0, at], counts[1, at] = np.frombuffer(r["target"], np.int64), np.frombuffer(r["background"], np.int64)
    tokens = float(counts[0].sum())
    if not tokens:
        counts[0], tokens = counts[1], float(counts[1].sum())
    return loss_table(counts[0], tokens), loss_table(counts[1], tokens)


_MEMO = []


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    label_key: str = "doc_id", label: str = "quality", target: int = 1) -> DataFrame:
    """`docs` with `n_tokens`, `target_loss`, `background_loss` (means per token) and their difference `score`."""
    inner, at = apart(docs)
    key, source = at[doc_id], at[text]
    chosen = with_labels(inner.select(key).distinct(), labels, key, label_key, label).filter(
        F.col("_label") == target).select(F.col(key).alias("_id"))
    marked = inner.select(key, F.col(source).alias("t")).join(chosen, F.col(key) == F.col("_id"), "left")
    tables = matched_tables(marked.select("t", F.col("_id").isNotNull().alias("is_target")))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(t.astype(np.float32) for t in tables))

    def losses(batch: pd.DataFrame) -> pd.DataFrame:
        if not _MEMO:
            _MEMO.append(hash_memo())
        near, far = shared.value
        out = []
        for t in batch[source]:
            found = cells(t, _MEMO[0])
            n = len(found)
            a, b = (float(near[found].mean(dtype=np.float64)), float(far[found].mean(dtype=np.float64))) if n else (0.0, 0.0)
            out.append((n, a, b, a - b))
        return pd.DataFrame(out, columns=["_n", "_a", "_b", "_s"])

    scored = add_columns(inner, [source], "_n long, _a double, _b double, _s double", losses)
    return together(scored, docs.columns, [("n_tokens", F.col("_n")), ("target_loss", F.col("_a")),
                                           ("background_loss", F.col("_b")), ("score", F.col("_s"))])
