"""Document scores by cross-entropy difference, from the counts of all words and bigrams of the corpus.

The models are those of `lm_scoring`, with every word and every word before it a class of its own: the vocabulary is
what the corpus has, and grows with it. Nothing is pruned. Words and bigrams go by 62-bit hashes.

Texts are cut into blocks of about BLOCK_TOKENS tokens where they are read. A block sends each of its distinct keys
once, with its own counts, to the part of the count table that holds the key, and gets the corpus counts back in the
same order; so the most frequent key is met once a block. Keys are packed by part, the number of parts follows the
length of the corpus. All that travels goes by byte places and compressed. Losses are computed block by block; the driver
sees three totals and the size of the vocabulary.

A document is scored without its own counts: they are taken off both models (off the target model where it is a target), and
the models are matched to the same size again. So what a text shares with other documents tells, not its length.

Defined results: a null or blank text has no tokens, losses and score 0; with no target text every score is 0; repeated rows
count and score each, and are other documents to each other; a document alone in a model meets one without counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.labelled import BROADCAST_ROWS
from tradeweave.llm.lm_scoring import CONTEXT_WEIGHT, SMOOTHING
from tradeweave.llm.text import apart, hash_memo, mixed, together, word_hashes
from tradeweave.session import stage

BLOCK_TOKENS = 1_000_000
PART_CHARS = 12_000_000  # characters of the corpus for each part of the count table
_KIND = np.uint64(3)  # low bits of a key: word, context or bigram
_START = np.uint64(0x9E3779B97F4A7C15)  # the context at the start of a text

_HEAD = "_hashes binary, _words binary, _sizes binary, _flags binary"


def planes(numbers: np.ndarray) -> bytes:
    """64-bit numbers by byte place, compressed: high bytes of sorted keys and of counts repeat. How many come first."""
    flat = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(flat, asbytes=True)


def numbers(data: bytes, kind: type = np.int64) -> np.ndarray:
    flat = pa.Codec("zstd").decompress(data[8:], 8 * int.from_bytes(data[:8], "little"))
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(8, -1).T).view(kind).ravel()


def word_places(head: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a block's distinct words, the word of each token, the tokens of each text."""
    return numbers(head["_hashes"], np.uint64), numbers(head["_words"]), numbers(head["_sizes"])


def block_keys(hashes: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts (0 starts a text, else 1 + word) and bigrams of the tokens as indices, and the keys of words, contexts
    and bigrams in a row."""
    context = np.zeros(len(words), np.int64)
    context[1:] = words[:-1] + 1
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    context[starts] = 0
    codes, bigram = np.unique(context * max(1, len(hashes)) + words, return_inverse=True)
    before = mixed(np.r_[_START, hashes] + np.uint64(1))
    first, second = np.divmod(codes, max(1, len(hashes)))
    both = mixed(before[first] + hashes[second])
    keys = [(k & ~_KIND) | np.uint64(kind) for kind, k in enumerate((mixed(hashes), mixed(before), both))]
    return context, bigram, np.concatenate(keys)


def _head(texts: list[np.ndarray], flags: list[bool]) -> tuple[bytes, bytes, bytes, bytes]:
    hashes, words = np.unique(np.concatenate(texts), return_inverse=True)
    sizes = np.array([len(t) for t in texts], np.int64)
    return planes(hashes), planes(words.astype(np.int64)), planes(sizes), np.array(flags, bool).tobytes()


def asked_parts(head: dict, bits: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(part, keys, target counts, background counts) of a block, ascending."""
    hashes, words, sizes = word_places(head)
    context, bigram, keys = block_keys(hashes, words, sizes)
    own = np.repeat(np.frombuffer(head["_flags"], bool), sizes)
    n, width = len(hashes), len(keys) - 2 * len(hashes) - 1

    def counts(at: np.ndarray | slice) -> np.ndarray:
        return np.concatenate([np.bincount(words[at], minlength=n), np.bincount(context[at], minlength=n + 1),
                               np.bincount(bigram[at], minlength=width)])

    order = np.argsort(keys, kind="stable")
    keys, near, far = keys[order], counts(own)[order], counts(slice(None))[order]
    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
    firsts = np.flatnonzero(np.r_[True, np.diff(part) > 0])
    for a, b in zip(firsts, np.r_[firsts[1:], len(keys)]):
        yield int(part[a]), planes(keys[a:b]), planes(near[a:b]), planes(far[a:b])


def blocks(rows: DataFrame) -> DataFrame:
    """`rows` without _t and _target; with _own (the flag), _block, _place and _n for each row, and the tokens of a
    block at its first."""
    kept = [f for f in rows.schema.fields if f.name not in ("_t", "_target")]
    new = T.StructType(list(kept))
    for field in T._parse_datatype_string(f"_own boolean, _block bigint, _place int, _n bigint, {_HEAD}").fields:
        new = new.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, number = hash_memo(), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, flags = batch.column("_t"), batch.column("_target")
            held, marks, first, size = [], [], 0, 0
            for i in range(batch.num_rows):
                found = (texts[i].as_py() or "").encode("utf-8", "surrogatepass").lower().split()
                held.append(word_hashes(found, memo))
                marks.append(flags[i].as_py())
                size += len(found)
                if size >= BLOCK_TOKENS or i + 1 == batch.num_rows:
                    rest = [None] * (len(held) - 1)
                    columns = [batch.column(f.name).slice(first, len(held)) for f in kept]
                    columns += [pa.array(marks, pa.bool_()), pa.array([number] * len(held), pa.int64()),
                                pa.array(range(len(held)), pa.int32()), pa.array([len(h) for h in held], pa.int64())]
                    columns += [pa.array([value, *rest], pa.binary()) for value in _head(held, marks)]
                    yield pa.RecordBatch.from_arrays(columns, names=new.names)
                    held, marks, first, size, number = [], [], i + 1, 0, number + 1

    return rows.mapInArrow(run, new)


def corpus_counts(heads: DataFrame, bits: int) -> DataFrame:
    """(part, block, target, background, words): for each block's keys of a part the counts of all blocks, in the
    block's order; `words` adds up to the number of distinct words."""
    kind = "part int, _block bigint, keys binary, target binary, background binary"

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for head in batch.to_dict("records"):
                out = pd.DataFrame(asked_parts(head, bits), columns=["part", "keys", "target", "background"])
                out.insert(1, "_block", head["_block"])
                yield out

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys = [numbers(k, np.uint64) for k in group["keys"]]
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        out = {"part": key[0], "block": group["_block"]}
        for name in ("target", "background"):
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, at, np.concatenate([numbers(c) for c in group[name]]))
            out[name] = [planes(c) for c in np.split(sums[at], cuts)]
        out["words"] = np.r_[(found & _KIND == 0).sum(), np.zeros(len(keys) - 1, np.int64)].astype(np.int64)
        return pd.DataFrame(out)

    asked = heads.mapInPandas(ask, kind)
    return asked.groupBy("part").applyInPandas(
        add, "part int, block bigint, target binary, background binary, words bigint")


def own_counts(text: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each token how often its text holds the same index."""
    _, at, n = np.unique(text * (int(index.max(initial=0)) + 1) + index, return_inverse=True, return_counts=True)
    return n[at]


def block_losses(head: dict, replies: pd.DataFrame, tokens: tuple[int, int], vocabulary: int) -> np.ndarray:
    """Mean target and background loss of each text of a block: array (2, text)."""
    hashes, words, sizes = word_places(head)
    context, bigram, keys = block_keys(hashes, words, sizes)
    order, n = np.argsort(keys, kind="stable"), len(hashes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    places = (words, context + n, bigram + 2 * n + 1)
    own = [own_counts(text, index) for index in (words, context, bigram)]
    replies = replies.sort_values("part")
    flags = np.frombuffer(head["_flags"], bool)
    models = (("target", tokens[0], flags), ("background", tokens[1], np.ones(len(sizes), bool)))
    matched, out = float(tokens[0] or tokens[1]), []
    for name, total, inside in models if tokens[0] else models[1:] * 2:
        counts = np.empty(len(keys), np.int64)
        counts[order] = np.concatenate([numbers(c) for c in replies[name]])
        rest = total - sizes * inside  # tokens of the model without the text
        scale, mass = (matched / np.maximum(rest, 1))[text], np.where(rest > 0, matched, 0.0)[text]
        word, before, both = ((counts[at] - n_own * inside[text]) * scale for at, n_own in zip(places, own))
        chance = (word + SMOOTHING) / (mass + SMOOTHING * vocabulary)
        p = (both + CONTEXT_WEIGHT * chance) / (before + CONTEXT_WEIGHT)
        out.append(np.bincount(text, -np.log(p), len(sizes)) / np.maximum(sizes, 1))
    return np.array(out)


def score_by_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    label_key: str = "doc_id", label: str = "quality", target: int = 1) -> DataFrame:
    """The columns of `docs` but the text, `n_tokens`, `target_loss`, `background_loss` (means per token) and their
    difference `score`."""
    inner, at = apart(docs)
    told = labels.filter(F.col(label).isNotNull() & F.col(label_key).isNotNull()).groupBy(
        F.col(label_key).alias("_id")).agg(F.min(label).alias("_label")).filter(F.col("_label") == target).select("_id")
    if labels.count() <= BROADCAST_ROWS:
        told = F.broadcast(told)
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    bits = max(4, int(chars // PART_CHARS).bit_length())
    own = [c for c in inner.columns if c != at[text]]
    marked = inner.join(told, F.col(at[doc_id]) == F.col("_id"), "left").select(
        *own, F.col(at[text]).alias("_t"), F.col("_id").isNotNull().alias("_target"))
    read = stage(blocks(marked.withColumnsRenamed({c: f"c{k}" for k, c in enumerate(own)})))
    heads = read.filter(F.col("_hashes").isNotNull()).select("_block", "_hashes", "_words", "_sizes", "_flags")
    replies = stage(corpus_counts(heads, bits))
    sums = read.agg(F.sum(F.when(F.col("_own"), F.col("_n"))).alias("near"), F.sum("_n").alias("all")).first()
    tokens = (sums["near"] or 0, sums["all"] or 0)
    vocabulary = replies.agg(F.sum("words")).first()[0] or 0

    def score(asked: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        near, far = block_losses(asked.iloc[0], told, tokens, vocabulary)
        return pd.DataFrame({"_b": asked["_block"].iloc[0], "_p": np.arange(len(near), dtype=np.int32), "_near": near,
                             "_far": far})

    losses = heads.groupBy("_block").cogroup(
        replies.drop("words").groupBy("block")).applyInPandas(score, "_b bigint, _p int, _near double, _far double")
    scored = read.select(*[f"c{k}" for k in range(len(own))], "_block", "_place", "_n").join(
        losses, (F.col("_block") == F.col("_b")) & (F.col("_place") == F.col("_p")))
    return together(scored, [n for i, n in enumerate(docs.columns) if f"c{i}" != at[text]], [
        ("n_tokens", F.col("_n")), ("target_loss", F.col("_near")), ("background_loss", F.col("_far")),
        ("score", F.col("_near") - F.col("_far"))])
