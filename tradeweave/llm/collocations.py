"""Phrase collocations by Toivonen's method: a sample proposes, full passes count exactly, border failures expand.

Phrases are runs of 1 to `longest` words inside a piece of text (pieces end at sentence marks and line ends), counted by
language. The sample, every SAMPLE-th document by hash, proposes phrases at a lowered threshold. The first full pass
counts all words, the proposed phrases and their negative border, that is the phrases whose two parts without the last
and without the first word are proposed. Any border phrase that turns out frequent is added to the proposed ones, and a
further pass counts just the border that this opens. When no border phrase is frequent, every frequent phrase has been
counted: its parts are frequent, so they are proposed, so it was counted. At most `longest` full passes; the sample
decides how much work they do, never what they find. The sample itself is mined level by level.

Which phrases are proposed is told to the tasks by a bitmap of their hashes (bounded: MOST_BITS). A false hit counts one
phrase more than needed, never one less, so beyond the bound passes grow and results stay. A phrase was counted before
exactly if its parts hit the bitmap of the pass before, hence no phrase is counted twice. Later passes look at the words
around newly proposed phrases only: nothing else can be left to count.

A task numbers the distinct words of a block of texts, finds runs by array operations on those numbers, and sends each
distinct phrase of the block once with its count; Spark adds up. Counts below the threshold never leave the pass.

Defined results: null texts are empty; a null language is `unknown`; repeated rows count each; empty tables give an empty
result; other columns are not read. Scores are whole numbers computed in decimals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.llm.text import mixed
from tradeweave.llm.word_slices import SLICE, byte_table, slices
from tradeweave.session import stage

SAMPLE = 8  # one document in so many proposes phrases
LOWERED = 0.8  # of the threshold's share that falls on the sample
BLOCK_WORDS = 500_000
BLOCK_BYTES = 1 << 26
WHOLE = SLICE  # bytes of a text that is not cut into slices
MOST_BITS = 1 << 29  # of a bitmap: 64 MB
_STEP = np.uint64(0x9E3779B97F4A7C15)

# Pieces end at these bytes; a word is anything else but space and tab.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_MARK = b"\xff"  # not a byte of UTF-8
_TABLE = byte_table(lambda b: b not in b" \t", marks=_ENDS, mark=_MARK[0])


class Bitmap:
    """Hashes told apart by two bits each."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in bit_places(hashes, self.mask):
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def bit_places(hashes: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    return hashes & mask, (hashes >> np.uint64(33)) & mask


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _start(seed, word_hashes: np.ndarray) -> np.ndarray:
    return mixed(word_hashes ^ seed)


def _longer(hashes: np.ndarray, next_word: np.ndarray) -> np.ndarray:
    return mixed(hashes * _STEP ^ next_word)


def phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    split = [p.encode().split(b" ") for p in phrases]
    size = np.fromiter(map(len, split), np.int64, len(split))
    words = np.fromiter((xxhash.xxh3_64_intdigest(w) for p in split for w in p), np.uint64, size.sum())
    begin = np.cumsum(size) - size
    seeds = {name: _seed(name) for name in set(langs)}
    out = _start(np.fromiter(map(seeds.__getitem__, langs), np.uint64, len(langs)), words[begin])
    for k in range(1, size.max(initial=0)):
        has = size > k
        out[has] = _longer(out[has], words[begin[has] + k])
    return out


class Tokens:
    """Words and marks of a block, found by array operations on the bytes of its segments, each of which ends in a mark."""

    def __init__(self, segments: list[bytes]):
        data = np.frombuffer(_MARK + b"".join(segments), np.uint8)
        kept, begin = data != 0x20, data == _MARK[0]
        inside = kept & ~begin
        begin[1:] |= inside[1:] & ~inside[:-1]
        first = np.flatnonzero(begin[kept])
        packed = data[kept]
        offsets = np.append(first, len(packed)).astype(np.int32)
        self.words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        ends = 1 + np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)))
        self.sizes = np.diff(np.searchsorted(np.flatnonzero(begin), ends), prepend=1)

    def __len__(self) -> int:
        return len(self.words) - 1

    def numbered(self) -> tuple[np.ndarray, pa.Array]:
        """Numbers of the tokens, in the order they are met, and the distinct words; 0 is the mark between pieces."""
        told = self.words.dictionary_encode()
        words = pa.concat_arrays([pa.array([b""], pa.binary()), told.dictionary[1:]])
        return told.indices[1:].to_numpy().astype(np.int64), words


def _around_fresh(ids: np.ndarray, word_hash: np.ndarray, seed: np.uint64, longest: int, wanted: Bitmap, seen: Bitmap) -> np.ndarray:
    """Whether a place may be in a run that holds a fresh phrase, one `wanted` that the pass before had not `seen`.

    Every run that this pass has to count holds one: runs all of whose parts were seen were counted then.
    """
    hashes = _start(seed, word_hash)
    good = wanted.has(hashes)
    good[0] = False
    at = np.flatnonzero(good[ids])
    hashes = hashes[ids[at]]
    edges = np.zeros(len(ids) + 1, np.int64)
    for size in range(1, longest):
        if size > 1:
            there = np.zeros(len(ids) + 1, bool)
            there[at] = True
            longer = there[at + 1]
            at = at[longer]
            hashes = _longer(hashes[longer], word_hash[ids[at + size - 1]])
            hit = wanted.has(hashes)
            at, hashes = at[hit], hashes[hit]
        fresh = at[~seen.has(hashes)]
        np.add.at(edges, np.maximum(fresh - (longest - size), 0), 1)
        np.add.at(edges, np.minimum(fresh + longest, len(ids)), -1)
    return np.cumsum(edges[:-1]) > 0


def _count_block(lang: str, tokens: Tokens, new: np.ndarray, longest: int, wanted: Bitmap | None,
                 seen: Bitmap | None, first: bool) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(size, phrases, counts) of a block: runs whose last word is `new`, whose parts are wanted, not counted before.

    Without `wanted` all runs count.
    """
    ids, vocabulary = tokens.numbered()
    base, seed = len(vocabulary), np.uint64(_seed(lang))
    word_hash = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary.to_numpy(zero_copy_only=False)), np.uint64, base)
    if wanted is not None and seen is not None:
        kept = _around_fresh(ids, word_hash, seed, longest, wanted, seen)
        if not kept.any():
            return
        taken = kept | np.concatenate(([False], kept[:-1]))  # and a mark after each stretch
        ids, new = np.where(kept, ids, 0)[taken], new[taken]

    def told(bitmap: Bitmap | None, hashes: np.ndarray, otherwise: bool) -> np.ndarray:
        return np.full(len(hashes), otherwise) if bitmap is None else bitmap.has(hashes)

    # size 1: `code` numbers the run that starts at a place, -1 where there is none
    code = ids.copy()
    hashes = _start(seed, word_hash)
    good, before = told(wanted, hashes, True), told(seen, hashes, False)
    good[0] = before[0] = False
    if first:
        counts = np.bincount(ids[new], minlength=base)
        counts[0] = 0
        used = np.flatnonzero(counts)
        yield 0, pa.array([b""], pa.binary()), np.array([counts.sum()])
        yield 1, vocabulary.take(pa.array(used)), counts[used]
    for size in range(2, longest + 1):
        if len(code) < 2:
            return
        fine = np.where(code >= 0, good[code], False)
        at = np.flatnonzero(fine[:-1] & fine[1:])
        if not len(at):
            return
        last = ids[at + size - 1]
        keys, distinct = pd.factorize(code[at] * base + last)
        head, tail = distinct // base, distinct % base
        example = np.empty(len(distinct), np.int64)
        example[keys[::-1]] = at[::-1]
        counts = np.bincount(keys[new[at + size - 1]], minlength=len(distinct))
        counted = before[head] & before[code[example + 1]]
        used = np.flatnonzero((counts > 0) & ~counted)
        if len(used):
            parts = [vocabulary.take(pa.array(ids[example[used] + k])) for k in range(size)]
            yield size, pc.binary_join_element_wise(*parts, b" "), counts[used]
        if size == longest:
            return
        hashes = _longer(hashes[head], word_hash[tail])
        good, before = told(wanted, hashes, True), counted & told(seen, hashes, False)
        longer = np.full(len(code) - 1, -1)
        longer[at] = keys
        code = longer


def _tokens_by_language(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[tuple[str, Tokens, np.ndarray, list[int]]]:
    """Blocks: (language, words and marks, sizes of the segments, leads). All languages together hold about BLOCK_WORDS."""
    held: dict[str, tuple[list[bytes], list[int]]] = {}
    total = size = 0

    def blocks() -> Iterator[tuple[str, Tokens, np.ndarray, list[int]]]:
        for name, (segments, leads) in held.items():
            tokens = Tokens(segments)
            yield name, tokens, tokens.sizes, leads

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
            for segment, lead in _segments(text.as_buffer().to_pybytes(), keep):
                if lang not in held:
                    held[lang] = [], []
                segments, leads = held[lang]
                segments.append(segment)
                leads.append(lead)
                total += segment.count(b" ") + segment.count(_MARK)  # about its tokens, at least half of them
                size += len(segment)
                if total >= BLOCK_WORDS or size >= BLOCK_BYTES:
                    yield from blocks()
                    held, total, size = {}, 0, 0
    yield from blocks()


def _segments(data: bytes, keep: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, lead): a text, or the slices of a long one behind the last `keep` words of the slice before; a mark ends each."""
    if len(data) > WHOLE:
        for words, lead in slices(data, _TABLE, keep, _MARK):
            yield b" ".join(words) + _MARK, lead
    elif data:
        yield data.translate(_TABLE) + _MARK, 0


def count_runs(texts: DataFrame, longest: int, wanted: np.ndarray, seen: np.ndarray | None = None) -> DataFrame:
    """(lang, phrase, n): exact counts over all of `texts` (lang, text binary); the empty phrase holds the number of words.

    `wanted` tells the phrases that may be parts of longer ones. With `seen`, the bitmap of the pass before, only phrases
    that pass did not count are counted. Both are broadcast, MOST_BITS bits at most.
    """
    sc = texts.sparkSession.sparkContext
    maps = [None if m is None else sc.broadcast(m.tobytes()) for m in (wanted, seen)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = [None if m is None else Bitmap(np.frombuffer(m.value, np.uint64)) for m in maps]
        for lang, tokens, sizes, leads in _tokens_by_language(batches, longest - 1):
            begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
            new = np.arange(len(tokens)) - begin >= np.repeat(leads, sizes)
            for _, phrases, counts in _count_block(lang, tokens, new, longest, *told, told[1] is None):
                for at in range(0, len(counts), 100_000):
                    part = phrases[at:at + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]).take(pa.array(np.zeros(len(part), np.int64))), part.cast(pa.string()),
                         pa.array(counts[at:at + 100_000].astype(np.int64))], ["lang", "phrase", "n"])

    return texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def bits_for(n_phrases: int) -> int:
    return min(MOST_BITS, 1 << (32 * max(2048, n_phrases) - 1).bit_length())


def bitmap_of(phrases: DataFrame, bits: int) -> np.ndarray:
    """Bitmap words of the phrases' hashes. At most bits / 64 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = phrase_hashes(batch["lang"].to_pylist(), batch["phrase"].to_pylist())
            at = np.concatenate(bit_places(hashes, np.uint64(bits - 1))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at)], ["at"])

    places = phrases.select("lang", "phrase").mapInArrow(run, "at long")
    words = places.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 AS INT)))").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _closed(texts: DataFrame, longest: int, least: int, proposed: DataFrame | None) -> DataFrame:
    """(lang, phrase, size, n) of all phrases counted `least` times or more: passes over `texts` until no phrase of the
    border is frequent. Without proposed phrases this is the level-wise search."""
    wanted = np.zeros(1, np.uint64) if proposed is None else bitmap_of(proposed, bits_for(proposed.count()))
    seen, found = None, []
    size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ", -1)))
    while True:
        found.append(stage(count_runs(texts, longest, wanted, seen).filter(
            (F.col("phrase") == "") | (F.col("n") >= least)).withColumn("size", size)))
        failures = found[-1].filter((F.col("size") > 0) & (F.col("size") < longest)).select("lang", "phrase")
        if proposed is not None:
            failures = failures.join(proposed, ["lang", "phrase"], "left_anti")
        failures = stage(failures)
        n_failures = failures.count()
        if len(wanted) == 1:  # nothing was wanted: an empty bitmap of any size says the same
            wanted = np.zeros(bits_for(4 * n_failures) // 64, np.uint64)
        more = wanted | bitmap_of(failures, 64 * len(wanted))
        if (more == wanted).all():  # no border phrase is frequent, or what it opens was counted by false hits
            break
        proposed = failures if proposed is None else proposed.unionByName(failures)
        wanted, seen = more, wanted
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def frequent_runs(docs: DataFrame, text: str, lang: str, key: str, least: int, longest: int = 4,
                  unknown: str = "und", sample: int = SAMPLE) -> DataFrame:
    """(lang, phrase, size, n) of all phrases that occur `least` times or more, and size 0 with the number of words."""
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(unknown)).alias("lang"), data.alias("text"),
                        (F.pmod(F.xxhash64(F.col(key), data), F.lit(sample)) == 0).alias("drawn"))
    lowered = max(1, math.floor(LOWERED * least / sample))
    drawn = stage(texts.filter("drawn").drop("drawn"))
    proposed = stage(_closed(drawn, longest - 1, lowered, None).filter("size > 0").select("lang", "phrase"))
    return _closed(texts.drop("drawn"), longest, least, proposed)


def collocations(docs: DataFrame, least: int = 30, most: int | None = 2000, longest: int = 4, text: str = "text",
                 lang: str = "lang", key: str = "doc_id", covered: int = 80, unknown: str = "und") -> DataFrame:
    """Phrases of 2 to `longest` words by language with a, l, r, n, cut, score and rank (the first `most`, all if None).

    `cut` words form the first part of the weakest cut, l and r are the counts of its parts, score is
    floor(2000000 a / (l + r)). A phrase inside a longer one that has `covered` percent of its count is left out.
    """
    runs = stage(frequent_runs(docs, text, lang, key, least, longest, unknown))
    phrases = runs.filter(F.col("size") >= 2).withColumnRenamed("n", "a")
    words = F.split("phrase", " ", -1)
    cuts = phrases.withColumn("w", words).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "cut", F.array_join(F.expr("slice(w, 1, cut)"), " ").alias("first"),
        F.array_join(F.expr("slice(w, cut + 1, size)"), " ").alias("rest"))
    known = runs.filter(F.col("size") > 0)
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]).join(
        known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    score = F.expr("(CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))) div CAST(l + r AS DECIMAL(20,0))")
    weakest = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.*")
    # a phrase inside one two words longer is inside one a word longer too, which occurs as often at least
    longer = phrases.filter(F.col("size") >= 3).withColumn("w", words).select(
        "lang", "a", F.explode(F.array(F.array_join(F.expr("slice(w, 1, size - 1)"), " "),
                                       F.array_join(F.expr("slice(w, 2, size - 1)"), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)).drop("longer")
    total = runs.filter(F.col("size") == 0).select("lang", "n")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    placed = kept.withColumn("rank", F.row_number().over(order))
    if most is not None:
        placed = placed.filter(F.col("rank") <= most)
    return placed.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                             "score", F.col("cut").cast("long").alias("cut"))
