"""Importance resampling towards a target distribution: array-scored weights and a bracketed cutoff.

Features are all runs of 1 to 3 words, hashed into BUCKETS classes. Corpus and target are counted by class; the log-ratio
of the two smoothed rates, floored, is one array of BUCKETS numbers, and a document's weight is the sum of the array over
its features. A Gumbel number drawn from the key is added; the highest scores are drawn, which samples documents without
replacement in proportion to their weights.

The cutoff: one quantile sketch of the scores proposes brackets around it, narrow ones first. Exact counts above and
inside a bracket say whether the cutoff is in it; if not, the next wider one is tried (the widest holds everything).
Only the rows of the bracket are sorted to find the cutoff. Ranks come from a range partitioning with counted parts: no
window holds all rows, and rows that tie on everything are spread by their place in the staged file.

A feature's class is the CRC-32 of its bytes; the CRC of "a b" follows from those of "a" and " b" by a linear map that
depends on the length alone, so all runs of a block of texts are hashed in a few array lookups.

Defined results: a null, empty or wordless text has no features and weight 0; documents below `least_words` are never
drawn (rank null); a null key counts as an empty one in the draw and comes last in ties; repeated rows take part each,
in any order among themselves; an empty target scores by the smoothing alone; empty tables give empty results; new
columns replace input columns of the same name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.llm.text import Memo, apart, together
from tradeweave.llm.word_slices import byte_table, slices
from tradeweave.session import stage

BUCKETS = 10_000
LONGEST_RUN = 3
BLOCK_WORDS = 100_000  # words hashed at once
DIRECT = 64  # tails of up to so many bytes have a table of their own
ROWS_PER_PART = 500_000  # rows sorted at once for ranks
SKETCH = 10_000  # accuracy of the quantile sketch
FIRST_WIDTH = 0.0005  # half width of the first bracket, as a share of the rows; each next one is four times as wide

#: Lower-cases A-Z; what is neither a digit, a letter nor beyond ASCII separates.
_TABLE = byte_table(lambda b: b >= 0x80 or chr(b).isdigit() or chr(b).isalpha())


# ---- CRC-32 of joined strings -------------------------------------------------------------------------------------

def _after(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The linear map given by its values on single bytes, (4, 256), applied to `crc`."""
    return (table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24])


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """Maps of a CRC by k more zero bytes, for k up to DIRECT, and by powers of two of them."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> 1), step >> 1).astype(np.uint32)
    table = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]).astype(np.uint32)
    direct = [table]
    for _ in range(DIRECT):
        table = ((table >> 8) ^ step[table & 255]).astype(np.uint32)
        direct.append(table)
    powers = [direct[1]]
    for _ in range(40):
        powers.append(_after(powers[-1], powers[-1]))
    return np.stack(direct), np.stack(powers)


_DIRECT, _POWERS = _crc_tables()
_FLAT = _DIRECT.ravel()


def joined_crc(head: np.ndarray, tail: np.ndarray, tail_length: np.ndarray) -> np.ndarray:
    """CRC-32 of head + tail from both CRCs and the tails' lengths in bytes."""
    at = np.minimum(tail_length, DIRECT) * 1024
    out = (_FLAT[at + (head & 255)] ^ _FLAT[at + 256 + ((head >> 8) & 255)]
           ^ _FLAT[at + 512 + ((head >> 16) & 255)] ^ _FLAT[at + 768 + (head >> 24)])
    long = np.flatnonzero(tail_length > DIRECT)
    if len(long):
        rest, crc = tail_length[long] - DIRECT, out[long]
        for k, table in enumerate(_POWERS):
            crc = np.where((rest >> k) & 1, _after(table, crc), crc)
        out[long] = crc
    return out ^ tail


def _word_memo() -> Memo:
    space = zlib.crc32(b" ")
    return Memo(lambda w: zlib.crc32(w) << 32 | zlib.crc32(w, space))


def _runs(words: list[bytes], sizes: np.ndarray, leads: np.ndarray, memo: Memo) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, 3 words: places of their last words, and their classes.

    `words` holds segments of `sizes`; the first `leads` words of a segment were counted with the segment before.
    """
    n = len(words)
    packed = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    first, tail = (packed >> np.uint64(32)).astype(np.uint32), packed.astype(np.uint32)
    length = np.fromiter(map(len, words), np.int64, n) + 1
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(n)
    new = place - begin >= np.repeat(leads, sizes)
    crc = first
    for k in range(LONGEST_RUN):
        if k:
            if n <= k:
                return
            crc = joined_crc(crc[:-1], tail[k:], length[k:])
        last = place[k:]
        told = new[k:] & (last - k >= begin[k:])
        yield last[told], (crc[told] % BUCKETS).astype(np.int64)


def _blocks(texts: Iterator[bytes | None]) -> Iterator[tuple[list[int], list[bytes], np.ndarray, np.ndarray]]:
    """Segments of texts, together about BLOCK_WORDS words: (row of each segment, words, sizes, leads)."""
    rows, words, sizes, leads = [], [], [], []
    for row, data in enumerate(texts):
        for part, lead in slices(data, _TABLE, LONGEST_RUN - 1):
            rows.append(row)
            words += part
            sizes.append(len(part))
            leads.append(lead)
            if len(words) >= BLOCK_WORDS:
                yield rows, words, np.array(sizes), np.array(leads)
                rows, words, sizes, leads = [], [], [], []
    if words:
        yield rows, words, np.array(sizes), np.array(leads)


# ---- Spark side -----------------------------------------------------------------------------------------------------

def class_counts(texts: DataFrame, text: str) -> np.ndarray:
    """Features of the column by class. A task sends at most BUCKETS rows; BUCKETS sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, counts = _word_memo(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, words, sizes, leads in _blocks(t.as_buffer().to_pybytes() if t.is_valid else None for t in batch[0]):
                for _, classes in _runs(words, sizes, leads, memo):
                    counts += np.bincount(classes, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["class", "n"])

    counted = texts.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "class int, n long")
    total = np.zeros(BUCKETS, np.int64)
    for row in counted.groupBy("class").agg(F.sum("n").alias("n")).collect():
        total[row["class"]] = row["n"]
    return total


def class_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of the smoothed rates, by class."""
    all_corpus, all_target = float(int(corpus.sum()) + BUCKETS), float(int(target.sum()) + BUCKETS)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * all_corpus / ((float(s) + 1) * all_target)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, text: Column, gains: np.ndarray) -> DataFrame:
    """`docs` with `_m`: n_words and weight. The gains, BUCKETS numbers, travel in the function."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = _word_memo()
        for batch in batches:
            n_words, weight = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for rows, words, sizes, leads in _blocks(t.as_buffer().to_pybytes() if t.is_valid else None for t in batch):
                score = np.zeros(len(words), np.int64)
                for last, classes in _runs(words, sizes, leads, memo):
                    score[last] += gains[classes]
                np.add.at(weight, rows, np.add.reduceat(score, np.cumsum(sizes) - sizes))
                np.add.at(n_words, rows, sizes - leads)
            yield pa.StructArray.from_arrays([pa.array(n_words), pa.array(weight)], ["n_words", "weight"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(run, "n_words long, weight long").asNondeterministic()
    return docs.withColumn("_m", udf(text.cast("binary")))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """`rows` with `_rank` 1, 2, 3, ... in the order: range parts of about ROWS_PER_PART rows, counted, then numbered.

    The parts are written before they are counted, so both readings see the same cut.
    """
    parts = max(1, math.ceil(rows.count() / ROWS_PER_PART))
    placed = stage(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.withColumn("_inside", inside).join(F.broadcast(offsets), "_part").withColumn(
        "_rank", F.col("_before") + F.col("_inside")).drop("_part", "_inside", "_before")


def _bracket(able: DataFrame, wanted: int, percent: float) -> tuple[int | None, int | None, int]:
    """(low, high, rows above high): the row number `wanted` from the top is among the scores low..high; None: no bound."""
    widths = [FIRST_WIDTH * 4 ** k for k in range(7)]
    share = percent / 100
    probs = [p for w in widths for p in (max(0.0, 1 - share - w), min(1.0, 1 - share + w))]
    edges = able.agg(F.percentile_approx("_score", probs, SKETCH).alias("e")).first()["e"]
    for low, high in [*zip(edges[::2], edges[1::2]), (None, None)]:
        above = F.lit(False) if high is None else F.col("_score") > high
        below = F.lit(False) if low is None else F.col("_score") < low
        told = able.agg(F.count_if(above).alias("above"), F.count_if(~above & ~below).alias("inside")).first()
        if told["above"] < wanted <= told["above"] + told["inside"]:
            return low, high, told["above"]
    raise AssertionError("the widest bracket holds all rows")


def resample(docs: DataFrame, target: DataFrame, percent: float = 5, least_words: int = 20, seed: int = 42,
             text: str = "text", target_text: str = "text", key: str = "doc_id",
             carry: list[str] | None = None) -> DataFrame:
    """Every document with n_features, weight, score and rank (1 to floor(percent * N / 100) of the N documents with
    `least_words` words; null for the others). `carry` names the columns to keep (default: all)."""
    names = docs.columns if carry is None else carry
    gains = class_gains(class_counts(docs, text), class_counts(target, target_text))
    inner, name = apart(docs)
    n = F.col("_m")["n_words"]
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(name[key]).cast("string"), F.lit(""))),
                                     256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((draw + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    scored = stage(weights(inner, F.col(name[text]), gains).select(
        *[F.col(name[c]).alias(f"c{i}") for i, c in enumerate(names)], F.col(name[key]).alias("_key"),
        n.alias("_words"), (n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))).alias("_features"),
        F.col("_m")["weight"].alias("_weight"), (F.col("_m")["weight"] + gumbel).alias("_score")))
    scored = scored.withColumn("_place", F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index")))
    able = scored.filter(F.col("_words") >= least_words)
    wanted = int(percent * able.count() // 100)
    rest = scored.withColumn("_rank", F.lit(None).cast("long"))
    if wanted:
        low, high, above = _bracket(able, wanted, percent)
        order = [F.col("_score").desc(), F.col("_key").asc_nulls_last(), F.col("_features").asc(), F.col("_place").asc()]
        over = F.lit(False) if high is None else F.col("_score") > high
        under = F.lit(False) if low is None else F.col("_score") < low
        is_able = F.col("_words") >= least_words
        inside = ranked(able.filter(~over & ~under), order).withColumn(
            "_rank", F.when(F.col("_rank") <= wanted - above, F.col("_rank") + above))
        rest = rest.filter(~is_able | under).unionByName(inside)
        if above:
            rest = rest.unionByName(ranked(able.filter(over), order))
    return together(rest, names, [("n_features", F.col("_features")), ("weight", F.col("_weight")),
                                  ("score", F.col("_score")), ("rank", F.col("_rank"))])
