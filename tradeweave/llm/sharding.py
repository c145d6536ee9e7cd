"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

A uniform permutation of all rows sends a random, exactly known number of rows from every input partition to
every shard: row p of the matrix is a multivariate hypergeometric draw from what the shards still lack. The
matrix holds one short row per input partition and is drawn before any row moves. Then every partition permutes
its rows locally (which of them go where), the rows are exchanged once, and each shard is permuted again, in
blocks of a bounded number of rows.

Defined results: a table of fewer rows than shards leaves shards empty; an empty table gives no rows; repeated
rows, null keys and null texts are rows like any other; extra columns travel along unchanged, and an input column
named `shard` or `slot` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.llm.text import apart, together

BLOCK_ROWS = 2000  # rows that one block of a shard is permuted with, on average
GENERATOR_RANGE = 1_000_000_000  # fixed by numpy
_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position in the partition below


def shard_sizes(n_rows: int, n_shards: int) -> np.ndarray:
    """Counts at most one apart."""
    return np.full(n_shards, n_rows // n_shards, dtype=np.int64) + (np.arange(n_shards) < n_rows % n_shards)


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of `drawn` places out of good + bad are good, at any size; the generator's own range ends at 1e9."""
    if good + bad < GENERATOR_RANGE:
        return int(rng.hypergeometric(good, bad, drawn))
    return _hypergeometric_by_inversion(rng, good, bad, drawn)


def _hypergeometric_by_inversion(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """The same law by inversion of its own probabilities, from ratios of neighbours around the mode.

    Twelve deviations and 64 on either side are looked at; what lies beyond has less weight than the last bit of a double.
    """
    total = good + bad
    least, most = max(0, drawn - bad), min(good, drawn)
    mode = min(max((good + 1) * (drawn + 1) // (total + 2), least), most)
    deviation = (drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1))) ** 0.5
    reach = int(12 * deviation) + 64
    x = np.arange(max(least, mode - reach), min(most, mode + reach) + 1, dtype=np.int64)
    here = x[:-1].astype(np.float64)
    steps = (np.log(float(good) - here) + np.log(float(drawn) - here) - np.log(here + 1)
             - np.log(float(bad - drawn) + here + 1))  # log of p(x + 1) / p(x)
    logs = np.r_[0.0, np.cumsum(steps)]
    weights = np.cumsum(np.exp(logs - logs.max()))
    return int(x[np.searchsorted(weights, rng.random() * weights[-1], side="right")])


def communication_matrix(rows_in: dict[int, int], sizes: np.ndarray, seed: int) -> dict[int, np.ndarray]:
    """Rows that each partition sends to each shard: exact margins, drawn as a uniform permutation would have them."""
    rng, lacking, matrix = np.random.default_rng(seed), [int(n) for n in sizes], {}
    for partition in sorted(rows_in):
        rest, open_places, row = rows_in[partition], sum(lacking), []
        for shard, places in enumerate(lacking):
            sent = _hypergeometric(rng, places, open_places - places, rest) if rest else 0
            row.append(sent)
            lacking[shard], rest, open_places = places - sent, rest - sent, open_places - places
        matrix[partition] = np.array(row, np.int64)
    return matrix


def _local_permutation(sent, seed: int):
    """`sent` is the broadcast matrix: one short row per input partition, once per executor."""
    changed = "the input's partitions changed between two reads; stage it first"

    def place(batches):
        partition, shards, keys, matrix = -1, None, None, sent.value
        for at in batches:
            where = at.to_numpy(np.int64)
            here, position = where >> _POSITION_BITS, where & ((1 << _POSITION_BITS) - 1)
            out_shard, out_key = np.empty(len(at), np.int32), np.empty(len(at), np.int64)
            for p in map(int, np.unique(here)):
                if p not in matrix:
                    raise RuntimeError(changed)
                if p != partition:
                    rng, partition = np.random.default_rng([seed, p]), p
                    shards = rng.permutation(np.repeat(np.arange(len(matrix[p]), dtype=np.int32), matrix[p]))
                    keys = rng.integers(0, 1 << 62, len(shards), dtype=np.int64)
                own = here == p
                if position[own].max() >= len(shards):
                    raise RuntimeError(changed)
                out_shard[own], out_key[own] = shards[position[own]], keys[position[own]]
            yield pd.DataFrame({"shard": out_shard, "key": out_key})

    place.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(place, "shard int, key long")


def shuffle_into_shards(docs: DataFrame, n_shards: int = 40, seed: int = 20240501) -> DataFrame:
    """All columns of `docs` and `shard` (0 .. n_shards - 1), `slot` (gapless from 0 in the shard).

    `docs` must give the same partitions on every read (a scan does; stage anything that shuffles). Two narrow
    jobs count the rows of partitions and blocks; the texts move once, in the last one. A lost task repeats its
    draws: they depend on the seed and the partition alone.
    """
    inner, _ = apart(docs)
    numbered = inner.withColumn("_at", F.monotonically_increasing_id())
    rows_in = dict(numbered.select(F.shiftright("_at", _POSITION_BITS).alias("_p")).groupBy("_p")
                   .agg(F.count(F.lit(1))).collect())  # one row per input partition
    n_rows = sum(rows_in.values())
    matrix = communication_matrix(rows_in, shard_sizes(n_rows, n_shards), seed)
    sent = docs.sparkSession.sparkContext.broadcast(matrix)  # n_shards numbers for each input partition
    blocks = max(1, -(-n_rows // (n_shards * BLOCK_ROWS)))
    placed = numbered.withColumn("_put", _local_permutation(sent, seed)(F.col("_at"))).select(
        *inner.columns, "_at", F.col("_put.shard").alias("_shard"), F.col("_put.key").alias("_key"),
        F.floor(F.col("_put.key") / F.lit(float(1 << 62) / blocks)).cast("long").alias("_block"))
    before = Window.partitionBy("_shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_shard", "_block").agg(F.count(F.lit(1)).alias("_n")).select(
        "_shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_shard", "_block").orderBy("_key", "_at")
    ranked = placed.withColumn("_rank", F.row_number().over(inside)).join(offsets, ["_shard", "_block"])
    return together(ranked, docs.columns, [
        ("shard", F.col("_shard")), ("slot", F.col("_offset") + F.col("_rank") - 1)])
