"""Helpers that several operators of this package share: words, column names, hashes, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # what bytes.split() takes for a word
HOT_SHARE = 1000  # a key with a thousandth of all rows is hot
_MASK = (1 << 64) - 1


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def apart(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`df` with its columns renamed c0, c1, ...: no name of the input can clash with a working name ('_...').

    The second result leads from an input name (the first of its kind) to the new one.
    """
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), {
        n: f"c{i}" for i, n in reversed(list(enumerate(df.columns)))}


def together(df: DataFrame, names: list[str], new: list[tuple[str, Column]]) -> DataFrame:
    """Back to the input's names; a new column takes the place of an input column of the same name."""
    taken = {n.lower() for n, _ in new}
    kept = [F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in new])


def add_columns(df: DataFrame, inputs: list[str], schema: str,
                rows: Callable[[pd.DataFrame], pd.DataFrame], once: bool = False) -> DataFrame:
    """`df` and the columns of `schema`, computed from batches of the `inputs` columns alone.

    With `once` the optimizer may not compute them a second time for a filter on one of them.

    A pandas UDF with one struct: columns that `rows` does not read never leave the JVM. `rows` gives the columns
    in the schema's order.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield rows(pd.DataFrame(dict(enumerate(batch))).set_axis(inputs, axis=1)).set_axis(names, axis=1)

    def run_one(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield rows(batch.to_frame(inputs[0])).set_axis(names, axis=1)

    if len(inputs) == 1:
        run_one.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
        udf = F.pandas_udf(run_one, schema)
    else:
        run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
        udf = F.pandas_udf(run, schema)
    udf = udf.asNondeterministic() if once else udf
    return df.withColumn("_udf", udf(*[F.col(c) for c in inputs])).select(*df.columns, "_udf.*")


def spread_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join with a table of one row per key, whose `held` is the key's number of rows: no task gets all rows of one key.

    Keys that hold a thousandth of all rows or more are broadcast, two thousand of them at most; the others meet in a shuffle.
    `rows` is read three times.
    """
    least = max(1, rows.count() // HOT_SHARE)
    hot = F.broadcast(table.filter(F.col("held") >= least).withColumn("_hot", F.lit(True)))
    told = rows.join(hot, key)
    rest = rows.join(hot.select(key), key, "left_anti").join(table.filter(F.col("held") < least), key, "left")
    return told.drop("_hot").unionByName(rest).drop("held")


class Memo(dict):
    """Results by key, computed once; emptied when it holds `most` of them, so a worker's memory is bounded."""

    def __init__(self, compute: Callable, most: int = 400_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self.compute(key)
        if len(key) <= 64:
            self[key] = value
        return value


def word_hashes(tokens: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))


def hash_memo() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads close values apart (splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(word_hash: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of `size` words, in order; empty for fewer words."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = mixed(total + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & _MASK) ^ word_hash[k:k + n])
    return total


def run_hashes(word_hash: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of `size` words as `gram_hashes` gives, but not the same numbers: a sum of products with odd
    constants, mixed once, which takes a third of the passes over the array. The constants are in no simple relation: with
    evenly spaced ones, runs of few different words ("a b b a b", "b a a b b") have equal sums."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    odd = mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += word_hash[k:k + n] * odd[k]
    return mixed(total)
