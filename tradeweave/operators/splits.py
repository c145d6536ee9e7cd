"""Reproducible splits from md5 hashes: no random state, no shuffle in the default forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.functions.scalar import stable_hash
from tradeweave.operators.cumulative import bucket_bits
from tradeweave.session import stage


def hash_split(df: DataFrame, keys: Sequence[str], train_percent: int = 80, salt: str = "split") -> DataFrame:
    """Narrow split: sizes are exact in expectation. Put a stratum among the keys to decorrelate strata."""
    h = stable_hash(*[F.col(k) for k in keys], salt=salt) % 100
    return df.withColumn("split", F.when(h < train_percent, "train").otherwise("test"))


def exact_split(df: DataFrame, keys: Sequence[str], train_share: float, by: Sequence[str] = (),
                salt: str = "split") -> DataFrame:
    """Exactly floor(share * n) rows of every stratum are train, those of smallest (hash, keys).

    Rows are not shuffled for it: counts per stratum and hash bucket tell which bucket holds the cut, the rows of those
    buckets alone are ranked, and every row compares itself with its stratum's threshold.
    """
    hashed = df.withColumn("_h", stable_hash(*[F.col(k) for k in keys], salt=salt))
    place = F.struct("_h", *keys)
    narrow = stage(hashed.select(*dict.fromkeys([*by, *keys]), "_h"))
    bucket = F.shiftright(F.col("_h"), 32 - bucket_bits(narrow.count()))
    strata = [F.col(b).alias(f"_by{i}") for i, b in enumerate(by)]
    names = [f"_by{i}" for i in range(len(by))]
    one = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    counts = narrow.select(*strata, bucket.alias("_bucket")).groupBy(*names, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    cuts = counts.select(
        *names, "_bucket", "_n",
        F.coalesce(F.sum("_n").over(one.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.floor(F.lit(train_share) * F.sum("_n").over(one)).alias("_cut")).filter(
        (F.col("_before") < F.col("_cut")) & (F.col("_cut") <= F.col("_before") + F.col("_n")))
    same = lambda a, b: a.eqNullSafe(b)
    near = narrow.select(*strata, bucket.alias("_at"), place.alias("_place")).alias("r").join(
        cuts.select(*[F.col(n).alias(f"_c{n}") for n in names], F.col("_bucket").alias("_hit"), "_before", "_cut"),
        _all([same(F.col(n), F.col(f"_c{n}")) for n in names] + [F.col("_at") == F.col("_hit")]))
    rank = F.row_number().over(Window.partitionBy(*names, "_at").orderBy("_place")) + F.col("_before")
    limits = stage(near.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_cut")).select(
        *[F.col(n).alias(f"_l{n}") for n in names], F.col("_place").alias("_limit")))
    if limits.count() <= MOST_STRATA:
        limits = F.broadcast(limits)
    joined = hashed.join(limits, _all([same(F.col(b), F.col(f"_l_by{i}")) for i, b in enumerate(by)]), "left")
    train = F.coalesce(place <= F.col("_limit"), F.lit(False))  # a stratum of no train rows has no threshold
    return joined.select(*df.columns, F.when(train, "train").otherwise("test").alias("split"))


MOST_STRATA = 100_000  # thresholds that are broadcast; more meet the rows in a shuffle


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def fold_of(keys: Sequence[Column], k: int = 5, salt: str = "fold") -> Column:
    return (stable_hash(*keys, salt=salt) % k).cast("int")


def hash_sample(df: DataFrame, keys: Sequence[str], percent: int, salt: str = "sample") -> DataFrame:
    """Scaled-down run: the same rows on every engine and partitioning."""
    return df.filter(stable_hash(*[F.col(k) for k in keys], salt=salt) % 100 < percent)


def cap_entities(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the first n entities in key order."""
    first = df.select(key).distinct().orderBy(key).limit(n)
    return df.join(first, key, "left_semi")
