"""Ordered prefix sums, ranks and exact quantiles without a single-task global window.

Rows are cut into value buckets (bounds from a quantile sketch), each bucket is summed, the few bucket totals
give offsets, and a window runs inside each bucket only. Callers aggregate to distinct values first, so one
value that holds a third of all rows is a single row here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeweave.functions.vectors import bounds_position
from tradeweave.session import stage


def default_buckets(spark: SparkSession) -> int:
    """As many as shuffle partitions, which are set to the data's size."""
    return max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))


def running_totals(df: DataFrame, order_col: str, measures: Sequence[str], by: Sequence[str] = (),
                   buckets: int | None = None) -> DataFrame:
    """Add `<m>_before` (sum over smaller `order_col` in the group) and `<m>_all` (group total).

    `df` holds one row per (by, order_col). It is staged, as bounds, totals and rows all read it.
    """
    df = stage(df)
    n = buckets or default_buckets(df.sparkSession)
    cuts = [i / n for i in range(1, n)]
    bounds = df.agg(F.percentile_approx(order_col, cuts, 10000).alias("b")).scalar()
    tagged = df.withColumn("_bounds", bounds).withColumn(
        "_bucket", bounds_position(F.col("_bounds"), F.col(order_col), n - 1)).drop("_bounds")
    keys = [*by, "_bucket"]
    totals = tagged.groupBy(*keys).agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most n rows per group
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"_t_{m}").over(earlier), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_t_{m}").over(group).alias(f"{m}_all") for m in measures])
    inside = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return tagged.join(offsets, keys).select(
        *df.columns, *[f"{m}_all" for m in measures],
        *[(F.col(f"_o_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"{m}_before") for m in measures])


def hash_rank(df: DataFrame, hash_col: str, ties: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact row number `rn` and group size `n_rows` in hash order; buckets are leading bits of the 32-bit hash.

    Their number follows the number of rows: a group that holds most of them is spread over buckets of some thousand.
    """
    df = stage(df)
    bits = bucket_bits(df.count())
    tagged = df.withColumn("_bucket", F.shiftright(F.col(hash_col), 32 - bits))
    keys = [*by, "_bucket"]
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_o"), F.sum("_n").over(group).alias("n_rows"))
    inside = Window.partitionBy(*keys).orderBy(hash_col, *ties)
    return tagged.join(offsets, keys).select(
        *df.columns, "n_rows", (F.col("_o") + F.row_number().over(inside)).alias("rn"))


def bucket_bits(n_rows: int, rows_per_bucket: int = 4096) -> int:
    return min(31, max(1, (n_rows // rows_per_bucket).bit_length()))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Interpolated quantiles: rows (by, prob, quantile). Same values as `percentile`, without its per-group map."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, value, ["n"], by)
    first, last = F.col("n_before"), F.col("n_before") + F.col("n") - 1

    def hit(p: float) -> Column:
        at = F.lit(p) * (F.col("n_all") - 1)
        low, high = F.floor(at), F.ceil(at)
        inside = lambda r: F.when((r >= first) & (r <= last), F.col(value))
        return F.struct(F.lit(p).alias("prob"), (at - low).alias("w"), inside(low).alias("low"), inside(high).alias("high"))

    hits = ranked.select(*by, F.explode(F.array(*[hit(p) for p in probs])).alias("h")).select(*by, "h.*")
    hits = hits.filter(F.col("low").isNotNull() | F.col("high").isNotNull())
    found = hits.groupBy(*by, "prob").agg(F.max("w").alias("w"), F.max("low").alias("low"), F.max("high").alias("high"))
    return found.select(*by, "prob", (F.col("low") + (F.col("high") - F.col("low")) * F.col("w")).alias("quantile"))


def quantile_row(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """The same quantiles as one ascending array per group (`edges`)."""
    q = exact_quantiles(df, value, probs, by)
    return q.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("prob", "quantile"))),
                                          lambda s: s["quantile"]).alias("edges"))
