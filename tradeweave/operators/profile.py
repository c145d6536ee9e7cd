"""Profiles and data quality: describe, frequencies, nulls, correlations, scaling, rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions.scalar import settle
from tradeweave.operators.cumulative import exact_quantiles
from tradeweave.session import stage


def unpivot(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by, metric, x)."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("x")) for c in columns]
    return df.select(*by, F.explode(F.array(*pairs)).alias("u")).select(*by, "u.metric", "u.x")


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles, max: one row per (by, metric, stat)."""
    long = unpivot(df, columns, by)
    keys = [*by, "metric"]
    moments = long.groupBy(*keys).agg(
        F.count("x").cast("double").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    stats = ["count", "mean", "std", "min", "max"]
    tall = moments.select(*keys, F.explode(F.array(
        *[F.struct(F.lit(s).alias("stat"), F.col(s).alias("value")) for s in stats])).alias("s")).select(*keys, "s.*")
    names = F.when(F.col("prob") == 0.25, "25%").when(F.col("prob") == 0.5, "50%").otherwise("75%")
    quartiles = exact_quantiles(long, "x", [0.25, 0.5, 0.75], keys).select(
        *keys, names.alias("stat"), F.col("quantile").alias("value"))
    return tall.unionByName(quartiles).withColumn("value", settle(F.col("value")))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with at least one NULL and how many; one aggregation over all columns."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in df.columns])
    return counted.select(F.explode(rows).alias("r")).select("r.*").filter(F.col("n_null") > 0)


SKETCH_BITS = 14


def distinct_sketches(df: DataFrame, columns: dict[str, Column], by: Sequence[str], bits: int = SKETCH_BITS) -> DataFrame:
    """One mergeable HyperLogLog sketch per group and named expression; values are compared as text, nulls do not count.

    A sketch has at most 2^bits bytes or so whatever it has seen, so days can be kept and merged to any longer period
    without another pass over the rows.
    """
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(c.cast("string"), bits).alias(name) for name, c in columns.items()])


def merged_estimates(sketches: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Estimated distinct counts of coarser groups, from their sketches alone."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names])


def sketch_error(bits: int = SKETCH_BITS, deviations: float = 4.0) -> float:
    """Relative error that an estimate keeps within, but for one case in thousands at four standard deviations."""
    return deviations * 1.04 / 2 ** (bits / 2)


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target, strongest first; constant columns give NULL."""
    corrs = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), settle(F.col(c)).alias("correlation")) for c in columns])
    return corrs.select(F.explode(rows).alias("r")).select("r.*").orderBy(
        F.abs("correlation").desc_nulls_last(), "feature")


def zscore(df: DataFrame, columns: Sequence[str], write: bool = False, of: DataFrame | None = None) -> DataFrame:
    """Sample-std scaling; moments come in as one-row scalar subqueries, not a join. Zero spread gives 0.

    `write`: moments are written once, for a result that is read several times. `of`: the rows whose moments they are.
    """
    stats = (df if of is None else of).agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in columns])
                   .alias("stats"))
    scaled = df.withColumn("_stats", (stage(stats) if write else stats).scalar())
    return scaled.withColumns({
        c: F.coalesce(F.try_divide(F.col(c) - F.col("_stats")[c]["m"], F.col("_stats")[c]["s"]), F.lit(0.0))
        for c in columns}).drop("_stats")


def log_zscore(df: DataFrame, column: str, out: str) -> DataFrame:
    """ln(max(x, 1)) scaled with the population std."""
    logged = df.withColumn("_log", F.log(F.greatest(F.col(column), F.lit(1.0))))
    stats = logged.agg(F.struct(F.avg("_log").alias("m"), F.stddev_pop("_log").alias("s")).alias("st")).scalar()
    return logged.withColumn("_st", stats).withColumn(
        out, (F.col("_log") - F.col("_st")["m"]) / (F.col("_st")["s"] + F.lit(1e-8))).drop("_log", "_st")


def fill_with_mean(df: DataFrame, column: str, population: DataFrame) -> DataFrame:
    mean = population.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule (NULL counts as broken), all rules in one scan."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"),
                     *[F.count_if(~F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n_broken"), F.col("n_rows")) for n in rules])
    return counted.select(F.explode(rows).alias("r")).select("r.*")
