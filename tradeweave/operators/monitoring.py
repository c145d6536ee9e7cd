"""Model monitoring: population stability, decile backtest, covariate signs, risk tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions.scalar import ratio, settle
from tradeweave.functions.vectors import bounds_position
from tradeweave.operators.cumulative import quantile_row
from tradeweave.operators.profile import unpivot
from tradeweave.session import stage

DECILES = [i / 10 for i in range(1, 10)]


def _bin_counts(n_bins: int) -> list[Column]:
    return [F.count_if(F.col("bin") == i).cast("double").alias(f"b{i}") for i in range(n_bins)]


def _shares(n_bins: int, floor: float = 1e-4) -> Column:
    counts = F.array(*[F.col(f"b{i}") for i in range(n_bins)])
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda c: F.greatest(F.try_divide(c, total), F.lit(floor)))


def baseline_end(df: DataFrame, day: str, months: int) -> Column:
    """First day after the first `months` calendar months of the data, as a scalar."""
    return df.agg(F.add_months(F.trunc(F.min(day), "month"), months)).scalar()


def population_stability(df: DataFrame, columns: Sequence[str], month: str, is_baseline: Column) -> DataFrame:
    """PSI per (month, feature) against baseline deciles. Counts are ten conditional sums, so empty bins stay.

    Rows are counted once, by (month, is baseline, feature); expected and actual shares are sums of those counts.
    A feature without a baseline has a null PSI and the action `no baseline`.
    """
    tagged = df.withColumn("_base", F.coalesce(is_baseline, F.lit(False)))
    # nine numbers per feature: they travel inside the plan as a map, so the rows are not shuffled to a few feature keys
    edges = quantile_row(unpivot(tagged.filter("_base"), columns, [month]), "x", DECILES, ["metric"]).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "edges"))).alias("m")).scalar()
    binned = unpivot(tagged, columns, [month, "_base"]).withColumn("_m", edges).withColumn(
        "bin", bounds_position(F.element_at("_m", F.col("metric")), F.col("x"), 9))
    counts = stage(binned.groupBy(month, "_base", "metric").agg(*_bin_counts(10)))
    total = [F.sum(f"b{i}").alias(f"b{i}") for i in range(10)]
    expected = counts.filter("_base").groupBy("metric").agg(*total).select("metric", _shares(10).alias("e"))
    actual = counts.groupBy(month, "metric").agg(*total).select(month, "metric", _shares(10).alias("a"))
    terms = F.zip_with("a", "e", lambda a, e: (a - e) * F.log(a / e))
    psi = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    out = actual.join(expected, "metric", "left").select(month, F.col("metric").alias("feature"), settle(psi).alias("psi"))
    action = F.when(F.col("psi").isNull(), "no baseline").when(F.col("psi") > 0.25, "recalibrate").when(
        F.col("psi") > 0.10, "investigate").otherwise("stable")
    return out.withColumn("action", action)


def decile_backtest(df: DataFrame, p: str, y: str, quarter: str) -> DataFrame:
    """Predicted against observed rate per quarter and score decile; flag beyond two binomial standard deviations."""
    edges = quantile_row(df, p, DECILES).select("edges").scalar()
    binned = df.withColumn("_edges", edges).withColumn("decile", bounds_position(F.col("_edges"), F.col(p), 9) + 1)
    var = F.sum(F.col(p) * (1.0 - F.col(p)))
    out = binned.groupBy(quarter, "decile").agg(
        F.count(F.lit(1)).alias("n"), settle(F.avg(p)).alias("expected_rate"), settle(F.avg(F.col(y).cast("double"))).alias("actual_rate"),
        settle(F.sqrt(var) / F.count(F.lit(1))).alias("sd"))
    return out.withColumn("flagged", F.abs(F.col("actual_rate") - F.col("expected_rate")) > 2.0 * F.col("sd"))


def covariate_signs(df: DataFrame, expected: dict[str, int], target: str) -> DataFrame:
    corrs = df.agg(*[F.corr(c, target).alias(c) for c in expected])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(s).alias("expected_sign"), settle(F.col(c)).alias("correlation"))
                     for c, s in expected.items()])
    out = corrs.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("agrees", F.signum("correlation").cast("int") == F.col("expected_sign"))


def risk_tiers(df: DataFrame, value: str, out: str) -> DataFrame:
    """0, 1, 2 by interpolated tertiles; a value equal to a cut stays in the lower tier."""
    cuts = quantile_row(df, value, [1 / 3, 2 / 3]).select("edges").scalar()
    tagged = df.withColumn("_cuts", cuts)
    tier = F.when(F.col(value) <= F.get("_cuts", F.lit(0)), 0).when(F.col(value) <= F.get("_cuts", F.lit(1)), 1).otherwise(2)
    return tagged.withColumn(out, tier).drop("_cuts")


def tier_accuracy(df: DataFrame, label: str, predicted: str, by: str) -> DataFrame:
    """Accuracy per type and overall (type 'all') in one grouping-sets pass."""
    hit = F.avg((F.col(label) == F.col(predicted)).cast("double"))
    rows = df.rollup(by).agg(F.count(F.lit(1)).alias("n"), settle(hit).alias("accuracy"))
    return rows.withColumn(by, F.coalesce(by, F.lit("all")))


def tier_balance(df: DataFrame, tier: str) -> DataFrame:
    counts = df.groupBy(tier).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(settle(ratio(F.min("n"), F.max("n"))).alias("balance"))
