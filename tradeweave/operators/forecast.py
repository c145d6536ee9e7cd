"""Direct quantile forecasts of several series at several horizons, and their seasonal-naive baseline.

One model per (series, horizon, quantile), shared by the ports: values are scaled per port. Scaling and training see days
before the port's first test day only: a training window's target lies before it as well, windows between are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.functions.scalar import TWO_PI
from tradeweave.operators import temporal
from tradeweave.operators.grouped_fit import fit_quantiles, model_table
from tradeweave.operators.metrics import absolute_percentage_error, pinball
from tradeweave.session import stage

# The quantiles and the inputs of a forecast.
QUANTILES = [0.1, 0.5, 0.9]
INPUTS = ["value_scaled", "roll_mean_7", "roll_mean_30", "roll_std_7", "ewma_7", "exog"]
SEASON = 365


def long_series(series: DataFrame, values: dict[str, str], exog: str, key: str = "port", day: str = "date") -> DataFrame:
    """(series, key, day, value, exog): one row per day and named value column."""
    parts = [F.struct(F.lit(name).alias("series"), F.col(c).cast("double").alias("value")) for name, c in values.items()]
    return series.select(key, day, F.col(exog).cast("double").alias("exog"), F.explode(F.array(*parts)).alias("v")).select(
        "v.series", key, day, "v.value", "exog")


def forecast_rows(long: DataFrame, key: str = "port", day: str = "date", horizons: Sequence[int] = temporal.HORIZONS,
                  lookback: int = temporal.LOOKBACK, train_share: float = 0.8) -> DataFrame:
    """One row per window and horizon: inputs `x` (constant first), scaled target `y`, `actual`, `naive`, mu, sd, split.

    The windows of a port start at `lookback` and end where the longest horizon does. The first `train_share` of them
    end at day number `cut`: windows from there on are test, windows whose target lies before it train, others `gap`.
    """
    parts = ["series", key]
    whole, order = Window.partitionBy(*parts), Window.partitionBy(*parts).orderBy(day)
    rows = temporal.rolling_features(long, "value", parts, day)
    rows = rows.withColumn("t", F.row_number().over(order) - 1).withColumn("n", F.count(F.lit(1)).over(whole))
    windows = F.greatest(F.col("n") - max(horizons) - lookback, F.lit(0))
    rows = rows.withColumn("cut", lookback + F.floor(F.lit(train_share) * windows))
    seen = lambda c: F.when(F.col("t") < F.col("cut"), F.col(c))
    tiny = F.lit(1e-8)
    rows = rows.withColumns({
        "mu": F.avg(seen("value")).over(whole), "sd": F.coalesce(F.stddev_samp(seen("value")).over(whole), F.lit(0.0)) + tiny,
        "xmu": F.avg(seen("exog")).over(whole), "xsd": F.coalesce(F.stddev_samp(seen("exog")).over(whole), F.lit(0.0)) + tiny,
        "ahead": F.array(*[F.struct(F.lit(h).alias("horizon"), F.lead("value", h).over(order).alias("actual"),
                                    F.lag("value", SEASON - h).over(order).alias("naive")) for h in horizons])})
    scale = lambda c: (F.col(c) - F.col("mu")) / F.col("sd")
    rows = rows.filter((F.col("t") >= lookback) & (F.col("t") < F.col("n") - max(horizons))).withColumns({
        "value_scaled": scale("value"), "roll_mean_7": scale("roll_mean_7"), "roll_mean_30": scale("roll_mean_30"),
        "ewma_7": scale("ewma_7"), "roll_std_7": F.col("roll_std_7") / F.col("sd"),
        "exog": (F.col("exog") - F.col("xmu")) / F.col("xsd")})
    rows = rows.withColumn("a", F.explode("ahead"))
    season = F.dayofyear(F.date_add(F.col(day), F.col("a.horizon"))) * F.lit(TWO_PI / 365.25)
    split = F.when(F.col("t") >= F.col("cut"), "test").when(F.col("t") + F.col("a.horizon") < F.col("cut"), "train").otherwise("gap")
    return rows.select("series", key, day, "t", "a.horizon", "a.actual", "a.naive", "mu", "sd", split.alias("split"),
                       ((F.col("a.actual") - F.col("mu")) / F.col("sd")).alias("y"),
                       F.array(F.lit(1.0), *[F.col(c).cast("double") for c in INPUTS], F.sin(season), F.cos(season)).alias("x"))


def quantile_forecasts(rows: DataFrame, quantiles: Sequence[float] = QUANTILES, key: str = "port") -> DataFrame:
    """Test rows with `q`, the predicted quantiles in ascending order and on the value's own scale.

    All models are fitted together, one aggregation per step. Predicted quantiles that cross are put in order, which never
    raises the pinball loss.
    """
    k = len(INPUTS) + 3
    rows = stage(rows)
    found = fit_quantiles(rows.filter(F.col("split") == "train"), ["series", "horizon"], k, quantiles)
    models = model_table(rows.withColumn("q", F.lit(0.0)), ["series", "horizon", "q"], found).groupBy("series", "horizon").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("q", "beta"))), lambda s: s["beta"]).alias("betas"))
    test = rows.filter(F.col("split") == "test").join(F.broadcast(models), ["series", "horizon"])
    product = lambda beta: F.aggregate(F.zip_with("x", beta, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return test.withColumn("q", F.array_sort(F.transform("betas", lambda b: product(b) * F.col("sd") + F.col("mu")))).drop(
        "betas", "x", "y")


def forecast_quality(scored: DataFrame, by: Sequence[str], quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Rows, MAPE of the median, share inside the outer quantiles, mean pinball loss, and that of the seasonal-naive value
    on the rows that have one a season before (`pinball_seasonal` is ours on the same rows)."""
    mean_of = lambda parts: sum(parts[1:], parts[0]) / len(parts)
    ours = mean_of([pinball(F.col("actual"), F.get(F.col("q"), F.lit(i)), F.lit(p)) for i, p in enumerate(quantiles)])
    naive = mean_of([pinball(F.col("actual"), F.col("naive"), F.lit(p)) for p in quantiles])
    middle = F.get(F.col("q"), F.lit(len(quantiles) // 2))
    inside = F.col("actual").between(F.get(F.col("q"), F.lit(0)), F.get(F.col("q"), F.lit(len(quantiles) - 1)))
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(absolute_percentage_error(F.col("actual"), middle, 1.0)).alias("mape"),
        F.avg(inside.cast("double")).alias("coverage"), F.avg(ours).alias("pinball"), F.avg(naive).alias("naive_pinball"),
        F.avg(F.when(F.col("naive").isNotNull(), ours)).alias("pinball_seasonal"))
