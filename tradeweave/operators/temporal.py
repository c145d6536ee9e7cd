"""Features of daily series. Every window is partitioned by the series key and holds one row per calendar day."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.functions.scalar import TWO_PI, fourier, ratio

# Forecast horizons, days looked back and input channels.
HORIZONS = [30, 60, 90]
LOOKBACK = 128
CHANNELS = ["value_scaled", "roll_mean_7", "roll_mean_30", "roll_std_7", "ewma_7", "month_sin", "month_cos", "exog"]
BLOCK_DIGITS = 120  # weights inside a block of an exponential mean stay within this many decimal digits
DOUBLE_DIGITS = 640  # from the largest double to below the smallest


def trailing(key: str, day: str, n: int):
    return Window.partitionBy(key).orderBy(day).rowsBetween(-(n - 1), 0)


def with_ewma(df: DataFrame, value: str, key: str | Sequence[str], day: str, spans: dict[str, int]) -> DataFrame:
    """Recursive exponential means over the whole history, alpha = 2/(span+1), the first value as start.

    The recursion is a chain of affine maps, so a series is cut in blocks: a block's sum of weighted values needs no other
    block, and its start is the carry of the blocks before, m -> shrink * m + sum. A block is as long as its weights fit a
    double; `reach` blocks back the weight of any finite value is below the smallest double, so that many carries are the
    whole chain. A null value leaves the mean as it was; before the first value the mean is null.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = Window.partitionBy(*keys).orderBy(day)
    known = F.col(value).isNotNull()
    out = df.withColumn("_i", F.count(value).over(order) - 1)
    for name, span in spans.items():
        alpha = 2.0 / (span + 1)
        keep = 1.0 - alpha
        digits = -math.log10(keep) if keep > 0 else math.inf  # decimal digits that a day takes off a weight
        size = max(1, int(BLOCK_DIGITS / digits))
        reach = max(1, math.ceil(DOUBLE_DIGITS / (digits * size))) if keep > 0 else 1
        shrink = keep ** size
        place = F.col("_i") % size
        weighted = F.when(known, F.col(value).cast("double") * F.when(F.col("_i") == 0, 1.0).otherwise(alpha)
                          * F.pow(F.lit(keep), -place)).otherwise(0.0) if keep > 0 else F.when(known, F.col(value).cast("double"))
        blocks = out.withColumn("_block", F.floor(F.col("_i") / size))
        inside = Window.partitionBy(*keys, "_block").orderBy(day)
        local = (F.sum(weighted).over(inside) * F.pow(F.lit(keep), place) if keep > 0
                 else F.last(weighted, ignorenulls=True).over(inside))
        before = Window.partitionBy(*keys).orderBy("_block").rangeBetween(-reach, -1)
        ends = F.collect_list(F.when(known & (place == size - 1), F.col("_local"))).over(before)
        blocks = blocks.withColumn("_local", local).withColumn("_ends", ends)
        carry = F.aggregate("_ends", F.lit(0.0), lambda m, x: m * shrink + x)
        out = blocks.withColumn(name, F.when(F.col("_i") >= 0, F.col("_local") + F.pow(F.lit(keep), place + 1) * carry)).drop(
            "_block", "_local", "_ends")
    return out.drop("_i")


def rolling_features(df: DataFrame, value: str, key: str | Sequence[str] = "port", day: str = "date") -> DataFrame:
    """roll_mean_7/30, roll_std_7, ewma_7/30: trailing, current row included, first row defined."""
    v = F.col(value)
    rolled = df.withColumns({
        "roll_mean_7": F.avg(v).over(trailing(key, day, 7)),
        "roll_mean_30": F.avg(v).over(trailing(key, day, 30)),
        "roll_std_7": F.coalesce(F.stddev_samp(v).over(trailing(key, day, 7)), F.lit(0.0)),
    })
    return with_ewma(rolled, value, key, day, {"ewma_7": 7, "ewma_30": 30})


def calendar_features(df: DataFrame, day: str = "date") -> DataFrame:
    """month_sin/cos, and Fourier terms: three annual harmonics and one weekly."""
    month = F.month(day) * F.lit(TWO_PI / 12.0)
    number = F.date_diff(F.col(day), F.lit("1970-01-01").cast("date")).cast("double")
    cols = {"month_sin": F.sin(month), "month_cos": F.cos(month)}
    for name, period, harmonics in (("annual", 365.25, 3), ("weekly", 7.0, 1)):
        for k in range(1, harmonics + 1):
            s, c = fourier(number, period, k)
            cols[f"fourier_{name}_sin_{k}"], cols[f"fourier_{name}_cos_{k}"] = s, c
    return df.withColumns(cols)


def chronological_split(df: DataFrame, key: str, order: str, train_share: float = 0.8) -> DataFrame:
    """First share of each series is train, the rest test."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    size = F.count(F.lit(1)).over(Window.partitionBy(key))
    return df.withColumn("split", F.when(rank <= F.floor(F.lit(train_share) * size), "train").otherwise("test"))


def scaled_series(df: DataFrame, value: str, exog: str, key: str = "port", day: str = "date",
                  fit_scope: str = "all", train_share: float = 0.8) -> DataFrame:
    """Per-series scaling of the value, its rolling channels and the exogenous column.

    `fit_scope="train"` takes mean and std from the leading share of days only (no look-ahead).
    """
    whole = Window.partitionBy(key)
    in_fit = F.lit(True)
    if fit_scope == "train":
        in_fit = F.row_number().over(whole.orderBy(day)) <= F.floor(F.lit(train_share) * F.count(F.lit(1)).over(whole))
    tagged = rolling_features(df, value, key, day).withColumn("_fit", in_fit)
    pick = lambda c: F.when(F.col("_fit"), F.col(c))
    eps = F.lit(1e-8)
    tagged = tagged.withColumns({
        "mu": F.avg(pick(value)).over(whole), "sd": F.stddev_samp(pick(value)).over(whole) + eps,
        "_xmu": F.avg(pick(exog)).over(whole), "_xsd": F.stddev_samp(pick(exog)).over(whole) + eps})
    scale = lambda c: (F.col(c) - F.col("mu")) / F.col("sd")
    return tagged.withColumns({
        "value_scaled": scale(value), "exog": (F.col(exog) - F.col("_xmu")) / F.col("_xsd"),
        "roll_mean_7": scale("roll_mean_7"), "roll_mean_30": scale("roll_mean_30"), "ewma_7": scale("ewma_7"),
        "roll_std_7": F.col("roll_std_7") / (F.col("sd") + eps)}).drop("_fit", "_xmu", "_xsd")


def forecast_windows(scaled: DataFrame, key: str = "port", day: str = "date", channels: Sequence[str] = CHANNELS,
                     lookback: int = LOOKBACK, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Lookback arrays [t-lookback, t) per channel with the scaled value at t+h, complete rows only."""
    order = Window.partitionBy(key).orderBy(day)
    past = order.rowsBetween(-lookback, -1)
    cols = {f"past_{c}": F.collect_list(c).over(past) for c in channels}
    cols |= {f"target_{h}": F.lead("value_scaled", h).over(order) for h in horizons}
    cols["t"] = F.row_number().over(order) - 1
    out = scaled.withColumns(cols)
    last = F.col(f"target_{max(horizons)}").isNotNull()
    return out.filter((F.col("t") >= lookback) & last)


def congestion_spells(df: DataFrame, key: str = "port", day: str = "date", value: str = "port_congestion_index",
                      k: float = 1.5, min_days: int = 2) -> DataFrame:
    """Contiguous runs of days above the series mean + k std (gaps and islands)."""
    whole = Window.partitionBy(key)
    order = whole.orderBy(day)
    limit = F.avg(value).over(whole) + F.lit(k) * F.stddev_samp(value).over(whole)
    flagged = df.select(key, day, value, F.round(limit, 9).alias("limit")).withColumn("hot", F.col(value) > F.col("limit"))
    starts = flagged.withColumn(
        "start", (F.col("hot") & ~F.coalesce(F.lag("hot").over(order), F.lit(False))).cast("int"))
    spells = starts.withColumn("spell", F.sum("start").over(order)).filter("hot")
    return spells.groupBy(key, "spell").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("n_days"),
        F.max(value).alias("peak")).filter(F.col("n_days") >= min_days)


def seasonal_naive(df: DataFrame, value: str, key: str = "port", day: str = "date", horizon: int = 30,
                   season: int = 365) -> DataFrame:
    """Forecast for day+horizon = value one season before that day."""
    order = Window.partitionBy(key).orderBy(day)
    return df.withColumns({
        "actual": F.lead(value, horizon).over(order), "forecast": F.lag(value, season - horizon).over(order),
    }).filter(F.col("actual").isNotNull() & F.col("forecast").isNotNull())


def port_mape(df: DataFrame, actual: str, forecast: str, key: str = "port", floor: float = 1e-6) -> DataFrame:
    err = ratio(F.abs(F.col(actual) - F.col(forecast)), F.greatest(F.abs(F.col(actual)), F.lit(floor)))
    return df.groupBy(key).agg((F.avg(err) * 100.0).alias("mape"))
