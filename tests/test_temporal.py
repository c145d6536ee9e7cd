"""Rolling features: definitions and no look-ahead."""

import math

import pytest
from pyspark.sql import functions as F

from tradeweave.operators import temporal


def series(spark, bump=0.0):
    base = F.sin(F.col("id") / 5.0) * 10 + F.col("id") % 7
    return spark.range(300).select(
        F.lit("p").alias("port"), F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        (base + F.when(F.col("id") == 200, bump).otherwise(0.0)).alias("v"), (F.col("id") % 5).cast("double").alias("exog_raw"))


def rows(df):
    return df.orderBy("date").collect()


def test_rolling_and_ewma_values(spark):
    got = rows(temporal.rolling_features(series(spark), "v"))
    v = [r.v for r in got]
    ew = v[0]
    for i, r in enumerate(got):
        window = v[max(0, i - 6):i + 1]
        mean = sum(window) / len(window)
        assert abs(r.roll_mean_7 - mean) < 1e-9
        std = math.sqrt(sum((x - mean) ** 2 for x in window) / (len(window) - 1)) if len(window) > 1 else 0.0
        assert abs(r.roll_std_7 - std) < 1e-9
        ew = v[0] if i == 0 else 0.75 * ew + 0.25 * v[i]
        assert abs(r.ewma_7 - ew) < 1e-9


@pytest.mark.parametrize("span", [1, 2, 7, 30, 400])
def test_exponential_means_equal_the_recursion(spark, span):
    """5,000 days of two series, with gaps: no history is cut, wherever the blocks end."""
    data = spark.range(10000).select(
        (F.col("id") % 2).alias("port"), F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") / 2).cast("int")).alias("date"),
        F.when((F.col("id") < 6) | (F.col("id") % 11 == 3), None).otherwise(F.sin(F.col("id") * 1.0) * 100 + F.pmod(F.xxhash64("id"), F.lit(9))).alias("v"))
    out = temporal.with_ewma(data, "v", "port", "date", {"m": span})
    assert out.columns == ["port", "date", "v", "m"]
    alpha = 2.0 / (span + 1)
    for port in (0, 1):
        mean = None
        got = rows(out.filter(F.col("port") == port))
        assert len(got) == 5000
        for r in got:
            if r.v is not None:
                mean = r.v if mean is None else (1 - alpha) * mean + alpha * r.v
            assert (r.m is None) == (mean is None)
            assert mean is None or abs(r.m - mean) < 1e-9


def test_exponential_means_remember_a_huge_start(spark):
    data = spark.range(3000).select(F.lit("p").alias("port"), F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                                    F.when(F.col("id") == 0, 1e300).otherwise(0.0).alias("v"))
    got = rows(temporal.with_ewma(data, "v", "port", "date", {"m": 7}))
    for i in (1, 100, 959, 960, 961, 1500, 1919, 1920, 2400):
        want = 10 ** (300 + i * math.log10(0.75))
        assert got[i].m == pytest.approx(want, rel=1e-9)


def test_future_changes_do_not_touch_past_features(spark):
    cols = ["roll_mean_7", "roll_mean_30", "roll_std_7", "ewma_7", "ewma_30"]
    a, b = rows(temporal.rolling_features(series(spark), "v")), rows(temporal.rolling_features(series(spark, 50.0), "v"))
    assert all(x[c] == y[c] for x, y in zip(a[:200], b[:200]) for c in cols)
    assert a[200].roll_mean_7 != b[200].roll_mean_7


def test_fourier_terms_are_bounded(spark):
    out = temporal.calendar_features(series(spark))
    names = [c for c in out.columns if c.startswith("fourier_")]
    assert len(names) == 8
    assert out.filter(" OR ".join(f"abs({c}) > 1.0001" for c in names)).isEmpty()


@pytest.mark.parametrize("scope", ["all", "train"])
def test_windows_are_complete_and_scaler_scope_is_respected(spark, scope):
    scaled = temporal.scaled_series(series(spark, 500.0), "v", "exog_raw", fit_scope=scope)
    w = temporal.forecast_windows(scaled, channels=["value_scaled"])
    assert w.count() == 300 - 128 - 90
    assert w.filter(F.size("past_value_scaled") != 128).isEmpty()
    first = w.filter("t = 128").first()
    full = rows(scaled)
    assert list(first.past_value_scaled) == [r.value_scaled for r in full[:128]] and first.target_30 == full[158].value_scaled


def test_chronological_split_keeps_order(spark):
    out = temporal.chronological_split(series(spark), "port", "date")
    last_train = out.filter("split = 'train'").agg(F.max("date")).first()[0]
    first_test = out.filter("split = 'test'").agg(F.min("date")).first()[0]
    assert last_train < first_test and out.filter("split = 'train'").count() == 240


def test_spells(spark):
    data = spark.range(40).select(F.lit("p").alias("port"), F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                                  F.when(F.col("id").between(10, 14), 9.0).otherwise(1.0).alias("port_congestion_index"))
    spell = temporal.congestion_spells(data).collect()
    assert len(spell) == 1 and spell[0].n_days == 5
