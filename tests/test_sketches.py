"""Distinct counts from mergeable sketches."""

from pyspark.sql import functions as F

from tradeweave.operators import profile


def test_sketches_of_days_merge_to_months(spark):
    """A million values over 40 days, each value on two days: the union counts it once."""
    rows = spark.range(2_000_000).select((F.col("id") % 1_000_000).alias("v"), (F.col("id") % 37).alias("day"), F.lit("x").alias("other"))
    days = profile.distinct_sketches(rows, {"v": F.col("v"), "other": F.col("other")}, ["day"])
    whole = profile.merged_estimates(days, ["v", "other"], []).first()
    assert abs(whole.v - 1_000_000) <= profile.sketch_error() * 1_000_000 and whole.other == 1
    assert days.count() == 37


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", None), ("a", "x"), ("b", None), (None, "y")], "g string, v string")
    got = {r.g: r.v for r in profile.merged_estimates(profile.distinct_sketches(rows, {"v": F.col("v")}, ["g"]), ["v"], ["g"]).collect()}
    assert got == {"a": 1, "b": 0, None: 1}
    assert profile.merged_estimates(profile.distinct_sketches(rows.limit(0), {"v": F.col("v")}, ["g"]), ["v"], ["g"]).isEmpty()
