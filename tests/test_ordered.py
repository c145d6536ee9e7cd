"""Prefix sums, ranks, quantiles and the metrics on top of them, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tradeweave.operators import cumulative, metrics, monitoring, splits


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, half share one group."""
    rng = random.Random(5)
    rows = [(i, "hot" if i % 2 else f"g{i % 7}", 0.5 if i % 3 == 0 else round(rng.random(), 3), int(rng.random() < 0.3),
             rng.randint(1, 60)) for i in range(900)]
    return rows, spark.createDataFrame(rows, "id int, grp string, x double, y int, days int")


def test_running_totals(skewed):
    rows, df = skewed
    got = cumulative.running_totals(df.groupBy("grp", "x").agg(F.count(F.lit(1)).alias("n")), "x", ["n"], ["grp"], buckets=5).collect()
    for r in got:
        group = [q for q in rows if q[1] == r.grp]
        assert r.n_all == len(group) and r.n_before == sum(q[2] < r.x for q in group)


@pytest.mark.parametrize("buckets_conf", ["4", "16"])
def test_exact_quantiles_equal_percentile(spark, skewed, buckets_conf):
    _, df = skewed
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", buckets_conf)
    got = {(r.grp, r.prob): r.quantile for r in cumulative.exact_quantiles(df, "x", [0.0, 0.25, 1 / 3, 0.9, 1.0], ["grp"]).collect()}
    want = df.groupBy("grp").agg(*[F.percentile("x", p).alias(str(i)) for i, p in enumerate([0.0, 0.25, 1 / 3, 0.9, 1.0])]).collect()
    spark.conf.set("spark.sql.shuffle.partitions", keep)
    for r in want:
        for i, p in enumerate([0.0, 0.25, 1 / 3, 0.9, 1.0]):
            assert abs(got[(r.grp, p)] - r[str(i)]) < 1e-12


def test_exact_split_is_exact_and_disjoint(skewed):
    rows, df = skewed
    out = splits.exact_split(df, ["id"], 0.8, ["grp"])
    assert out.count() == len(rows) == out.select("id").distinct().count()
    for r in out.groupBy("grp").agg(F.count_if(F.col("split") == "train").alias("t"), F.count(F.lit(1)).alias("n")).collect():
        assert r.t == int(0.8 * r.n)


def test_hash_split_is_repeatable(skewed):
    _, df = skewed
    a = splits.hash_split(df, ["id"]).select("id", "split")
    assert a.exceptAll(splits.hash_split(df.repartition(5), ["id"]).select("id", "split")).isEmpty()


def test_auc_and_average_precision(skewed):
    rows, df = skewed
    got = metrics.ranking_metrics(df, "x", "y").first()
    pos, neg = [r[2] for r in rows if r[3]], [r[2] for r in rows if not r[3]]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, tp_before = 0.0, 0
    for s in sorted({r[2] for r in rows}, reverse=True):
        tp = sum(p >= s for p in pos)
        ap += (tp - tp_before) / len(pos) * tp / sum(r[2] >= s for r in rows)
        tp_before = tp
    assert abs(got.auc - auc) < 1e-12 and abs(got.gini - (2 * auc - 1)) < 1e-12 and abs(got.average_precision - ap) < 1e-12


def test_concordance(skewed):
    rows, df = skewed
    got = metrics.concordance_index(df, "days", "y", "x").first()
    pairs = wins = 0.0
    for i in rows:
        if i[3]:
            for j in rows:
                if j[4] > i[4] or (j[4] == i[4] and not j[3]):
                    pairs += 1
                    wins += (i[2] > j[2]) + 0.5 * (i[2] == j[2])
    assert got.n_pairs == pairs and abs(got.c_index - wins / pairs) < 1e-12


def test_cox_loss(skewed):
    import math
    rows, df = skewed
    want = -sum(i[2] - math.log(sum(math.exp(j[2]) for j in rows if j[4] >= i[4])) for i in rows if i[3]) / sum(r[3] for r in rows)
    assert abs(metrics.cox_loss(df, "days", "y", "x").first().loss - want) < 1e-9


def test_calibration_error_bins(spark):
    df = spark.createDataFrame([(0.05, 0), (0.15, 1), (0.1, 0), (1.0, 1)], "p double, y int")
    want = (1 * 0.05 + 2 * abs(0.5 - 0.125) + 0) / 4
    assert abs(metrics.expected_calibration_error(df, "p", "y").first().ece - want) < 1e-12


def test_tertiles_are_balanced(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    tiers = monitoring.risk_tiers(df, "v", "tier")
    assert monitoring.tier_balance(tiers, "tier").first().balance > 0.9


def test_psi_of_the_baseline_itself_is_zero(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"), F.lit("m").alias("month"))
    assert monitoring.population_stability(df, ["v"], "month", F.lit(True)).first().psi == 0.0
