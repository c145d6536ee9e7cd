"""Survival at any duration, softmax at any scale, splits without a shuffle of rows."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tradeweave.operators import graph, learning, metrics, splits


def survival(seed, n, longest):
    rng = random.Random(seed)
    return [(i, round(rng.random() * longest, rng.choice([0, 1, 3])), int(rng.random() < 0.6), round(rng.random(), 2)) for i in range(n)]


def brute_concordance(rows):
    pairs = wins = 0.0
    for _, d, e, r in rows:
        if e:
            for _, d2, e2, r2 in rows:
                if d2 > d or (d2 == d and not e2):
                    pairs += 1
                    wins += (r > r2) + 0.5 * (r == r2)
    return pairs, wins / pairs


def test_concordance_of_long_and_broken_durations(spark):
    for longest in (5, 5000):
        rows = survival(longest, 300, longest)
        got = metrics.concordance_index(spark.createDataFrame(rows, "id int, d double, e int, r double"), "d", "e", "r").first()
        pairs, index = brute_concordance(rows)
        assert got.n_pairs == pairs and abs(got.c_index - index) < 1e-12


def test_fold_concordance(spark):
    rows = survival(3, 240, 2000)
    df = spark.createDataFrame(rows, "id int, d double, e int, r double").withColumn("fold", F.col("id") % 4)
    got = {r["fold"]: r for r in metrics.fold_concordance(df, "fold", "d", "e", "r", 4).collect()}
    want = [brute_concordance([r for r in rows if r[0] % 4 == f])[1] for f in range(4)]
    assert all(abs(got[f]["c_index"] - want[f]) < 1e-12 for f in range(4))
    assert abs(got[0]["mean_c_index"] - np.mean(want)) < 1e-12 and abs(got[0]["std_c_index"] - np.std(want)) < 1e-12


def test_cox_at_any_duration(spark):
    rng = random.Random(9)
    rows = []
    for i in range(800):
        a = rng.random() - 0.5
        rows.append((i, a, rng.random() - 0.5, -math.log(rng.random()) * 2500 * math.exp(-2 * a), int(rng.random() < 0.8)))
    df = spark.createDataFrame(rows, "id int, a double, b double, t double, e int")
    got = learning.fit_cox(df, ["a", "b"], "t", "e", ridge=0.01)
    x = np.array([[r[1], r[2]] for r in sorted(rows, key=lambda r: -r[3])])
    e = np.array([r[4] for r in sorted(rows, key=lambda r: -r[3])], float)
    beta = np.zeros(2)
    for _ in range(30):
        w = np.exp(x @ beta)
        s0, s1 = np.cumsum(w), np.cumsum(w[:, None] * x, 0)
        s2 = np.cumsum(w[:, None, None] * x[:, :, None] * x[:, None, :], 0)
        mean = s1 / s0[:, None]
        g = (e[:, None] * (x - mean)).sum(0) / len(x) - 0.01 * beta
        h = (e[:, None, None] * (s2 / s0[:, None, None] - mean[:, :, None] * mean[:, None, :])).sum(0) / len(x)
        beta += np.linalg.solve(h + 0.01 * np.eye(2), g)
    assert abs(got["a"] - beta[0]) < 1e-6 and abs(got["b"] - beta[1]) < 1e-6


def test_softmax_of_large_strengths(spark):
    rel = spark.createDataFrame([("a", "x", "r", 800.0), ("b", "x", "r", 799.0), ("c", "y", "r", -900.0)],
                                "src string, dst string, relation string, strength double")
    got = {r["src"]: r["weight"] for r in graph.attention(rel).collect()}
    assert abs(got["a"] - 1 / (1 + math.exp(-1))) < 1e-12 and abs(got["a"] + got["b"] - 1) < 1e-12 and got["c"] == 1.0
    nodes = spark.createDataFrame([(n, float(i)) for i, n in enumerate("abcxy")], "node_id string, h double")
    assert all(math.isfinite(r["h"]) for r in graph.propagate(nodes, rel, ["h"], hops=1).collect())


def test_exact_split_moves_no_rows(spark):
    df = spark.range(20_000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"), F.lit("wide").alias("text"))
    out = splits.exact_split(df, ["id"], 0.7, ["y"])
    for r in out.groupBy("y").agg(F.count_if(F.col("split") == "train").alias("t"), F.count(F.lit(1)).alias("n")).collect():
        assert r["t"] == int(0.7 * r["n"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan
