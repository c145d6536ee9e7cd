"""Model properties, streams against batch, and the driver contract."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tradeweave.operators import learning, metrics
from tradeweave.plans.registry import registered
from tradeweave.session import shared_dir
from tradeweave.sources.tables import read_results_json, write_results_json

from conftest import DATA


@pytest.fixture(scope="module")
def separable(spark):
    """Label = above the median of a noisy linear score."""
    h = lambda s: (F.abs(F.xxhash64("id", F.lit(s))) % 1000) / 1000.0
    df = spark.range(500).select("id", h(1).alias("f1"), h(2).alias("f2"), h(3).alias("f3"))
    df = df.withColumn("z", 2 * F.col("f1") - F.col("f2") + 0.2 * F.col("f3"))
    median = df.agg(F.percentile("z", 0.5)).scalar()
    return df.withColumn("y", (F.col("z") > median).cast("int"))


def test_stacking_separates(separable):
    _, oof, test = learning.fit_stacking(separable, "id", ["f1", "f2", "f3"], "y", k=2, rounds=5)
    assert metrics.ranking_metrics(oof, "p", "y").first().auc > 0.7
    assert metrics.ranking_metrics(test, "p", "y").first().auc > 0.7


def test_search_halves_its_points_whatever_the_layout(separable):
    ranges = {**learning.SEARCH_RANGES, "maxIter": (6, 9, "whole"), "maxDepth": (2, 3, "whole")}
    search = lambda df: learning.search_default_classifier(
        df, "id", ["f1", "f2", "f3"], "y", n_points=4, ranges=ranges, first_rounds=2)
    model, trials = search(separable)
    assert [t.rounds for t in trials] == [2, 2, 2, 2, 6] and {t.point for t in trials[:4]} == set(range(4))
    best = max(trials[:4], key=lambda t: (t.auc, -t.point))
    assert trials[4].point == best.point and model.stages[-1].getNumTrees == best.params["maxIter"]
    again = search(separable.orderBy(F.xxhash64("id")).repartition(7))[1]
    assert again == trials


def test_points_are_drawn_inside_their_ranges():
    points = [learning.drawn_point(p) for p in range(200)]
    for name, (low, high, scale) in learning.SEARCH_RANGES.items():
        values = [p[name] for p in points]
        assert low <= min(values) and max(values) <= high
        assert scale != "whole" or all(isinstance(v, int) for v in values)
        middle = (low * high) ** 0.5 if scale == "log" else (low + high) / 2
        assert 60 < sum(v < middle for v in values) < 140
    assert points[:3] == [learning.drawn_point(p) for p in range(3)]


def test_cox_maximises_the_penalised_likelihood(spark):
    """Exponential lifetimes with hazard exp(2a): coefficient near 2 on `a`, near 0 on `b`, and a flat top."""
    h = lambda s: (F.abs(F.xxhash64("id", F.lit(s))) % 1000) / 1000.0
    life = -F.log(h(3) + 0.0005) * 300 * F.exp(-2.0 * F.col("a"))
    df = spark.range(3000).select("id", (h(1) - 0.5).alias("a"), (h(2) - 0.5).alias("b"))
    df = df.withColumn("life", life).select(
        "id", "a", "b", F.greatest(F.lit(1), F.least(F.col("life"), F.lit(450.0)).cast("int")).alias("t"), (F.col("life") < 450).cast("int").alias("e"))
    ridge, n = 0.001, 3000
    beta = learning.fit_cox(df, ["a", "b"], "t", "e", ridge=ridge)
    assert abs(beta["a"] - 2) < 0.3 and abs(beta["b"]) < 0.3
    scored = df.withColumn("risk", F.round(learning.partial_hazard(beta), 9))
    assert metrics.concordance_index(scored, "t", "e", "risk").first().c_index > 0.6

    def objective(da):
        a, b = beta["a"] + da, beta["b"]
        row = metrics.cox_loss(df.withColumn("lr", a * F.col("a") + b * F.col("b")), "t", "e", "lr").first()
        return row.loss * row.n_events / n + ridge / 2 * (a * a + b * b)

    assert objective(0.0) < objective(0.2) and objective(0.0) < objective(-0.2)


def test_ccc_models_learn_the_response(mart):
    train = mart.shocks.filter("pmod(hash(port, month), 5) > 0")
    models = learning.fit_ccc_models(train, rounds=5)
    mae = learning.predict_ccc(models, mart.shocks).agg(F.avg(F.abs(F.col("ccc_change") - F.col("pred_ccc_change")))).first()[0]
    assert mae < 15


def test_results_json_round_trip(spark):
    df = spark.createDataFrame([("a", "m", 1.5)], "section string, metric string, value double")
    path = f"{shared_dir(spark)}/json-test"
    write_results_json(df, path)
    assert read_results_json(spark, path, "section string, metric string, value double").collect() == df.collect()


def test_entry_is_ranked_and_complete(spark, mart):
    out = entry_module.entry(spark)
    rows = out.collect()
    assert len(rows) == mart.orders.count()
    losses = [r.expected_loss for r in rows]
    assert losses == sorted(losses, reverse=True)


def test_stacked_matrix_is_complete(spark, mart):
    x = registered()[0]["k9_stacked_feature_matrix"](spark, DATA)
    assert len(x.columns) == 25 and x.count() == mart.orders.count()
    assert x.filter(" OR ".join(f"{c} IS NULL" for c in x.columns)).isEmpty()


def test_every_twin_has_a_query():
    queries, oracles = registered()
    assert set(oracles) <= set(queries) and len(queries) > 100
