"""Steps that several queries share: what is read once, what is left out, and that results stay the same."""

from functools import partial

import numpy as np
from pyspark.sql import functions as F

from tradeweave import session
from tradeweave.operators import graph, grouped_fit, learning
from tradeweave.plans import aggregates, evaluation
from tradeweave.sources import contract as C
from tradeweave.sources import mart as marts
from tradeweave.sources.mart import Mart


def same(a, b) -> bool:
    return a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_lines_are_joined_once_for_entities_and_edges(spark, mart, monkeypatch):
    asked, joined = [], C.trade_lines
    monkeypatch.setattr(C, "trade_lines", lambda t, **which: asked.append(which) or joined(t, **which))
    monkeypatch.setattr(marts, "_STAGED", {})
    fresh = Mart(spark, mart.folder)
    nodes, edges = fresh.nodes, fresh.edges
    assert len(asked) == 1
    assert same(nodes, C.entity_nodes(fresh)) and same(edges, C.all_edges(fresh))
    light = C.entity_nodes(fresh, flows=False)
    assert light.columns == [c for c in nodes.columns if c not in C.FLOW_COLUMNS]
    assert same(light, nodes.select(*light.columns))


def test_letter_ranking_and_exposure_do_not_build_the_letters(spark, mart, monkeypatch):
    monkeypatch.setattr(marts, "_STAGED", {})
    fresh = Mart(spark, mart.folder)
    evaluation.e1(fresh).collect()
    aggregates.g15(fresh).collect()
    assert not fresh.at_hand("lc") and not fresh.at_hand("nodes")
    scores, letters = fresh.lc_default_scores, fresh.lc
    assert same(scores, letters.select("default_probability_true", "is_default"))
    assert same(C.lc_parties(fresh), letters.select("applicant_id", "beneficiary_id").distinct())


def test_jobs_run_side_by_side_inside_jobs(spark):
    inner = partial(session.concurrently, [spark.range(3).count, spark.range(4).count])
    assert session.concurrently([inner, inner]) == [[3, 4], [3, 4]]


def test_network_measures_run_side_by_side(spark, monkeypatch):
    asked, real = [], session.concurrently
    monkeypatch.setattr(graph, "concurrently", lambda jobs: asked.append(len(jobs)) or real(jobs))
    nodes = spark.createDataFrame([(c,) for c in "abcde"], "node_id string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")], "src string, dst string")
    out = {r.node_id: r for r in graph.with_network_position(nodes, edges, rounds=5).collect()}
    assert asked == [3] and len(out) == 5
    for measure, column in ((graph.betweenness, "betweenness_centrality"), (graph.clustering, "clustering_coefficient"),
                            (partial(graph.pagerank, rounds=5), "pagerank")):
        for r in measure(nodes, edges).collect():
            assert abs(r[column] - out[r.node_id][column]) < 1e-12


def test_cox_steps_over_many_blocks_of_durations(spark):
    """More than a thousand durations, tied ones too; steps write no row for each pair of columns but arrays of sums."""
    u = lambda i: (F.abs(F.xxhash64("id", F.lit(i))) % 100_000) / 100_000.0
    df = spark.range(4000).select("id", (F.col("id") % 2).cast("int").alias("g"), (u(1) - 0.5).alias("a"), (u(2) - 0.5).alias("b"),
                                  F.floor(u(3) * 2500).alias("days"), (u(4) < 0.7).cast("int").alias("event"))
    seen, write = [], grouped_fit.stage
    rows = df.select("g", F.array("a", "b").alias("x"), F.col("days").alias("t"), F.col("event").alias("e"))
    try:
        grouped_fit.stage = lambda frame: seen.append(write(frame)) or seen[-1]
        found = grouped_fit.fit_cox_by(rows, ["g"], 2, ridge=0.01)
    finally:
        grouped_fit.stage = write
    for g in (0, 1):
        alone = learning.fit_cox(df.filter(F.col("g") == g), ["a", "b"], "days", "event", ridge=0.01)
        assert np.allclose(found[(g,)], [alone["a"], alone["b"]], atol=1e-6)
    steps = [f for f in seen if "sums" in f.columns]
    assert steps and steps[0].select("block").distinct().count() > 1
    assert steps[0].count() == steps[0].select("_model", "t").distinct().count()
