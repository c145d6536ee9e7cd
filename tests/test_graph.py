"""Network measures on small graphs with known answers."""

import itertools
from collections import deque

import pytest
from pyspark.sql import functions as F

from tradeweave.operators import graph, joins


def make(spark, pairs, n):
    nodes = spark.createDataFrame([(f"n{i}", "a" if i % 2 else "b") for i in range(n)], "node_id string, node_type string")
    edges = spark.createDataFrame([(f"n{a}", f"n{b}", "t") for a, b in pairs], "src string, dst string, edge_type string")
    return nodes, edges.withColumns({"value": F.lit(5.0), "cost": F.lit(None).cast("double")})


# a hub, parallel edges, a cycle, a dangling node and an isolated one
PAIRS = [(0, 1), (0, 1), (0, 2), (1, 2), (2, 0), (2, 3), (3, 4), (0, 5), (5, 6), (6, 0), (1, 4)]
N = 8


def test_degrees_collapse_parallel_edges(spark):
    nodes, edges = make(spark, PAIRS, N)
    got = {r.node_id: (r.in_degree, r.out_degree) for r in graph.degrees(nodes, edges).collect()}
    assert got["n0"] == (2, 3) and got["n4"] == (2, 0) and got["n7"] == (0, 0)


def test_pagerank_matches_power_iteration(spark):
    nodes, edges = make(spark, PAIRS, N)
    got = {r.node_id: r.pagerank for r in graph.pagerank(nodes, edges, rounds=60, stage_every=10).collect()}
    out = {i: {b for a, b in set(PAIRS) if a == i} for i in range(N)}
    x = {i: 1 / N for i in range(N)}
    for _ in range(200):
        lost = sum(x[i] for i in range(N) if not out[i])
        x = {j: 0.15 / N + 0.85 * (lost / N + sum(x[i] / len(out[i]) for i in range(N) if j in out[i])) for j in range(N)}
    assert abs(sum(got.values()) - 1) < 1e-9
    assert all(abs(got[f"n{i}"] - x[i]) < 1e-4 for i in range(N))


def test_clustering(spark):
    nodes, edges = make(spark, PAIRS, N)
    got = {r.node_id: r.clustering_coefficient for r in graph.clustering(nodes, edges).collect()}
    und = {frozenset(p) for p in PAIRS}
    for i in range(N):
        nb = [j for j in range(N) if frozenset((i, j)) in und and j != i]
        t = sum(frozenset(p) in und for p in itertools.combinations(nb, 2))
        want = 2 * t / (len(nb) * (len(nb) - 1)) if len(nb) > 1 else 0.0
        assert abs(got[f"n{i}"] - want) < 1e-12


def brute_betweenness(pairs, n):
    out = {i: sorted({b for a, b in pairs if a == i and b != i}) for i in range(n)}
    total = [0.0] * n
    for s in range(n):
        dist, sigma, order, pred = {s: 0}, {s: 1.0}, [], {i: [] for i in range(n)}
        queue = deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in out[v]:
                if w not in dist:
                    dist[w], sigma[w] = dist[v] + 1, 0.0
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    pred[w].append(v)
        delta = [0.0] * n
        for w in reversed(order):
            for v in pred[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                total[w] += delta[w]
    return [t / ((n - 1) * (n - 2)) for t in total]


def test_betweenness_with_all_pivots_is_exact(spark):
    nodes, edges = make(spark, PAIRS, N)
    got = {r.node_id: r.betweenness_centrality for r in graph.betweenness(nodes, edges, k=N).collect()}
    want = brute_betweenness(PAIRS, N)
    assert all(abs(got[f"n{i}"] - want[i]) < 1e-12 for i in range(N))


def test_reverse_twins_and_unknown_ends(spark):
    nodes, edges = make(spark, PAIRS + [(0, 99)], N)
    typed = joins.typed_edges(edges, nodes)
    assert typed.count() == len(PAIRS)
    both = joins.with_reverse(typed)
    assert both.count() == 2 * len(PAIRS) and both.filter(F.col("edge_type").startswith("rev_")).count() == len(PAIRS)


def test_attention_sums_to_one(spark):
    nodes, edges = make(spark, PAIRS, N)
    w = graph.attention(graph.relation_edges(nodes, edges)).groupBy("dst", "relation").agg(F.sum("weight").alias("s"))
    assert w.filter(F.abs(F.col("s") - 1) > 1e-9).isEmpty()


def test_negative_links_are_no_edges(spark):
    nodes, edges = make(spark, PAIRS, N)
    types = nodes.select(F.col("node_id").alias("dst"), F.col("node_type").alias("dst_type"))
    neg = graph.negative_links(edges.join(types, "dst"), nodes, edges).select("src", "dst")
    assert neg.join(edges, ["src", "dst"], "left_semi").isEmpty()


def test_common_neighbours(spark):
    nodes, edges = make(spark, PAIRS, N)
    pairs = spark.createDataFrame([("n0", "n4"), ("n1", "n3"), ("n7", "n0")], "src string, dst string")
    got = {(r.src, r.dst): r for r in graph.common_neighbour_features(pairs, edges).collect()}
    assert got[("n0", "n4")].common == 1 and got[("n1", "n3")].common == 2 and got[("n7", "n0")].common == 0
    assert got[("n1", "n3")].jaccard == pytest.approx(2 / 3, abs=1e-6)


def test_interval_match_equals_range_join(spark):
    claims = spark.createDataFrame([("a", d, 2.0) for d in range(0, 90, 3)] + [("b", 5, 1.0)], "asset string, d int, claimed double")
    obs = spark.createDataFrame([("a", d, 1.0 + d) for d in range(0, 120, 7)] * 2, "asset string, d int, observed double")
    day = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), c)
    claims = claims.select("asset", day("d").alias("start_day"), "claimed")
    obs = obs.select("asset", day("d").alias("obs_day"), "observed")
    got = {(r.asset, r.start_day): r.observed for r in joins.observed_in_window(claims, obs, 10).collect()}
    want = claims.distinct().join(obs.withColumnRenamed("asset", "a2"), (F.col("asset") == F.col("a2")) & F.col("obs_day").between(
        F.col("start_day"), F.date_add("start_day", 10)), "left").groupBy("asset", "start_day").agg(
        F.coalesce(F.sum("observed"), F.lit(0.0)).alias("o")).collect()
    assert got == {(r.asset, r.start_day): r.o for r in want}


def test_interval_match_of_missing_and_unmatched_rows(spark):
    claims = spark.createDataFrame([("a", None, 1.0), (None, "2024-01-05", 2.0), ("a", "2024-01-05", 3.0), ("z", "2024-01-05", 4.0)],
                                   "asset string, start_day string, claimed double").withColumn("start_day", F.to_date("start_day"))
    obs = spark.createDataFrame([("a", "2024-01-04", 1.0), ("a", "2024-01-05", 2.0), ("a", "2025-01-03", 4.0), ("a", "2025-01-05", 8.0),
                                 (None, "2024-01-06", 16.0), ("a", None, 32.0), ("a", "2024-01-06", None)],
                                "asset string, obs_day string, observed double").withColumn("obs_day", F.to_date("obs_day"))
    out = joins.observed_in_window(claims, obs, 365)
    got = {(r.asset, str(r.start_day)): (r.claimed, r.n_claims, r.observed) for r in out.collect()}
    assert got == {("a", "None"): (1.0, 1, 0.0), (None, "2024-01-05"): (2.0, 1, 0.0), ("a", "2024-01-05"): (3.0, 1, 6.0),
                   ("z", "2024-01-05"): (4.0, 1, 0.0)}
    assert joins.observed_in_window(claims.limit(0), obs, 30).isEmpty()


def staged_by(monkeypatch, work):
    """Tables that `work` writes."""
    seen, write = [], graph.stage
    monkeypatch.setattr(graph, "stage", lambda df: seen.append(write(df)) or seen[-1])
    return work(), seen


LEAVES = [(0, 1), (1, 0)] + [(0, i) for i in range(2, 30)] + [(1, i) for i in range(2, 30)]


def test_pagerank_rounds_leave_out_links_to_leaves(spark, monkeypatch):
    nodes, edges = make(spark, LEAVES, 31)
    ranks, seen = staged_by(monkeypatch, lambda: graph.pagerank(nodes, edges, rounds=60, stage_every=10))
    assert min(t.count() for t in seen if "w" in t.columns) == 2  # the two links between nodes that pass rank on
    got = {r.node_id: r.pagerank for r in ranks.collect()}
    x = [1 / 31] * 31
    for _ in range(200):
        lost = sum(x[2:])
        x = [0.15 / 31 + 0.85 * (lost / 31 + sum(x[a] / 29 for a, b in LEAVES if b == j)) for j in range(31)]
    assert all(abs(got[f"n{i}"] - x[i]) < 1e-9 for i in range(31))


def test_triangles_ship_lists_of_neighbours_that_have_one(spark, monkeypatch):
    nodes, edges = make(spark, LEAVES, 31)
    found, seen = staged_by(monkeypatch, lambda: graph.clustering(nodes, edges))
    assert [t.count() for t in seen if "nv" in t.columns] == [1]  # one of the two hubs, not the leaves
    got = {r.node_id: (r.n_triangles, r.clustering_coefficient) for r in found.collect()}
    assert got["n0"][0] == got["n1"][0] == 28 and got["n2"] == (1, 1.0) and got["n30"] == (0, 0.0)


def test_betweenness_levels_expand_without_leaves(spark, monkeypatch):
    nodes, edges = make(spark, LEAVES, 31)
    found, seen = staged_by(monkeypatch, lambda: graph.betweenness(nodes, edges, 31))
    assert any(t.columns == ["node_id"] and t.count() == 2 for t in seen)
    want = brute_betweenness(LEAVES, 31)
    got = {r.node_id: r.betweenness_centrality for r in found.collect()}
    assert all(got[f"n{i}"] == pytest.approx(want[i]) for i in range(31))


def test_positions_by_codes_equal_positions_by_texts(spark):
    """Ids that entity_id makes become numbers; one id of another form keeps all of them texts. Nulls and repeats stay."""
    from tradeweave.functions.scalar import entity_code, entity_id

    made = spark.createDataFrame([("supplier", 1), ("supplier", 2), ("customer", 1), ("port", 123456789), ("port", 12345678),
                                  ("customer", -1)], "t string, k bigint")
    codes = [r[0] for t in ("supplier", "customer", "port") for r in made.filter(F.col("t") == t).select(
        entity_code(entity_id(t, F.col("k")))).collect()]
    assert codes.count(None) == 1 and len({c for c in codes if c is not None}) == 5
    ids = [f"SUPP_{i:08d}" for i in range(6)] + [f"CUST_{i:08d}" for i in range(9)]
    pairs = [(ids[i], ids[(i * 7 + j) % 15]) for i in range(6) for j in range(1, 6)] + [("SUPP_00000001", None), (ids[0], ids[0])]
    nodes = spark.createDataFrame([(i,) for i in [*ids, ids[3], None]], "node_id string")
    edges = spark.createDataFrame(pairs, "src string, dst string")
    coded = graph.with_network_position(nodes, edges, rounds=6)
    texts = nodes
    for part in (graph.degrees(nodes, edges).select("node_id", "in_degree", "out_degree"), graph.betweenness(nodes, edges),
                 graph.clustering(nodes, edges).select("node_id", "clustering_coefficient"), graph.pagerank(nodes, edges, rounds=6)):
        texts = texts.join(part, "node_id", "left")
    rounded = lambda df: sorted((str(r.node_id), *(round(float(r[c] or 0), 12) for c in df.columns[1:]))
                                for r in df.select(*nodes.columns, *coded.columns[1:]).collect())
    assert rounded(coded) == rounded(texts)
    odd = lambda df: df.select(*[F.when(F.col(c) == ids[-1], "x").otherwise(F.col(c)).alias(c) for c in df.columns])
    named = graph.with_network_position(odd(nodes), odd(edges), rounds=6)
    assert named.count() == coded.count()
    same = lambda df: sorted(tuple(round(float(v), 12) for v in r[1:3]) for r in df.select("node_id", "in_degree", "out_degree").collect())
    assert same(named) == same(coded)
