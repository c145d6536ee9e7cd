"""Graph measures, typed neighbour aggregation, links; entity features that need network position."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeweave.functions.scalar import logistic, settle
from tradeweave.operators import graph, lc_features, metrics, profile, scorecards
from tradeweave.plans.aggregates import describe_sql
from tradeweave.plans.oracle_base import cte, hash32, logistic as sql_logistic, sql
from tradeweave.plans.registry import Section
from tradeweave.plans.scores import NODE_Z
from tradeweave.plans.series import holdout
from tradeweave.session import stage
from tradeweave.sources import contract

section = Section()
QUERIES, ORACLES = section.queries, section.oracles

PR_ROUNDS = 30
SIGNALS = ["otif_rate", "debt_to_equity", "ccc_days"]

cte("digraph", ["edges"], "SELECT DISTINCT src, dst FROM edges")
cte("und", ["digraph"], "SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM digraph WHERE src <> dst")
cte("sym", ["und"], "SELECT a AS x, b AS nbr FROM und UNION ALL SELECT b, a FROM und")
cte("deg", ["node_keys", "digraph"], """
SELECT node_id, coalesce(i.n, 0) AS in_degree, coalesce(o.n, 0) AS out_degree FROM node_keys
LEFT JOIN (SELECT dst, count(*) AS n FROM digraph GROUP BY dst) i ON i.dst = node_id
LEFT JOIN (SELECT src, count(*) AS n FROM digraph GROUP BY src) o ON o.src = node_id""")


@section.add("g1_degrees", sql(["deg"], "SELECT node_id, in_degree, out_degree FROM deg"))
def g1(m):
    return graph.degrees(m.node_types, m.edges).select("node_id", "in_degree", "out_degree")


@section.add("g2_degree_distribution", sql(["deg"], describe_sql("(SELECT in_degree + out_degree AS degree FROM deg)", ["degree"])))
def g2(m):
    return profile.describe(graph.degrees(m.node_types, m.edges), ["degree"])


@section.add("g3_density", sql(["digraph", "node_keys"], """
SELECT n AS n_nodes, e AS n_edges, round(CAST(e AS DOUBLE) / (n * (n - 1)), 6) AS density FROM
(SELECT count(*) AS n FROM node_keys), (SELECT count(*) AS e FROM digraph)"""))
def g3(m):
    return graph.density(m.node_types, m.edges).withColumn("density", settle(F.col("density")))


cte("links", ["digraph"], """
SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS w FROM digraph""")
cte("pr_0", ["node_keys"], "SELECT node_id, 1.0::DOUBLE / (SELECT count(*) FROM node_keys) AS rank FROM node_keys")
for _i in range(1, PR_ROUNDS + 1):
    cte(f"pr_{_i}", [f"pr_{_i - 1}", "links"], f"""
SELECT k.node_id, CAST(0.15 AS DOUBLE) / (SELECT count(*) FROM node_keys) + CAST(0.85 AS DOUBLE) * coalesce(f.s, 0) AS rank FROM node_keys k
LEFT JOIN (SELECT dst, sum(rank * w) AS s FROM pr_{_i - 1} JOIN links ON src = node_id GROUP BY dst) f ON f.dst = k.node_id""")


@section.add("g4_pagerank", sql([f"pr_{PR_ROUNDS}"], f"""
SELECT node_id, round(rank / (SELECT sum(rank) FROM pr_{PR_ROUNDS}), 9) AS pagerank FROM pr_{PR_ROUNDS}"""))
def g4(m):
    return graph.pagerank(m.node_types, m.edges, rounds=PR_ROUNDS).withColumn("pagerank", F.round("pagerank", 9))


cte("triangles", ["sym"], """
SELECT p.x AS node_id, count(*) AS t FROM sym p JOIN sym q ON q.x = p.nbr JOIN sym r ON r.x = p.x AND r.nbr = q.nbr
WHERE p.nbr < q.nbr GROUP BY p.x""")
cte("clust", ["triangles", "sym", "node_keys"], """
SELECT k.node_id, coalesce(t.t, 0) AS n_triangles, CASE WHEN coalesce(d.d, 0) < 2 THEN 0.0
 ELSE coalesce(2.0 * t.t / (d.d * (d.d - 1)), 0.0) END::DOUBLE AS cc FROM node_keys k
LEFT JOIN (SELECT x, count(*) AS d FROM sym GROUP BY x) d ON d.x = k.node_id LEFT JOIN triangles t ON t.node_id = k.node_id""")


@section.add("g5_clustering", sql(["clust"], "SELECT node_id, n_triangles, round(cc, 6) AS clustering_coefficient FROM clust"))
def g5(m):
    return graph.clustering(m.node_types, m.edges).withColumn("clustering_coefficient", settle(F.col("clustering_coefficient")))


# breadth-first levels and back-flow, unrolled deep enough for this graph
DEPTH = 7
cte("arcs", ["digraph"], "SELECT src, dst FROM digraph WHERE src <> dst")
cte("lvl_0", ["node_keys"], f"""
SELECT node_id AS pv, node_id, 1.0::DOUBLE AS sigma FROM (SELECT node_id FROM node_keys
 ORDER BY {hash32('node_id', salt='pivot')}, node_id LIMIT 80)""")
for _i in range(1, DEPTH + 1):
    _seen = " UNION ALL ".join(f"SELECT pv, node_id FROM lvl_{j}" for j in range(_i))
    cte(f"lvl_{_i}", [f"lvl_{j}" for j in range(_i)] + ["arcs"], f"""
SELECT r.* FROM (SELECT pv, dst AS node_id, sum(sigma) AS sigma FROM lvl_{_i - 1} JOIN arcs ON src = node_id GROUP BY pv, dst) r
WHERE NOT EXISTS (SELECT 1 FROM ({_seen}) s WHERE s.pv = r.pv AND s.node_id = r.node_id)""")
cte(f"dep_{DEPTH}", [f"lvl_{DEPTH}"], f"SELECT *, 0.0::DOUBLE AS delta FROM lvl_{DEPTH}")
for _i in range(DEPTH - 1, -1, -1):
    cte(f"dep_{_i}", [f"lvl_{_i}", f"dep_{_i + 1}", "arcs"], f"""
SELECT l.*, l.sigma * coalesce(c.credit, 0) AS delta FROM lvl_{_i} l LEFT JOIN (
 SELECT d.pv, a.src AS node_id, sum((1 + d.delta) / d.sigma) AS credit FROM dep_{_i + 1} d JOIN arcs a ON a.dst = d.node_id
 GROUP BY d.pv, a.src) c ON c.pv = l.pv AND c.node_id = l.node_id""")
cte("between", [f"dep_{i}" for i in range(DEPTH + 1)], f"""
SELECT k.node_id, coalesce(s.s, 0) * (k.n / 80.0) / ((k.n - 1) * (k.n - 2)) AS b FROM
 (SELECT node_id, CAST(count(*) OVER () AS DOUBLE) AS n FROM node_keys) k LEFT JOIN (SELECT node_id, sum(delta) AS s FROM (
 {' UNION ALL '.join(f'SELECT * FROM dep_{i}' for i in range(DEPTH + 1))}) WHERE pv <> node_id GROUP BY node_id) s ON s.node_id = k.node_id""")


@section.add("g6_betweenness", sql(["between"], "SELECT node_id, round(b, 9) AS betweenness_centrality FROM between"))
def g6(m):
    return graph.betweenness(m.node_types, m.edges).withColumn("betweenness_centrality", F.round("betweenness_centrality", 9))


cte("position", ["nodes", "deg", "between", "clust", f"pr_{PR_ROUNDS}"], f"""
SELECT n.*, round(1 - 1 / nullif(n.current_ratio, 0), 6) AS working_capital_ratio, d.in_degree, d.out_degree, b.b AS betweenness_centrality,
 c.cc AS clustering_coefficient, p.rank / (SELECT sum(rank) FROM pr_{PR_ROUNDS}) AS pagerank FROM nodes n JOIN deg d ON d.node_id = n.node_id
JOIN between b ON b.node_id = n.node_id JOIN clust c ON c.node_id = n.node_id JOIN pr_{PR_ROUNDS} p ON p.node_id = n.node_id""")


@section.add("c1_entity_default_score", sql(["position"], f"""
SELECT node_id, round({sql_logistic(NODE_Z + ' + 2.2 * betweenness_centrality')}, 6) AS pd_annual FROM position"""))
def c1(m):
    return m.network_nodes.select("node_id", settle(scorecards.entity_default_probability()).alias("pd_annual"))


@section.add("k6_entity_features", sql(["position"], "SELECT node_id, node_type, " + ", ".join(
    f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in lc_features.ENTITY_FEATURES) + " FROM position"))
def k6(m):
    feats = lc_features.entity_features(m.network_nodes)
    return feats.select("node_id", "node_type", *[settle(F.col(c)).alias(c) for c in lc_features.ENTITY_FEATURES])


# ------------------------------------------------------------------ typed neighbour aggregation
cte("typed", ["edges", "node_keys"], """
SELECT e.src, e.dst, a.node_type AS src_type, e.edge_type, b.node_type AS dst_type, ln(1 + coalesce(e.value, e.cost, 0)) / 10 AS strength
FROM edges e JOIN node_keys a ON a.node_id = e.src JOIN node_keys b ON b.node_id = e.dst""")


@section.add("g7_typed_relation_table", sql(["typed"], """
SELECT relation, count(*) AS n_edges, count(DISTINCT dst) AS n_dst, round(sum(strength), 4) AS strength FROM (
 SELECT dst, src_type || ':' || edge_type || ':' || dst_type AS relation, strength FROM typed
 UNION ALL SELECT src, dst_type || ':rev_' || edge_type || ':' || src_type, strength FROM typed) GROUP BY 1"""))
def g7(m):
    return graph.relation_edges(m.node_types, m.edges).groupBy("relation").agg(
        F.count(F.lit(1)).alias("n_edges"), F.countDistinct("dst").alias("n_dst"), F.round(F.sum("strength"), 4).alias("strength"))


cte("rel", ["typed"], """
SELECT src, dst, src_type || ':' || edge_type || ':' || dst_type AS relation, strength FROM typed
UNION ALL SELECT dst, src, dst_type || ':rev_' || edge_type || ':' || src_type, strength FROM typed""")


@section.add("g9_attention_weights", sql(["rel"], """
SELECT relation, count(*) AS n, round(sum(weight), 6) AS mass, round(max(weight), 6) AS peak FROM (
 SELECT relation, exp(strength) / sum(exp(strength)) OVER (PARTITION BY dst, relation) AS weight FROM rel) GROUP BY relation"""))
def g9(m):
    weights = graph.attention(graph.relation_edges(m.node_types, m.edges))
    return weights.groupBy("relation").agg(F.count(F.lit(1)).alias("n"), settle(F.sum("weight")).alias("mass"),
                                           settle(F.max("weight")).alias("peak"))


cte("hop_0", ["nodes"], "SELECT node_id, " + ", ".join(
    f"({c} - (SELECT avg({c}) FROM nodes)) / (SELECT stddev_samp({c}) FROM nodes) AS f{i}" for i, c in enumerate(SIGNALS)) + " FROM nodes")


def hop_ctes(prefix: str, rel: str) -> None:
    for h in range(1, 4):
        prev = "hop_0" if h == 1 else f"{prefix}_{h - 1}"
        cte(f"{prefix}_{h}", [prev, rel], f"""
SELECT node_id, (f0 - mu) / s AS f0, (f1 - mu) / s AS f1, (f2 - mu) / s AS f2 FROM (
 SELECT *, sqrt(((f0 - mu) * (f0 - mu) + (f1 - mu) * (f1 - mu) + (f2 - mu) * (f2 - mu)) / 3 + 1e-5) AS s FROM (
  SELECT *, (f0 + f1 + f2) / 3 AS mu FROM (
   SELECT h.node_id, h.f0 + coalesce(g.f0, 0) AS f0, h.f1 + coalesce(g.f1, 0) AS f1, h.f2 + coalesce(g.f2, 0) AS f2 FROM {prev} h LEFT JOIN (
    SELECT dst, sum(f0) AS f0, sum(f1) AS f1, sum(f2) AS f2 FROM (
     SELECT r.dst, relation, sum(exp(strength) * f0) / sum(exp(strength)) AS f0, sum(exp(strength) * f1) / sum(exp(strength)) AS f1,
      sum(exp(strength) * f2) / sum(exp(strength)) AS f2 FROM {rel} r JOIN {prev} n ON n.node_id = r.src GROUP BY r.dst, relation)
    GROUP BY dst) g ON g.dst = h.node_id)))""")


hop_ctes("hop", "rel")


def propagated(m, edges=None):
    lines = m.joined_lines  # of which the edges are made too
    nodes = m.nodes if m.at_hand("nodes") else stage(contract.entity_nodes(m, lines, flows=False).select("node_id", *SIGNALS))
    signals = profile.zscore(nodes, SIGNALS)
    return graph.propagate(signals, graph.relation_edges(m.node_types, m.edges if edges is None else edges), SIGNALS)


@section.add("g8_neighbour_propagation", sql(["hop_3"], "SELECT node_id, " + ", ".join(
    f"round(f{i}, 6) AS {c}" for i, c in enumerate(SIGNALS)) + " FROM hop_3"))
def g8(m):
    return propagated(m).select("node_id", *[settle(F.col(c)).alias(c) for c in SIGNALS])


# ------------------------------------------------------------------ links
cte("held", ["typed"], f"""
SELECT src, dst, dst_type, relation, edge_type, strength, src_type,
 row_number() OVER (PARTITION BY relation ORDER BY {hash32('src', 'dst', salt='split')}, src, dst) <= floor(0.85 * count(*) OVER (PARTITION BY relation))
 AS is_train FROM (SELECT *, src_type || ':' || edge_type || ':' || dst_type AS relation FROM typed)""")
cte("ranked_ids", ["node_keys"], f"""
SELECT node_type, node_id, row_number() OVER (PARTITION BY node_type ORDER BY {hash32('node_id', salt='rank')}, node_id) - 1 AS position,
 count(*) OVER (PARTITION BY node_type) AS size FROM node_keys""")
cte("negatives", ["held", "ranked_ids", "digraph"], f"""
SELECT DISTINCT h.src, r.node_id AS dst FROM (SELECT h.*, {hash32('h.src', 'h.dst', salt='negative')} AS draw FROM held h WHERE NOT is_train) h
JOIN ranked_ids r ON r.node_type = h.dst_type AND r.position = h.draw % r.size
WHERE h.src <> r.node_id AND NOT EXISTS (SELECT 1 FROM digraph d WHERE d.src = h.src AND d.dst = r.node_id)""")


def test_links(m):
    """Held-out edges (label 1) and sampled non-edges (label 0), and the training edges."""
    parts = holdout(m)
    positives = parts.filter(F.col("split") == "test")
    negatives = graph.negative_links(positives.select("src", "dst", "dst_type"), m.node_types, m.edges)
    pairs = positives.select("src", "dst").withColumn("label", F.lit(1)).unionByName(negatives.withColumn("label", F.lit(0)))
    return pairs, parts.filter(F.col("split") == "train")


@section.add("j10_u6_sampled_non_edges", sql(["negatives"], "SELECT src, dst FROM negatives"))
def j10(m):
    pairs, _ = test_links(m)
    return pairs.filter(F.col("label") == 0).select("src", "dst")


cte("train_rel", ["held"], """
SELECT src, dst, src_type || ':' || edge_type || ':' || dst_type AS relation, strength FROM held WHERE is_train
UNION ALL SELECT dst, src, dst_type || ':rev_' || edge_type || ':' || src_type, strength FROM held WHERE is_train""")
hop_ctes("thop", "train_rel")


@section.add("g10_link_prediction_auc", sql(["thop_3", "held", "negatives"], """,
pairs AS (SELECT src, dst, 1 AS label FROM held WHERE NOT is_train UNION ALL SELECT src, dst, 0 FROM negatives),
sc AS (SELECT label, round((a.f0 * b.f0 + a.f1 * b.f1 + a.f2 * b.f2) / sqrt(3.0), 6) AS score FROM pairs
 JOIN thop_3 a ON a.node_id = src JOIN thop_3 b ON b.node_id = dst)
SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 4) AS auc, CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM (
 SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM (
  SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg FROM sc GROUP BY 1))"""))
def g10(m):
    """Vectors are propagated over training edges only, so held-out edges do not leak into their own score."""
    m.joined_lines  # written before the edges, which are made of them
    pairs, train = test_links(m)
    kept = m.edges.join(train.select("src", "dst", F.element_at(F.split("relation", ":"), 2).alias("edge_type")),
                        ["src", "dst", "edge_type"], "left_semi")
    scored = graph.link_scores(pairs, propagated(m, kept), SIGNALS).withColumn("score", settle(F.col("score")))
    out = metrics.ranking_metrics(scored, "score", "label")
    size = scored.agg(F.count_if(F.col("label") == 1).alias("n_pos"), F.count_if(F.col("label") == 0).alias("n_neg"))
    return size.select("n_pos", "n_neg", F.round(out.select("auc").scalar(), 4).alias("auc"))


@section.add("g11_common_neighbours", sql(["held", "negatives", "sym"], """,
pairs AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM held WHERE NOT is_train UNION ALL SELECT src, dst FROM negatives)),
dg AS (SELECT x, count(*) AS d FROM sym GROUP BY x),
cn AS (SELECT p.src, p.dst, count(*) AS common, sum(CASE WHEN d.d > 1 THEN 1 / ln(d.d) END) AS aa FROM pairs p JOIN sym s ON s.x = p.src
 JOIN sym t ON t.x = p.dst AND t.nbr = s.nbr JOIN dg d ON d.x = s.nbr GROUP BY 1, 2)
SELECT p.src, p.dst, coalesce(c.common, 0) AS common, round(coalesce(CAST(coalesce(c.common, 0) AS DOUBLE) /
 nullif(coalesce(a.d, 0) + coalesce(b.d, 0) - coalesce(c.common, 0), 0), 0), 6) AS jaccard, round(coalesce(c.aa, 0), 6) AS adamic_adar,
 coalesce(a.d, 0) * coalesce(b.d, 0) AS preferential_attachment
FROM pairs p LEFT JOIN cn c ON c.src = p.src AND c.dst = p.dst LEFT JOIN dg a ON a.x = p.src LEFT JOIN dg b ON b.x = p.dst"""))
def g11(m):
    pairs, _ = test_links(m)
    return graph.common_neighbour_features(pairs, m.edges)
