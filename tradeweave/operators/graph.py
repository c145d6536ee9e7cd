"""Network measures on node and edge tables, as joins and aggregations.

Loops run a fixed or data-driven number of rounds on the driver and stage each round, so plans stay short and a
lost executor costs one round at most. Hubs: sums per node are partial aggregates, join skew is split at run time,
and neighbour lists are only built for degree-oriented edges (at most sqrt(2m) long).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.functions.scalar import entity_code, ratio, settle, stable_hash
from tradeweave.operators.cumulative import hash_rank
from tradeweave.operators.joins import typed_edges, with_reverse
from tradeweave.session import concurrently, stage


def simple_digraph(edges: DataFrame) -> DataFrame:
    """Parallel edges collapse; types are dropped."""
    return edges.select("src", "dst").distinct()


def undirected(edges: DataFrame) -> DataFrame:
    pairs = edges.filter(F.col("src") != F.col("dst")).select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    return pairs.distinct()


def degrees(nodes: DataFrame, edges: DataFrame, simple: bool = False) -> DataFrame:
    """In, out and total degree of every node on the simple digraph; one shuffle for both directions.

    `simple`, here and below: `edges` is a staged simple digraph already.
    """
    ends = (edges if simple else simple_digraph(edges)).select(F.explode(F.array(
        F.struct(F.col("src").alias("node_id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("node_id"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e")).select("e.*")
    counted = ends.groupBy("node_id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    out = nodes.select("node_id").join(counted, "node_id", "left").fillna(0, ["in_degree", "out_degree"])
    return out.withColumn("degree", F.col("in_degree") + F.col("out_degree"))


def density(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = nodes.agg(F.count(F.lit(1))).scalar()
    return simple_digraph(edges).agg(F.count(F.lit(1)).alias("n_edges")).select(
        n.alias("n_nodes"), "n_edges", ratio(F.col("n_edges"), n * (n - 1)).alias("density"))


def pagerank(nodes: DataFrame, edges: DataFrame, alpha: float = 0.85, rounds: int = 30, stage_every: int = 5,
             simple: bool = False) -> DataFrame:
    """PageRank with uniform teleport and uniform dangling mass, scaled to sum 1.

    The fixed point with dangling nodes is the one without them, rescaled; so each round is one join and one
    aggregation, and the dangling mass needs no extra pass. Nodes without out-links pass nothing on: all rounds but the
    last follow only the links between nodes that have some.
    """
    digraph = edges if simple else stage(simple_digraph(edges))
    out = digraph.groupBy("src").agg(F.count(F.lit(1)).alias("d"))
    links = stage(digraph.join(out, "src").select(F.col("src").alias("node_id"), "dst", (1.0 / F.col("d")).alias("w")))
    ids = stage(nodes.select("node_id"))
    n = ids.count()
    passing = stage(ids.join(links.select("node_id").distinct(), "node_id", "left_semi"))
    inner = stage(links.join(passing.select(F.col("node_id").alias("dst")).distinct(), "dst", "left_semi"))

    def after_round(ranks: DataFrame, over: DataFrame, of: DataFrame) -> DataFrame:
        inflow = ranks.join(over, "node_id").groupBy(F.col("dst").alias("node_id")).agg(
            F.sum(F.col("rank") * F.col("w")).alias("inflow"))
        return of.join(inflow, "node_id", "left").select(
            "node_id", (F.lit((1.0 - alpha) / n) + F.lit(alpha) * F.coalesce("inflow", F.lit(0.0))).alias("rank"))

    start = F.lit(1.0 / n) if n else F.lit(0.0)
    ranks = (passing if rounds else ids).withColumn("rank", start)
    for i in range(rounds):
        last = i == rounds - 1
        ranks = after_round(ranks, links, ids) if last else after_round(ranks, inner, passing)
        if (i + 1) % stage_every == 0 or last:
            ranks = stage(ranks)
    total = ranks.agg(F.sum("rank")).scalar()
    return ranks.select("node_id", (F.col("rank") / total).alias("pagerank"))


def clustering(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Undirected clustering coefficient 2T / (d (d - 1)).

    Every edge points from its lower-degree end to the higher one; a triangle is then a common out-neighbour of an
    edge's two ends. Out-lists are at most sqrt(2m) long, also at hubs, and only real triangles become rows. A node's list
    meets the lists of its neighbours that have one, few as a rule: leaves of hubs lead to the same hubs.
    """
    pairs = stage(undirected(edges))
    deg = pairs.select(F.explode(F.array("a", "b")).alias("node_id")).groupBy("node_id").agg(F.count(F.lit(1)).alias("d"))
    deg = stage(deg)
    end = lambda c: deg.select(F.col("node_id").alias(c), F.col("d").alias(f"d_{c}"))
    ranked = pairs.join(end("a"), "a").join(end("b"), "b")
    low_first = F.struct("d_a", "a") < F.struct("d_b", "b")
    oriented = ranked.select(F.when(low_first, F.col("a")).otherwise(F.col("b")).alias("u"),
                             F.when(low_first, F.col("b")).otherwise(F.col("a")).alias("v"))
    outs = stage(oriented.groupBy("u").agg(F.collect_list("v").alias("nbrs")))
    heads = outs.select(F.explode("nbrs").alias("u")).distinct()
    lists = stage(outs.join(heads, "u", "left_semi").select(F.col("u").alias("v"), F.col("nbrs").alias("nv")))
    both = outs.select("u", F.col("nbrs").alias("nu"), F.explode("nbrs").alias("v")).join(lists, "v")
    common = both.select("u", "v", F.explode(F.array_intersect("nu", "nv")).alias("w"))
    triangles = common.select(F.explode(F.array("u", "v", "w")).alias("node_id")).groupBy("node_id").agg(
        F.count(F.lit(1)).alias("t"))
    out = nodes.select("node_id").join(deg, "node_id", "left").join(triangles, "node_id", "left").fillna(0, ["d", "t"])
    coefficient = F.coalesce(ratio(2.0 * F.col("t"), F.col("d") * (F.col("d") - 1)), F.lit(0.0))
    return out.select("node_id", F.col("t").alias("n_triangles"), F.when(F.col("d") < 2, 0.0).otherwise(coefficient)
                      .alias("clustering_coefficient"))


def pivots(nodes: DataFrame, k: int) -> DataFrame:
    """k nodes in hash order: a reproducible stand-in for a seeded draw."""
    return nodes.select("node_id", stable_hash(F.col("node_id"), salt="pivot").alias("h")).orderBy("h", "node_id").limit(k).select(
        F.col("node_id").alias("pivot"))


def betweenness(nodes: DataFrame, edges: DataFrame, k: int = 80, simple: bool = False, start: DataFrame | None = None) -> DataFrame:
    """Directed betweenness from k pivots, scaled by n/k and normalised by (n-1)(n-2).

    Breadth-first levels run for all pivots at once (one join + aggregation per level, until no node is new), then
    dependencies flow back level by level. Rows are k * n at most. Nodes without out-links end a path: only the others of a
    level meet the links. `start`(pivot): the pivots, if drawn already.
    """
    ids = stage(nodes.select("node_id"))
    n = ids.count()
    k = min(k, n)
    links = (edges if simple else simple_digraph(edges)).filter(F.col("src") != F.col("dst"))
    links = links if simple else stage(links)
    passing = stage(links.select(F.col("src").alias("node_id")).distinct())
    level = stage((pivots(ids, k) if start is None else start).select("pivot", F.col("pivot").alias("node_id"), F.lit(1.0).alias("sigma")))
    levels, seen = [level], level.select("pivot", "node_id")
    while True:
        onward = stage(level.join(passing, "node_id", "left_semi"))
        reached = onward.join(links, F.col("node_id") == F.col("src")).groupBy("pivot", F.col("dst").alias("node_id")).agg(
            F.sum("sigma").alias("sigma"))
        fresh = stage(reached.join(seen, ["pivot", "node_id"], "left_anti"))
        if fresh.isEmpty():
            break
        levels.append(fresh)
        seen = seen.unionByName(fresh.select("pivot", "node_id"))
        level = fresh
    # walk back: delta(v) = sum over successors w one level down of sigma(v)/sigma(w) * (1 + delta(w))
    below = stage(levels[-1].withColumn("delta", F.lit(0.0)))
    collected = [below]
    for current in reversed(levels[:-1]):
        down = below.select("pivot", F.col("node_id").alias("w"), ((1.0 + F.col("delta")) / F.col("sigma")).alias("share"))
        credit = (down.join(links, F.col("w") == F.col("dst")).groupBy("pivot", F.col("src").alias("node_id"))
                  .agg(F.sum("share").alias("credit")))
        below = stage(current.join(credit, ["pivot", "node_id"], "left").select(
            "pivot", "node_id", "sigma", (F.col("sigma") * F.coalesce("credit", F.lit(0.0))).alias("delta")))
        collected.append(below)
    parts = collected[0]
    for p in collected[1:]:
        parts = parts.unionByName(p)
    total = parts.filter(F.col("pivot") != F.col("node_id")).groupBy("node_id").agg(F.sum("delta").alias("s"))
    scale = (n / k) / ((n - 1) * (n - 2)) if n > 2 else 0.0
    return ids.join(total, "node_id", "left").select(
        "node_id", (F.coalesce("s", F.lit(0.0)) * F.lit(scale)).alias("betweenness_centrality"))


def with_network_position(nodes: DataFrame, edges: DataFrame, pivot_count: int = 80, rounds: int = 30) -> DataFrame:
    """Nodes plus the five network columns. The three measures of many small rounds run side by side.

    They share one simple digraph, whose ends are whole numbers where every id is one that `entity_id` makes: shorter to send,
    sort and compare than texts.
    """
    code = lambda c: entity_code(F.col(c))
    other = lambda c: F.col(c).isNotNull() & code(c).isNull()
    digraph = stage(edges.select(code("src").alias("src"), code("dst").alias("dst"), (other("src") | other("dst")).alias("other")).distinct())
    if digraph.filter("other").isEmpty() and nodes.filter(other("node_id")).isEmpty():
        digraph = digraph.drop("other")
    else:
        code, digraph = F.col, stage(simple_digraph(edges))
    ids = nodes.select(code("node_id").alias("node_id"))
    start = pivots(nodes, pivot_count).select(code("pivot").alias("pivot"))
    measured = concurrently([partial(betweenness, ids, digraph, pivot_count, simple=True, start=start), partial(clustering, ids, digraph),
                             partial(pagerank, ids, digraph, rounds=rounds, simple=True)])
    parts = [degrees(ids, digraph, simple=True).select("node_id", "in_degree", "out_degree"), measured[0],
             measured[1].select("node_id", "clustering_coefficient"), measured[2]]
    out = nodes.withColumn("_code", code("node_id"))
    for p in parts:
        out = out.join(p.withColumnRenamed("node_id", "_code"), "_code", "left")
    out = out.drop("_code")
    return out.fillna(0.0, ["betweenness_centrality", "clustering_coefficient", "pagerank"]).fillna(0, ["in_degree", "out_degree"])


# ------------------------------------------------------------------ typed neighbour aggregation
def relation_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Typed edges in both directions with a bounded log-scale strength from whichever measure the family has."""
    strength = F.log1p(F.coalesce(F.col("value"), F.col("cost"), F.lit(0.0))) / 10.0
    both = with_reverse(typed_edges(edges.select("src", "dst", "edge_type", strength.alias("strength")), nodes))
    return both.select("src", "dst", F.concat_ws(":", "src_type", "edge_type", "dst_type").alias("relation"), "strength")


def attention(rel: DataFrame) -> DataFrame:
    """Softmax of edge strength over the in-edges of a node within one relation.

    The group's peak and mass come from partial aggregates joined back, so a hub's in-edges never meet in one task.
    """
    gated = with_gates(rel)
    mass = gated.groupBy("dst", "relation").agg(F.sum("gate").alias("mass"))
    return gated.join(mass, ["dst", "relation"]).withColumn("weight", F.col("gate") / F.col("mass")).drop("gate", "mass")


def with_gates(rel: DataFrame) -> DataFrame:
    """`gate` = exp(strength - the group's largest strength): never overflows, whatever the scale of strengths."""
    peak = rel.groupBy("dst", "relation").agg(F.max("strength").alias("peak"))
    return rel.join(peak, ["dst", "relation"]).withColumn("gate", F.exp(F.col("strength") - F.col("peak"))).drop("peak")


def propagate(features: DataFrame, rel: DataFrame, columns: Sequence[str], hops: int = 3) -> DataFrame:
    """h' = layer_norm(h + sum over relations of the attention-weighted mean of neighbours), `hops` times.

    Softmax weights enter as sum(gate * h) / sum(gate): one aggregation per hop, no window over neighbours.
    """
    h = features.select("node_id", *columns)
    rel = stage(with_gates(rel))
    gate = F.col("gate")
    for _ in range(hops):
        messages = rel.join(h.withColumnRenamed("node_id", "src"), "src").groupBy("dst", "relation").agg(
            *[(F.sum(gate * F.col(c)) / F.sum(gate)).alias(c) for c in columns])
        summed = messages.groupBy(F.col("dst").alias("node_id")).agg(*[F.sum(c).alias(f"_{c}") for c in columns])
        mixed = h.join(summed, "node_id", "left").select(
            "node_id", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0.0))).alias(c) for c in columns])
        h = stage(layer_norm(mixed, columns))
    return h


def layer_norm(df: DataFrame, columns: Sequence[str], eps: float = 1e-5) -> DataFrame:
    d = float(len(columns))
    mean = sum((F.col(c) for c in columns[1:]), F.col(columns[0])) / d
    with_mean = df.withColumn("_m", mean)
    squares = [(F.col(c) - F.col("_m")) * (F.col(c) - F.col("_m")) for c in columns]
    var = sum(squares[1:], squares[0]) / d
    return with_mean.withColumn("_s", F.sqrt(var + eps)).select(
        "node_id", *[((F.col(c) - F.col("_m")) / F.col("_s")).alias(c) for c in columns])


# ------------------------------------------------------------------ links
def negative_links(positives: DataFrame, nodes: DataFrame, all_edges: DataFrame) -> DataFrame:
    """For each (src, dst, dst_type) one node of dst's type drawn by hash; true edges are taken out.

    Drawn by position: types are ranked once in hash order and met on (type, position), an equi-join.
    """
    hashed = nodes.select("node_id", F.col("node_type").alias("dst_type"), stable_hash(F.col("node_id"), salt="rank").alias("h"))
    ranked = stage(hash_rank(hashed, "h", ["node_id"], ["dst_type"]).select(
        "dst_type", (F.col("rn") - 1).alias("position"), F.col("node_id").alias("drawn")))
    sizes = ranked.groupBy("dst_type").agg(F.count(F.lit(1)).alias("size"))
    draw = stable_hash(F.col("src"), F.col("dst"), salt="negative")
    picks = positives.join(sizes, "dst_type").withColumn("position", draw % F.col("size"))
    pairs = picks.join(ranked, ["dst_type", "position"]).select("src", F.col("drawn").alias("dst"))
    return pairs.filter(F.col("src") != F.col("dst")).distinct().join(simple_digraph(all_edges), ["src", "dst"], "left_anti")


def link_scores(pairs: DataFrame, vectors: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scaled dot product of the two ends' vectors."""
    end = lambda c: vectors.select(F.col("node_id").alias(c), F.array(*columns).alias(f"v_{c}"))
    from tradeweave.functions.vectors import scaled_dot
    return pairs.join(end("src"), "src").join(end("dst"), "dst").withColumn(
        "score", scaled_dot(F.col("v_src"), F.col("v_dst"))).drop("v_src", "v_dst")


def common_neighbour_features(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Common neighbours, Jaccard, Adamic-Adar and preferential attachment of given pairs.

    Each pair expands the neighbours of its lower-degree end only and probes the edge (neighbour, other end):
    exact, with no cap and no neighbour-pair blow-up at hubs.
    """
    und = undirected(edges)
    sym = stage(und.select(F.col("a").alias("x"), F.col("b").alias("nbr")).unionByName(
        und.select(F.col("b").alias("x"), F.col("a").alias("nbr"))))
    deg = stage(sym.groupBy("x").agg(F.count(F.lit(1)).alias("d")))
    d = lambda c: deg.select(F.col("x").alias(c), F.col("d").alias(f"d_{c}"))
    sized = pairs.select("src", "dst").distinct().join(d("src"), "src", "left").join(d("dst"), "dst", "left").fillna(0, ["d_src", "d_dst"])
    sized = stage(sized)
    small_src = F.col("d_src") <= F.col("d_dst")
    probes = sized.select("src", "dst", F.when(small_src, F.col("src")).otherwise(F.col("dst")).alias("x"),
                          F.when(small_src, F.col("dst")).otherwise(F.col("src")).alias("other")).join(sym, "x")
    hits = probes.join(sym.select(F.col("x").alias("other"), "nbr"), ["other", "nbr"])
    weighed = hits.join(deg.select(F.col("x").alias("nbr"), F.col("d").alias("d_nbr")), "nbr").groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("common"), F.sum(F.when(F.col("d_nbr") > 1, 1.0 / F.log(F.col("d_nbr").cast("double"))))
        .alias("adamic_adar"))
    out = sized.join(weighed, ["src", "dst"], "left").fillna(0, ["common"]).fillna(0.0, ["adamic_adar"])
    union = F.col("d_src") + F.col("d_dst") - F.col("common")
    return out.select("src", "dst", "common", settle(F.coalesce(ratio(F.col("common"), union), F.lit(0.0))).alias("jaccard"),
                      settle(F.col("adamic_adar")).alias("adamic_adar"),
                      (F.col("d_src") * F.col("d_dst")).alias("preferential_attachment"))


# ------------------------------------------------------------------ exposure roll-ups
def ownership_rollup(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    own = edges.filter(F.col("edge_type") == "ownership").select(F.col("src").alias("parent"), F.col("dst").alias("node_id"))
    return own.join(nodes, "node_id").groupBy("parent").agg(
        F.count(F.lit(1)).alias("n_subsidiaries"), F.round(F.sum("revenue"), 2).alias("group_revenue"),
        F.max("debt_to_equity").alias("worst_leverage"))


def bank_exposure(edges: DataFrame) -> DataFrame:
    v = F.col("value")
    return edges.filter(F.col("edge_type") == "financial").groupBy(F.col("src").alias("bank")).agg(
        F.count(F.lit(1)).alias("n_clients"), F.round(F.sum(v), 2).alias("exposure"),
        F.round(F.sum("outstanding_balance"), 2).alias("outstanding"),
        settle(ratio(F.sum(v * v), F.sum(v) * F.sum(v))).alias("client_hhi"),
        settle(F.avg("payment_terms_days")).alias("mean_terms"))


def sourcing_shares(edges: DataFrame) -> DataFrame:
    """Share of each buyer's inflow value per seller."""
    flows = edges.filter(F.col("edge_type") == "material_flow").select("src", "dst", "value")
    total = flows.groupBy("dst").agg(F.sum("value").alias("total"))
    return flows.join(total, "dst").select("src", "dst", (F.col("value") / F.col("total")).alias("share"))


def tier_two_exposure(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exposure of given (customer, tier_two) pairs: share products summed over the two-hop paths between them.

    Only asked-for pairs are expanded, over the customer's own sellers: a hub in the middle never pairs all its
    suppliers with all its customers.
    """
    shares = stage(sourcing_shares(edges))
    wanted = pairs.select("customer", "tier_two").distinct()
    near = shares.select(F.col("dst").alias("customer"), F.col("src").alias("mid"), F.col("share").alias("s1"))
    far = shares.select(F.col("dst").alias("mid"), F.col("src").alias("tier_two"), F.col("share").alias("s2"))
    return wanted.join(near, "customer").join(far, ["tier_two", "mid"]).groupBy("customer", "tier_two").agg(
        settle(F.sum(F.col("s1") * F.col("s2"))).alias("exposure"))


def tier_two_risk(edges: DataFrame, nodes: DataFrame, risk: str) -> DataFrame:
    """Risk a customer carries through its sellers' sellers: two share-weighted aggregations, no pairs at all."""
    shares = stage(sourcing_shares(edges))
    tier_one = (shares.join(nodes.select(F.col("node_id").alias("src"), F.col(risk).alias("r")), "src")
                .groupBy(F.col("dst").alias("src")).agg(F.sum(F.col("share") * F.col("r")).alias("r")))
    return shares.join(tier_one, "src").groupBy(F.col("dst").alias("node_id")).agg(
        settle(F.sum(F.col("share") * F.col("r"))).alias("tier_two_risk"))
