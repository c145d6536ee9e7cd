"""Scans, sinks, projections, filters, scalar functions, joins and set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tradeweave.functions import scalar as S
from tradeweave.functions import vectors as V
from tradeweave.operators import joins as J
from tradeweave.operators import profile, scorecards, splits
from tradeweave.plans.oracle_base import TENOR, eid, hash32, sql
from tradeweave.plans.registry import Section
from tradeweave.session import forget_at_exit, shared_dir
from tradeweave.sources import contract as C
from tradeweave.sources.tables import read_results_json, write_results_json

section = Section()
QUERIES, ORACLES = section.queries, section.oracles
FINANCIAL = ["current_ratio", "debt_to_equity", "ebitda_margin", "interest_coverage"]


# ------------------------------------------------------------------ sources and sinks
@section.add("s1_orders_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
             "CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders")
def s1(m):
    return m.orders.withColumn("o_orderdate", F.to_date("o_orderdate"))


@section.add("s3_date_spine_gaps", sql(["series"], """
SELECT port, count(*) AS n_days, count(*) FILTER (throughput_teu = 0) AS n_gap_days, min(date) AS first_day,
       max(date) AS last_day FROM series GROUP BY port"""))
def s3(m):
    return m.series.groupBy("port").agg(
        F.count(F.lit(1)).alias("n_days"), F.count_if(F.col("throughput_teu") == 0).alias("n_gap_days"),
        F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@section.add("s4_s5_json_results_round_trip", sql([], """
SELECT 'orders' AS section, unnest(['n_orders', 'pending_rate']) AS metric, unnest([CAST(count(*) AS DOUBLE),
 round(CAST(count(*) FILTER (o_orderstatus = 'P') AS DOUBLE) / count(*), 6)]) AS value FROM orders"""))
def s4(m):
    rates = m.orders.agg(F.count(F.lit(1)).alias("n_orders"),
                         S.settle(F.avg((F.col("o_orderstatus") == "P").cast("double"))).alias("pending_rate"))
    from tradeweave.operators.metrics import metric_rows
    path = f"{shared_dir(m.spark).rstrip('/')}/results-{uuid.uuid4().hex}"
    forget_at_exit(m.spark, path)
    write_results_json(metric_rows("orders", rates), path)
    return read_results_json(m.spark, path, "section string, metric string, value double")


@section.add("s6_hash_sample", f"SELECT o_orderkey, o_totalprice FROM orders WHERE "
             f"{hash32('o_orderkey', salt='sample')} % 100 < 10")
def s6(m):
    return splits.hash_sample(m.orders, ["o_orderkey"], 10).select("o_orderkey", "o_totalprice")


@section.add("s8_entity_cap", sql(["series"], """
SELECT port, count(*) AS n, sum(throughput_teu) AS throughput FROM series
WHERE port IN (SELECT DISTINCT port FROM series ORDER BY port LIMIT 4) GROUP BY port"""))
def s8(m):
    return splits.cap_entities(m.series, "port", 4).groupBy("port").agg(
        F.count(F.lit(1)).alias("n"), F.sum("throughput_teu").alias("throughput"))


# ------------------------------------------------------------------ projections and predicates
@section.add("p1_column_pruning", sql(["nodes"], f"SELECT node_id, {', '.join(FINANCIAL)} FROM nodes"))
def p1(m):
    return m.nodes.select("node_id", *FINANCIAL)


@section.add("p2_derived_columns", """
SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net_value,
 round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS gross_value, sum(l_quantity) AS quantity
FROM lineitem GROUP BY ALL""")
def p2(m):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = m.lineitem.withColumns({"net": net, "gross": net * (1 + F.col("l_tax"))})
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("net"), 2).alias("net_value"), F.round(F.sum("gross"), 2).alias("gross_value"),
        F.sum("l_quantity").alias("quantity"))


@section.add("p3_drop_columns", sql(["nodes"], "SELECT otif_rate, ccc_days, survival_duration_days FROM nodes"))
def p3(m):
    return m.nodes.select("node_id", "otif_rate", "ccc_days", "survival_duration_days").drop("node_id")


@section.add("p4_equality_filter", sql(["nodes"], "SELECT node_id, otif_rate FROM nodes WHERE node_type = 'supplier'"))
def p4(m):
    return m.nodes.filter(F.col("node_type") == "supplier").select("node_id", "otif_rate")


@section.add("p5_membership_filter", sql(["nodes"], """
SELECT node_type, count(*) AS n FROM nodes WHERE node_type IN ('manufacturer', 'customer') GROUP BY node_type"""))
def p5(m):
    return m.nodes.filter(F.col("node_type").isin("manufacturer", "customer")).groupBy("node_type").agg(
        F.count(F.lit(1)).alias("n"))


@section.add("p6_known_endpoints_only", sql(["edges", "nodes"], """
SELECT edge_type, count(*) AS n FROM edges e
JOIN (SELECT node_id FROM nodes WHERE revenue > 0 AND node_type <> 'port') a ON a.node_id = e.src
JOIN (SELECT node_id FROM nodes WHERE revenue > 0 AND node_type <> 'port') b ON b.node_id = e.dst GROUP BY edge_type"""))
def p6(m):
    known = m.nodes.filter((F.col("revenue") > 0) & (F.col("node_type") != "port"))
    return J.typed_edges(m.edges, known).groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"))


@section.add("p7_point_lookup", sql(["edges", "nodes"], """
SELECT node_type, count(*) AS n_found, round(sum(revenue), 2) AS revenue FROM nodes
WHERE node_id IN (SELECT src FROM edges) GROUP BY node_type"""))
def p7(m):
    requests = m.edges.select(F.col("src").alias("node_id"))
    return J.checked_lookup(requests, m.nodes, "node_id").groupBy("node_type").agg(
        F.count(F.lit(1)).alias("n_found"), F.round(F.sum("revenue"), 2).alias("revenue"))


@section.add("p8_fill_missing_zero", sql(["nodes", "finance_edges"], """
SELECT n.node_id, coalesce(f.outstanding_balance, 0) AS outstanding_balance FROM nodes n
LEFT JOIN finance_edges f ON f.dst = n.node_id"""))
def p8(m):
    balance = C.financial(m).select(F.col("dst").alias("node_id"), "outstanding_balance")
    return m.nodes.select("node_id").join(balance, "node_id", "left").fillna(0.0, ["outstanding_balance"])


@section.add("p9_fill_missing_mean", sql(["lc", "nodes"], """
SELECT l.lc_id, round(coalesce(n.freight_cost_ratio, (SELECT avg(freight_cost_ratio) FROM nodes)), 6)
 AS beneficiary_freight_ratio FROM lc l LEFT JOIN nodes n ON n.node_id = l.beneficiary_id"""))
def p9(m):
    look = m.nodes.select(F.col("node_id").alias("beneficiary_id"), F.col("freight_cost_ratio"))
    filled = profile.fill_with_mean(m.lc.join(look, "beneficiary_id", "left"), "freight_cost_ratio", m.nodes)
    return filled.select("lc_id", S.settle(F.col("freight_cost_ratio")).alias("beneficiary_freight_ratio"))


@section.add("p10_p11_clip", """
SELECT l_returnflag, round(sum(least(greatest(l_extendedprice, 5000.0), 60000.0)), 2) AS both_sides,
 sum(least(l_quantity, 40.0)) AS upper_only, round(sum(greatest(l_tax, 0.02)), 2) AS lower_only FROM lineitem GROUP BY 1""")
def p10(m):
    return m.lineitem.groupBy("l_returnflag").agg(
        F.round(F.sum(S.clip(F.col("l_extendedprice"), 5000.0, 60000.0)), 2).alias("both_sides"),
        F.sum(S.clip(F.col("l_quantity"), high=40.0)).alias("upper_only"),
        F.round(F.sum(S.clip(F.col("l_tax"), low=0.02)), 2).alias("lower_only"))


@section.add("p12_threshold_flag", sql(["nodes"], "SELECT node_id, ccc_days > 60 AS over_limit FROM nodes"))
def p12(m):
    return m.nodes.select("node_id", (F.col("ccc_days") > 60.0).alias("over_limit"))


@section.add("p13_casts", """
SELECT l_linenumber, CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS whole_units,
 CAST(count(*) FILTER (l_returnflag = 'R') AS INTEGER) AS n_returned FROM lineitem GROUP BY l_linenumber""")
def p13(m):
    return m.lineitem.groupBy("l_linenumber").agg(
        F.sum(F.col("l_extendedprice").cast("bigint")).alias("whole_units"),
        F.sum((F.col("l_returnflag") == "R").cast("int")).cast("int").alias("n_returned"))


@section.add("p14_quality_rules", sql(["nodes"], """
SELECT unnest(['otif_in_range', 'ccc_positive', 'duration_in_range', 'country_known']) AS rule,
 unnest([count(*) FILTER (otif_rate NOT BETWEEN 0 AND 1), count(*) FILTER (NOT ccc_days > 0),
  count(*) FILTER (NOT (survival_duration_days > 0 AND survival_duration_days <= 730)),
  count(*) FILTER (country IS NULL)]) AS n_broken, count(*) AS n_rows FROM nodes"""))
def p14(m):
    return profile.rule_violations(m.nodes, {
        "otif_in_range": F.col("otif_rate").between(0, 1), "ccc_positive": F.col("ccc_days") > 0,
        "duration_in_range": (F.col("survival_duration_days") > 0) & (F.col("survival_duration_days") <= 730),
        "country_known": F.col("country").isNotNull()})


def shipment_shape(lc):
    """A letter of credit seen as a shipment: its route, congestion and discrepancy fields renamed and rescaled."""
    return lc.select(
        "lc_id", F.col("port_congestion_origin").alias("origin_congestion_index"),
        F.col("port_congestion_destination").alias("destination_congestion_index"),
        S.settle(1.0 - 0.15 * F.col("freight_rate_percentile")).alias("vessel_speed_ratio"),
        S.settle(1.0 - 0.5 * F.col("historical_discrepancy_rate_beneficiary")).alias("carrier_reliability_score"),
        S.settle(0.6 * F.col("trade_route_risk_score")).alias("weather_risk_score"),
        F.col("lc_amount_usd").alias("cargo_value_usd"))


SHAPE_SQL = """SELECT lc_id, port_congestion_origin AS origin_congestion_index,
 port_congestion_destination AS destination_congestion_index,
 round(1.0 - CAST(0.15 AS DOUBLE) * freight_rate_percentile, 6) AS vessel_speed_ratio,
 round(1.0 - CAST(0.5 AS DOUBLE) * historical_discrepancy_rate_beneficiary, 6) AS carrier_reliability_score,
 round(CAST(0.6 AS DOUBLE) * trade_route_risk_score, 6) AS weather_risk_score, lc_amount_usd AS cargo_value_usd FROM lc"""


@section.add("p15_lc_as_shipment", sql(["lc"], SHAPE_SQL))
def p15(m):
    return shipment_shape(m.lc)


@section.add("p16_supplier_count_proxy", sql(["nodes"], """
SELECT node_id, round(least(1 / nullif(supplier_concentration_hhi, 0), 8), 6) AS alternative_suppliers FROM nodes"""))
def p16(m):
    return m.nodes.select("node_id", S.settle(F.least(
        S.ratio(F.lit(1.0), F.col("supplier_concentration_hhi")), F.lit(8.0))).alias("alternative_suppliers"))


# ------------------------------------------------------------------ scalar functions
@section.add("f1_f2_scalar_math", """
SELECT l_returnflag, round(avg(1 / (1 + exp(-(l_quantity - 25) / 10))), 6) AS logistic_mean,
 round(avg(ln(l_extendedprice)), 6) AS log_mean, round(avg(sqrt(l_quantity)), 6) AS sqrt_mean,
 round(avg(pow(l_quantity / 50, 1.4)), 6) AS power_mean, round(avg(sin(2 * pi() * l_quantity / 50)), 6) AS sin_mean,
 round(avg(abs(l_quantity - 25)), 6) AS abs_mean FROM lineitem GROUP BY 1""".replace(", 6)", " + 1e-9, 6)"))
def f1(m):
    q, price = F.col("l_quantity"), F.col("l_extendedprice")
    return m.lineitem.groupBy("l_returnflag").agg(
        S.settle(F.avg(S.logistic((q - 25) / 10))).alias("logistic_mean"), S.settle(F.avg(F.log(price))).alias("log_mean"),
        S.settle(F.avg(F.sqrt(q))).alias("sqrt_mean"), S.settle(F.avg(F.pow(q / 50, F.lit(1.4)))).alias("power_mean"),
        S.settle(F.avg(F.sin(F.lit(S.TWO_PI) * q / 50))).alias("sin_mean"), S.settle(F.avg(F.abs(q - 25))).alias("abs_mean"))


@section.add("f3_f4_f6_ids_rounding_dates", f"""
SELECT 'LC_' || printf('%09d', o_orderkey) AS lc_id, {eid('CUST', 'o_custkey')} AS applicant_id,
 round(o_totalprice, 1) AS amount_1dp, CAST(CAST(o_orderdate AS DATE) + {TENOR} AS DATE) AS due_day FROM orders""")
def f3(m):
    tenor = S.lookup(F.col("o_orderpriority"), C.TENOR_DAYS, 90)
    return m.orders.select(
        F.concat(F.lit("LC_"), S.padded(F.col("o_orderkey"), 9)).alias("lc_id"), S.entity_id("customer", F.col("o_custkey")).alias("applicant_id"),
        F.round("o_totalprice", 1).alias("amount_1dp"), F.date_add(F.to_date("o_orderdate"), tenor).alias("due_day"))


@section.add("f5_u3_reverse_relations", sql(["edges", "node_keys"], """
SELECT starts_with(edge_type, 'rev_') AS is_reverse, edge_type, src_type, dst_type, count(*) AS n FROM (
 SELECT e.edge_type, a.node_type AS src_type, b.node_type AS dst_type FROM edges e
 JOIN nodes_t a ON a.node_id = e.src JOIN nodes_t b ON b.node_id = e.dst
 UNION ALL SELECT 'rev_' || e.edge_type, b.node_type, a.node_type FROM edges e
 JOIN nodes_t a ON a.node_id = e.src JOIN nodes_t b ON b.node_id = e.dst) GROUP BY ALL""").replace(
    "nodes_t", "node_keys"))
def f5(m):
    both = J.with_reverse(J.typed_edges(m.edges.select("src", "dst", "edge_type"), m.node_types))
    return both.groupBy(F.col("edge_type").startswith("rev_").alias("is_reverse"), "edge_type", "src_type", "dst_type").agg(
        F.count(F.lit(1)).alias("n"))


@section.add("f7_days_from_turnover", sql(["nodes"], """
SELECT node_id, round(365.0 / greatest(inventory_turnover, 0.1), 6) AS days_inventory FROM nodes"""))
def f7(m):
    return m.nodes.select("node_id", S.settle(S.days_from_turnover(F.col("inventory_turnover"))).alias("days_inventory"))


_VEC_SQL = """SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) / len(embedding), 6) AS mean,
 round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 6) AS norm,
 CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS top_class FROM embeddings""".replace(
    ", 6)", " + 1e-9, 6)")


@section.add("a14_f11_vector_mean_norm_argmax", _VEC_SQL)
def a14(m):
    v = F.col("embedding")
    return m.embeddings.select("vec_id", S.settle(V.vector_mean(v)).alias("mean"), S.settle(V.vector_norm(v)).alias("norm"),
                               V.argmax(v).alias("top_class"))


@section.add("f10_scaled_dot_product", """
SELECT o_orderkey, round(list_sum(list_transform(list_zip(a.embedding, b.embedding),
  lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) / sqrt(len(a.embedding)) + 1e-9, 6) AS score
FROM (SELECT o_orderkey, o_custkey, l_suppkey FROM orders JOIN (SELECT l_orderkey, max(l_suppkey) AS l_suppkey FROM lineitem
 GROUP BY 1) ON l_orderkey = o_orderkey) JOIN embeddings a ON a.vec_id = o_custkey JOIN embeddings b ON b.vec_id = l_suppkey""")
def f10(m):
    pairs = m.orders.join(m.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_suppkey").alias("s")), "o_orderkey")
    a = m.embeddings.select(F.col("vec_id").alias("o_custkey"), F.col("embedding").alias("ea"))
    b = m.embeddings.select(F.col("vec_id").alias("s"), F.col("embedding").alias("eb"))
    return pairs.join(a, "o_custkey").join(b, "s").select(
        "o_orderkey", S.settle(V.scaled_dot(F.col("ea"), F.col("eb"))).alias("score"))


@section.add("f16_metrics_to_json_text", """
SELECT o_orderstatus, '{"n":' || count(*) || ',"price":{"mean":' || round(avg(o_totalprice), 2) || '}}' AS metrics FROM orders GROUP BY 1""")
def f16(m):
    stats = m.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 2).alias("mean"))
    return stats.select("o_orderstatus", F.to_json(F.struct("n", F.struct("mean").alias("price"))).alias("metrics"))


# ------------------------------------------------------------------ joins
@section.add("j1_features_with_survival_labels", sql(["nodes"], """
SELECT f.otif_rate, f.ccc_days, f.debt_to_equity, s.survival_duration_days, s.survival_event
FROM nodes f JOIN nodes s ON f.node_id = s.node_id"""))
def j1(m):
    labels = m.nodes.select("node_id", "survival_duration_days", "survival_event")
    return m.nodes.select("node_id", "otif_rate", "ccc_days", "debt_to_equity").join(labels, "node_id").drop("node_id")


@section.add("j2_score_lookup", sql(["lc", "nodes"], """
SELECT l.lc_id, n.current_ratio AS applicant_score FROM lc l LEFT JOIN nodes n ON n.node_id = l.applicant_id"""))
def j2(m):
    scores = m.nodes.select(F.col("node_id").alias("applicant_id"), F.col("current_ratio").alias("applicant_score"))
    return m.lc.join(scores, "applicant_id", "left").select("lc_id", "applicant_score")


@section.add("j3_a13_typed_relations", sql(["edges", "node_keys"], """
SELECT coalesce(a.node_type, 'logistics_provider') AS src_type, edge_type, b.node_type AS dst_type, count(*) AS n_edges,
 count(DISTINCT src) AS n_src FROM edges JOIN node_keys a ON a.node_id = src JOIN node_keys b ON b.node_id = dst GROUP BY ALL"""))
def j3(m):
    return J.typed_edges(m.edges.select("src", "dst", "edge_type"), m.node_types).groupBy("src_type", "edge_type", "dst_type").agg(
        F.count(F.lit(1)).alias("n_edges"), F.countDistinct("src").alias("n_src"))


@section.add("j4_two_role_enrichment", sql(["lc"], """
SELECT lc_id, applicant_country, beneficiary_country, applicant_leverage, beneficiary_otif_rate,
 country_risk_differential FROM lc"""))
def j4(m):
    parties = m.lc.select("lc_id", "applicant_id", "beneficiary_id")
    return C.with_two_roles(parties, m.nodes).select(
        "lc_id", "applicant_country", "beneficiary_country", "applicant_leverage", "beneficiary_otif_rate",
        "country_risk_differential")


def entity_vectors(m):
    """Vectors of customers and suppliers: the embedding with the entity's key."""
    vec = F.col("embedding").alias("vec")
    return (m.embeddings.select(S.entity_id("customer", F.col("vec_id")).alias("node_id"), vec)
            .unionByName(m.embeddings.select(S.entity_id("supplier", F.col("vec_id")).alias("node_id"), vec)))


_EMB = f"""emb AS ({_VEC_SQL.replace(' + 1e-9', '')})"""
ROLE_SQL = f"""SELECT l.lc_id, coalesce(a.mean, 0) AS applicant_emb_mean, coalesce(a.norm, 0) AS applicant_emb_norm,
 coalesce(b.mean, 0) AS beneficiary_emb_mean, coalesce(b.norm, 0) AS beneficiary_emb_norm FROM lc l
LEFT JOIN ({_VEC_SQL.replace(' + 1e-9', '')}) a ON {eid('CUST', 'a.vec_id')} = l.applicant_id
LEFT JOIN ({_VEC_SQL.replace(' + 1e-9', '')}) b ON {eid('SUPP', 'b.vec_id')} = l.beneficiary_id"""


@section.add("j5_role_embeddings", sql(["lc"], ROLE_SQL))
def j5(m):
    out = J.role_vectors(m.lc.select("lc_id", "applicant_id", "beneficiary_id"), entity_vectors(m),
                         [("applicant_id", "applicant"), ("beneficiary_id", "beneficiary")])
    cols = ["applicant_emb_mean", "applicant_emb_norm", "beneficiary_emb_mean", "beneficiary_emb_norm"]
    return out.select("lc_id", *[S.settle(F.col(c)).alias(c) for c in cols])


@section.add("j6_key_concat", sql(["lc"], f"""
SELECT l.lc_id, l.tenor_days, s.weather_risk_score, s.vessel_speed_ratio FROM lc l JOIN ({SHAPE_SQL}) s ON s.lc_id = l.lc_id"""))
def j6(m):
    shape = shipment_shape(m.lc).select("lc_id", "weather_risk_score", "vessel_speed_ratio")
    return m.lc.select("lc_id", "tenor_days").join(shape, "lc_id")


@section.add("j7_constant_map", sql(["lc"], """
SELECT commodity_risk_category, CASE commodity_risk_category WHEN 'Low' THEN 0.0 WHEN 'Medium' THEN 1.0 ELSE 2.0 END::DOUBLE
 AS commodity_risk_num, count(*) AS n FROM lc GROUP BY ALL"""))
def j7(m):
    return m.lc.groupBy("commodity_risk_category", scorecards.commodity_num().alias("commodity_risk_num")).agg(
        F.count(F.lit(1)).alias("n"))


@section.add("j8_u5_required_types", sql(["edges", "node_keys"], """
SELECT 'node_type' AS kind, 6 - count(DISTINCT node_type) AS n_missing FROM node_keys
UNION ALL SELECT 'edge_type', 4 - count(DISTINCT edge_type) FROM edges"""))
def j8(m):
    need = lambda names, kind: m.spark.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias(kind))
    need_nodes, need_edges = need(C.NODE_TYPES, "node_type"), need(C.EDGE_TYPES, "edge_type")
    count = lambda wanted, have, kind: J.missing_keys(wanted, have.select(kind), kind).agg(
        F.count(F.lit(1)).alias("n_missing")).select(F.lit(kind).alias("kind"), "n_missing")
    return count(need_nodes, m.node_types, "node_type").unionByName(count(need_edges, m.edges, "edge_type"))


@section.add("j11_document_vs_observation", """
WITH claims AS (SELECT l_partkey AS asset, CAST(o_orderdate AS DATE) AS start_day, sum(l_quantity) AS claimed, count(*) AS n_claims
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
obs AS (SELECT l_partkey AS asset, CAST(l_shipdate AS DATE) AS obs_day, sum(l_quantity) AS observed FROM lineitem GROUP BY 1, 2)
SELECT c.asset, c.start_day, c.claimed, c.n_claims, coalesce(sum(o.observed), 0) AS observed,
 c.claimed - coalesce(sum(o.observed), 0) AS discrepancy
FROM claims c LEFT JOIN obs o ON o.asset = c.asset AND o.obs_day BETWEEN c.start_day AND c.start_day + 30
GROUP BY c.asset, c.start_day, c.claimed, c.n_claims""")
def j11(m):
    claims = m.lineitem.join(m.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey").select(
        F.col("l_partkey").alias("asset"), F.to_date("o_orderdate").alias("start_day"), F.col("l_quantity").alias("claimed"))
    obs = m.lineitem.select(F.col("l_partkey").alias("asset"), F.to_date("l_shipdate").alias("obs_day"),
                            F.col("l_quantity").alias("observed"))
    out = J.observed_in_window(claims, obs, 30)
    return out.withColumn("discrepancy", F.col("claimed") - F.col("observed"))


# ------------------------------------------------------------------ set operations
@section.add("u1_u2_edge_family_union", sql(["edges"], """
SELECT edge_type, count(*) AS n, count(volume) AS n_volume, count(cost) AS n_cost, count(outstanding_balance) AS n_balance
FROM edges GROUP BY edge_type"""))
def u1(m):
    return m.edges.groupBy("edge_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("volume").alias("n_volume"), F.count("cost").alias("n_cost"),
        F.count("outstanding_balance").alias("n_balance"))


@section.add("u4_id_concat", sql(["node_keys"], """
SELECT node_id FROM node_keys WHERE node_type = 'supplier' UNION ALL
SELECT node_id FROM node_keys WHERE node_type = 'manufacturer'"""))
def u4(m):
    ids = lambda t: m.node_types.filter(F.col("node_type") == t).select("node_id")
    return ids("supplier").union(ids("manufacturer"))
