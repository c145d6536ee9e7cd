"""Aggregations, profiles, sorting and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeweave.functions.scalar import ratio, settle
from tradeweave.operators import fusion, graph, metrics, profile, scorecards
from tradeweave.plans.oracle_base import cte, sql
from tradeweave.plans.registry import Section
from tradeweave.sources import contract

section = Section()
QUERIES, ORACLES = section.queries, section.oracles

PROFILE_COLUMNS = ["otif_rate", "inventory_turnover", "ccc_days", "debt_to_equity", "freight_cost_ratio"]


def describe_sql(source: str, columns: list[str], by: str = "") -> str:
    """Twin of profile.describe: one UNION branch per column and statistic."""
    stats = [("count", "CAST(count({c}) AS DOUBLE)"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"), ("min", "min({c})"),
             ("25%", "quantile_cont({c}, 0.25)"), ("50%", "quantile_cont({c}, 0.5)"), ("75%", "quantile_cont({c}, 0.75)"),
             ("max", "max({c})")]
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return "\nUNION ALL\n".join(
        f"SELECT {head}'{c}' AS metric, '{name}' AS stat, round(CAST({expr.format(c=c)} AS DOUBLE), 6) AS value FROM {source}{tail}"
        for c in columns for name, expr in stats)


@section.add("a1_table_sizes", sql(["nodes", "edges"], """
SELECT (SELECT count(*) FROM nodes) AS n_nodes, (SELECT count(*) FROM edges) AS n_edges,
 (SELECT count(*) FROM edges WHERE edge_type = 'transportation') AS n_transport_links"""))
def a1(m):
    nodes = m.node_types.agg(F.count(F.lit(1)).alias("n_nodes")).scalar()
    return m.edges.agg(F.count(F.lit(1)).alias("n_edges"),
                       F.count_if(F.col("edge_type") == "transportation").alias("n_transport_links")).select(
        nodes.alias("n_nodes"), "n_edges", "n_transport_links")


@section.add("a2_label_rates", sql(["nodes", "lc", "shipments"], """
SELECT round((SELECT avg(default_12m) FROM nodes), 6) AS node_default_rate,
 round((SELECT avg(is_default) FROM lc), 6) AS lc_default_rate, round((SELECT avg(delayed) FROM shipments), 6) AS delay_rate"""))
def a2(m):
    rate = lambda df, c: df.agg(settle(F.avg(F.col(c).cast("double"))).alias(c)).scalar()
    return m.nodes.agg(settle(F.avg("default_12m")).alias("node_default_rate")).select(
        "node_default_rate", rate(m.lc, "is_default").alias("lc_default_rate"), rate(m.shipments, "delayed").alias("delay_rate"))


@section.add("a3_frequency_table", sql(["node_keys"], "SELECT node_type, count(*) AS n FROM node_keys GROUP BY node_type"))
def a3(m):
    return profile.value_counts(m.node_types, "node_type")


@section.add("a4_describe_by_port", sql(["series"], describe_sql(
    "series", ["throughput_teu", "freight_rate_usd_feu"], by="port")))
def a4(m):
    return profile.describe(m.series, ["throughput_teu", "freight_rate_usd_feu"], by=["port"])


@section.add("a5_describe", sql(["nodes"], describe_sql("nodes", PROFILE_COLUMNS)))
def a5(m):
    return profile.describe(m.nodes, PROFILE_COLUMNS)


@section.add("a6_distinct_counts", """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT CAST(l_shipdate AS DATE)) AS n_days
FROM lineitem GROUP BY 1""")
def a6(m):
    return m.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_suppkey").alias("n_suppliers"), F.countDistinct(F.to_date("l_shipdate")).alias("n_days"))


@section.add("a6_sketched_distinct_counts", """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(DISTINCT l_orderkey) AS n_orders,
 count(DISTINCT l_partkey) AS n_parts, TRUE AS within_error FROM lineitem GROUP BY 1""")
def a6_sketched(m):
    """Sketches of days merged to months, held against the exact counts."""
    names = {"n_orders": F.col("l_orderkey"), "n_parts": F.col("l_partkey")}
    lines = m.lineitem.select(F.to_date("l_shipdate").alias("day"), *names.values())
    month = F.trunc("day", "month").alias("month")
    days = profile.distinct_sketches(lines, names, ["day"])
    merged = profile.merged_estimates(days.select(month, *names), list(names), ["month"])
    exact = lines.groupBy(month).agg(*[F.countDistinct(c).alias(f"exact_{n}") for n, c in names.items()])
    near = F.lit(True)
    for n in names:
        near = near & (F.abs(F.col(n) - F.col(f"exact_{n}")) <= F.ceil(profile.sketch_error() * F.col(f"exact_{n}")))
    both = merged.withColumnRenamed("month", "m").join(exact, F.col("m").eqNullSafe(F.col("month")))
    return both.select("month", *[F.col(f"exact_{n}").alias(n) for n in names], near.alias("within_error"))


@section.add("a7_t5_sorted_distinct", sql(["node_keys"], "SELECT DISTINCT node_type FROM node_keys"))
def a7(m):
    return m.node_types.select("node_type").distinct().orderBy("node_type")


@section.add("a8_null_counts", sql(["nodes", "edges"], """
SELECT 'country' AS column_name, count(*) FILTER (country IS NULL) AS n_null, 'nodes' AS source FROM nodes
UNION ALL SELECT column_name, n_null, 'edges' FROM (SELECT unnest(['volume', 'value', 'mode', 'transit_time_days', 'cost',
 'payment_terms_days', 'outstanding_balance']) AS column_name, unnest([count(*) - count(volume), count(*) - count(value),
 count(*) - count(mode), count(*) - count(transit_time_days), count(*) - count(cost), count(*) - count(payment_terms_days),
 count(*) - count(outstanding_balance)]) AS n_null FROM edges)"""))
def a8(m):
    return profile.null_counts(m.nodes).withColumn("source", F.lit("nodes")).unionByName(
        profile.null_counts(m.edges).withColumn("source", F.lit("edges")))


@section.add("a9_t3_target_correlations", sql(["nodes"], "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(corr({c}, lead_time_mean), 6) AS correlation FROM nodes" for c in PROFILE_COLUMNS)))
def a9(m):
    return profile.target_correlations(m.nodes, PROFILE_COLUMNS, "lead_time_mean")


@section.add("a10_zscore", sql(["nodes"], "SELECT node_id, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM nodes)) / (SELECT stddev_samp({c}) FROM nodes), 6) AS {c}"
    for c in PROFILE_COLUMNS) + " FROM nodes"))
def a10(m):
    return profile.zscore(m.nodes, PROFILE_COLUMNS).select("node_id", *[settle(F.col(c)).alias(c) for c in PROFILE_COLUMNS])


@section.add("a12_log_zscore", """
SELECT l_returnflag, round(avg(z) + 1e-9, 6) AS mean_z, round(min(z) + 1e-9, 6) AS min_z, round(max(z) + 1e-9, 6) AS max_z FROM (
 SELECT l_returnflag, (ln(greatest(l_extendedprice, 1)) - s.mu) / (s.sd + 1e-8) AS z FROM lineitem,
  (SELECT avg(ln(greatest(l_extendedprice, 1))) AS mu, stddev_pop(ln(greatest(l_extendedprice, 1))) AS sd FROM lineitem) s)
GROUP BY 1""")
def a12(m):
    z = profile.log_zscore(m.lineitem, "l_extendedprice", "z")
    return z.groupBy("l_returnflag").agg(settle(F.avg("z")).alias("mean_z"), settle(F.min("z")).alias("min_z"),
                                         settle(F.max("z")).alias("max_z"))


@section.add("a15_label_balance", """
SELECT round(CAST(min(n) AS DOUBLE) / max(n) + 1e-9, 6) AS balance, count(*) AS n_classes FROM (
 SELECT label, count(*) AS n FROM embeddings GROUP BY label)""")
def a15(m):
    counts = m.embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(settle(ratio(F.min("n"), F.max("n"))).alias("balance"), F.count(F.lit(1)).alias("n_classes"))


@section.add("a16_class_weight", sql(["nodes"], """
SELECT round(avg(default_12m), 6) AS pos_rate, round((1 - avg(default_12m)) / greatest(avg(default_12m), 0.000001), 6) AS pos_weight
FROM nodes"""))
def a16(m):
    w = metrics.class_weight(m.nodes, "default_12m")
    return w.select(settle(F.col("pos_rate")).alias("pos_rate"), settle(F.col("pos_weight")).alias("pos_weight"))


@section.add("a17_flow_concentration", sql(["hhi"], """
SELECT node_id, supplier_hhi AS supplier_concentration_hhi, customer_hhi AS customer_concentration_hhi FROM hhi"""))
def a17(m):
    from tradeweave.sources.contract import concentration
    return concentration(m.edges.filter(F.col("edge_type") == "material_flow"))


@section.add("a18_portfolio_kpis", sql(["lc"], """
SELECT commodity_risk_category, count(*) AS n_lc, CAST(sum(is_default) AS BIGINT) AS n_default,
 round(sum(lc_amount_usd * (0.005 + 0.02 * default_probability_true) * tenor_days / 360.0) / sum(lc_amount_usd), 6) AS realised_yield,
 round(sum(lc_amount_usd * is_default) / sum(lc_amount_usd), 6) AS npl_ratio,
 round(CAST(count(DISTINCT applicant_id) AS DOUBLE) / (SELECT count(DISTINCT applicant_id) FROM lc), 6) AS participation_rate,
 round(sum(lc_amount_usd * 0.01 * CASE WHEN tenor_days >= 90 THEN 1 ELSE 0 END), 2) AS discount_revenue
FROM lc GROUP BY commodity_risk_category"""))
def a18(m):
    return fusion.portfolio_kpis(m.lc, "commodity_risk_category")


@section.add("a20_fold_mean_std", sql(["nodes"], """
SELECT round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, count(*) AS n_folds FROM (
 SELECT CAST('0x' || substr(md5('fold|' || node_id), 1, 8) AS BIGINT) % 5 AS fold, avg(otif_rate) AS v FROM nodes GROUP BY 1)"""))
def a20(m):
    from tradeweave.operators.splits import fold_of
    folds = m.nodes.groupBy(fold_of([F.col("node_id")]).alias("fold")).agg(F.avg("otif_rate").alias("v"))
    return folds.agg(settle(F.avg("v")).alias("mean"), settle(F.stddev_pop("v")).alias("std"), F.count(F.lit(1)).alias("n_folds"))


# ------------------------------------------------------------------ sort, limit, top-k
_CARD = [t for t in scorecards.ENTITY_DEFAULT[1] if t[0] != "betweenness_centrality"]


@section.add("t2_m4_top_contributions", sql(["nodes"], """
SELECT node_id, feature, round(contribution, 6) AS contribution, round(base_value, 6) AS base_value, rank FROM (
 SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY abs(round(contribution, 9)) DESC, feature) AS rank FROM (""" +
    "\nUNION ALL\n".join(
        f"SELECT node_id, '{c}' AS feature, {w} * ({c} - (SELECT avg({c}) FROM nodes)) AS contribution, b.base_value FROM nodes, base b"
        for c, w, _ in _CARD) + ")) WHERE rank <= 8").replace(
    "FROM nodes, base b", "FROM nodes, (SELECT -4.35 + " + " + ".join(
        f"{w} * (avg({c}) - {x})" for c, w, x in _CARD) + " AS base_value FROM nodes) b"))
def t2(m):
    """Exact additive attributions of the linear score: weight * (x - population mean), eight largest per entity."""
    return fusion.top_contributions(m.nodes, "node_id", (scorecards.ENTITY_DEFAULT[0], _CARD), 8).withColumns(
        {c: settle(F.col(c)) for c in ("contribution", "base_value")})


@section.add("t4_head_and_tail", sql(["series"], """
SELECT * FROM (SELECT 'head' AS part, date, port, throughput_teu FROM series ORDER BY date, port LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'tail', date, port, throughput_teu FROM series ORDER BY date DESC, port DESC LIMIT 10)"""))
def t4(m):
    rows = m.series.select("date", "port", "throughput_teu")
    head = rows.orderBy("date", "port").limit(10).withColumn("part", F.lit("head"))
    tail = rows.orderBy(F.desc("date"), F.desc("port")).limit(10).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


@section.add("t6_first_row_of_group", sql(["nodes"], """
SELECT node_type, node_id, otif_rate FROM (SELECT *, row_number() OVER (PARTITION BY node_type ORDER BY node_id) AS rn FROM nodes)
WHERE rn = 1"""))
def t6(m):
    return m.nodes.groupBy("node_type").agg(F.min("node_id").alias("node_id"), F.min_by("otif_rate", "node_id").alias("otif_rate"))


# ------------------------------------------------------------------ concentration by network role
@section.add("g13_ownership_rollup", sql(["owners", "nodes", "flows"], """
SELECT o.src AS parent, count(*) AS n_subsidiaries, round(sum(s.revenue), 2) AS group_revenue,
 round(max(s.debt_to_equity), 6) AS worst_leverage FROM owners o JOIN nodes s ON s.node_id = o.dst GROUP BY o.src"""))
def g13(m):
    return graph.ownership_rollup(m.edges, m.nodes)


@section.add("g14_bank_exposure", sql(["finance_edges"], """
SELECT src AS bank, count(*) AS n_clients, round(sum(value), 2) AS exposure, round(sum(outstanding_balance), 2) AS outstanding,
 round(sum(value * value) / (sum(value) * sum(value)), 6) AS client_hhi, round(avg(payment_terms_days), 6) AS mean_terms
FROM finance_edges GROUP BY src"""))
def g14(m):
    return graph.bank_exposure(m.edges)


cte("shares", ["flows"], """SELECT f.src, f.dst, f.value / t.total AS share FROM flows f
JOIN (SELECT dst, sum(value) AS total FROM flows GROUP BY dst) t ON t.dst = f.dst""")


@section.add("g15_tier_two_exposure", sql(["shares", "lc_a"], """
SELECT p.customer, p.tier_two, round(sum(c.share * s.share), 6) AS exposure FROM
 (SELECT DISTINCT applicant_id AS customer, beneficiary_id AS tier_two FROM lc_a) p
 JOIN shares c ON c.dst = p.customer JOIN shares s ON s.dst = c.src AND s.src = p.tier_two GROUP BY p.customer, p.tier_two"""))
def g15(m):
    pairs = contract.lc_parties(m).select(F.col("applicant_id").alias("customer"), F.col("beneficiary_id").alias("tier_two"))
    return graph.tier_two_exposure(m.flows, pairs)


@section.add("g15_tier_two_risk", sql(["shares", "nodes"], """
SELECT c.dst AS node_id, round(sum(c.share * s.r), 6) AS tier_two_risk FROM shares c JOIN (
 SELECT s.dst, sum(s.share * n.freight_cost_ratio) AS r FROM shares s JOIN nodes n ON n.node_id = s.src GROUP BY s.dst) s
 ON s.dst = c.src GROUP BY c.dst"""))
def g15b(m):
    return graph.tier_two_risk(m.edges, m.nodes, "freight_cost_ratio")
