"""Scorecards, fusion features, the stacked matrix and the flagship ranking."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeweave.functions.scalar import clip, logistic, ratio, settle
from tradeweave.operators import fusion, lc_features, scorecards
from tradeweave.operators.profile import zscore
from tradeweave.plans import oracle_base as O
from tradeweave.plans.oracle_base import cte, sql
from tradeweave.plans.registry import Section
from tradeweave.plans.relational import ROLE_SQL, SHAPE_SQL, entity_vectors, shipment_shape

section = Section()
QUERIES, ORACLES = section.queries, section.oracles

NODE_Z = ("(-4.35 + 1.35 * debt_to_equity - 1.55 * (current_ratio - 1.0) - 3.1 * (otif_rate - 0.90) "
          "- 0.22 * (inventory_turnover - 6.5) + 0.018 * (ccc_days - 55.0) + 1.9 * (supplier_concentration_hhi - 0.3) "
          "+ 0.06 * (lead_time_std - 4.0) - 2.6 * ebitda_margin + 0.9 * geopolitical_risk_score "
          "+ 0.55 * natural_disaster_exposure)")
cte("scored_nodes", ["nodes"], f"""
SELECT *, round({O.logistic(NODE_Z)}, 6) AS pd, round(exp({NODE_Z} + 4.35), 6) AS hazard FROM nodes""")


def scored_nodes(m):
    """Nodes with scorecard PD and hazard (network term left at zero)."""
    return m.nodes.join(lc_features.entity_scores(m.nodes), "node_id")


# ------------------------------------------------------------------ shipments
@section.add("c2_c5_shipment_scores", sql(["shipments_a"], f"""
SELECT shipment_id, round({O.logistic(O.DELAY)}, 6) AS delay_probability, round({O.logistic(O.DAMAGE)}, 6) AS damage_probability,
 round({O.logistic(O.DISCREPANCY)}, 6) AS discrepancy_probability,
 round(100.0 * {O.logistic(f'0.9 * {O.DELAY} + 0.4 * {O.DAMAGE} + 0.3 * {O.DISCREPANCY} - 1.0')}, 1) AS shipment_risk_score
FROM shipments_a"""))
def c2(m):
    return m.shipments.select(
        "shipment_id", settle(logistic(scorecards.delay_score())).alias("delay_probability"),
        settle(logistic(scorecards.damage_score())).alias("damage_probability"),
        settle(logistic(scorecards.discrepancy_score())).alias("discrepancy_probability"),
        F.round(scorecards.shipment_risk(), 1).alias("shipment_risk_score"))


@section.add("c6_lc_default_score", sql(["lc_b"], f"SELECT lc_id, round({O.logistic(O.LC_Z)}, 6) AS default_probability FROM lc_b"))
def c6(m):
    return m.lc.select("lc_id", settle(scorecards.lc_default_probability()).alias("default_probability"))


@section.add("c7_freight_index", sql(["series"], """
SELECT date, port, round(least(greatest(1500 + 300 * pow(port_congestion_index, 1.4) + 400 * sin(2 * pi() *
 (row_number() OVER (PARTITION BY port ORDER BY date) - 1) / 365.25 + 1.0), 400), 15000), 4) AS freight_index FROM series"""))
def c7(m):
    t = F.row_number().over(Window.partitionBy("port").orderBy("date")) - 1
    return m.series.withColumn("t", t).select(
        "date", "port", F.round(scorecards.freight_index(F.col("port_congestion_index"), F.col("t").cast("double")), 4).alias("freight_index"))


@section.add("c8_c9_c10_component_response", sql(["shocks_h"], f"""
SELECT port, month, horizon_days, round({O.DIO}, 6) AS dio_change, round({O.DSO}, 6) AS dso_change, round({O.DPO}, 6) AS dpo_change,
 round({O.DIO} + {O.DSO} - {O.DPO}, 6) AS ccc_change FROM shocks_h"""))
def c8(m):
    parts = scorecards.component_response()
    total = fusion.cash_conversion_cycle(parts["dio_change"], parts["dso_change"], parts["dpo_change"])
    return m.shocks.select("port", "month", "horizon_days", *[settle(v).alias(k) for k, v in parts.items()],
                           settle(total).alias("ccc_change"))


# ------------------------------------------------------------------ fusion
@section.add("k1_cash_conversion_cycle", sql(["nodes"], "SELECT node_id, round(dio + dso - dpo, 6) AS ccc FROM nodes"))
def k1(m):
    return m.nodes.select("node_id", settle(fusion.cash_conversion_cycle(F.col("dio"), F.col("dso"), F.col("dpo"))).alias("ccc"))


def sc_pd_sql(pd: str, otif: str = "otif_rate", turn: str = "inventory_turnover", hhi: str = "supplier_concentration_hhi") -> str:
    return (f"least(greatest({pd} * (1 + 0.3 * greatest(0, (0.95 - {otif}) / 0.2) + 0.2 * greatest(0, (6.0 - {turn}) / 6.0) "
            f"+ 0.15 / greatest(least(1 / nullif({hhi}, 0), 8), 1)), 0), 1)")


@section.add("k2_supply_chain_adjusted_pd", sql(["scored_nodes"], f"SELECT node_id, round({sc_pd_sql('pd')}, 6) AS sc_pd FROM scored_nodes"))
def k2(m):
    return scored_nodes(m).select("node_id", settle(fusion.supply_chain_adjusted_pd(
        F.col("pd"), F.col("otif_rate"), F.col("inventory_turnover"),
        fusion.alternative_suppliers(F.col("supplier_concentration_hhi")))).alias("sc_pd"))


@section.add("k3_working_capital_velocity", sql(["shocks"], """
SELECT port, month, horizon_days, round(((dio_change - avg(dio_change) OVER w) / stddev_samp(dio_change) OVER w
 + (dso_change - avg(dso_change) OVER w) / stddev_samp(dso_change) OVER w
 - (dpo_change - avg(dpo_change) OVER w) / stddev_samp(dpo_change) OVER w) / 3, 6) AS velocity
FROM shocks WINDOW w AS (PARTITION BY 1)"""))
def k3(m):
    z = zscore(m.shocks, ["dio_change", "dso_change", "dpo_change"])
    return z.select("port", "month", "horizon_days", settle(fusion.working_capital_velocity(
        F.col("dio_change"), F.col("dso_change"), F.col("dpo_change"))).alias("velocity"))


@section.add("k4_trade_route_stress", sql(["lc"], """
SELECT lc_id, round(least(greatest(0.25 * least(port_congestion_origin / 5.0, 1) + 0.25 * freight_rate_percentile
 + 0.25 * least(currency_volatility_30d / 0.4, 1) + 0.25 * least(trade_route_risk_score, 1), 0), 1), 6) AS route_stress FROM lc"""))
def k4(m):
    unit = lambda c: clip(c, high=1.0)
    return m.lc.select("lc_id", settle(fusion.trade_route_stress(
        unit(F.col("port_congestion_origin") / 5.0), F.col("freight_rate_percentile"),
        unit(F.col("currency_volatility_30d") / 0.4), unit(F.col("trade_route_risk_score")))).alias("route_stress"))


_LC15 = ("CAST(lc_amount_usd AS DOUBLE) AS lc_amount_usd, CAST(tenor_days AS DOUBLE) AS tenor_days, trade_route_risk_score, "
         "applicant_leverage, applicant_current_ratio, beneficiary_otif_rate, historical_discrepancy_rate_applicant, "
         "historical_discrepancy_rate_beneficiary, port_congestion_origin, port_congestion_destination, freight_rate_percentile, "
         "seasonal_factor, country_risk_differential, currency_volatility_30d, CASE commodity_risk_category WHEN 'Low' THEN 0.0 "
         "WHEN 'Medium' THEN 1.0 ELSE 2.0 END::DOUBLE AS commodity_risk_num")


@section.add("k5_lc_features", sql(["lc"], f"SELECT lc_id, {_LC15} FROM lc"))
def k5(m):
    return lc_features.lc_features(m.lc)


@section.add("k7_covenant_alerts", sql(["nodes", "shocks"], """
SELECT n.node_id, s.month, s.horizon_days, round(n.ccc_days + s.ccc_change, 1) AS predicted_ccc_days,
 CAST(60.0 AS DOUBLE) AS covenant_threshold_days, n.ccc_days + s.ccc_change > 60.0 AS breach_predicted,
 round(60.0 - (n.ccc_days + s.ccc_change), 1) AS margin_days
FROM nodes n JOIN shocks s ON s.port = n.node_id"""))
def k7(m):
    """Every port entity's current cycle with each month's predicted change per horizon."""
    rows = m.nodes.select("node_id", "ccc_days").join(m.shocks.withColumnRenamed("port", "node_id"), "node_id")
    return rows.select("node_id", "month", "horizon_days", *[c.alias(n) for n, c in fusion.covenant_alert(
        F.col("ccc_days"), F.col("ccc_change"), F.lit(60.0)).items()])


cte("shape", ["lc"], SHAPE_SQL)
cte("goods", ["shape"], f"""
SELECT lc_id, round({O.logistic(O.DELAY)}, 6) AS shipment_delay_probability,
 round({O.logistic(f'0.9 * {O.DELAY} + 0.4 * {O.DAMAGE} + 0.3 * {O.DISCREPANCY} - 1.0')}, 6) AS shipment_risk
FROM (SELECT *, 0 AS delayed FROM shape)""")
cte("roles", ["lc"], ROLE_SQL)
cte("stacked", ["lc", "scored_nodes", "goods", "roles"], f"""
SELECT l.*, round(coalesce(a.pd, mu.pd), 6) AS applicant_pd, round(coalesce(a.hazard, mu.hazard), 6) AS applicant_hazard,
 round(coalesce(b.pd, mu.pd), 6) AS beneficiary_pd, r.* EXCLUDE (lc_id), g.* EXCLUDE (lc_id)
FROM (SELECT lc_id, applicant_id, beneficiary_id, {_LC15} FROM lc) l
LEFT JOIN scored_nodes a ON a.node_id = l.applicant_id LEFT JOIN scored_nodes b ON b.node_id = l.beneficiary_id
JOIN roles r ON r.lc_id = l.lc_id JOIN goods g ON g.lc_id = l.lc_id,
(SELECT avg(pd) AS pd, avg(hazard) AS hazard FROM scored_nodes) mu""")


def stacked(m):
    return lc_features.stacked_matrix(m.lc, lc_features.entity_scores(m.nodes), entity_vectors(m),
                                      lc_features.shipment_scores_of(shipment_shape(m.lc)))


@section.add("k9_stacked_feature_matrix", sql(["stacked"], "SELECT * EXCLUDE (applicant_id, beneficiary_id) FROM stacked"))
def k9(m):
    return stacked(m)


def ranked_letters(m):
    """Letters of credit by expected loss: financial PD fused with operating signals of both parties."""
    entity = m.nodes.select("node_id", "inventory_turnover", "supplier_concentration_hhi")
    rows = (m.lc.join(entity.select(F.col("node_id").alias("beneficiary_id"), "inventory_turnover"), "beneficiary_id", "left")
            .join(entity.select(F.col("node_id").alias("applicant_id"), "supplier_concentration_hhi"), "applicant_id", "left"))
    sc_pd = fusion.supply_chain_adjusted_pd(
        F.col("default_probability_true"), F.col("beneficiary_otif_rate"), F.coalesce("inventory_turnover", F.lit(6.0)),
        fusion.alternative_suppliers(F.coalesce("supplier_concentration_hhi", F.lit(1.0))))
    out = rows.select("lc_id", "applicant_id", "beneficiary_id", "lc_amount_usd", F.col("default_probability_true").alias("pd"),
                      settle(sc_pd).alias("sc_pd"))
    out = out.withColumns({"expected_loss": F.round(F.col("sc_pd") * F.col("lc_amount_usd") * 0.45, 2),
                           "tier": fusion.tier_of(F.round(1000.0 * (1.0 - F.col("sc_pd")), 1), "level")})
    return out.orderBy(F.desc("expected_loss"), "lc_id")


TIER_SQL = ("CASE WHEN {s} < 400 THEN 'Novice' WHEN {s} < 600 THEN 'Practitioner' WHEN {s} < 750 THEN 'Advanced' "
            "WHEN {s} < 900 THEN 'Expert' ELSE 'Master' END")
section.add("k9_ranked_letters_of_credit", sql(["lc", "nodes"], f"""
SELECT *, round(sc_pd * lc_amount_usd * 0.45, 2) AS expected_loss, {TIER_SQL.format(s='round(1000.0 * (1.0 - sc_pd), 1)')} AS tier FROM (
 SELECT l.lc_id, l.applicant_id, l.beneficiary_id, l.lc_amount_usd, l.default_probability_true AS pd,
  round({sc_pd_sql('l.default_probability_true', 'l.beneficiary_otif_rate', 'coalesce(b.inventory_turnover, 6)', 'coalesce(a.supplier_concentration_hhi, 1)')}, 6) AS sc_pd
 FROM lc l LEFT JOIN nodes b ON b.node_id = l.beneficiary_id LEFT JOIN nodes a ON a.node_id = l.applicant_id)"""))(ranked_letters)


@section.add("k10_double_pledge", """
SELECT asset, n_banks, n_pledges, round(pledged_quantity / physical_quantity + 1e-9, 6) AS pledge_ratio FROM (
 SELECT l_partkey AS asset, count(DISTINCT n_regionkey) AS n_banks, count(*) AS n_pledges, sum(l_quantity) AS pledged_quantity,
  max(l_quantity) AS physical_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey GROUP BY 1) WHERE n_banks > 1""")
def k10(m):
    """Assets financed through several banks; the pledge ratio compares pledged with the largest physical lot."""
    from tradeweave.sources.contract import trade_lines
    lines = trade_lines(m, customer=True, region=True)
    out = lines.groupBy(F.col("l_partkey").alias("asset")).agg(
        F.countDistinct("n_regionkey").alias("n_banks"), F.count(F.lit(1)).alias("n_pledges"),
        settle(ratio(F.sum("l_quantity"), F.max("l_quantity"))).alias("pledge_ratio"))
    return out.filter(F.col("n_banks") > 1)


_SCEN = "(SELECT * FROM (VALUES " + ", ".join(
    "('" + s[0] + "', " + ", ".join(f"CAST({v} AS DOUBLE)" for v in s[1:]) + ")" for s in fusion.SCENARIOS) + \
    ") v(scenario, otif_loss, turnover_loss, congestion, freight, currency, weather))"


@section.add("k11_scenario_stress", sql(["scored_nodes"], f"""
SELECT node_id, scenario, round(base, 6) AS base_sc_pd, round(hit, 6) AS stressed_sc_pd, round(hit - base, 6) AS delta_sc_pd,
 round(route, 6) AS route_stress FROM (SELECT node_id, scenario, {sc_pd_sql('pd')} AS base,
 {sc_pd_sql('pd', 'greatest(otif_rate - otif_loss, 0)', '(inventory_turnover * (1 - turnover_loss))')} AS hit,
 least(greatest(0.25 * congestion + 0.25 * freight + 0.25 * currency + 0.25 * greatest(weather, natural_disaster_exposure), 0), 1) AS route
 FROM scored_nodes, {_SCEN} s)"""))
def k11(m):
    out = fusion.scenario_stress(scored_nodes(m), "pd")
    return out.withColumns({c: settle(F.col(c)) for c in ("base_sc_pd", "stressed_sc_pd", "delta_sc_pd", "route_stress")})


@section.add("k12_score_tiers", sql(["scored_nodes"], f"""
SELECT {TIER_SQL.format(s='round(1000.0 * (1.0 - pd), 1)')} AS level, count(*) AS n FROM scored_nodes GROUP BY 1"""))
def k12(m):
    return scored_nodes(m).groupBy(fusion.tier_of(F.round(1000.0 * (1.0 - F.col("pd")), 1), "level").alias("level")).agg(
        F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ event tokens
_E = "event_pos"
@section.add("m10_f8_f9_event_tokens", sql(["shipments"], f"""
SELECT {_E}, count(*) AS n, round(avg({_E} / 7.0), 6) AS position, round(avg(origin_congestion_index * greatest(0.25, 1 - {_E} / 3.0)), 6) AS origin_congestion,
 round(avg(destination_congestion_index * greatest(0.25, ({_E} - 3) / 4.0)), 6) AS destination_congestion,
 round(avg(vessel_speed_ratio), 6) AS vessel_speed_ratio, round(avg(carrier_reliability_score), 6) AS carrier_reliability,
 round(avg(weather_risk_score * CASE WHEN {_E} IN (2, 3, 4) THEN 1.0 ELSE 0.3 END), 6) AS weather_risk,
 round(max((ln(greatest(cargo_value_usd, 1)) - s.mu) / (s.sd + 1e-8)), 6) AS cargo_value_log, CAST({_E} AS BIGINT) AS hot_index
FROM shipments, (SELECT CAST(unnest(generate_series(0, 7)) AS INTEGER) AS {_E}) e,
 (SELECT avg(ln(greatest(cargo_value_usd, 1))) AS mu, stddev_pop(ln(greatest(cargo_value_usd, 1))) AS sd FROM shipments) s GROUP BY {_E}"""))
def m10(m):
    """Profile of the token table per event (the table itself has eight rows per order line)."""
    tokens = lc_features.event_tokens(m.shipments)
    means = [settle(F.avg(c)).alias(c) for c in lc_features.TOKEN_COLUMNS if c != "cargo_value_log"]
    return tokens.groupBy("event_pos").agg(
        F.count(F.lit(1)).alias("n"), *means, settle(F.max("cargo_value_log")).alias("cargo_value_log"),
        F.max(F.array_position("event_one_hot", 1.0) - 1).alias("hot_index"))
