"""Feature tables: entities (21 columns), letters of credit (15), event tokens, and the stacked matrix (24)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.functions.scalar import logistic, settle
from tradeweave.functions.vectors import one_hot
from tradeweave.operators import scorecards
from tradeweave.operators.joins import role_vectors
from tradeweave.operators.profile import log_zscore

# Feature column names, shipment life-cycle events.
FINANCIAL_ONLY = ["current_ratio", "debt_to_equity", "ebitda_margin", "interest_coverage", "working_capital_ratio"]
NON_FINANCIAL = [
    "inventory_turnover", "clustering_coefficient", "supplier_concentration_hhi", "ccc_days", "natural_disaster_exposure",
    "otif_rate", "freight_cost_ratio", "betweenness_centrality", "lead_time_std", "lead_time_mean", "fill_rate",
    "customer_concentration_hhi", "capacity_utilisation", "pagerank", "country_risk_score", "geopolitical_risk_score"]
ENTITY_FEATURES = FINANCIAL_ONLY + NON_FINANCIAL
COX_COVARIATES = ["otif_rate", "inventory_turnover", "ccc_days", "supplier_concentration_hhi", "freight_cost_ratio",
                  "betweenness_centrality", "debt_to_equity", "current_ratio", "ebitda_margin", "lead_time_std"]
LC_FEATURES = [
    "lc_amount_usd", "tenor_days", "trade_route_risk_score", "applicant_leverage", "applicant_current_ratio",
    "beneficiary_otif_rate", "historical_discrepancy_rate_applicant", "historical_discrepancy_rate_beneficiary",
    "port_congestion_origin", "port_congestion_destination", "freight_rate_percentile", "seasonal_factor",
    "country_risk_differential", "currency_volatility_30d", "commodity_risk_num"]
STACKED_EXTRA = ["applicant_pd", "applicant_hazard", "beneficiary_pd", "applicant_emb_mean", "applicant_emb_norm",
                 "beneficiary_emb_mean", "beneficiary_emb_norm", "shipment_delay_probability", "shipment_risk"]
EVENTS = ["booking_confirmed", "container_loaded", "vessel_departed", "transhipment_arrival", "transhipment_departure",
          "destination_port_arrival", "customs_cleared", "final_delivery"]
TOKEN_COLUMNS = ["position", "origin_congestion", "destination_congestion", "vessel_speed_ratio", "carrier_reliability",
                 "weather_risk", "cargo_value_log"]


def entity_features(network_nodes: DataFrame) -> DataFrame:
    """node_id, type and the 21 features; working capital ratio is 1 - 1/current_ratio."""
    with_wc = network_nodes.withColumn("working_capital_ratio", settle(
        F.coalesce(1.0 - F.try_divide(F.lit(1.0), F.col("current_ratio")), F.lit(0.0))))
    return with_wc.select("node_id", "node_type", *[F.col(c).cast("double").alias(c) for c in ENTITY_FEATURES])


def lc_features(lc: DataFrame) -> DataFrame:
    rows = lc.withColumn("commodity_risk_num", scorecards.commodity_num())
    return rows.select("lc_id", *[F.col(c).cast("double").alias(c) for c in LC_FEATURES])


# Columns of a shipment that its tokens are made of.
TOKEN_SOURCES = ["origin_congestion_index", "destination_congestion_index", "vessel_speed_ratio", "carrier_reliability_score",
                 "weather_risk_score", "cargo_value_usd"]


def event_tokens(shipments: DataFrame, key: str = "shipment_id", gathered: bool = False) -> DataFrame:
    """Eight life-cycle tokens per shipment: event one-hot and seven signals.

    Origin congestion weighs on early events, destination congestion on late ones, weather on the sea legs. `gathered`:
    shipments of a key are brought together before they become tokens, so that grouping tokens by key moves nothing more.
    """
    scaled = log_zscore(shipments, "cargo_value_usd", "cargo_value_log")
    if gathered:
        scaled = scaled.select(key, *TOKEN_SOURCES[:-1], "cargo_value_log").repartition(key)
    rows = scaled.withColumn("event_pos", F.explode(F.sequence(F.lit(0), F.lit(len(EVENTS) - 1))))
    e = F.col("event_pos")
    near_origin = F.greatest(F.lit(0.25), 1.0 - e / 3.0)
    near_destination = F.greatest(F.lit(0.25), (e - 3) / 4.0)
    at_sea = F.when(e.isin(2, 3, 4), 1.0).otherwise(0.3)
    return rows.select(
        key, "event_pos", one_hot(e, len(EVENTS)).alias("event_one_hot"), (e / float(len(EVENTS) - 1)).alias("position"),
        (F.col("origin_congestion_index") * near_origin).alias("origin_congestion"),
        (F.col("destination_congestion_index") * near_destination).alias("destination_congestion"),
        "vessel_speed_ratio", F.col("carrier_reliability_score").alias("carrier_reliability"),
        (F.col("weather_risk_score") * at_sea).alias("weather_risk"), "cargo_value_log")


def entity_scores(nodes: DataFrame) -> DataFrame:
    """One PD and one partial hazard per entity, computed once and looked up per role."""
    linear = scorecards.linear(scorecards.ENTITY_DEFAULT, None if "betweenness_centrality" in nodes.columns
                               else {"betweenness_centrality": F.lit(0.0)})
    return nodes.select("node_id", settle(logistic(linear)).alias("pd"),
                        settle(F.exp(linear - F.lit(scorecards.ENTITY_DEFAULT[0]))).alias("hazard"))


def stacked_matrix(lc: DataFrame, scores: DataFrame, vectors: DataFrame, shipment_scores: DataFrame) -> DataFrame:
    """lc_id + 24 columns, one row per letter of credit, no NULLs.

    `scores`(node_id, pd, hazard), `vectors`(node_id, vec), `shipment_scores`(lc_id, two scores) come from
    scorecards or trained models. Missing entities get the population mean, missing vectors zeros.
    """
    means = scores.agg(F.struct(F.avg("pd").alias("pd"), F.avg("hazard").alias("hazard"))).scalar()
    applicant = scores.select(F.col("node_id").alias("applicant_id"), F.col("pd").alias("applicant_pd"),
                              F.col("hazard").alias("applicant_hazard"))
    beneficiary = scores.select(F.col("node_id").alias("beneficiary_id"), F.col("pd").alias("beneficiary_pd"))
    roles = lc.select("lc_id", "applicant_id", "beneficiary_id").join(applicant, "applicant_id", "left").join(
        beneficiary, "beneficiary_id", "left").withColumn("_m", means)
    roles = roles.withColumns({
        "applicant_pd": F.coalesce("applicant_pd", F.col("_m")["pd"]),
        "applicant_hazard": F.coalesce("applicant_hazard", F.col("_m")["hazard"]),
        "beneficiary_pd": F.coalesce("beneficiary_pd", F.col("_m")["pd"])}).drop("_m")
    roles = role_vectors(roles, vectors, [("applicant_id", "applicant"), ("beneficiary_id", "beneficiary")])
    features = lc_features(lc).join(roles.drop("applicant_id", "beneficiary_id"), "lc_id").join(shipment_scores, "lc_id")
    return features.select("lc_id", *LC_FEATURES, *[settle(F.col(c)).alias(c) for c in STACKED_EXTRA])


def shipment_scores_of(shape: DataFrame) -> DataFrame:
    """Scorecard delay probability and composite risk of goods behind each letter of credit."""
    delayed = shape.withColumn("delayed", F.lit(0))
    return delayed.select("lc_id", settle(logistic(scorecards.delay_score())).alias("shipment_delay_probability"),
                          settle(scorecards.shipment_risk() / 100.0).alias("shipment_risk"))
