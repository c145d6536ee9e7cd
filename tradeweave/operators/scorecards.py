"""Deterministic scorecards as column expressions. Coefficients are fixed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions.scalar import TWO_PI, clip, logistic, lookup, settle

# Intercept, then (column, weight, centre) per score.
ENTITY_DEFAULT = (-4.35, [
    ("debt_to_equity", 1.35, 0.0), ("current_ratio", -1.55, 1.0), ("otif_rate", -3.1, 0.90),
    ("inventory_turnover", -0.22, 6.5), ("ccc_days", 0.018, 55.0), ("supplier_concentration_hhi", 1.9, 0.3),
    ("lead_time_std", 0.06, 4.0), ("ebitda_margin", -2.6, 0.0), ("betweenness_centrality", 2.2, 0.0),
    ("geopolitical_risk_score", 0.9, 0.0), ("natural_disaster_exposure", 0.55, 0.0)])
SHIPMENT_DELAY = (-2.9, [
    ("vessel_speed_ratio", -1.6, 1.0), ("destination_congestion_index", 0.55, 2.0),
    ("origin_congestion_index", 0.35, 2.0), ("carrier_reliability_score", -1.3, 1.0), ("weather_risk_score", 1.8, 0.0)])
SHIPMENT_DAMAGE = (-3.4, [("weather_risk_score", 1.6, 0.0), ("carrier_reliability_score", -0.9, 1.0)])
DOC_DISCREPANCY = (-2.2, [("delayed", 0.8, 0.0), ("destination_congestion_index", 0.3, 2.0)])
LC_DEFAULT = (-5.15, [
    ("applicant_leverage", 0.85, 0.8), ("beneficiary_otif_rate", -3.0, 0.9),
    ("historical_discrepancy_rate_applicant", 1.9, 0.0), ("commodity_risk_num", 0.7, 0.0),
    ("trade_route_risk_score", 1.1, 0.0), ("port_congestion_destination", 0.35, 2.0),
    ("country_risk_differential", -0.02, 0.0), ("currency_volatility_30d", 2.6, 0.0), ("tenor_days", 0.015, 90.0)])
COMMODITY_NUM = {"Low": 0, "Medium": 1, "High": 2}
HORIZONS = [30, 60, 90]


def linear(card, overrides: dict[str, Column] | None = None) -> Column:
    intercept, terms = card
    overrides = overrides or {}
    total = F.lit(intercept)
    for name, weight, centre in terms:
        total = total + F.lit(weight) * (overrides.get(name, F.col(name)) - F.lit(centre))
    return total


def entity_default_probability(has_betweenness: bool = True) -> Column:
    missing = {} if has_betweenness else {"betweenness_centrality": F.lit(0.0)}
    return logistic(linear(ENTITY_DEFAULT, missing))


def delay_score() -> Column:
    return linear(SHIPMENT_DELAY)


def damage_score() -> Column:
    return linear(SHIPMENT_DAMAGE)


def discrepancy_score() -> Column:
    return linear(DOC_DISCREPANCY)


def shipment_risk() -> Column:
    mix = 0.9 * delay_score() + 0.4 * damage_score() + 0.3 * discrepancy_score() - 1.0
    return 100.0 * logistic(mix)


def commodity_num() -> Column:
    return lookup(F.col("commodity_risk_category"), COMMODITY_NUM).cast("double")


def lc_default_probability() -> Column:
    return logistic(linear(LC_DEFAULT, {"commodity_risk_num": commodity_num()}))


def freight_index(congestion: Column, t: Column) -> Column:
    season = F.sin(F.lit(TWO_PI) * t / 365.25 + 1.0)
    return clip(1500.0 + 300.0 * F.pow(congestion, F.lit(1.4)) + 400.0 * season, 400.0, 15000.0)


def horizon_scale(days: Column) -> Column:
    return F.sqrt(days / 30.0)


def horizon_rows(df: DataFrame, delta_cols: list[str]) -> DataFrame:
    """One row per horizon; deltas grow with the square root of time."""
    out = df.withColumn("horizon_days", F.explode(F.array(*[F.lit(h) for h in HORIZONS])))
    scale = horizon_scale(F.col("horizon_days").cast("double"))
    return out.withColumns({c: settle(F.col(c) * scale) for c in delta_cols})


def component_response() -> dict[str, Column]:
    gain = lambda c: F.greatest(F.lit(0.0), F.col(c))
    drop = lambda c: F.greatest(F.lit(0.0), -F.col(c))
    return {
        "dio_change": 62.0 * drop("delta_otif") + 2.6 * gain("delta_lead_time_std") - 3.0 * F.col("delta_inventory_turnover"),
        "dso_change": 4.8 * gain("delta_port_congestion"),
        "dpo_change": -58.0 * gain("delta_freight_cost_ratio") + 0.6 * drop("delta_port_congestion"),
    }
