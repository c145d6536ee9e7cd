"""Queries over the contract tables: schema-checked scans, and the tables themselves."""

from __future__ import annotations

from tradeweave.plans.oracle_base import sql
from tradeweave.sources import contract as C
from tradeweave.sources.mart import Mart

SHIPMENT_COLUMNS = [
    "shipment_id", "origin_port", "destination_port", "depart_date", "planned_transit_days", "vessel_speed_ratio",
    "origin_congestion_index", "destination_congestion_index", "carrier_reliability_score", "cargo_value_usd",
    "weather_risk_score", "delay_probability_true", "delayed", "delay_days", "damaged", "doc_discrepancy",
    "shipment_risk_score"]
LC_COLUMNS = [
    "lc_id", "applicant_id", "beneficiary_id", "applicant_country", "beneficiary_country", "lc_amount_usd",
    "tenor_days", "commodity_risk_category", "trade_route_risk_score", "applicant_leverage", "applicant_current_ratio",
    "beneficiary_otif_rate", "historical_discrepancy_rate_applicant", "historical_discrepancy_rate_beneficiary",
    "port_congestion_origin", "port_congestion_destination", "freight_rate_percentile", "seasonal_factor",
    "country_risk_differential", "currency_volatility_30d", "default_probability_true", "is_default"]
SERIES_COLUMNS = ["date", "port", "throughput_teu", "port_congestion_index", "freight_rate_usd_feu"]
EDGE_COLUMNS = ["src", "dst", "edge_type", *C.EDGE_SCHEMA]
SHOCK_COLUMNS = [
    "port", "month", "horizon_days", "delta_otif", "delta_lead_time_std", "delta_freight_cost_ratio",
    "delta_port_congestion", "delta_inventory_turnover", "dio_change", "dso_change", "dpo_change", "ccc_change"]

QUERIES = {
    "table_nodes": lambda s, d: Mart(s, d).nodes,
    "table_edges": lambda s, d: Mart(s, d).edges,
    "table_time_series": lambda s, d: Mart(s, d).series,
    "table_shipments": lambda s, d: Mart(s, d).shipments.select(*SHIPMENT_COLUMNS),
    "table_lc_transactions": lambda s, d: Mart(s, d).lc_alone.select(*LC_COLUMNS),
    "table_working_capital_shocks": lambda s, d: Mart(s, d).shocks.select(*SHOCK_COLUMNS),
}

ORACLES = {
    "table_nodes": sql(["nodes"], f"SELECT {', '.join(C.NODE_COLUMNS)} FROM nodes"),
    "table_edges": sql(["edges"], f"SELECT {', '.join(EDGE_COLUMNS)} FROM edges"),
    "table_time_series": sql(["series"], f"SELECT {', '.join(SERIES_COLUMNS)} FROM series"),
    "table_shipments": sql(["shipments"], f"SELECT {', '.join(SHIPMENT_COLUMNS)} FROM shipments"),
    "table_lc_transactions": sql(["lc"], f"SELECT {', '.join(LC_COLUMNS)} FROM lc"),
    "table_working_capital_shocks": sql(["shocks"], f"SELECT {', '.join(SHOCK_COLUMNS)} FROM shocks"),
}
