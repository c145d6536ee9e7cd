"""SQL twins of the contract tables, as named CTEs for the independent check engine."""

from __future__ import annotations

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


def sql(deps: list[str], body: str) -> str:
    """`WITH` clause holding the given CTEs and everything they need, then the body."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for d in CTES[name][0]:
            visit(d)
        if name not in ordered:
            ordered.append(name)

    for d in deps:
        visit(d)
    withs = ",\n".join(f"{n} AS {'MATERIALIZED ' if n == 'shocks' else ''}(\n{CTES[n][1]}\n)" for n in ordered)
    text = f"WITH {withs}\n{body}" if withs else body
    # the same nudge as functions.scalar.settle: half-way cases go up
    return text.replace(", 6)", " + 1e-9, 6)")


def eid(prefix: str, key: str) -> str:
    return f"CASE WHEN {key} IS NOT NULL THEN '{prefix}_' || printf('%08d', CAST({key} AS BIGINT)) END"


def hash32(*parts: str, salt: str = "") -> str:
    text = " || '|' || ".join([f"'{salt}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def clip(x: str, lo=None, hi=None) -> str:
    if lo is not None:
        x = f"greatest({x}, {lo})"
    if hi is not None:
        x = f"least({x}, {hi})"
    return x


def logistic(x: str) -> str:
    return f"(1.0 / (1.0 + exp(-({x}))))"


TENOR = ("CASE o_orderpriority WHEN '1-URGENT' THEN 30 WHEN '2-HIGH' THEN 60 WHEN '3-MEDIUM' THEN 90 "
         "WHEN '4-NOT SPECIFIED' THEN 120 WHEN '5-LOW' THEN 180 ELSE 90 END")


def country_risk(k: str) -> str:
    return f"coalesce(CAST(48 + ({k} * 7) % 41 AS INTEGER), 68)"


def disaster(k: str) -> str:
    return f"coalesce(round(CAST(0.05 AS DOUBLE) + CAST(0.0125 AS DOUBLE) * (({k} * 5) % 29), 6), CAST(0.2 AS DOUBLE))"


def geopolitical(k: str) -> str:
    return f"coalesce(round(CAST(0.08 AS DOUBLE) + CAST(0.01 AS DOUBLE) * (({k} * 11) % 28), 6), CAST(0.2 AS DOUBLE))"


cte("brand", [], """
SELECT p_partkey, p_type, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_no FROM part""")

cte("lines", ["brand"], """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, CAST(l_shipdate AS DATE) AS ship_day, CAST(o_orderdate AS DATE) AS order_day,
       o_custkey, o_orderstatus, s_nationkey, s_acctbal, c_nationkey, c_acctbal, n_regionkey, brand_no, p_type,
       CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS DOUBLE) / 100 AS lead_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON n_nationkey = c_nationkey
JOIN brand ON l_partkey = p_partkey""")

_STATS = """
SELECT {id} AS node_id, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS revenue,
  round(avg(s_acctbal), 6) AS supplier_balance, round(avg(c_acctbal), 6) AS customer_balance,
  round(sum(l_extendedprice * l_tax), 4) AS freight, round(sum(l_extendedprice * l_discount), 4) AS discount,
  round(avg(l_quantity), 6) AS avg_quantity,
  round(avg(CASE WHEN lead_days <= 16 THEN 1.0 ELSE 0.0 END), 6) AS otif_rate,
  round(avg(lead_days), 6) AS lead_time_mean,
  round(coalesce(stddev_samp(lead_days), 0), 6) AS lead_time_std,
  round(CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) / count(*), 6) AS return_rate,
  round(CAST(count(*) FILTER (l_linestatus = 'F') AS DOUBLE) / count(*), 6) AS fill_rate,
  round(CAST(count(*) FILTER (o_orderstatus = 'P') AS DOUBLE) / count(*), 6) AS pending_rate,
  round(CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) / count(*), 6) AS open_rate,
  min(ship_day) AS first_day, min(ship_day) FILTER (lead_days > 16) AS first_late_day
FROM lines GROUP BY {key}"""

_KEYS = [("SUPP", "l_suppkey"), ("MANU", "brand_no"), ("LOGI", "l_linenumber"), ("PORT", "s_nationkey"),
         ("FINA", "n_regionkey"), ("CUST", "o_custkey")]

cte("entity_stats", ["lines"], "\nUNION ALL\n".join(_STATS.format(id=eid(p, k), key=k) for p, k in _KEYS))

cte("node_keys", ["brand"], f"""
SELECT k.node_id, k.node_type, k.nation_key, n.n_name AS country FROM (
  SELECT {eid('SUPP', 's_suppkey')} AS node_id, 'supplier' AS node_type, s_nationkey AS nation_key FROM supplier
  UNION ALL SELECT DISTINCT {eid('MANU', 'brand_no')}, 'manufacturer', NULL FROM brand
  UNION ALL SELECT DISTINCT {eid('LOGI', 'l_linenumber')}, 'logistics_provider', NULL FROM lineitem
  UNION ALL SELECT {eid('PORT', 'n_nationkey')}, 'port', n_nationkey FROM nation
  UNION ALL SELECT {eid('FINA', 'r_regionkey')}, 'financial_institution', NULL FROM region
  UNION ALL SELECT {eid('CUST', 'c_custkey')}, 'customer', c_nationkey FROM customer) k
LEFT JOIN nation n ON n.n_nationkey = k.nation_key""")

cte("flows", ["lines"], f"""
SELECT {eid('SUPP', 'l_suppkey')} AS src, {eid('MANU', 'brand_no')} AS dst, 'material_flow' AS edge_type,
       sum(l_quantity) AS volume, round(sum(l_extendedprice), 2) AS value FROM lines GROUP BY l_suppkey, brand_no
UNION ALL
SELECT {eid('MANU', 'brand_no')}, {eid('CUST', 'o_custkey')}, 'material_flow',
       sum(l_quantity), round(sum(l_extendedprice), 2) FROM lines GROUP BY brand_no, o_custkey""")

_LEGS = [("SUPP", "l_suppkey", "PORT", "s_nationkey"), ("MANU", "brand_no", "PORT", "c_nationkey"),
         ("PORT", "c_nationkey", "CUST", "o_custkey"), ("LOGI", "l_linenumber", "MANU", "brand_no")]

cte("transport", ["lines"], "SELECT src, dst, edge_type, CASE " + hash32("src", "dst") + """ % 4
    WHEN 0 THEN 'ocean' WHEN 1 THEN 'air' WHEN 2 THEN 'rail' WHEN 3 THEN 'road' END AS mode,
    transit_time_days, cost FROM (""" + "\nUNION ALL\n".join(
    f"SELECT {eid(a, k)} AS src, {eid(b, m)} AS dst, 'transportation' AS edge_type, "
    f"round(avg(lead_days), 6) AS transit_time_days, round(sum(l_extendedprice * l_tax), 4) AS cost "
    f"FROM lines GROUP BY {k}, {m}" for a, k, b, m in _LEGS) + ")")

cte("finance_edges", [], f"""
SELECT {eid('FINA', 'n_regionkey')} AS src, {eid('CUST', 'o_custkey')} AS dst, 'financial' AS edge_type,
       round(sum(o_totalprice), 2) AS value, round(avg({TENOR}), 6) AS payment_terms_days,
       round(coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 0), 2) AS outstanding_balance
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
GROUP BY n_regionkey, o_custkey""")

cte("owners", ["flows"], """
SELECT dst AS src, src AS dst, 'ownership' AS edge_type FROM (
  SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY value DESC, dst DESC) AS rn
  FROM flows WHERE src LIKE 'SUPP\\_%' ESCAPE '\\') WHERE rn = 1""")

cte("edges", ["flows", "transport", "finance_edges", "owners"], """
SELECT src, dst, edge_type, volume, value, CAST(NULL AS VARCHAR) AS mode, CAST(NULL AS DOUBLE) AS transit_time_days,
       CAST(NULL AS DOUBLE) AS cost, CAST(NULL AS DOUBLE) AS payment_terms_days,
       CAST(NULL AS DOUBLE) AS outstanding_balance FROM flows
UNION ALL SELECT src, dst, edge_type, NULL, NULL, mode, transit_time_days, cost, NULL, NULL FROM transport
UNION ALL SELECT src, dst, edge_type, NULL, value, NULL, NULL, NULL, payment_terms_days, outstanding_balance
          FROM finance_edges
UNION ALL SELECT src, dst, edge_type, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM owners""")

cte("hhi", ["flows"], """
SELECT coalesce(i.node_id, o.node_id) AS node_id, i.h AS supplier_hhi, o.h AS customer_hhi FROM
 (SELECT dst AS node_id, round(sum(value * value) / nullif(sum(value) * sum(value), 0), 6) AS h FROM flows GROUP BY dst) i
 FULL JOIN
 (SELECT src AS node_id, round(sum(value * value) / nullif(sum(value) * sum(value), 0), 6) AS h FROM flows GROUP BY src) o
 ON i.node_id = o.node_id""")

_BAL = ("coalesce(CASE WHEN node_type IN ('customer', 'financial_institution') THEN customer_balance "
        "ELSE supplier_balance END, 0)")

cte("nodes_a", ["node_keys", "entity_stats", "hhi"], f"""
SELECT k.*, s.* EXCLUDE (node_id), h.supplier_hhi, h.customer_hhi FROM node_keys k
LEFT JOIN entity_stats s ON s.node_id = k.node_id LEFT JOIN hhi h ON h.node_id = k.node_id""")

cte("nodes_b", ["nodes_a"], f"""
SELECT node_id, node_type, country, {country_risk('nation_key')} AS country_risk_score,
  {disaster('nation_key')} AS natural_disaster_exposure, {geopolitical('nation_key')} AS geopolitical_risk_score,
  round({clip(f'1.0 + {_BAL} / 10000.0', 0.4, 4.0)}, 6) AS current_ratio,
  round({clip('CAST(1.6 AS DOUBLE) * (1.0 - coalesce(fill_rate, 0))', 0.05, 5.0)}, 6) AS debt_to_equity,
  round({clip('CAST(0.2 AS DOUBLE) - coalesce(discount / nullif(revenue, 0), 0)', -0.1, 0.4)}, 6) AS ebitda_margin,
  coalesce(revenue, 0) AS revenue, CAST(coalesce(otif_rate, 0) AS DOUBLE) AS otif_rate,
  coalesce(lead_time_mean, 0) AS lead_time_mean, coalesce(lead_time_std, 0) AS lead_time_std,
  round({clip('CAST(6.5 AS DOUBLE) * coalesce(avg_quantity, 0) / 25.5', 1.0, 20.0)}, 6) AS inventory_turnover,
  coalesce(fill_rate, 0) AS fill_rate,
  round({clip('30.0 + 54.0 * coalesce(pending_rate, 0)', 5.0, 150.0)}, 6) AS dso,
  round({clip('30.0 + 45.0 * coalesce(open_rate, 0)', 5.0, 150.0)}, 6) AS dpo,
  coalesce(supplier_hhi, 1) AS supplier_concentration_hhi, coalesce(customer_hhi, 1) AS customer_concentration_hhi,
  round({clip('coalesce(avg_quantity, 0) / 34.0', 0.2, 0.99)}, 6) AS capacity_utilisation,
  round(1.0 - coalesce(return_rate, 0), 6) AS reliability_score,
  round(coalesce(freight / nullif(revenue, 0), 0), 6) AS freight_cost_ratio,
  CASE WHEN (coalesce(return_rate, 0) - CAST(0.3333 AS DOUBLE)) * sqrt(CAST(coalesce(n_lines, 0) AS DOUBLE)) > 0.6
       THEN 1 ELSE 0 END AS default_12m,
  CAST(least(coalesce(date_diff('day', first_day, first_late_day) + 1, 730), 730) AS DOUBLE) AS survival_duration_days,
  CASE WHEN coalesce(date_diff('day', first_day, first_late_day) + 1, 731) <= 730 THEN 1 ELSE 0 END AS survival_event
FROM nodes_a""")

cte("nodes", ["nodes_b"], f"""
SELECT *, round(dio + dso - dpo, 6) AS ccc_days FROM (
 SELECT *, round({clip('365.0 / greatest(inventory_turnover, 0.1)', 5.0, 200.0)}, 6) AS dio,
  round({clip('ebitda_margin / greatest(CAST(0.05 AS DOUBLE) * debt_to_equity, 0.001)', 0.2, 25.0)}, 6)
  AS interest_coverage FROM nodes_b)""")

cte("series", [], f"""
SELECT d.date, d.port, d.qty AS throughput_teu,
  round({clip('2.0 * coalesce(n_lines / nullif(avg(n_lines) OVER (PARTITION BY port ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 0), 0)', 0.2, 5.0)}, 6)
  AS port_congestion_index,
  round(coalesce(freight / nullif(qty, 0), 0), 6) AS freight_rate_usd_feu
FROM (
 SELECT sp.date, {eid('PORT', 'sp.port_key')} AS port, coalesce(n_lines, 0) AS n_lines, coalesce(qty, 0) AS qty,
        coalesce(freight, 0) AS freight FROM
 (SELECT p.port_key, CAST(g.d AS DATE) AS date FROM (SELECT DISTINCT s_nationkey AS port_key FROM supplier) p,
   (SELECT unnest(generate_series((SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem)::TIMESTAMP,
                                  (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem)::TIMESTAMP, INTERVAL 1 DAY)) AS d) g) sp
 LEFT JOIN (SELECT s_nationkey AS port_key, CAST(l_shipdate AS DATE) AS date, count(*) AS n_lines,
                   sum(l_quantity) AS qty, round(sum(l_extendedprice * l_tax), 4) AS freight
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) x
 ON x.port_key = sp.port_key AND x.date = sp.date) d""")

DELAY = ("(-2.9 - 1.6 * (vessel_speed_ratio - 1.0) + 0.55 * (destination_congestion_index - 2.0) "
         "+ 0.35 * (origin_congestion_index - 2.0) - 1.3 * (carrier_reliability_score - 1.0) + 1.8 * weather_risk_score)")
DAMAGE = "(-3.4 + 1.6 * weather_risk_score - 0.9 * (carrier_reliability_score - 1.0))"
DISCREPANCY = "(-2.2 + 0.8 * delayed + 0.3 * (destination_congestion_index - 2.0))"

cte("shipments_a", ["lines", "series"], f"""
SELECT b.*, CASE WHEN b.delay_days > 0 THEN 1 ELSE 0 END AS delayed,
  coalesce(o.port_congestion_index, 0.2) AS origin_congestion_index,
  coalesce(e.port_congestion_index, 0.2) AS destination_congestion_index FROM (
 SELECT 'SHP_' || concat_ws('-', printf('%09d', l_orderkey), l_linenumber, l_partkey, l_suppkey) AS shipment_id,
  {eid('PORT', 's_nationkey')} AS origin_port, {eid('PORT', 'c_nationkey')} AS destination_port,
  ship_day AS depart_date, 12.0 + l_quantity % 26 AS planned_transit_days,
  round({clip('CAST(1.2 AS DOUBLE) - 4.0 * l_discount', 0.6, 1.25)}, 6) AS vessel_speed_ratio,
  round({clip('CAST(0.95 AS DOUBLE) - l_tax', 0.3, 0.999)}, 6) AS carrier_reliability_score,
  l_extendedprice AS cargo_value_usd, round(l_quantity / 100.0, 6) AS weather_risk_score,
  round(greatest(0.0, lead_days - (12.0 + l_quantity % 26)), 6) AS delay_days,
  CASE WHEN l_returnflag = 'R' AND l_discount >= CAST(0.08 AS DOUBLE) THEN 1 ELSE 0 END AS damaged,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' AND l_discount < CAST(0.05 AS DOUBLE) THEN 1 ELSE 0 END
  AS doc_discrepancy FROM lines) b
LEFT JOIN series o ON o.port = b.origin_port AND o.date = b.depart_date
LEFT JOIN series e ON e.port = b.destination_port AND e.date = b.depart_date""")

cte("shipments", ["shipments_a"], f"""
SELECT *, round({logistic(DELAY)}, 6) AS delay_probability_true,
  round(100.0 * {logistic(f'0.9 * {DELAY} + 0.4 * {DAMAGE} + 0.3 * {DISCREPANCY} - 1.0')}, 1) AS shipment_risk_score
FROM shipments_a""")

cte("conditions", ["series"], f"""
SELECT port, date, port_congestion_index,
 round(percent_rank() OVER (PARTITION BY port ORDER BY freight_rate_usd_feu), 6) AS freight_rate_percentile,
 round({clip('coalesce(avg(throughput_teu) OVER m / nullif(avg(throughput_teu) OVER (PARTITION BY port), 0), 1.0)', 0.7, 1.5)}, 6)
 AS seasonal_factor,
 round({clip('CAST(0.1 AS DOUBLE) * coalesce(coalesce(stddev_samp(freight_rate_usd_feu) OVER m, 0) / nullif(avg(freight_rate_usd_feu) OVER m, 0), 0)', 0.01, 0.4)}, 6)
 AS currency_volatility_30d
FROM series WINDOW m AS (PARTITION BY port ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")

LC_Z = ("(-5.15 + 0.85 * (applicant_leverage - 0.8) - 3.0 * (beneficiary_otif_rate - 0.9) "
        "+ 1.9 * historical_discrepancy_rate_applicant + 0.7 * CASE commodity_risk_category WHEN 'Low' THEN 0.0 "
        "WHEN 'Medium' THEN 1.0 ELSE 2.0 END + 1.1 * trade_route_risk_score "
        "+ 0.35 * (port_congestion_destination - 2.0) - 0.02 * country_risk_differential "
        "+ 2.6 * currency_volatility_30d + 0.015 * (tenor_days - 90.0))")

cte("lc_a", ["nodes", "brand"], f"""
SELECT 'LC_' || printf('%09d', o_orderkey) AS lc_id, CAST(o_orderdate AS DATE) AS issue_date,
 {eid('CUST', 'o_custkey')} AS applicant_id, {eid('SUPP', 's_suppkey')} AS beneficiary_id,
 {eid('PORT', 'c_nationkey')} AS dest_port, {eid('PORT', 's_nationkey')} AS orig_port, o_totalprice AS lc_amount_usd,
 {TENOR} AS tenor_days,
 CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'SMALL') THEN 'Low' WHEN p_type = 'PROMO' THEN 'High' ELSE 'Medium' END
 AS commodity_risk_category,
 round(({geopolitical('c_nationkey')} + {geopolitical('s_nationkey')}) / 2.0 + {disaster('s_nationkey')}, 6)
 AS trade_route_risk_score,
 CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_default
FROM orders JOIN customer ON c_custkey = o_custkey
LEFT JOIN (SELECT l_orderkey, l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_extendedprice DESC, l_suppkey DESC, l_partkey DESC) AS rn FROM lineitem) m
 ON m.l_orderkey = o_orderkey AND m.rn = 1
LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN brand ON p_partkey = l_partkey""")

cte("lc_b", ["lc_a", "conditions"], """
SELECT l.*, a.country AS applicant_country, a.debt_to_equity AS applicant_leverage,
 a.current_ratio AS applicant_current_ratio, round(1.0 - a.reliability_score, 6) AS historical_discrepancy_rate_applicant,
 b.country AS beneficiary_country, coalesce(b.otif_rate, 0.9) AS beneficiary_otif_rate,
 coalesce(round(1.0 - b.reliability_score, 6), 0.0) AS historical_discrepancy_rate_beneficiary,
 CAST(a.country_risk_score - coalesce(b.country_risk_score, a.country_risk_score) AS DOUBLE) AS country_risk_differential,
 coalesce(o.port_congestion_index, 0.2) AS port_congestion_origin,
 coalesce(d.port_congestion_index, 0.2) AS port_congestion_destination,
 coalesce(o.freight_rate_percentile, 0.5) AS freight_rate_percentile,
 coalesce(o.seasonal_factor, 1.0) AS seasonal_factor,
 coalesce(o.currency_volatility_30d, 0.05) AS currency_volatility_30d
FROM lc_a l LEFT JOIN nodes a ON a.node_id = l.applicant_id LEFT JOIN nodes b ON b.node_id = l.beneficiary_id
LEFT JOIN conditions o ON o.port = l.orig_port AND o.date = l.issue_date
LEFT JOIN conditions d ON d.port = l.dest_port AND d.date = l.issue_date""")

cte("lc", ["lc_b"], f"SELECT *, round({logistic(LC_Z)}, 6) AS default_probability_true FROM lc_b")

DIO = "(62.0 * greatest(0, -delta_otif) + 2.6 * greatest(0, delta_lead_time_std) - 3.0 * delta_inventory_turnover)"
DSO = "(4.8 * greatest(0, delta_port_congestion))"
DPO = "(-58.0 * greatest(0, delta_freight_cost_ratio) + 0.6 * greatest(0, -delta_port_congestion))"

cte("shock_months", ["lines"], """
SELECT s_nationkey, CAST(date_trunc('month', ship_day) AS DATE) AS month,
 round(avg(CASE WHEN lead_days <= 16 THEN 1.0 ELSE 0.0 END), 6) AS otif,
 round(coalesce(stddev_samp(lead_days), 0), 6) AS lead_std,
 round(coalesce(sum(l_extendedprice * l_tax) / nullif(sum(l_extendedprice), 0), 0), 6) AS freight_ratio,
 round(CAST(count(*) AS DOUBLE) / 10, 6) AS congestion,
 round(CAST(6.5 AS DOUBLE) * avg(l_quantity) / 25.5, 6) AS turnover
FROM lines GROUP BY 1, 2""")

cte("shock_deltas", ["shock_months"], f"""
SELECT * FROM (SELECT {eid('PORT', 's_nationkey')} AS port, month,
 round(otif - lag(otif) OVER w, 6) AS delta_otif, round(lead_std - lag(lead_std) OVER w, 6) AS delta_lead_time_std,
 round(freight_ratio - lag(freight_ratio) OVER w, 6) AS delta_freight_cost_ratio,
 round(congestion - lag(congestion) OVER w, 6) AS delta_port_congestion,
 round(turnover - lag(turnover) OVER w, 6) AS delta_inventory_turnover
 FROM shock_months WINDOW w AS (PARTITION BY s_nationkey ORDER BY month)) WHERE delta_otif IS NOT NULL""")

_D = ["delta_otif", "delta_lead_time_std", "delta_freight_cost_ratio", "delta_port_congestion", "delta_inventory_turnover"]
cte("shocks_h", ["shock_deltas"], "SELECT port, month, horizon_days, " + ", ".join(
    f"round({d} * sqrt(horizon_days / 30.0), 6) AS {d}" for d in _D) +
    " FROM shock_deltas, (SELECT unnest([30, 60, 90]) AS horizon_days)")
cte("shocks", ["shocks_h"], f"""
SELECT *, round(dio_change + dso_change - dpo_change, 6) AS ccc_change FROM (
 SELECT *, round({DIO}, 6) AS dio_change, round({DSO}, 6) AS dso_change, round({DPO}, 6) AS dpo_change FROM shocks_h)""")
