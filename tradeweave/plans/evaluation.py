"""Metrics, calibration, survival evaluation, monitoring."""

from __future__ import annotations

import time

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeweave.functions.scalar import logistic, settle
from tradeweave.operators import metrics, monitoring, scorecards, splits, temporal
from tradeweave.plans.oracle_base import cte, hash32, logistic as sql_logistic, sql
from tradeweave.plans.registry import Section
from tradeweave.plans.scores import scored_nodes
from tradeweave.session import stage
from tradeweave.plans import series as _series  # noqa: F401  its CTEs are used here

section = Section()
QUERIES, ORACLES = section.queries, section.oracles


def ranking_sql(source: str, score: str, label: str) -> str:
    return f"""
SELECT round(sum(pos * (neg_before + neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc,
 round(2 * sum(pos * (neg_before + neg / 2)) / (sum(pos) * sum(neg)) - 1, 6) AS gini,
 round(sum(pos / total * tp / seen), 6) AS average_precision FROM (
 SELECT *, sum(neg) OVER (ORDER BY score) - neg AS neg_before, sum(pos) OVER (ORDER BY score DESC) AS tp,
  sum(pos + neg) OVER (ORDER BY score DESC) AS seen, sum(pos) OVER () AS total FROM (
  SELECT {score} AS score, CAST(sum({label}) AS DOUBLE) AS pos, CAST(sum(1 - {label}) AS DOUBLE) AS neg FROM {source} GROUP BY 1))"""


def rounded(df, *cols):
    return df.select(*[settle(F.col(c)).alias(c) for c in cols])


@section.add("e1_e2_e4_lc_ranking_metrics", sql(["lc"], ranking_sql("lc", "default_probability_true", "is_default")))
def e1(m):
    return rounded(metrics.ranking_metrics(m.lc_default_scores, "default_probability_true", "is_default"), "auc", "gini", "average_precision")


@section.add("e1_shipment_delay_auc", sql(["shipments"], ranking_sql("shipments", "delay_probability_true", "delayed")))
def e1s(m):
    return rounded(metrics.ranking_metrics(m.shipments, "delay_probability_true", "delayed"), "auc", "gini", "average_precision")


@section.add("e1_auc_by_node_type", sql(["scored_nodes"], """
SELECT a.node_type, round(avg(CASE WHEN a.pd > b.pd THEN 1.0 WHEN a.pd = b.pd THEN 0.5 ELSE 0.0 END), 6) AS auc
FROM scored_nodes a JOIN scored_nodes b ON a.node_type = b.node_type AND a.default_12m = 1 AND b.default_12m = 0 GROUP BY 1"""))
def e1t(m):
    out = metrics.ranking_metrics(scored_nodes(m), "pd", "default_12m", ["node_type"])
    return out.filter(F.col("auc").isNotNull()).select("node_type", settle(F.col("auc")).alias("auc"))


@section.add("e3_e12_brier_logloss_mse", sql(["lc"], """
SELECT round(avg(pow(default_probability_true - is_default, 2)), 6) AS brier,
 round(avg(-(is_default * ln(q) + (1 - is_default) * ln(1 - q))), 6) AS log_loss,
 round(avg(pow(applicant_leverage - 0.8, 2)), 6) AS mse FROM (
 SELECT *, least(greatest(default_probability_true, 1e-12), 1 - 1e-12) AS q FROM lc)"""))
def e3(m):
    p, y = F.col("default_probability_true"), F.col("is_default").cast("double")
    gap = F.col("applicant_leverage") - 0.8
    return m.lc.agg(settle(metrics.brier(p, y)).alias("brier"), settle(metrics.log_loss(p, y)).alias("log_loss"),
                    settle(F.avg(gap * gap)).alias("mse"))


@section.add("e5_accuracy_at_half", sql(["scored_nodes"], """
SELECT node_type, round(avg(CASE WHEN (pd > 0.5) = (default_12m = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored_nodes GROUP BY 1"""))
def e5(m):
    hit = (F.col("pd") > 0.5) == (F.col("default_12m") == 1)
    return scored_nodes(m).groupBy("node_type").agg(settle(F.avg(hit.cast("double"))).alias("accuracy"))


@section.add("e6_calibration_error", sql(["lc"], """
SELECT round(sum(n * abs(rate - mean_p)) / sum(n), 6) AS ece FROM (
 SELECT least(floor(default_probability_true * 10), 9) AS bin, count(*) AS n, avg(is_default) AS rate, avg(default_probability_true) AS mean_p
 FROM lc GROUP BY 1)"""))
def e6(m):
    return rounded(metrics.expected_calibration_error(m.lc, "default_probability_true", "is_default"), "ece")


@section.add("e8_e9_ccc_forecast_error", sql(["shocks"], """
SELECT round(avg(ape) FILTER (horizon_days = 30), 6) AS mape_30d, round(avg(ape), 6) AS mape_all, round(avg(abs(ccc_change - pred)), 6) AS mae_days
FROM (SELECT *, 100 * abs(ccc_change - pred) / greatest(abs(ccc_change), 3.0) AS ape FROM (
 SELECT *, lag(ccc_change) OVER (PARTITION BY port, horizon_days ORDER BY month) AS pred FROM shocks) WHERE pred IS NOT NULL)"""))
def e8(m):
    """Last month's change as the forecast of this month's."""
    w = Window.partitionBy("port", "horizon_days").orderBy("month")
    rows = m.shocks.withColumn("pred", F.lag("ccc_change").over(w)).filter(F.col("pred").isNotNull())
    ape = metrics.absolute_percentage_error(F.col("ccc_change"), F.col("pred"), 3.0)
    return rows.agg(settle(F.avg(F.when(F.col("horizon_days") == 30, ape))).alias("mape_30d"), settle(F.avg(ape)).alias("mape_all"),
                    settle(F.avg(F.abs(F.col("ccc_change") - F.col("pred")))).alias("mae_days"))


@section.add("e10_pinball_loss", sql(["naive"], """
SELECT q, round(avg(greatest((q - 1) * (actual - forecast * (0.5 + q)), q * (actual - forecast * (0.5 + q)))), 6) AS loss
FROM naive, (SELECT CAST(unnest([0.1, 0.5, 0.9]) AS DOUBLE) AS q) GROUP BY q"""))
def e10(m):
    rows = temporal.seasonal_naive(m.series, "throughput_teu").withColumn("q", F.explode(F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))))
    q = F.col("q")
    return rows.groupBy("q").agg(settle(F.avg(metrics.pinball(F.col("actual"), F.col("forecast") * (0.5 + q), q))).alias("loss"))


# ------------------------------------------------------------------ survival
cte("surv", ["scored_nodes"], """
SELECT node_id, CAST(survival_duration_days AS INTEGER) AS days, survival_event AS event, hazard, round(ln(hazard), 6) AS log_risk
FROM scored_nodes""")


def survival_rows(m):
    return scored_nodes(m).select("node_id", F.col("survival_duration_days").cast("int").alias("days"),
                                  F.col("survival_event").alias("event"), "hazard", settle(F.log("hazard")).alias("log_risk"))


@section.add("e11_j9_concordance", sql(["surv"], """
SELECT round(avg(CASE WHEN i.hazard > j.hazard THEN 1.0 WHEN i.hazard = j.hazard THEN 0.5 ELSE 0.0 END), 6) AS c_index,
 CAST(count(*) AS DOUBLE) AS n_pairs FROM surv i JOIN surv j ON i.event = 1 AND (j.days > i.days OR (j.days = i.days AND j.event = 0))"""))
def e11(m):
    out = metrics.concordance_index(survival_rows(m), "days", "event", "hazard")
    return out.select(settle(F.col("c_index")).alias("c_index"), "n_pairs")


@section.add("e11_fold_concordance", sql(["surv"], f"""
, folded AS (SELECT *, CAST({hash32('node_id', salt='fold')} % 5 AS INTEGER) AS fold FROM surv),
per AS (SELECT i.fold, avg(CASE WHEN i.hazard > j.hazard THEN 1.0 WHEN i.hazard = j.hazard THEN 0.5 ELSE 0.0 END) AS c
 FROM folded i JOIN folded j ON i.fold = j.fold AND i.event = 1 AND (j.days > i.days OR (j.days = i.days AND j.event = 0)) GROUP BY 1)
SELECT fold, round(c, 6) AS c_index, round((SELECT avg(c) FROM per), 6) AS mean_c_index,
 round((SELECT stddev_pop(c) FROM per), 6) AS std_c_index FROM per""").replace(")\n\n, folded", "),\nfolded"))
def e11_folds(m):
    """Concordance over five folds of the entities, with mean and population deviation."""
    rows = survival_rows(m).withColumn("fold", splits.fold_of([F.col("node_id")], 5))
    out = metrics.fold_concordance(rows, "fold", "days", "event", "hazard", 5)
    return out.select("fold", *[settle(F.col(c)).alias(c) for c in ("c_index", "mean_c_index", "std_c_index")])


@section.add("w12_m7_cox_partial_likelihood", sql(["surv"], """
SELECT round(-sum(er - d * ln(risk_set)) / greatest(sum(d), 1), 6) AS loss, CAST(sum(d) AS DOUBLE) AS n_events FROM (
 SELECT days, d, er, sum(s) OVER (ORDER BY days DESC) AS risk_set FROM (
  SELECT days, sum(exp(log_risk)) AS s, sum(event) AS d, coalesce(sum(log_risk) FILTER (event = 1), 0) AS er FROM surv GROUP BY days))"""))
def w12(m):
    out = metrics.cox_loss(survival_rows(m), "days", "event", "log_risk")
    return out.select(settle(F.col("loss")).alias("loss"), "n_events")


# ------------------------------------------------------------------ tiers
FIN_Z = "(-4.35 + 1.35 * debt_to_equity - 1.55 * (current_ratio - 1.0) - 2.6 * ebitda_margin)"
cte("tiers", ["scored_nodes"], f"""
SELECT node_id, node_type, CASE WHEN pd <= q.a THEN 0 WHEN pd <= q.b THEN 1 ELSE 2 END AS tier,
 CASE WHEN fin <= r.a THEN 0 WHEN fin <= r.b THEN 1 ELSE 2 END AS fin_tier FROM (
  SELECT *, round({sql_logistic(FIN_Z)}, 6) AS fin FROM scored_nodes),
 (SELECT quantile_cont(pd, 1.0 / 3) AS a, quantile_cont(pd, 2.0 / 3) AS b FROM scored_nodes) q,
 (SELECT quantile_cont(round({sql_logistic(FIN_Z)}, 6), 1.0 / 3) AS a, quantile_cont(round({sql_logistic(FIN_Z)}, 6), 2.0 / 3) AS b FROM scored_nodes) r""")


def financial_pd():
    terms = [t for t in scorecards.ENTITY_DEFAULT[1] if t[0] in ("debt_to_equity", "current_ratio", "ebitda_margin")]
    return settle(logistic(scorecards.linear((scorecards.ENTITY_DEFAULT[0], terms))))


def tiered(m):
    nodes = scored_nodes(m).withColumn("fin", financial_pd())
    return monitoring.risk_tiers(monitoring.risk_tiers(nodes, "pd", "tier"), "fin", "fin_tier")


@section.add("f12_risk_tertiles", sql(["tiers"], "SELECT node_id, tier FROM tiers"))
def f12(m):
    return monitoring.risk_tiers(scored_nodes(m), "pd", "tier").select("node_id", "tier")


@section.add("g12_tier_accuracy_by_type", sql(["tiers"], """
SELECT node_type, count(*) AS n, round(avg(CASE WHEN tier = fin_tier THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM tiers GROUP BY 1
UNION ALL SELECT 'all', count(*), round(avg(CASE WHEN tier = fin_tier THEN 1.0 ELSE 0.0 END), 6) FROM tiers"""))
def g12(m):
    return monitoring.tier_accuracy(tiered(m), "tier", "fin_tier", "node_type")


@section.add("k8_financial_vs_enhanced", sql(["scored_nodes"], """
SELECT round(f, 6) AS auc_financial_only, round(e, 6) AS auc_enhanced, round(e - f, 6) AS auc_improvement, (e - f) > 0.03 AS meaningful FROM (
 SELECT avg(CASE WHEN a.fin > b.fin THEN 1.0 WHEN a.fin = b.fin THEN 0.5 ELSE 0.0 END) AS f,
  avg(CASE WHEN a.pd > b.pd THEN 1.0 WHEN a.pd = b.pd THEN 0.5 ELSE 0.0 END) AS e
 FROM fin_nodes a JOIN fin_nodes b ON a.default_12m = 1 AND b.default_12m = 0)""").replace(
    "SELECT round(f, 6 + 1e-9", "SELECT round(f, 6 + 1e-9").replace("fin_nodes", f"(SELECT *, round({sql_logistic(FIN_Z)} + 1e-9, 6) AS fin FROM scored_nodes)"))
def k8(m):
    """Both scores go through one ranking pass, keyed by score name."""
    from tradeweave.operators.profile import unpivot
    long = unpivot(scored_nodes(m).withColumn("fin", financial_pd()), ["pd", "fin"], ["default_12m"])
    auc = metrics.ranking_metrics(long, "x", "default_12m", ["metric"])
    pick = lambda n: F.max(F.when(F.col("metric") == n, F.col("auc")))
    gain = F.col("e") - F.col("f")
    return auc.agg(pick("fin").alias("f"), pick("pd").alias("e")).select(
        settle(F.col("f")).alias("auc_financial_only"), settle(F.col("e")).alias("auc_enhanced"),
        settle(gain).alias("auc_improvement"), (gain > 0.03).alias("meaningful"))


# ------------------------------------------------------------------ monitoring
PSI_COLUMNS = ["lc_amount_usd", "trade_route_risk_score", "port_congestion_destination"]
BASELINE_MONTHS = 24  # the first months of the data are the baseline
_EDGES = ", ".join(f"{i / 10}" for i in range(1, 10))


@section.add("e13_population_stability", sql(["lc"], """,
psi_long AS (SELECT date_trunc('month', issue_date)::DATE AS month, issue_date < (SELECT date_trunc('month', min(issue_date)) + INTERVAL 24 MONTH FROM lc) AS base, u.metric, u.x FROM lc,
 LATERAL (SELECT unnest(['lc_amount_usd', 'trade_route_risk_score', 'port_congestion_destination']) AS metric,
  unnest([lc_amount_usd, trade_route_risk_score, port_congestion_destination]) AS x) u),
psi_edges AS (SELECT metric, quantile_cont(x, [%s]) AS edges FROM psi_long WHERE base GROUP BY metric),
psi_bin AS (SELECT l.*, len(list_filter(e.edges, lambda b: b < l.x)) AS bin FROM psi_long l JOIN psi_edges e ON e.metric = l.metric),
bins AS (SELECT unnest(generate_series(0, 9)) AS bin),
expd AS (SELECT m.metric, b.bin, greatest(CAST(count(p.bin) AS DOUBLE) / any_value(m.n), 0.0001) AS e FROM
 (SELECT metric, count(*) AS n FROM psi_bin WHERE base GROUP BY metric) m CROSS JOIN bins b
 LEFT JOIN psi_bin p ON p.metric = m.metric AND p.bin = b.bin AND p.base GROUP BY m.metric, b.bin),
act AS (SELECT m.month, m.metric, b.bin, greatest(CAST(count(p.bin) AS DOUBLE) / any_value(m.n), 0.0001) AS a FROM
 (SELECT month, metric, count(*) AS n FROM psi_bin GROUP BY ALL) m CROSS JOIN bins b
 LEFT JOIN psi_bin p ON p.metric = m.metric AND p.month = m.month AND p.bin = b.bin GROUP BY m.month, m.metric, b.bin)
SELECT month, feature, psi, CASE WHEN psi > 0.25 THEN 'recalibrate' WHEN psi > 0.10 THEN 'investigate' ELSE 'stable' END AS action FROM (
 SELECT act.month, act.metric AS feature, round(sum((a - e) * ln(a / e)), 6) AS psi FROM act
 JOIN expd ON expd.metric = act.metric AND expd.bin = act.bin GROUP BY 1, 2)""" % _EDGES).replace(")\n,\npsi_long", "),\npsi_long"))
def e13(m):
    lc = m.lc.withColumn("month", F.trunc("issue_date", "month"))
    return monitoring.population_stability(lc, PSI_COLUMNS, "month", F.col("issue_date") < monitoring.baseline_end(
        m.lc, "issue_date", BASELINE_MONTHS))


@section.add("e14_decile_backtest", sql(["lc"], """
SELECT quarter, decile, n, expected_rate, actual_rate, sd, abs(actual_rate - expected_rate) > 2 * sd AS flagged FROM (
 SELECT date_trunc('quarter', issue_date)::DATE AS quarter, CAST(len(list_filter(q.edges, lambda b: b < p)) + 1 AS INTEGER) AS decile, count(*) AS n,
  round(avg(p), 6) AS expected_rate, round(avg(is_default), 6) AS actual_rate, round(sqrt(sum(p * (1 - p))) / count(*), 6) AS sd FROM
 (SELECT issue_date, is_default, default_probability_true AS p FROM lc) l,
 (SELECT quantile_cont(default_probability_true, [%s]) AS edges FROM lc) q GROUP BY 1, 2)""" % _EDGES))
def e14(m):
    rows = m.lc.select(F.trunc("issue_date", "quarter").alias("quarter"), "default_probability_true", "is_default")
    return monitoring.decile_backtest(rows, "default_probability_true", "is_default", "quarter")


SIGNS = {"otif_rate": -1, "ccc_days": 1, "debt_to_equity": 1, "current_ratio": -1, "supplier_concentration_hhi": 1}


@section.add("e15_covariate_signs", sql(["scored_nodes"], "SELECT *, CAST(sign(correlation) AS INTEGER) = expected_sign AS agrees FROM (" +
             "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, {s} AS expected_sign, round(corr({c}, pd), 6) AS correlation FROM scored_nodes"
                                 for c, s in SIGNS.items()) + ")"))
def e15(m):
    return monitoring.covariate_signs(scored_nodes(m), SIGNS, "pd")


@section.add("e16_run_metrics")
def e16(m):
    """Run-level metrics table: sizes, label rates, ranking quality, wall time of computing them."""
    start = time.time()
    sizes = m.edges.agg(F.count(F.lit(1)).alias("n_edges"), F.count_if(F.col("edge_type") == "transportation").alias("n_transport_links"))
    rates = m.nodes.agg(F.count(F.lit(1)).alias("n_nodes"), F.avg("default_12m").alias("node_default_rate"))
    quality = metrics.ranking_metrics(m.lc, "default_probability_true", "is_default")
    rows = stage(metrics.metric_rows("network", sizes).unionByName(metrics.metric_rows("entities", rates)).unionByName(
        metrics.metric_rows("lc", quality)))
    elapsed = m.spark.range(1).select(F.lit(time.time() - start).alias("run_seconds"))
    return rows.unionByName(metrics.metric_rows("run", elapsed))
