"""MLlib queries. Model outputs have no SQL twin; tests check their properties instead."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tradeweave.operators import (forecast, fusion, grouped_fit, lc_features, learning, metrics, shipment_heads, splits,
                                  temporal)
from tradeweave.operators.metrics import metric_rows
from tradeweave.plans.registry import Section
from tradeweave.plans.relational import entity_vectors, shipment_shape
from tradeweave.session import concurrently, stage

section = Section()
QUERIES, ORACLES = section.queries, section.oracles
LABEL = "default_12m"


def entity_rows(m):
    """21 features and the label, with a split stratified by label (exact sizes, no per-label task)."""
    def build():
        rows = lc_features.entity_features(m.network_nodes).join(m.nodes.select("node_id", LABEL), "node_id")
        return splits.exact_split(rows, ["node_id"], 0.8, [LABEL])
    return m.staged("entity_rows", build)


def train_of(df):
    return df.filter(F.col("split") == "train")


def test_of(df):
    return df.filter(F.col("split") == "test")


@section.add("m1_default_classifier")
def m1(m):
    rows = entity_rows(m)
    model = learning.fit_default_classifier(train_of(rows), lc_features.ENTITY_FEATURES, LABEL)
    return learning.score(model, test_of(rows), "pd").select("node_id", LABEL, "pd")


def searched(m):
    """Every trial of the search; the winner's fit with its full number of rounds is the row with `final`."""
    def build():
        rows = entity_rows(m)
        model, trials = learning.search_default_classifier(train_of(rows), "node_id", lc_features.ENTITY_FEATURES, LABEL)
        best = trials[-1]
        auc = metrics.ranking_metrics(learning.score(model, test_of(rows), "pd"), "pd", LABEL).first().auc
        full = best._replace(rounds=best.params["maxIter"], auc=float(auc))
        ranges = learning.SEARCH_RANGES
        kinds = ", ".join(f"{n} {'int' if scale == 'whole' else 'double'}" for n, (_, _, scale) in ranges.items())
        return m.spark.createDataFrame(
            [(t.point, *[t.params[n] for n in ranges], t.rounds, t.auc, t is full) for t in [*trials, full]],
            f"point int, {kinds}, rounds int, auc double, final boolean")
    return m.staged("searched", build)


@section.add("m2_hyperparameter_search")
def m2(m):
    """Trials by halving round: area under ROC on the inner held-out rows, of the final fit on the outer ones."""
    return searched(m)


@section.add("m3_t1_top_importances")
def m3(m):
    model = learning.fit_default_classifier(train_of(entity_rows(m)), lc_features.ENTITY_FEATURES, LABEL)
    return learning.importances(m.spark, model, lc_features.ENTITY_FEATURES)


def compared_scores(m):
    """(default_12m, metric, x): test entities scored by the financial-only and the enhanced model and the closed form."""
    rows = entity_rows(m)
    fin = learning.fit_default_classifier(train_of(rows), lc_features.FINANCIAL_ONLY, LABEL, depth=3)
    full = learning.fit_default_classifier(train_of(rows), lc_features.ENTITY_FEATURES, LABEL, depth=3)
    scored = learning.score(full, learning.score(fin, test_of(rows), "fin"), "enhanced").withColumn(
        "formula", fusion.supply_chain_adjusted_pd(F.col("fin"), F.col("otif_rate"), F.col("inventory_turnover"),
                                                   fusion.alternative_suppliers(F.col("supplier_concentration_hhi"))))
    from tradeweave.operators.profile import unpivot
    return unpivot(scored, ["fin", "enhanced", "formula"], [LABEL])


@section.add("k8_trained_model_comparison")
def k8(m):
    """Financial-only against supply-chain-enhanced model on one split, with the closed-form SC-PD as cross-check."""
    return metrics.ranking_metrics(compared_scores(m), "x", LABEL, ["metric"])


def ccc_scored(m):
    rows = splits.hash_split(m.shocks, ["port", "month", "horizon_days"], 80, "ccc")
    return learning.predict_ccc(learning.fit_ccc_models(train_of(rows)), test_of(rows))


@section.add("m5_ccc_component_models")
def m5(m):
    scored = ccc_scored(m)
    ape = metrics.absolute_percentage_error(F.col("ccc_change"), F.col("pred_ccc_change"), 3.0)
    return metric_rows("ccc", scored.agg(
        F.avg(F.when(F.col("horizon_days") == 30, ape)).alias("mape_30d"), F.avg(ape).alias("mape_all"),
        F.avg(F.abs(F.col("ccc_change") - F.col("pred_ccc_change"))).alias("mae_days")))


@section.add("s7_request_batch_scoring")
def s7(m):
    """Covenant alerts for a table of requests (the latest month per port), scored by the component models."""
    latest = m.shocks.agg(F.max("month")).scalar()
    models = learning.fit_ccc_models(m.shocks.filter(F.col("month") < latest), rounds=5)
    requests = m.shocks.filter(F.col("month") == latest).select("port", *learning.CCC_FEATURES)
    scored = learning.predict_ccc(models, requests)
    current = m.nodes.select(F.col("node_id").alias("port"), "ccc_days")
    return scored.join(current, "port").select("port", "horizon_days", *[c.alias(n) for n, c in fusion.covenant_alert(
        F.col("ccc_days"), F.col("pred_ccc_change"), F.lit(60.0)).items()])


def survival_table(m):
    return lc_features.entity_features(m.network_nodes).join(
        m.nodes.select("node_id", "survival_duration_days", "survival_event"), "node_id")


@section.add("m6_cox_comparison")
def m6(m):
    return learning.cox_comparison(survival_table(m), lc_features.COX_COVARIATES, ["debt_to_equity", "current_ratio", "ebitda_margin"],
                                   "node_id", "survival_duration_days", "survival_event")


@section.add("m8_linear_quantile_forecast")
def m8(m):
    out = stage(learning.forecast_quantiles(m.series, "throughput_teu", "port_congestion_index"))
    mape = temporal.port_mape(out, "actual", "q50", floor=1.0)
    cover = out.groupBy("port").agg(F.avg(F.col("actual").between(F.col("q10"), F.col("q90")).cast("double")).alias("coverage"))
    return mape.join(cover, "port")


def forecasts(m):
    def build():
        long = forecast.long_series(m.series, {"throughput": "throughput_teu", "freight": "freight_rate_usd_feu"},
                                    "port_congestion_index")
        return forecast.quantile_forecasts(forecast.forecast_rows(long))
    return m.staged("forecasts", build)


@section.add("m8_multi_horizon_forecast")
def m8_all(m):
    """Two series, three horizons, three quantiles, by port: error, cover and pinball loss against the seasonal-naive value."""
    return forecast.forecast_quality(forecasts(m), ["series", "port", "horizon"])


def shipment_scores(m):
    """(split, task, y, p) of every shipment and head. Shipments are made once, with the columns that tokens and labels need."""
    def build():
        rows = stage(m.shipments.select("shipment_id", *lc_features.TOKEN_SOURCES, *shipment_heads.HEADS.values()))
        return shipment_heads.shipment_heads(lc_features.event_tokens(rows, gathered=True), rows).drop("shipment_id")
    return m.staged("shipment_head_scores", build)


@section.add("m9_shipment_multi_task")
def m9(m):
    """Test-split quality of the three probability heads over pooled event tokens."""
    test = stage(test_of(shipment_scores(m)).filter(F.col("task") != "risk"))
    auc = metrics.ranking_metrics(test, "p", "y", ["task"])
    brier = test.groupBy("task").agg(metrics.brier(F.col("p"), F.col("y")).alias("brier"))
    return auc.join(brier, "task")


FOLDS = 5


def letter_matrix(m):
    """Stacked matrix with out-of-fold scores of the fitted default and Cox models, looked up per letter of credit."""
    def build():
        from tradeweave.operators import profile
        # tables that do not read each other are written side by side
        concurrently([lambda: m.joined_lines, lambda: m.series])
        concurrently([lambda: m.nodes, lambda: m.edges])
        concurrently([lambda: m.network_nodes, lambda: m.lc])
        entities = stage(profile.zscore(survival_table(m), lc_features.ENTITY_FEATURES).join(m.nodes.select("node_id", LABEL), "node_id"))
        pd, hazard = concurrently([
            partial(grouped_fit.out_of_fold_logistic, entities, "node_id", lc_features.ENTITY_FEATURES, LABEL, "pd", FOLDS),
            partial(grouped_fit.out_of_fold_hazard, entities, "node_id", lc_features.COX_COVARIATES, "survival_duration_days",
                    "survival_event", "hazard", FOLDS)])
        scores = stage(pd.join(hazard, "node_id"))
        matrix = lc_features.stacked_matrix(m.lc, scores, entity_vectors(m), lc_features.shipment_scores_of(shipment_shape(m.lc)))
        return matrix.join(m.lc.select("lc_id", "is_default"), "lc_id")
    return m.staged("letter_matrix", build)


def stacked_scores(m):
    """(lc_id, is_default, fold, p): out-of-fold scores of the train letters, fold null for the test letters."""
    def build():
        _, oof, test = learning.fit_stacking(letter_matrix(m), "lc_id", lc_features.LC_FEATURES + lc_features.STACKED_EXTRA,
                                             "is_default", FOLDS, META_ROUNDS)
        return oof.unionByName(test.withColumn("fold", F.lit(None).cast("int")))
    return m.staged("stacked_scores", build)


META_ROUNDS = 40  # of the registered queries: 200, the default of fit_stacking, takes over five minutes for six fits


@section.add("m11_m12_stacked_default_model")
def m11(m):
    """Out-of-fold entity scores, looked up per letter of credit, feed the boosted meta-learner."""
    scored = stacked_scores(m)
    test = scored.filter(F.col("fold").isNull())
    oof_auc = metrics.ranking_metrics(scored.filter(F.col("fold").isNotNull()), "p", "is_default").select(F.col("auc").alias("oof_auc"))
    ranks = metrics.ranking_metrics(test, "p", "is_default").select(F.col("auc").alias("test_auc"), "gini")
    fit = test.agg(metrics.brier(F.col("p"), F.col("is_default")).alias("brier"))
    ece = metrics.expected_calibration_error(test, "p", "is_default")
    out = None
    for p in [oof_auc, ranks, fit, ece]:
        rows = metric_rows("stacking", p)
        out = rows if out is None else out.unionByName(rows)
    return out
