"""MLlib models: default, working capital, survival, forecast, stacking."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.operators import boosting, metrics, profile, splits, temporal
from tradeweave.operators.cumulative import exact_quantiles, running_totals
from tradeweave.session import concurrently, stage

SEED = 42


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(column)[1]


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    """Positives weigh (1 - p) / p; the rate comes in as a scalar subquery."""
    weight = metrics.class_weight(df, label).select("pos_weight").scalar()
    return df.withColumn("class_weight", F.when(F.col(label) == 1, weight).otherwise(1.0))


def _assembled(columns: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(columns), outputCol="features"), estimator])


def fit_default_classifier(train: DataFrame, columns: Sequence[str], label: str, depth: int = 4, rounds: int = 10,
                           step: float = 0.1, subsample: float = 1.0) -> PipelineModel:
    """Boosted trees with weighted positives."""
    gbt = GBTClassifier(labelCol=label, weightCol="class_weight", maxDepth=depth, maxIter=rounds, stepSize=step,
                        subsamplingRate=subsample, seed=SEED, maxBins=32)
    return _assembled(columns, gbt).fit(stage(with_class_weight(train, label)))


def fit_logistic(train: DataFrame, columns: Sequence[str], label: str, ridge: float = 0.01) -> PipelineModel:
    lr = LogisticRegression(labelCol=label, weightCol="class_weight", regParam=ridge, maxIter=30)
    return _assembled(columns, lr).fit(stage(with_class_weight(train, label)))


def score(model: PipelineModel, df: DataFrame, out: str) -> DataFrame:
    keep = df.columns
    return model.transform(df).select(*keep, positive_probability().alias(out))


# The searched ranges of the default classifier. MLlib has no penalties on leaf values: the share of weight
# that a leaf needs and the number of bins take the place of the two.
SEARCH_RANGES = {
    "maxDepth": (2, 6, "whole"),
    "stepSize": (0.01, 0.2, "log"),
    "maxIter": (100, 500, "whole"),
    "minInstancesPerNode": (1, 15, "whole"),
    "subsamplingRate": (0.6, 1.0, "real"),
    "featureShare": (0.5, 1.0, "real"),
    "minInfoGain": (0.0, 0.004, "real"),
    "minWeightFractionPerNode": (0.0, 0.02, "real"),
    "maxBins": (16, 64, "whole"),
}


def drawn_point(point: int, ranges: dict[str, tuple] = SEARCH_RANGES, seed: int = SEED) -> dict[str, float]:
    """Parameters of one trial, from md5 of (seed, trial, name): the same on every engine and run."""
    drawn = {}
    for name, (low, high, scale) in ranges.items():
        u = (int(hashlib.md5(f"search-{seed}|{point}|{name}".encode()).hexdigest()[:8], 16) + 0.5) / 2 ** 32
        if scale == "whole":
            drawn[name] = low + math.floor(u * (high - low + 1))
        elif scale == "log":
            drawn[name] = round(math.exp(math.log(low) + u * (math.log(high) - math.log(low))), 6)
        else:
            drawn[name] = round(low + u * (high - low), 6)
    return drawn


class Trial(NamedTuple):
    point: int
    params: dict
    rounds: int
    auc: float


def search_default_classifier(train: DataFrame, key: str, columns: Sequence[str], label: str, n_points: int = 15,
                              ranges: dict[str, tuple] = SEARCH_RANGES, first_rounds: int = 4, keep: int = 3,
                              at_once: int = 4) -> tuple[PipelineModel, list[Trial]]:
    """Successive halving over hash-drawn points: all get a few rounds, the better third of them `keep` times as many, and so
    on; the last one is fitted with its own full number of rounds on all of `train`. Returns that model and every trial.
    Rows are laid out once for all trials and once for the last fit, and kept by the executors until the fits are done.

    Points are compared by area under ROC on a fifth of the rows, an exact split by hash within each label. Rows reach every
    fit in the same order and partitions whatever the layout of `train`, so subsampling and the result do not depend on it;
    ties go to the smaller point. A label of one value only cannot be ranked: its areas are 0.5 and the first points go on.
    """
    parted = stage(splits.exact_split(train.select(key, *columns, label), [key], 0.8, [label], salt="inner"))
    parts = max(1, math.ceil(parted.count() / ROWS_OF_A_TASK))

    def laid_out(df: DataFrame) -> DataFrame:
        return df.repartition(parts, key).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)

    fit_rows, held_out = parted.filter(F.col("split") == "train"), parted.filter(F.col("split") == "test")
    weighted = laid_out(stage(with_class_weight(fit_rows, label)))

    def model_of(params: dict, rounds: int, rows: DataFrame) -> PipelineModel:
        own = {n: v for n, v in params.items() if n not in ("maxIter", "featureShare")}
        if "featureShare" in params:
            own["featureSubsetStrategy"] = str(params["featureShare"]) if params["featureShare"] < 1 else "all"
        gbt = GBTClassifier(labelCol=label, weightCol="class_weight", maxIter=rounds, seed=SEED, **own)
        return _assembled(columns, gbt).fit(rows)

    def tried(point: int, params: dict, rounds: int) -> Trial:
        scored = score(model_of(params, rounds, weighted), held_out, "p")
        auc = metrics.ranking_metrics(scored, "p", label).first().auc
        return Trial(point, params, rounds, 0.5 if auc is None else float(auc))

    alive = [(p, drawn_point(p, ranges)) for p in range(n_points)]
    trials: list[Trial] = []
    rounds = first_rounds
    while True:
        jobs = [partial(tried, p, params, min(rounds, params["maxIter"])) for p, params in alive]
        done = [t for i in range(0, len(jobs), at_once) for t in concurrently(jobs[i:i + at_once])]
        trials += done
        if len(alive) == 1:
            break
        done.sort(key=lambda t: (-t.auc, t.point))
        alive = [(t.point, t.params) for t in done[:max(1, len(done) // keep)]]
        rounds *= keep
    weighted.unpersist()
    _, best = alive[0]
    whole = laid_out(stage(with_class_weight(parted, label)))
    model = model_of(best, best["maxIter"], whole)
    whole.unpersist()
    return model, trials


ROWS_OF_A_TASK = 200_000


def importances(spark, model: PipelineModel, columns: Sequence[str], n: int = 10) -> DataFrame:
    """Feature importances, largest first. One row per feature: as long as the column list."""
    values = model.stages[-1].featureImportances.toArray()
    rows = spark.createDataFrame([(c, float(v)) for c, v in zip(columns, values)], "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(n)


# ------------------------------------------------------------------ working capital
# Inputs and targets of the component models.
CCC_FEATURES = ["horizon_days", "delta_otif", "delta_lead_time_std", "delta_freight_cost_ratio", "delta_port_congestion",
                "delta_inventory_turnover"]
CCC_TARGETS = ["dio_change", "dso_change", "dpo_change"]


def fit_ccc_models(train: DataFrame, rounds: int = 10) -> dict[str, PipelineModel]:
    train = stage(train)
    fits = [_assembled(CCC_FEATURES, GBTRegressor(labelCol=t, predictionCol=f"pred_{t}", maxDepth=4, maxIter=rounds,
                                                  stepSize=0.3, seed=SEED)) for t in CCC_TARGETS]
    return dict(zip(CCC_TARGETS, concurrently([partial(f.fit, train) for f in fits])))


def predict_ccc(models: dict[str, PipelineModel], requests: DataFrame) -> DataFrame:
    """Scores a whole table of requests; total = DIO + DSO - DPO."""
    out = requests
    for model in models.values():
        out = model.transform(out).drop("features")
    return out.withColumn("pred_ccc_change", F.col("pred_dio_change") + F.col("pred_dso_change") - F.col("pred_dpo_change"))


# ------------------------------------------------------------------ survival
def fit_cox(df: DataFrame, covariates: Sequence[str], duration: str, event: str, ridge: float = 0.05, rounds: int = 15,
            tolerance: float = 1e-7) -> dict[str, float]:
    """Ridge-penalised Cox model (Breslow ties) by Newton steps, for any durations.

    Per distinct duration Spark sums exp(eta), x exp(eta) and x x' exp(eta); running sums over later durations give the
    risk sets, and gradient and Hessian are sums over durations. One row of those reaches the driver per step.
    """
    k = len(covariates)
    plain = stage(df.select((-F.col(duration).cast("double")).alias("t"), F.col(event).cast("double").alias("e"),
                            *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(covariates)]))
    # distinct durations, longest first, in blocks of a thousand: found once, so a step is one aggregation
    places = running_totals(plain.select("t").distinct().withColumn("one", F.lit(1).cast("long")), "t", ["one"])
    blocks = places.select("t", F.floor(F.col("one_before") / 1000).cast("long").alias("block"))
    rows = stage(plain.join(blocks, "t"))
    n = rows.count()
    beta = np.zeros(k)
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    names = ["s0"] + [f"s1_{i}" for i in range(k)] + [f"s2_{i}_{j}" for i, j in upper]
    inside = Window.partitionBy("block").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(F.lit(0)).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # few blocks
    for _ in range(rounds):
        eta = F.lit(0.0)
        for i, b in enumerate(beta):
            eta = eta + F.lit(float(b)) * F.col(f"x{i}")
        top = rows.agg(F.max(eta)).scalar()
        weighed = rows.withColumn("w", F.exp(eta - top))
        sums = weighed.groupBy("block", "t").agg(
            F.sum("e").alias("d"), F.sum("w").alias("s0"),
            *[F.sum(F.col("w") * F.col(f"x{i}")).alias(f"s1_{i}") for i in range(k)],
            *[F.sum(F.col("e") * F.col(f"x{i}")).alias(f"ex_{i}") for i in range(k)],
            *[F.sum(F.col("w") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s2_{i}_{j}") for i, j in upper])
        offsets = sums.groupBy("block").agg(*[F.sum(name).alias(name) for name in names]).select(
            "block", *[F.coalesce(F.sum(name).over(before), F.lit(0.0)).alias(f"o_{name}") for name in names])
        risk = sums.select("block", "d", *[f"ex_{i}" for i in range(k)], *[
            F.sum(name).over(inside).alias(name) for name in names]).join(offsets, "block")
        at = {name: F.col(f"o_{name}") + F.col(name) for name in names}
        mean = [at[f"s1_{i}"] / at["s0"] for i in range(k)]
        cells = risk.agg(
            *[F.sum(F.col(f"ex_{i}") - F.col("d") * mean[i]).alias(f"g_{i}") for i in range(k)],
            *[F.sum(F.col("d") * (at[f"s2_{i}_{j}"] / at["s0"] - mean[i] * mean[j])).alias(f"h_{i}_{j}") for i, j in upper]).first()
        gradient = np.array([cells[f"g_{i}"] for i in range(k)]) / n - ridge * beta
        hessian = np.zeros((k, k))
        for i, j in upper:
            hessian[i, j] = hessian[j, i] = cells[f"h_{i}_{j}"] / n
        step = np.linalg.solve(hessian + ridge * np.eye(k), gradient)
        beta = beta + step
        if np.abs(step).max() < tolerance:
            break
    return dict(zip(covariates, (float(b) for b in beta)))


def partial_hazard(coefficients: dict[str, float]) -> Column:
    eta = F.lit(0.0)
    for c, b in coefficients.items():
        eta = eta + F.lit(b) * F.col(c)
    return F.exp(eta)


def cox_comparison(df: DataFrame, full: Sequence[str], financial: Sequence[str], key: str, duration: str,
                   event: str) -> DataFrame:
    """Concordance of the full and the financial-only model on train and test, one row per model and split."""
    scaled = stage(splits.hash_split(profile.zscore(df, full), [key], 80, "cox"))
    train = scaled.filter(F.col("split") == "train")
    out = None
    for name, cols in (("full", full), ("financial_only", financial)):
        risk = F.round(partial_hazard(fit_cox(train, cols, duration, event)), 9)
        scored = scaled.select("split", F.col(duration).alias("days"), F.col(event).alias("event"), risk.alias("risk"))
        for part in ("train", "test"):
            c = metrics.concordance_index(scored.filter(F.col("split") == part), "days", "event", "risk")
            row = c.select(F.lit(name).alias("model"), F.lit(part).alias("split"), "c_index", "n_pairs")
            out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------------ forecasts
# Inputs of the forecast.
FORECAST_FEATURES = ["value_scaled", "roll_mean_7", "roll_mean_30", "roll_std_7", "ewma_7", "month_sin", "month_cos", "exog"]


def forecast_quantiles(series: DataFrame, value: str, exog: str, horizon: int = 30) -> DataFrame:
    """Linear forecast per horizon plus residual quantiles per series; scaler and model see train days only."""
    feats = temporal.calendar_features(temporal.scaled_series(series, value, exog, fit_scope="train"))
    windows = temporal.forecast_windows(feats, channels=[])
    rows = stage(temporal.chronological_split(windows, "port", "t").select(
        "port", "date", "t", "mu", "sd", "split", *FORECAST_FEATURES, F.col(f"target_{horizon}").alias("target")))
    lr = LinearRegression(labelCol="target", regParam=0.01, maxIter=20)
    model = _assembled(FORECAST_FEATURES, lr).fit(rows.filter(F.col("split") == "train"))
    scored = model.transform(rows).withColumn("residual", F.col("target") - F.col("prediction"))
    spread = exact_quantiles(scored.filter(F.col("split") == "train"), "residual", [0.1, 0.5, 0.9], ["port"])
    arrays = spread.groupBy("port").agg(F.transform(F.array_sort(F.collect_list(F.struct("prob", "quantile"))),
                                                    lambda s: s["quantile"]).alias("q"))
    back = lambda x: x * F.col("sd") + F.col("mu")
    test = scored.filter(F.col("split") == "test").join(arrays, "port")
    return test.select("port", "date", back(F.col("target")).alias("actual"), *[
        back(F.col("prediction") + F.element_at("q", i + 1)).alias(n) for i, n in enumerate(("q10", "q50", "q90"))])


# ------------------------------------------------------------------ stacking
def fit_stacking(matrix: DataFrame, key: str, columns: Sequence[str], label: str, k: int = 5, rounds: int = 200,
                 depth: int = 4, step: float = 0.05) -> tuple[boosting.Boosted, DataFrame, DataFrame]:
    """Boosted meta-learner. Returns the model, out-of-fold train scores (key, label, fold, p) and test scores.

    The k + 1 models, boosted trees with weighted positives, are grown together on one staged table.
    """
    rows = stage(splits.hash_split(matrix, [key], 80, "stack").withColumn("fold", splits.fold_of([F.col(key)], k, "stack-fold")))
    train = rows.filter(F.col("split") == "train").select(key, *columns, label, "fold")
    models = boosting.fit_boosted(train, key, columns, label, k + 1, rounds, depth, step)
    oof = boosting.scored(train, columns, models, "p")
    test = rows.filter(F.col("split") == "test").select(key, *columns, label, F.lit(None).cast("int").alias("fold"))
    return models[k], oof, boosting.scored(test, columns, models, "p").drop("fold")
