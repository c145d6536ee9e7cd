"""Evaluation metrics, exact at any size: rows collapse to distinct scores (or bins) before anything is ordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions.scalar import ratio
from tradeweave.operators.cumulative import running_totals
from tradeweave.session import stage


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("double")).alias("pos"), F.sum(1.0 - F.col(label).cast("double")).alias("neg"))


def ranking_metrics(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC (ties count half), Gini and step-wise average precision."""
    t = running_totals(score_counts(df, score, label, by), "score", ["pos", "neg"], by)
    wins = F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg")))
    top_pos = F.col("pos_all") - F.col("pos_before")
    top_all = top_pos + F.col("neg_all") - F.col("neg_before")
    agg = t.groupBy(*by).agg(
        ratio(wins, F.max("pos_all") * F.max("neg_all")).alias("auc"),
        F.sum(ratio(F.col("pos"), F.col("pos_all")) * ratio(top_pos, top_all)).alias("average_precision"))
    return agg.withColumn("gini", 2.0 * F.col("auc") - 1.0)


def brier(p: Column, y: Column) -> Column:
    return F.avg((p - y) * (p - y))


def log_loss(p: Column, y: Column, eps: float = 1e-12) -> Column:
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return F.avg(-(y * F.log(q) + (1.0 - y) * F.log(1.0 - q)))


def expected_calibration_error(df: DataFrame, p: str, y: str, n_bins: int = 10) -> DataFrame:
    """Equal bins, left-closed, the last one closed; empty bins do not exist after grouping."""
    bins = df.groupBy(F.least(F.floor(F.col(p) * n_bins), F.lit(n_bins - 1)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(y).cast("double")).alias("rate"), F.avg(p).alias("mean_p"))
    return bins.agg((F.sum(F.col("n") * F.abs(F.col("rate") - F.col("mean_p"))) / F.sum("n")).alias("ece"))


def absolute_percentage_error(actual: Column, predicted: Column, floor: float) -> Column:
    return F.abs(actual - predicted) / F.greatest(F.abs(actual), F.lit(floor)) * 100.0


def pinball(actual: Column, predicted: Column, q: Column) -> Column:
    err = actual - predicted
    return F.greatest((q - 1.0) * err, q * err)


def concordance_index(df: DataFrame, duration: str, event: str, risk: str) -> DataFrame:
    """Share of comparable pairs in which the earlier failure has the higher risk (equal risk counts half).

    A pair is comparable when one side failed and the other outlived it; at equal durations only a censored row
    outlives a failure. Instead of joining rows with rows, the ranks of the distinct durations are cut into dyadic
    blocks: every failure meets the later rows through at most log2(durations) blocks, and inside a block a running
    count over risk does the rest. Durations may be any numbers. Work is n*log(durations); no pairs are built.
    """
    counted = stage(df.groupBy(F.col(duration).cast("double").alias("d"), F.col(event).cast("int").alias("e"),
                               F.col(risk).cast("double").alias("risk")).agg(F.count(F.lit(1)).cast("double").alias("n")))
    ranks = running_totals(counted.select("d").distinct().withColumn("one", F.lit(1).cast("long")), "d", ["one"])
    ranks = stage(ranks.select("d", F.col("one_before").alias("place")))
    levels = (2 * ranks.count() + 1).bit_length()
    rows = counted.join(ranks, "d").withColumn("k", 2 * F.col("place") + (1 - F.col("e")))
    block = lambda b: F.floor(F.col("k") / F.lit(1 << b)).cast("long")
    parts = []
    for b in range(levels):
        odd = block(b) % 2 == 1
        later = F.struct(F.lit(b).alias("level"), block(b).alias("block"), F.lit(0.0).alias("asks"), F.col("n").alias("rows"))
        ask = F.struct(F.lit(b).alias("level"), (block(b) + 1).alias("block"), F.col("n").alias("asks"), F.lit(0.0).alias("rows"))
        parts.append(F.when(odd, later).when(F.col("e") == 1, ask))
    spread = rows.select("risk", F.explode(F.array_compact(F.array(*parts))).alias("p")).select("risk", "p.*")
    merged = spread.groupBy("level", "block", "risk").agg(F.sum("asks").alias("asks"), F.sum("rows").alias("rows"))
    t = running_totals(merged, "risk", ["rows"], ["level", "block"])
    return t.agg(ratio(F.sum(F.col("asks") * (F.col("rows_before") + 0.5 * F.col("rows"))),
                       F.sum(F.col("asks") * F.col("rows_all"))).alias("c_index"),
                 F.sum(F.col("asks") * F.col("rows_all")).alias("n_pairs"))


def risk_sets(df: DataFrame, duration: str, event: str, log_risk: str) -> DataFrame:
    """Per duration: events, their summed log-risk, and the log of the risk-set sum over equal or longer durations."""
    top = df.agg(F.max(log_risk)).scalar()
    shifted = df.withColumn("_top", top)
    per = shifted.groupBy((-F.col(duration)).alias("neg_duration")).agg(
        F.sum(F.exp(F.col(log_risk) - F.col("_top"))).alias("mass"), F.max("_top").alias("top"),
        F.sum(F.col(event).cast("double")).alias("events"),
        F.sum(F.when(F.col(event) == 1, F.col(log_risk)).otherwise(0.0)).alias("event_risk"))
    t = running_totals(per, "neg_duration", ["mass"])
    return t.select((-F.col("neg_duration")).alias("duration"), "events", "event_risk",
                    (F.log(F.col("mass_before") + F.col("mass")) + F.col("top")).alias("log_risk_set"))


def cox_loss(df: DataFrame, duration: str, event: str, log_risk: str) -> DataFrame:
    """Negative Breslow partial log-likelihood per event."""
    r = risk_sets(df, duration, event, log_risk)
    return r.agg((-F.sum(F.col("event_risk") - F.col("events") * F.col("log_risk_set"))
                  / F.greatest(F.sum("events"), F.lit(1.0))).alias("loss"), F.sum("events").alias("n_events"))


def fold_concordance(df: DataFrame, fold: str, duration: str, event: str, risk: str, k: int) -> DataFrame:
    """Concordance within each of k folds: one row per fold, with mean and population deviation over the folds."""
    out = None
    for f in range(k):
        one = concordance_index(df.filter(F.col(fold) == f), duration, event, risk).select(F.lit(f).alias("fold"), "c_index")
        out = one if out is None else out.unionByName(one)
    out = stage(out)
    whole = out.agg(F.avg("c_index").alias("mean_c_index"), F.stddev_pop("c_index").alias("std_c_index"))
    return out.crossJoin(F.broadcast(whole))  # one row


def class_weight(df: DataFrame, label: str) -> DataFrame:
    rate = F.avg(F.col(label).cast("double"))
    return df.agg(rate.alias("pos_rate"), ((1.0 - rate) / F.greatest(rate, F.lit(1e-6))).alias("pos_weight"))


def metric_rows(section: str, df: DataFrame) -> DataFrame:
    """One-row metrics table to (section, metric, value) rows."""
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns]
    return df.select(F.lit(section).alias("section"), F.explode(F.array(*cells)).alias("m")).select("section", "m.*")
