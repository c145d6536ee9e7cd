"""Rolling windows, forecast windows, splits, spells."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeweave.functions.scalar import settle
from tradeweave.operators import splits, temporal
from tradeweave.operators.joins import typed_edges
from tradeweave.plans.oracle_base import cte, hash32, sql
from tradeweave.plans.registry import Section

section = Section()
QUERIES, ORACLES = section.queries, section.oracles

VALUE, EXOG = "throughput_teu", "port_congestion_index"


def _w(n: int) -> str:
    return f"(PARTITION BY port ORDER BY date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


def _ewma(span: int) -> str:
    """The recursion itself, day by day."""
    a = 2.0 / (span + 1)
    return f"CAST({1.0 - a!r} AS DOUBLE) * r.ewma_{span} + CAST({a!r} AS DOUBLE) * d.x"


cte("rolled", ["series"], f"""
SELECT date, port, throughput_teu, port_congestion_index, avg(throughput_teu) OVER {_w(6)} AS roll_mean_7,
 avg(throughput_teu) OVER {_w(29)} AS roll_mean_30, coalesce(stddev_samp(throughput_teu) OVER {_w(6)}, 0) AS roll_std_7
FROM series""")


@section.add("w1_w2_rolling_mean_std", sql(["rolled"], """
SELECT date, port, round(roll_mean_7, 6) AS roll_mean_7, round(roll_mean_30, 6) AS roll_mean_30,
 round(roll_std_7, 6) AS roll_std_7 FROM rolled"""))
def w1(m):
    cols = ["roll_mean_7", "roll_mean_30", "roll_std_7"]
    return temporal.rolling_features(m.series, VALUE).select("date", "port", *[settle(F.col(c)).alias(c) for c in cols])


cte("days_in_order", ["series"], """
SELECT date, port, CAST(throughput_teu AS DOUBLE) AS x, row_number() OVER (PARTITION BY port ORDER BY date) AS i FROM series""")


@section.add("w3_exponential_means", sql(["days_in_order"], f"""
SELECT date, port, round(ewma_7, 6) AS ewma_7, round(ewma_30, 6) AS ewma_30 FROM (
 WITH RECURSIVE d AS MATERIALIZED (SELECT * FROM days_in_order),
 r AS (SELECT date, port, i, x AS ewma_7, x AS ewma_30 FROM d WHERE i = 1
  UNION ALL SELECT d.date, d.port, d.i, {_ewma(7)}, {_ewma(30)} FROM r JOIN d ON d.port = r.port AND d.i = r.i + 1)
 SELECT * FROM r)"""))
def w3(m):
    return temporal.rolling_features(m.series, VALUE).select(
        "date", "port", settle(F.col("ewma_7")).alias("ewma_7"), settle(F.col("ewma_30")).alias("ewma_30"))


@section.add("a11_per_entity_scaling", sql(["series"], """
SELECT date, port, round((throughput_teu - avg(throughput_teu) OVER p) / (stddev_samp(throughput_teu) OVER p + 1e-8), 6)
 AS value_scaled, round((port_congestion_index - avg(port_congestion_index) OVER p) /
 (stddev_samp(port_congestion_index) OVER p + 1e-8), 6) AS exog FROM series WINDOW p AS (PARTITION BY port)"""))
def a11(m):
    s = temporal.scaled_series(m.series, VALUE, EXOG)
    return s.select("date", "port", settle(F.col("value_scaled")).alias("value_scaled"), settle(F.col("exog")).alias("exog"))


cte("scaled", ["rolled"], """
SELECT *, (throughput_teu - avg(throughput_teu) OVER p) / (stddev_samp(throughput_teu) OVER p + 1e-8) AS value_scaled,
 row_number() OVER (PARTITION BY port ORDER BY date) - 1 AS t, count(*) OVER p AS n FROM rolled WINDOW p AS (PARTITION BY port)""")
cte("fwin", ["scaled"], """
SELECT * FROM (SELECT port, date, t, sum(value_scaled) OVER b AS past_sum, first_value(value_scaled) OVER b AS past_first,
 last_value(value_scaled) OVER b AS past_last, count(*) OVER b AS past_size, lead(value_scaled, 30) OVER o AS target_30,
 lead(value_scaled, 60) OVER o AS target_60, lead(value_scaled, 90) OVER o AS target_90 FROM scaled
 WINDOW o AS (PARTITION BY port ORDER BY date),
        b AS (PARTITION BY port ORDER BY date ROWS BETWEEN 128 PRECEDING AND 1 PRECEDING))
WHERE t >= 128 AND target_90 IS NOT NULL""")


@section.add("w4_w5_w13_forecast_windows", sql(["fwin"], """
SELECT port, t, past_size, round(past_sum, 6) AS past_sum, round(past_first, 6) AS past_first,
 round(past_last, 6) AS past_last, round(target_30, 6) AS target_30, round(target_60, 6) AS target_60,
 round(target_90, 6) AS target_90 FROM fwin"""))
def w4(m):
    s = temporal.scaled_series(m.series, VALUE, EXOG)
    w = temporal.forecast_windows(s, channels=["value_scaled"])
    past = F.col("past_value_scaled")
    return w.select("port", F.col("t").cast("bigint").alias("t"), F.size(past).cast("bigint").alias("past_size"),
                    settle(F.aggregate(past, F.lit(0.0), lambda a, x: a + x)).alias("past_sum"),
                    settle(F.get(past, F.lit(0))).alias("past_first"), settle(F.element_at(past, -1)).alias("past_last"),
                    *[settle(F.col(f"target_{h}")).alias(f"target_{h}") for h in temporal.HORIZONS])


@section.add("w6_f15_chronological_split", sql(["series"], """
SELECT port, split, count(*) AS n, min(date) AS first_day, max(date) AS last_day, sum(throughput_teu) AS throughput FROM (
 SELECT *, CASE WHEN row_number() OVER (PARTITION BY port ORDER BY date) <= floor(0.8 * count(*) OVER (PARTITION BY port))
  THEN 'train' ELSE 'test' END AS split FROM series) GROUP BY port, split"""))
def w6(m):
    return temporal.chronological_split(m.series, "port", "date").groupBy("port", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.sum("throughput_teu").alias("throughput"))


@section.add("w14_w15_calendar_terms", sql(["series"], """
SELECT DISTINCT date, round(sin(2 * pi() * month(date) / 12), 6) AS month_sin, round(cos(2 * pi() * month(date) / 12), 6) AS month_cos,
""" + ",\n".join(
    f"round({f}(2 * pi() * {k} / {p} * date_diff('day', DATE '1970-01-01', date)), 6) AS fourier_{name}_{f}_{k}"
    for name, p, ks in (("annual", 365.25, (1, 2, 3)), ("weekly", 7.0, (1,))) for k in ks for f in ("sin", "cos")) +
    " FROM series"))
def w14(m):
    days = m.series.select("date").distinct()
    feats = temporal.calendar_features(days)
    return feats.select("date", *[settle(F.col(c)).alias(c) for c in feats.columns if c != "date"])


@section.add("w16_congestion_spells", sql(["series"], """
SELECT port, min(date) AS first_day, max(date) AS last_day, count(*) AS n_days, max(port_congestion_index) AS peak FROM (
 SELECT *, sum(CASE WHEN hot AND NOT coalesce(prev, FALSE) THEN 1 ELSE 0 END) OVER (PARTITION BY port ORDER BY date) AS spell FROM (
  SELECT *, lag(hot) OVER (PARTITION BY port ORDER BY date) AS prev FROM (
   SELECT *, port_congestion_index > round(avg(port_congestion_index) OVER p + 1.5 * stddev_samp(port_congestion_index) OVER p, 9)
    AS hot FROM series WINDOW p AS (PARTITION BY port)))) WHERE hot GROUP BY port, spell HAVING count(*) >= 2"""))
def w16(m):
    return temporal.congestion_spells(m.series).drop("spell")


# ------------------------------------------------------------------ splits
@section.add("w7_permutation_split", f"""
SELECT CASE WHEN {hash32('o_orderkey', salt='split')} % 100 < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n,
 round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1""")
def w7(m):
    return splits.hash_split(m.orders, ["o_orderkey"]).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("amount"))


@section.add("w7_exact_split_by_type", sql(["node_keys"], f"""
SELECT node_id, CASE WHEN row_number() OVER (PARTITION BY node_type ORDER BY {hash32('node_id', salt='split')}, node_id)
 <= floor(0.8 * count(*) OVER (PARTITION BY node_type)) THEN 'train' ELSE 'test' END AS split FROM node_keys"""))
def w7b(m):
    return splits.exact_split(m.node_types, ["node_id"], 0.8, ["node_type"]).select("node_id", "split")


@section.add("w8_edge_holdout_by_relation", sql(["edges", "node_keys"], f"""
SELECT relation, split, count(*) AS n, min(src || dst) AS first_pair FROM (
 SELECT *, CASE WHEN row_number() OVER (PARTITION BY relation ORDER BY {hash32('src', 'dst', salt='split')}, src, dst)
  <= floor(0.85 * count(*) OVER (PARTITION BY relation)) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT src, dst, a.node_type || ':' || edge_type || ':' || b.node_type AS relation FROM edges
  JOIN node_keys a ON a.node_id = src JOIN node_keys b ON b.node_id = dst)) GROUP BY relation, split"""))
def w8(m):
    return holdout(m).groupBy("relation", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.concat("src", "dst")).alias("first_pair"))


def holdout(m):
    """Forward edges, 85 % train per relation."""
    rel = typed_edges(m.edges.select("src", "dst", "edge_type"), m.node_types).select(
        "src", "dst", "dst_type", F.concat_ws(":", "src_type", "edge_type", "dst_type").alias("relation"))
    return splits.exact_split(rel, ["src", "dst"], 0.85, ["relation"])


@section.add("w9_stratified_split", sql(["nodes"], f"""
SELECT node_id, CASE WHEN row_number() OVER (PARTITION BY default_12m ORDER BY {hash32('node_id', salt='split')}, node_id)
 <= floor(0.8 * count(*) OVER (PARTITION BY default_12m)) THEN 'train' ELSE 'test' END AS split FROM nodes"""))
def w9(m):
    return splits.exact_split(m.nodes.select("node_id", "default_12m"), ["node_id"], 0.8, ["default_12m"]).select("node_id", "split")


@section.add("w10_plain_split", sql(["node_keys"], f"""
SELECT node_id, CASE WHEN {hash32('node_id', salt='plain')} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM node_keys"""))
def w10(m):
    return splits.hash_split(m.node_types.select("node_id"), ["node_id"], salt="plain")


@section.add("w11_fold_assignment", sql(["node_keys"], f"""
SELECT node_id, CAST({hash32('node_id', salt='fold')} % 5 AS INTEGER) AS fold FROM node_keys"""))
def w11(m):
    return m.node_types.select("node_id", splits.fold_of([F.col("node_id")]).alias("fold"))


# ------------------------------------------------------------------ forecast baseline
cte("naive", ["series"], """
SELECT * FROM (SELECT port, date, lead(throughput_teu, 30) OVER o AS actual, lag(throughput_teu, 335) OVER o AS forecast
 FROM series WINDOW o AS (PARTITION BY port ORDER BY date)) WHERE actual IS NOT NULL AND forecast IS NOT NULL""")


@section.add("e7_a19_seasonal_naive_mape", sql(["naive"], """
SELECT port, round(mape, 6) AS mape, round(avg(mape) OVER (), 6) AS mean_mape FROM (
 SELECT port, 100 * avg(abs(actual - forecast) / greatest(abs(actual), 1.0)) AS mape FROM naive GROUP BY port)"""))
def e7(m):
    by_port = temporal.port_mape(temporal.seasonal_naive(m.series, VALUE), "actual", "forecast", floor=1.0)
    mean = by_port.agg(F.avg("mape")).scalar()
    return by_port.select("port", settle(F.col("mape")).alias("mape"), settle(mean).alias("mean_mape"))


@section.add("m8_f13_naive_quantile_forecast", sql(["naive"], """
SELECT port, prob, round(q, 6) AS residual_quantile FROM (
 SELECT port, unnest([0.1, 0.5, 0.9])::DOUBLE AS prob, unnest(quantile_cont(actual - forecast, [0.1, 0.5, 0.9])) AS q
 FROM naive GROUP BY port)"""))
def m8(m):
    from tradeweave.operators.cumulative import exact_quantiles
    r = temporal.seasonal_naive(m.series, VALUE).withColumn("residual", F.col("actual") - F.col("forecast"))
    q = exact_quantiles(r, "residual", [0.1, 0.5, 0.9], ["port"])
    return q.select("port", "prob", settle(F.col("quantile")).alias("residual_quantile"))


@section.add("f14_inverse_scaling", sql(["scaled"], """
SELECT port, round(max(abs(value_scaled * sd + mu - throughput_teu)), 6) AS max_gap FROM (
 SELECT *, avg(throughput_teu) OVER p AS mu, stddev_samp(throughput_teu) OVER p + 1e-8 AS sd FROM scaled
 WINDOW p AS (PARTITION BY port)) GROUP BY port"""))
def f14(m):
    s = temporal.scaled_series(m.series, VALUE, EXOG)
    gap = F.abs(F.col("value_scaled") * F.col("sd") + F.col("mu") - F.col(VALUE))
    return s.groupBy("port").agg(settle(F.max(gap)).alias("max_gap"))
