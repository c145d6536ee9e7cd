"""Worked values and properties of the finance formulas."""

import pytest
from pyspark.sql import functions as F

from tradeweave.functions.scalar import padded
from tradeweave.operators import fusion, metrics, scorecards


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def sc_pd(pd, otif, turnover, alternatives):
    return fusion.supply_chain_adjusted_pd(F.lit(pd), F.lit(otif), F.lit(turnover), F.lit(float(alternatives)))


def test_sc_pd_worked_value(spark):
    assert abs(one(spark, sc_pd(0.025, 0.85, 4.8, 1))[0] - 0.0333) < 0.001


def test_sc_pd_rises_when_otif_falls_and_stays_a_probability(spark):
    high, low, top = one(spark, sc_pd(0.02, 0.95, 6.0, 3), sc_pd(0.02, 0.70, 6.0, 3).alias("b"), sc_pd(0.99, 0.0, 0.1, 1).alias("c"))
    assert low > high and top == 1.0


def test_cash_conversion_cycle(spark):
    assert abs(one(spark, fusion.cash_conversion_cycle(F.lit(60.8), F.lit(50.0), F.lit(50.0)))[0] - 60.8) < 1e-6


def test_velocity_index_is_odd(spark):
    f = fusion.working_capital_velocity
    a, b = one(spark, f(F.lit(1.0), F.lit(1.0), F.lit(-1.0)), f(F.lit(-1.0), F.lit(-1.0), F.lit(1.0)).alias("b"))
    assert a == -b


def test_route_stress_is_bounded(spark):
    f = fusion.trade_route_stress
    mid, top = one(spark, f(F.lit(.5), F.lit(.3), F.lit(.2), F.lit(.1)), f(F.lit(2.), F.lit(2.), F.lit(2.), F.lit(2.)).alias("t"))
    assert 0 <= mid <= 1 and top == 1.0


def test_covenant_alerts(spark):
    hit = one(spark, *[c.alias(n) for n, c in fusion.covenant_alert(F.lit(72.0), F.lit(26.0), F.lit(90.0)).items()])
    calm = one(spark, *[c.alias(n) for n, c in fusion.covenant_alert(F.lit(50.0), F.lit(5.0), F.lit(90.0)).items()])
    edge = one(spark, *[c.alias(n) for n, c in fusion.covenant_alert(F.lit(60.0), F.lit(30.0), F.lit(90.0)).items()])
    assert hit.predicted_ccc_days == 98.0 and hit.breach_predicted and hit.margin_days == -8.0
    assert not calm.breach_predicted and not edge.breach_predicted


def test_tier_lookup_covers_the_whole_range(spark):
    rows = spark.createDataFrame([(0.0,), (399.9,), (400.0,), (791.0,), (1000.0,)], "s double").select(
        fusion.tier_of(F.col("s"), "level").alias("l"), fusion.tier_of(F.col("s"), "badge").alias("b")).collect()
    assert [r.l for r in rows] == ["Novice", "Novice", "Practitioner", "Expert", "Master"]
    assert rows[3].b == "Platinum"


def test_component_response_direction(spark):
    row = spark.range(1).select(
        F.lit(-0.12).alias("delta_otif"), F.lit(4.2).alias("delta_lead_time_std"), F.lit(0.0).alias("delta_freight_cost_ratio"),
        F.lit(2.1).alias("delta_port_congestion"), F.lit(0.0).alias("delta_inventory_turnover")).withColumns(
        scorecards.component_response()).first()
    assert abs(row.dio_change - 18.36) < 1e-9 and abs(row.dso_change - 10.08) < 1e-9 and row.dpo_change == 0.0


def test_pinball_is_zero_on_a_perfect_forecast(spark):
    assert one(spark, metrics.pinball(F.lit(3.0), F.lit(3.0), F.lit(0.9)))[0] == 0.0


def test_padding_keeps_long_numbers(spark):
    assert one(spark, padded(F.lit(7), 4), padded(F.lit(123456789), 4).alias("b"), padded(F.lit(None).cast("int"), 4).alias("c")) == (
        "0007", "123456789", None)


def test_top_contributions_add_up(spark, mart):
    card = (scorecards.ENTITY_DEFAULT[0], scorecards.ENTITY_DEFAULT[1][:5])
    parts = fusion.top_contributions(mart.nodes, "node_id", card, 5).groupBy("node_id").agg(
        (F.sum("contribution") + F.max("base_value")).alias("z"))
    gap = parts.join(mart.nodes.select("node_id", scorecards.linear(card).alias("want")), "node_id").agg(
        F.max(F.abs(F.col("z") - F.col("want")))).first()[0]
    assert gap < 1e-9
