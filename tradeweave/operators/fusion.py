"""Finance and fusion features: SC-PD, stress indices, covenants, scenario stress, portfolio measures, attributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions.scalar import clip, ratio, settle

# Weights of the SC-PD formula and its reference points.
SC_PD_WEIGHTS = {"otif": 0.3, "inventory": 0.2, "network": 0.15}
OTIF_TARGET, OTIF_SPAN = 0.95, 0.20
TURNOVER_TARGET = 6.0

# Score bands (low, high, level, badge); the last band includes its upper end.
TIERS = [(0, 400, "Novice", "Bronze"), (400, 600, "Practitioner", "Silver"), (600, 750, "Advanced", "Gold"),
         (750, 900, "Expert", "Platinum"), (900, 1000, "Master", "Diamond")]

# Scenario shocks (OTIF loss, turnover loss share, congestion, freight, currency, weather).
SCENARIOS = [
    ("port_strike", 0.08, 0.10, 0.50, 0.20, 0.05, 0.00),
    ("canal_closure", 0.10, 0.15, 0.60, 0.50, 0.05, 0.00),
    ("typhoon", 0.06, 0.05, 0.40, 0.10, 0.00, 0.60),
    ("pandemic_wave", 0.15, 0.25, 0.50, 0.40, 0.10, 0.00),
    ("fuel_spike", 0.02, 0.02, 0.05, 0.60, 0.10, 0.00),
    ("tariff_shock", 0.03, 0.12, 0.10, 0.20, 0.25, 0.00),
    ("currency_crisis", 0.04, 0.08, 0.05, 0.10, 0.70, 0.00),
    ("supplier_failure", 0.20, 0.20, 0.10, 0.10, 0.00, 0.00),
    ("cyber_attack", 0.12, 0.10, 0.30, 0.05, 0.00, 0.00),
    ("regional_flood", 0.09, 0.12, 0.30, 0.20, 0.05, 0.50),
]


def cash_conversion_cycle(dio: Column, dso: Column, dpo: Column) -> Column:
    return dio + dso - dpo


def supply_chain_adjusted_pd(pd: Column, otif: Column, turnover: Column, alternatives: Column) -> Column:
    """PD * (1 + .3 OTIF shortfall + .2 turnover shortfall + .15 / alternative suppliers), within [0, 1]."""
    otif_gap = F.greatest(F.lit(0.0), (F.lit(OTIF_TARGET) - otif) / OTIF_SPAN)
    inventory_gap = F.greatest(F.lit(0.0), (F.lit(TURNOVER_TARGET) - turnover) / TURNOVER_TARGET)
    network_gap = 1.0 / F.greatest(alternatives, F.lit(1.0))
    w = SC_PD_WEIGHTS
    return clip(pd * (1.0 + w["otif"] * otif_gap + w["inventory"] * inventory_gap + w["network"] * network_gap), 0.0, 1.0)


def alternative_suppliers(hhi: Column) -> Column:
    return F.least(ratio(F.lit(1.0), hhi), F.lit(8.0))


def working_capital_velocity(dio: Column, dso: Column, dpo: Column) -> Column:
    """Odd in its arguments; meant for z-scored component changes."""
    return (dio + dso - dpo) / 3.0


def trade_route_stress(congestion: Column, freight: Column, currency: Column, weather: Column,
                       weights=(0.25, 0.25, 0.25, 0.25)) -> Column:
    parts = [F.lit(w) * x for w, x in zip(weights, (congestion, freight, currency, weather))]
    return clip(parts[0] + parts[1] + parts[2] + parts[3], 0.0, 1.0)


def covenant_alert(current: Column, change: Column, limit: Column) -> dict[str, Column]:
    predicted = current + change
    return {"predicted_ccc_days": F.round(predicted, 1), "covenant_threshold_days": limit,
            "breach_predicted": predicted > limit, "margin_days": F.round(limit - predicted, 1)}


def tier_of(score: Column, field: str) -> Column:
    """Band lookup in a constant table kept inside the expression: no join."""
    bands = F.array(*[F.struct(F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"), F.lit(level).alias("level"),
                               F.lit(badge).alias("badge")) for lo, hi, level, badge in TIERS])
    top = float(TIERS[-1][1])
    inside = F.filter(bands, lambda b: (score >= b["lo"]) & ((score < b["hi"]) | ((b["hi"] == top) & (score == top))))
    return F.get(inside, F.lit(0))[field]


def scenario_stress(entities: DataFrame, pd: str) -> DataFrame:
    """Every entity under every scenario. The ten scenarios are an array in the plan, exploded per entity row."""
    shocks = F.array(*[F.struct(F.lit(s[0]).alias("scenario"), *[F.lit(v).alias(n) for n, v in zip(
        ("otif_loss", "turnover_loss", "congestion", "freight", "currency", "weather"), s[1:])]) for s in SCENARIOS])
    rows = entities.withColumn("s", F.explode(shocks))
    alternatives = alternative_suppliers(F.col("supplier_concentration_hhi"))
    base = supply_chain_adjusted_pd(F.col(pd), F.col("otif_rate"), F.col("inventory_turnover"), alternatives)
    hit = supply_chain_adjusted_pd(
        F.col(pd), F.greatest(F.col("otif_rate") - F.col("s.otif_loss"), F.lit(0.0)),
        F.col("inventory_turnover") * (1.0 - F.col("s.turnover_loss")), alternatives)
    stress = trade_route_stress(F.col("s.congestion"), F.col("s.freight"), F.col("s.currency"), F.greatest(
        F.col("s.weather"), F.col("natural_disaster_exposure")))
    return rows.select("node_id", F.col("s.scenario").alias("scenario"), base.alias("base_sc_pd"),
                       hit.alias("stressed_sc_pd"), (hit - base).alias("delta_sc_pd"), stress.alias("route_stress"))


def portfolio_kpis(lc: DataFrame, by: str) -> DataFrame:
    """Yield = fees / amount, NPL = defaulted amount / amount, participation, discount revenue."""
    amount, bad = F.col("lc_amount_usd"), F.col("is_default")
    fee = amount * (0.005 + 0.02 * F.col("default_probability_true")) * F.col("tenor_days") / 360.0
    everyone = lc.agg(F.countDistinct("applicant_id")).scalar()
    out = lc.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_lc"), F.sum(bad.cast("bigint")).alias("n_default"),
        settle(ratio(F.sum(fee), F.sum(amount))).alias("realised_yield"),
        settle(ratio(F.sum(amount * bad), F.sum(amount))).alias("npl_ratio"),
        F.countDistinct("applicant_id").alias("_n"),
        F.round(F.sum(amount * 0.01 * F.when(F.col("tenor_days") >= 90, 1.0).otherwise(0.0)), 2).alias("discount_revenue"))
    return out.withColumn("participation_rate", settle(ratio(F.col("_n"), everyone))).drop("_n")


def top_contributions(df: DataFrame, key: str, card, n: int) -> DataFrame:
    """Additive attributions of a linear score, the n largest per row. Sorted inside the row: no shuffle, no window."""
    intercept, terms = card
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c, _, _ in terms]).alias("m")).scalar()
    rows = df.withColumn("_m", means)
    base = F.lit(intercept)
    for c, w, centre in terms:
        base = base + F.lit(w) * (F.col("_m")[c] - F.lit(centre))
    parts = []
    for c, w, _ in terms:
        value = F.lit(w) * (F.col(c) - F.col("_m")[c])
        parts.append(F.struct((-F.abs(F.round(value, 9))).alias("order"), F.lit(c).alias("feature"), value.alias("contribution")))
    ranked = F.slice(F.array_sort(F.array(*parts)), 1, n)
    return rows.select(key, base.alias("base_value"), F.posexplode(ranked).alias("pos", "c")).select(
        key, "c.feature", "c.contribution", "base_value", (F.col("pos") + 1).cast("bigint").alias("rank"))
