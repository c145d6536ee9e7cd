"""The six contract tables, derived from the input star schema.

Every measure is rounded where it is born (6 digits, money to cents), so thresholds, ties and groupings
downstream do not depend on the order in which doubles were summed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.functions.scalar import (
    brand_number, clip, days_from_turnover, entity_id, logistic, lookup, padded, ratio, settle, stable_hash)
from tradeweave.operators import scorecards
from tradeweave.session import stage
from tradeweave.sources.tables import Tables

# Node and edge types.
NODE_TYPES = ["supplier", "manufacturer", "logistics_provider", "port", "financial_institution", "customer"]
EDGE_TYPES = ["material_flow", "transportation", "financial", "ownership"]

# Tenor in days per order priority; commodity class per part type; transport modes.
TENOR_DAYS = {"1-URGENT": 30, "2-HIGH": 60, "3-MEDIUM": 90, "4-NOT SPECIFIED": 120, "5-LOW": 180}
COMMODITY_CLASS = {"ECONOMY": "Low", "STANDARD": "Low", "SMALL": "Low", "MEDIUM": "Medium",
                   "LARGE": "Medium", "PROMO": "High"}
MODES = ["ocean", "air", "rail", "road"]

OTIF_LIMIT_DAYS = 16.0
LEAD_SCALE = 100.0
SURVIVAL_HORIZON_DAYS = 730


# ------------------------------------------------------------------ country risk (a rule on the nation key)
def country_risk(key: Column) -> Column:
    return F.coalesce((F.lit(48) + (key * 7) % 41).cast("int"), F.lit(68))


def disaster_exposure(key: Column) -> Column:
    return F.coalesce(settle(F.lit(0.05) + F.lit(0.0125) * ((key * 5) % 29)), F.lit(0.2))


def geopolitical_risk(key: Column) -> Column:
    return F.coalesce(settle(F.lit(0.08) + F.lit(0.01) * ((key * 11) % 28)), F.lit(0.2))


# ------------------------------------------------------------------ line level
def trade_lines(t: Tables, orders=False, part=False, supplier=False, customer=False, region=False) -> DataFrame:
    """Order lines with only the dimensions a caller asks for; each join is a plain equi-join.

    No broadcast hints: the optimizer broadcasts a dimension only when its statistics are under the
    session's size threshold and shuffles otherwise; runtime skew splitting handles hot keys.
    """
    lines = t.lineitem.withColumn("ship_day", F.to_date("l_shipdate")).drop("l_shipdate")
    if part:
        brands = t.part.select(F.col("p_partkey").alias("l_partkey"), brand_number(F.col("p_brand")).alias("brand_no"),
                               "p_type")
        lines = lines.join(brands, "l_partkey")
    if supplier:
        sup = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey", "s_acctbal")
        lines = lines.join(sup, "l_suppkey")
    if orders or customer or region:
        heads = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus",
                                F.to_date("o_orderdate").alias("order_day"))
        if customer or region:
            heads = heads.join(_customers(t, region), "o_custkey")
        lines = lines.join(heads, "l_orderkey").withColumn(
            "lead_days", F.abs(F.date_diff("ship_day", "order_day")) / F.lit(LEAD_SCALE))
    return lines


def _customers(t: Tables, region: bool) -> DataFrame:
    cust = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal")
    if region:
        cust = cust.join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey")
    return cust


# ------------------------------------------------------------------ one pass over the lines
def grouping_pass(lines: DataFrame, sets: list[tuple[str, ...]], measures: list[Column]) -> tuple[DataFrame, dict]:
    """Aggregate many key sets in one scan (grouping sets), instead of one scan and join chain per set.

    Returns the rows and the grouping id of each set. Partial aggregation runs before the only shuffle,
    so a key that holds a third of the lines arrives as one row per map task.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    # the grouping id has one bit per key column that is not in the set, first key highest
    bit = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    ids = {s: sum(b for k, b in bit.items() if k not in s) for s in sets}
    rows = lines.groupingSets([list(s) for s in sets], *keys).agg(F.grouping_id().alias("gid"), *measures)
    return rows, ids


# ------------------------------------------------------------------ nodes
ENTITY_KEYS = {"supplier": "l_suppkey", "manufacturer": "brand_no", "logistics_provider": "l_linenumber",
               "port": "s_nationkey", "financial_institution": "n_regionkey", "customer": "o_custkey"}
FLOW_PAIRS = [("supplier", "manufacturer"), ("manufacturer", "customer")]


def node_keys(t: Tables) -> DataFrame:
    """Entities listed in the dimension tables, also those that never traded (carriers only exist in lines)."""
    def ids(df: DataFrame, node_type: str, key: str, nation: str | None) -> DataFrame:
        nation = F.lit(None) if nation is None else F.col(nation)
        return df.select(entity_id(node_type, F.col(key)).alias("node_id"), F.lit(node_type).alias("node_type"),
                         nation.cast("int").alias("nation_key"))

    brands = t.part.select(brand_number(F.col("p_brand")).alias("brand_no")).distinct()
    keys = (
        ids(t.supplier, "supplier", "s_suppkey", "s_nationkey")
        .unionByName(ids(brands, "manufacturer", "brand_no", None))
        .unionByName(ids(t.nation, "port", "n_nationkey", "n_nationkey"))
        .unionByName(ids(t.region, "financial_institution", "r_regionkey", None))
        .unionByName(ids(t.customer, "customer", "c_custkey", "c_nationkey"))
    )
    names = t.nation.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("country"))
    return keys.join(names, "nation_key", "left")


def node_types(t: Tables) -> DataFrame:
    """node_id and node_type of every entity without a pass over the line measures (one column of the lines)."""
    carriers = t.lineitem.select("l_linenumber").distinct().select(
        entity_id("logistics_provider", F.col("l_linenumber")).alias("node_id"), F.lit("logistics_provider").alias("node_type"))
    return node_keys(t).select("node_id", "node_type").unionByName(carriers)


def joined_lines(t: Tables) -> DataFrame:
    """Lines with all dimensions, as the entity table and the edge table read them: a mart writes them once for both."""
    return trade_lines(t, orders=True, part=True, supplier=True, customer=True).select(
        "l_suppkey", "brand_no", "l_linenumber", "s_nationkey", "c_nationkey", "o_custkey", "l_extendedprice", "l_tax",
        "l_discount", "l_quantity", "l_returnflag", "l_linestatus", "o_orderstatus", "s_acctbal", "c_acctbal", "lead_days",
        "ship_day")


def entity_profile(t: Tables, lines: DataFrame | None = None, flows: bool = True) -> DataFrame:
    """Operating measures and flow concentration of every entity from `lines` (joined lines, written once if not given).

    Key sets: one per entity type with all measures, and the two material-flow pairs, nearly as many as lines, with their
    value alone. A pair row then feeds the squared value of its flow to both ends; the Herfindahl index is
    (sum v^2) / (sum v)^2, so no hub's list is collected. Without `flows` the pairs and the index are left out; lines that
    are not given are then read once and not written.
    """
    if lines is None:
        lines = stage(joined_lines(t)) if flows else joined_lines(t)
    lines = lines.join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey")
    late = F.col("lead_days") > OTIF_LIMIT_DAYS
    share = lambda cond: settle(F.avg(cond.cast("double")))
    measures = {
        "n_lines": F.count(F.lit(1)),
        "revenue": F.round(F.sum("l_extendedprice"), 2),
        "supplier_balance": settle(F.avg("s_acctbal")),
        "customer_balance": settle(F.avg("c_acctbal")),
        "freight": F.round(F.sum(F.col("l_extendedprice") * F.col("l_tax")), 4),
        "discount": F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 4),
        "avg_quantity": settle(F.avg("l_quantity")),
        "otif_rate": share(~late),
        "lead_time_mean": settle(F.avg("lead_days")),
        "lead_time_std": settle(F.coalesce(F.stddev_samp("lead_days"), F.lit(0.0))),
        "return_rate": share(F.col("l_returnflag") == "R"),
        "fill_rate": share(F.col("l_linestatus") == "F"),
        "pending_rate": share(F.col("o_orderstatus") == "P"),
        "open_rate": share(F.col("o_orderstatus") == "O"),
        "first_day": F.min("ship_day"),
        "first_late_day": F.min(F.when(late, F.col("ship_day"))),
    }
    singles = {(k,): node_type for node_type, k in ENTITY_KEYS.items()}
    pairs = {(ENTITY_KEYS[a], ENTITY_KEYS[b]): (a, b) for a, b in FLOW_PAIRS}
    value = F.col("revenue")

    def part(node_type: str, key: str, own: bool, inflow: bool, outflow: bool) -> Column:
        flag = lambda on, v: (v if on else F.lit(0.0))
        return F.struct(entity_id(node_type, F.col(key)).alias("node_id"), F.lit(own).alias("own"),
                        flag(inflow, value * value).alias("in2"), flag(inflow, value).alias("in1"),
                        flag(outflow, value * value).alias("out2"), flag(outflow, value).alias("out1"))

    def spread_of(sets: dict[tuple, object], kept: dict[str, Column]) -> DataFrame:
        rows, gid = grouping_pass(lines, list(sets), [m.alias(n) for n, m in kept.items()])
        parts = None
        for keyset, types in sets.items():
            if isinstance(types, str):
                made = F.array(part(types, keyset[0], True, False, False))
            else:
                made = F.array(part(types[0], keyset[0], False, False, True), part(types[1], keyset[1], False, True, False))
            hit = F.col("gid") == gid[keyset]
            parts = F.when(hit, made) if parts is None else parts.when(hit, made)
        return rows.select(F.explode(parts).alias("e"), *kept).select("e.*", *kept)

    spread = spread_of(singles, measures)
    if not flows:
        return spread.groupBy("node_id").agg(*[F.max(m).alias(m) for m in measures])
    spread = spread.unionByName(
        spread_of(pairs, {"revenue": measures["revenue"]}), allowMissingColumns=True)
    return spread.groupBy("node_id").agg(
        *[F.max(F.when(F.col("own"), F.col(m))).alias(m) for m in measures],
        settle(ratio(F.sum("in2"), F.sum("in1") * F.sum("in1"))).alias("supplier_concentration_hhi"),
        settle(ratio(F.sum("out2"), F.sum("out1") * F.sum("out1"))).alias("customer_concentration_hhi"))


def entity_nodes(t: Tables, lines: DataFrame | None = None, flows: bool = True) -> DataFrame:
    """The nodes table without network position (see `operators.graph.with_network_position`).

    Without `flows` the two columns of flow concentration are left out.
    """
    m = node_keys(t).join(entity_profile(t, lines, flows), "node_id", "full")
    m = m.withColumn("node_type", F.coalesce("node_type", F.lit("logistics_provider")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    balance = F.when(F.col("node_type").isin("customer", "financial_institution"), zero("customer_balance")).otherwise(
        zero("supplier_balance"))
    m = m.withColumns({
        "country_risk_score": country_risk(F.col("nation_key")),
        "natural_disaster_exposure": disaster_exposure(F.col("nation_key")),
        "geopolitical_risk_score": geopolitical_risk(F.col("nation_key")),
        "current_ratio": settle(clip(1.0 + balance / 10000.0, 0.4, 4.0)),
        "debt_to_equity": settle(clip(1.6 * (1.0 - zero("fill_rate")), 0.05, 5.0)),
        "ebitda_margin": settle(clip(0.2 - F.coalesce(ratio(F.col("discount"), F.col("revenue")), F.lit(0.0)),
                                      -0.1, 0.4)),
        "revenue": zero("revenue"),
        "otif_rate": zero("otif_rate"),
        "lead_time_mean": zero("lead_time_mean"),
        "lead_time_std": zero("lead_time_std"),
        "inventory_turnover": settle(clip(6.5 * zero("avg_quantity") / 25.5, 1.0, 20.0)),
        "fill_rate": zero("fill_rate"),
        "dso": settle(clip(30.0 + 54.0 * zero("pending_rate"), 5.0, 150.0)),
        "dpo": settle(clip(30.0 + 45.0 * zero("open_rate"), 5.0, 150.0)),
        "capacity_utilisation": settle(clip(zero("avg_quantity") / 34.0, 0.2, 0.99)),
        "reliability_score": settle(1.0 - zero("return_rate")),
        "freight_cost_ratio": settle(F.coalesce(ratio(F.col("freight"), F.col("revenue")), F.lit(0.0))),
        **({c: F.coalesce(c, F.lit(1.0)) for c in FLOW_COLUMNS} if flows else {}),
    })
    lag = F.date_diff("first_late_day", "first_day") + 1
    excess = (zero("return_rate") - F.lit(0.3333)) * F.sqrt(F.coalesce(F.col("n_lines"), F.lit(0)).cast("double"))
    m = m.withColumns({
        "interest_coverage": settle(clip(F.col("ebitda_margin") / F.greatest(0.05 * F.col("debt_to_equity"),
                                                                              F.lit(0.001)), 0.2, 25.0)),
        "dio": settle(clip(days_from_turnover(F.col("inventory_turnover")), 5.0, 200.0)),
        "survival_event": (F.coalesce(lag, F.lit(SURVIVAL_HORIZON_DAYS + 1)) <= SURVIVAL_HORIZON_DAYS).cast("int"),
        "survival_duration_days": F.least(F.coalesce(lag, F.lit(SURVIVAL_HORIZON_DAYS)),
                                          F.lit(SURVIVAL_HORIZON_DAYS)).cast("double"),
        "default_12m": (excess > 0.6).cast("int"),
    })
    m = m.withColumn("ccc_days", settle(F.col("dio") + F.col("dso") - F.col("dpo")))
    return m.select(*[c for c in NODE_COLUMNS if flows or c not in FLOW_COLUMNS])


FLOW_COLUMNS = ["supplier_concentration_hhi", "customer_concentration_hhi"]
NODE_COLUMNS = [
    "node_id", "node_type", "country", "country_risk_score", "natural_disaster_exposure", "geopolitical_risk_score",
    "current_ratio", "debt_to_equity", "ebitda_margin", "interest_coverage", "revenue", "otif_rate", "lead_time_mean",
    "lead_time_std", "inventory_turnover", "fill_rate", "dio", "dso", "dpo", "ccc_days", "supplier_concentration_hhi",
    "customer_concentration_hhi", "capacity_utilisation", "reliability_score", "freight_cost_ratio", "default_12m",
    "survival_duration_days", "survival_event"]


# ------------------------------------------------------------------ edges
EDGE_SCHEMA = {"volume": "double", "value": "double", "mode": "string", "transit_time_days": "double",
               "cost": "double", "payment_terms_days": "double", "outstanding_balance": "double"}


def _flow_and_transport(t: Tables, flows: bool, transport: bool, lines: DataFrame | None = None) -> DataFrame:
    """Material-flow and transportation edges from one pass over the lines (joined lines, if given)."""
    legs: dict[tuple, tuple] = {}
    if flows:
        legs[("l_suppkey", "brand_no")] = ("supplier", "manufacturer", "material_flow")
        legs[("brand_no", "o_custkey")] = ("manufacturer", "customer", "material_flow")
    if transport:
        legs[("l_suppkey", "s_nationkey")] = ("supplier", "port", "transportation")
        legs[("brand_no", "c_nationkey")] = ("manufacturer", "port", "transportation")
        legs[("c_nationkey", "o_custkey")] = ("port", "customer", "transportation")
        legs[("l_linenumber", "brand_no")] = ("logistics_provider", "manufacturer", "transportation")
    if lines is None:
        lines = trade_lines(t, part=True, orders=True, supplier=transport, customer=transport)
    measures = {"volume": F.sum("l_quantity"), "value": F.round(F.sum("l_extendedprice"), 2)}
    if transport:
        measures |= {"transit_time_days": settle(F.avg("lead_days")),
                     "cost": F.round(F.sum(F.col("l_extendedprice") * F.col("l_tax")), 4)}
    rows, gid = grouping_pass(lines, list(legs), [m.alias(n) for n, m in measures.items()])
    ends = None
    for (a, b), (src_type, dst_type, kind) in legs.items():
        made = F.struct(entity_id(src_type, F.col(a)).alias("src"), entity_id(dst_type, F.col(b)).alias("dst"),
                        F.lit(kind).alias("edge_type"))
        hit = F.col("gid") == gid[(a, b)]
        ends = F.when(hit, made) if ends is None else ends.when(hit, made)
    out = rows.select(ends.alias("e"), *measures).select("e.*", *measures)
    if not transport:
        return out
    is_flow = F.col("edge_type") == "material_flow"
    pick = stable_hash(F.col("src"), F.col("dst")) % len(MODES)
    return out.withColumns({
        "mode": F.when(~is_flow, lookup(pick, dict(enumerate(MODES)))),
        **{c: F.when(is_flow, F.col(c)) for c in ("volume", "value")},
        **{c: F.when(~is_flow, F.col(c)) for c in ("transit_time_days", "cost")},
    })


def material_flow(t: Tables) -> DataFrame:
    return _flow_and_transport(t, flows=True, transport=False)


def known_flows(t: Tables) -> DataFrame:
    """The material-flow edges of `all_edges` with their value alone: lines of known parties, without the other families."""
    lines = trade_lines(t, orders=True, part=True, supplier=True, customer=True)
    return _flow_and_transport(t, flows=True, transport=False, lines=lines).select("src", "dst", "edge_type", "value")


def transportation(t: Tables) -> DataFrame:
    return _flow_and_transport(t, flows=False, transport=True).drop("volume", "value")


def financial(t: Tables) -> DataFrame:
    heads = t.orders.join(_customers(t, region=True), "o_custkey")
    tenor = lookup(F.col("o_orderpriority"), TENOR_DAYS, 90)
    grouped = heads.groupBy("n_regionkey", "o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("value"),
        settle(F.avg(tenor)).alias("payment_terms_days"),
        F.round(F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).otherwise(0.0)), 2)
        .alias("outstanding_balance"))
    return grouped.select(
        entity_id("financial_institution", F.col("n_regionkey")).alias("src"),
        entity_id("customer", F.col("o_custkey")).alias("dst"), F.lit("financial").alias("edge_type"),
        "value", "payment_terms_days", "outstanding_balance")


def ownership(flows: DataFrame) -> DataFrame:
    """Parent of a supplier: the manufacturer that buys most from it (largest value, then largest id)."""
    upstream = flows.filter(F.col("src").startswith("SUPP_"))
    top = upstream.groupBy("src").agg(F.max(F.struct("value", "dst")).alias("top"))
    return top.select(F.col("top.dst").alias("src"), F.col("src").alias("dst"), F.lit("ownership").alias("edge_type"))


def all_edges(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Union of the edge families into one wide table; measures a family lacks are NULL. `lines`: joined lines, if at hand."""
    lines = stage(_flow_and_transport(t, flows=True, transport=True, lines=lines))
    flows = lines.filter(F.col("edge_type") == "material_flow")
    wide = (lines.unionByName(financial(t), allowMissingColumns=True)
            .unionByName(ownership(flows), allowMissingColumns=True))
    return wide.select("src", "dst", "edge_type", *[F.col(c).cast(ty).alias(c) for c, ty in EDGE_SCHEMA.items()])


def concentration(flows: DataFrame) -> DataFrame:
    """Herfindahl index of inflows (supplier side) and outflows (customer side) by value.

    The sum of squared shares is (sum v^2) / (sum v)^2, so one partial aggregation is enough: no window over
    a hub's whole neighbour list.
    """
    def side(key: str, name: str) -> DataFrame:
        return flows.groupBy(F.col(key).alias("node_id")).agg(
            settle(ratio(F.sum(F.col("value") * F.col("value")), F.sum("value") * F.sum("value"))).alias(name))
    return side("dst", "supplier_concentration_hhi").join(side("src", "customer_concentration_hhi"), "node_id", "full")


# ------------------------------------------------------------------ daily port series
def date_spine(bounds: DataFrame) -> Column:
    """One array of all days between the bounds, as a scalar subquery (a calendar: bounded)."""
    return bounds.select(F.sequence("first_day", "last_day").alias("days")).scalar()


def port_series(t: Tables) -> DataFrame:
    """Gap-free daily series per port: throughput, congestion, freight rate.

    Lines collapse to (supplier, day) before the supplier join and to (port, day) after it: a supplier that holds a
    third of the lines crosses the network as one row per map task and day, and every later window holds one row
    per calendar day.
    """
    by_supplier = t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("freight"))
    ports_of = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("port_key"))
    daily = by_supplier.join(ports_of, "l_suppkey").groupBy("port_key", "date").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("qty").alias("qty"), F.round(F.sum("freight"), 4).alias("freight"))
    span = t.lineitem.agg(F.to_date(F.min("l_shipdate")).alias("first_day"), F.to_date(F.max("l_shipdate")).alias("last_day"))
    ports = t.supplier.select(F.col("s_nationkey").alias("port_key")).distinct()
    spine = ports.select("port_key", F.explode(date_spine(span)).alias("date"))
    filled = spine.join(daily, ["port_key", "date"], "left").na.fill(0, ["n_lines"]).na.fill(0.0, ["qty", "freight"])
    trailing = Window.partitionBy("port_key").orderBy("date").rowsBetween(-29, 0)
    busy = F.avg("n_lines").over(trailing)
    return filled.select(
        "date", entity_id("port", F.col("port_key")).alias("port"),
        F.col("qty").alias("throughput_teu"),
        settle(clip(2.0 * F.coalesce(ratio(F.col("n_lines"), busy), F.lit(0.0)), 0.2, 5.0))
        .alias("port_congestion_index"),
        settle(F.coalesce(ratio(F.col("freight"), F.col("qty")), F.lit(0.0))).alias("freight_rate_usd_feu"))


# ------------------------------------------------------------------ shipments
def shipments(t: Tables, series: DataFrame | None = None) -> DataFrame:
    """One shipment per order line, with the congestion of both ports on the departure day."""
    lines = trade_lines(t, supplier=True, customer=True)
    planned = F.lit(12.0) + F.col("l_quantity") % 26.0
    base = lines.select(
        F.concat(F.lit("SHP_"), F.concat_ws("-", padded(F.col("l_orderkey"), 9), "l_linenumber", "l_partkey",
                                            "l_suppkey")).alias("shipment_id"),
        entity_id("port", F.col("s_nationkey")).alias("origin_port"),
        entity_id("port", F.col("c_nationkey")).alias("destination_port"),
        F.col("ship_day").alias("depart_date"), planned.alias("planned_transit_days"),
        settle(clip(1.2 - 4.0 * F.col("l_discount"), 0.6, 1.25)).alias("vessel_speed_ratio"),
        settle(clip(0.95 - F.col("l_tax"), 0.3, 0.999)).alias("carrier_reliability_score"),
        F.col("l_extendedprice").alias("cargo_value_usd"),
        settle(F.col("l_quantity") / 100.0).alias("weather_risk_score"),
        settle(F.greatest(F.lit(0.0), F.col("lead_days") - planned)).alias("delay_days"),
        ((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.08)).cast("int").alias("damaged"),
        ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O") & (F.col("l_discount") < 0.05)).cast("int")
        .alias("doc_discrepancy"))
    base = base.withColumn("delayed", (F.col("delay_days") > 0).cast("int"))
    series = stage(port_series(t)) if series is None else series
    for role in ("origin", "destination"):
        look = series.select(F.col("port").alias(f"{role}_port"), F.col("date").alias("depart_date"),
                             F.col("port_congestion_index").alias(f"{role}_congestion_index"))
        base = base.join(look, [f"{role}_port", "depart_date"], "left")
        base = base.withColumn(f"{role}_congestion_index", F.coalesce(f"{role}_congestion_index", F.lit(0.2)))
    delay = scorecards.delay_score()
    return base.withColumns({
        "delay_probability_true": settle(logistic(delay)),
        "shipment_risk_score": F.round(scorecards.shipment_risk(), 1),
    })


# ------------------------------------------------------------------ letters of credit
def _orders_with_largest_line(t: Tables) -> DataFrame:
    largest = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.struct("l_extendedprice", "l_suppkey", "l_partkey")).alias("top"))
    largest = largest.select("o_orderkey", F.col("top.l_suppkey").alias("s_suppkey"), F.col("top.l_partkey").alias("p_partkey"))
    return (t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
            .join(largest, "o_orderkey", "left"))


def lc_parties(t: Tables) -> DataFrame:
    """The distinct (applicant_id, beneficiary_id) of all letters of credit, without their other columns."""
    pairs = _orders_with_largest_line(t).select("o_custkey", "s_suppkey").distinct()
    return pairs.select(entity_id("customer", F.col("o_custkey")).alias("applicant_id"),
                        entity_id("supplier", F.col("s_suppkey")).alias("beneficiary_id"))


def lc_transactions(t: Tables, nodes: DataFrame | None = None, series: DataFrame | None = None) -> DataFrame:
    """One letter of credit per order: applicant = customer, beneficiary = supplier of its largest line."""
    # both tables are joined once per role: computed once, not twice
    nodes = stage(entity_nodes(t)) if nodes is None else nodes
    conditions = stage(port_conditions(port_series(t) if series is None else series))
    heads = (_orders_with_largest_line(t)
             .join(t.supplier.select("s_suppkey", "s_nationkey"), "s_suppkey", "left")
             .join(t.part.select("p_partkey", "p_type"), "p_partkey", "left"))
    base = heads.select(
        F.concat(F.lit("LC_"), padded(F.col("o_orderkey"), 9)).alias("lc_id"), F.to_date("o_orderdate").alias("issue_date"),
        entity_id("customer", F.col("o_custkey")).alias("applicant_id"),
        entity_id("supplier", F.col("s_suppkey")).alias("beneficiary_id"),
        entity_id("port", F.col("c_nationkey")).alias("dest_port"),
        entity_id("port", F.col("s_nationkey")).alias("orig_port"),
        F.col("o_totalprice").alias("lc_amount_usd"),
        lookup(F.col("o_orderpriority"), TENOR_DAYS, 90).alias("tenor_days"),
        F.coalesce(lookup(F.col("p_type"), COMMODITY_CLASS), F.lit("Medium")).alias("commodity_risk_category"),
        settle((geopolitical_risk(F.col("c_nationkey")) + geopolitical_risk(F.col("s_nationkey"))) / 2.0
                + disaster_exposure(F.col("s_nationkey"))).alias("trade_route_risk_score"),
        (F.col("o_orderstatus") == "P").cast("int").alias("is_default"))
    base = with_two_roles(base, nodes)
    for role, port in (("origin", "orig_port"), ("destination", "dest_port")):
        cols = [F.col("port").alias(port), F.col("date").alias("issue_date"),
                F.col("port_congestion_index").alias(f"port_congestion_{role}")]
        if role == "origin":
            cols += [F.col(c) for c in ("freight_rate_percentile", "seasonal_factor", "currency_volatility_30d")]
        base = base.join(conditions.select(*cols), [port, "issue_date"], "left")
    base = base.withColumns({
        "port_congestion_origin": F.coalesce("port_congestion_origin", F.lit(0.2)),
        "port_congestion_destination": F.coalesce("port_congestion_destination", F.lit(0.2)),
        "freight_rate_percentile": F.coalesce("freight_rate_percentile", F.lit(0.5)),
        "seasonal_factor": F.coalesce("seasonal_factor", F.lit(1.0)),
        "currency_volatility_30d": F.coalesce("currency_volatility_30d", F.lit(0.05)),
    })
    return base.withColumn("default_probability_true", settle(scorecards.lc_default_probability()))


def with_two_roles(lc: DataFrame, nodes: DataFrame) -> DataFrame:
    """Entity attributes of both parties: the same entity table joined once per role."""
    applicant = nodes.select(
        F.col("node_id").alias("applicant_id"), F.col("country").alias("applicant_country"),
        F.col("debt_to_equity").alias("applicant_leverage"), F.col("current_ratio").alias("applicant_current_ratio"),
        settle(1.0 - F.col("reliability_score")).alias("historical_discrepancy_rate_applicant"),
        F.col("country_risk_score").alias("_a_risk"))
    beneficiary = nodes.select(
        F.col("node_id").alias("beneficiary_id"), F.col("country").alias("beneficiary_country"),
        F.col("otif_rate").alias("beneficiary_otif_rate"),
        settle(1.0 - F.col("reliability_score")).alias("historical_discrepancy_rate_beneficiary"),
        F.col("country_risk_score").alias("_b_risk"))
    joined = lc.join(applicant, "applicant_id", "left").join(beneficiary, "beneficiary_id", "left")
    return joined.withColumns({
        "beneficiary_otif_rate": F.coalesce("beneficiary_otif_rate", F.lit(0.9)),
        "historical_discrepancy_rate_beneficiary": F.coalesce("historical_discrepancy_rate_beneficiary", F.lit(0.0)),
        "country_risk_differential": (F.col("_a_risk") - F.coalesce(F.col("_b_risk"), F.col("_a_risk"))).cast("double"),
    }).drop("_a_risk", "_b_risk")


def port_conditions(series: DataFrame) -> DataFrame:
    """Market conditions per port and day; each window holds one port's calendar."""
    port = Window.partitionBy("port")
    month = port.orderBy("date").rowsBetween(-29, 0)
    rate, flow = F.col("freight_rate_usd_feu"), F.col("throughput_teu")
    spread = ratio(F.coalesce(F.stddev_samp(rate).over(month), F.lit(0.0)), F.avg(rate).over(month))
    season = ratio(F.avg(flow).over(month), F.avg(flow).over(port))
    return series.select(
        "port", "date", "port_congestion_index",
        settle(F.percent_rank().over(port.orderBy("freight_rate_usd_feu"))).alias("freight_rate_percentile"),
        settle(clip(F.coalesce(season, F.lit(1.0)), 0.7, 1.5)).alias("seasonal_factor"),
        settle(clip(0.1 * F.coalesce(spread, F.lit(0.0)), 0.01, 0.4)).alias("currency_volatility_30d"))


# ------------------------------------------------------------------ monthly working-capital deltas
def working_capital_shocks(t: Tables) -> DataFrame:
    """Month-over-month changes of operating signals per port region, with the response of each CCC part."""
    lines = trade_lines(t, orders=True, supplier=True)
    monthly = lines.groupBy("s_nationkey", F.trunc("ship_day", "month").alias("month")).agg(
        settle(F.avg(F.when(F.col("lead_days") > OTIF_LIMIT_DAYS, 0.0).otherwise(1.0))).alias("otif"),
        settle(F.coalesce(F.stddev_samp("lead_days"), F.lit(0.0))).alias("lead_std"),
        settle(F.coalesce(ratio(F.sum(F.col("l_extendedprice") * F.col("l_tax")), F.sum("l_extendedprice")),
                           F.lit(0.0))).alias("freight_ratio"),
        settle(F.count(F.lit(1)) / 10.0).alias("congestion"),
        settle(6.5 * F.avg("l_quantity") / 25.5).alias("turnover"))
    w = Window.partitionBy("s_nationkey").orderBy("month")
    deltas = {"delta_otif": "otif", "delta_lead_time_std": "lead_std", "delta_freight_cost_ratio": "freight_ratio",
              "delta_port_congestion": "congestion", "delta_inventory_turnover": "turnover"}
    moved = monthly.select(
        entity_id("port", F.col("s_nationkey")).alias("port"), "month",
        *[settle(F.col(c) - F.lag(c).over(w)).alias(d) for d, c in deltas.items()]).filter(F.col("delta_otif").isNotNull())
    scaled = scorecards.horizon_rows(moved, list(deltas))
    parts = scorecards.component_response()
    out = scaled.withColumns({k: settle(v) for k, v in parts.items()})
    return out.withColumn("ccc_change", settle(F.col("dio_change") + F.col("dso_change") - F.col("dpo_change")))
