"""What letters and shipment heads move and write: less than before, with the same results."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from tradeweave.operators import lc_features, learning, shipment_heads
from tradeweave.plans import aggregates
from tradeweave.plans import contract as queries
from tradeweave.plans import learning as plans
from tradeweave.sources import contract as C
from tradeweave.sources import mart as marts
from tradeweave.sources.mart import Mart


def same(a, b) -> bool:
    return a.count() == b.count() and a.exceptAll(b).isEmpty()


def exchanges(df) -> int:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("simple")
    return text.getvalue().split("Subqueries")[0].count("Exchange hashpartitioning")


def test_letters_alone_need_no_entity_table(spark, mart, monkeypatch):
    monkeypatch.setattr(marts, "_STAGED", {})
    out = queries.QUERIES["table_lc_transactions"](spark, mart.folder)
    fresh = Mart(spark, mart.folder)
    assert fresh.at_hand("lc") and not fresh.at_hand("nodes") and not fresh.at_hand("joined_lines")
    assert same(out, C.lc_transactions(fresh, fresh.nodes, fresh.series).select(*queries.LC_COLUMNS))


def test_gathered_tokens_are_pooled_where_they_lie(spark):
    u = lambda i: (F.abs(F.xxhash64("id", F.lit(i))) % 1000) / 1000.0
    rows = spark.range(400).select(F.concat(F.lit("s"), (F.col("id") % 350).cast("string")).alias("shipment_id"),
                                   *[u(i).alias(c) for i, c in enumerate(lc_features.TOKEN_SOURCES)])
    rows = rows.withColumn("cargo_value_usd", 100 * F.col("cargo_value_usd"))
    apart = shipment_heads.pooled_tokens(lc_features.event_tokens(rows))
    gathered = shipment_heads.pooled_tokens(lc_features.event_tokens(rows, gathered=True))
    rounded = lambda df: df.select("shipment_id", *[F.round(c, 9).alias(c) for c in shipment_heads.POOLED])
    assert same(rounded(apart), rounded(gathered))
    assert exchanges(apart) == exchanges(gathered) == 1
    plan = gathered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RepartitionByExpression")  # tokens are made after the move


def test_shipments_of_the_heads_are_made_once(spark, mart, monkeypatch):
    monkeypatch.setattr(marts, "_STAGED", {})
    made, real = [], C.shipments
    monkeypatch.setattr(C, "shipments", lambda *a: made.append(1) or real(*a))
    fresh = Mart(spark, mart.folder)
    scores = plans.shipment_scores(fresh)
    assert len(made) == 1 and scores.count() == 4 * fresh.lineitem.count()
    assert scores.filter("p IS NULL OR split IS NULL").isEmpty()


def test_search_lays_its_rows_out_twice_only(spark, monkeypatch):
    u = lambda i: (F.abs(F.xxhash64("id", F.lit(i))) % 1000) / 1000.0
    df = spark.range(300).select("id", u(1).alias("a"), u(2).alias("b")).withColumn("y", (F.col("a") + 0.3 * F.col("b") > 0.7).cast("int"))
    moved, real = [], type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, *a: moved.append(a) or real(self, *a))
    ranges = {**learning.SEARCH_RANGES, "maxIter": (2, 3, "whole"), "maxDepth": (2, 2, "whole")}
    _, trials = learning.search_default_classifier(df, "id", ["a", "b"], "y", n_points=3, ranges=ranges, first_rounds=2)
    assert len(trials) == 4 and len(moved) == 2
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_exposure_needs_no_edges_but_flows(spark, mart, monkeypatch):
    monkeypatch.setattr(marts, "_STAGED", {})
    fresh = Mart(spark, mart.folder)
    out = aggregates.g15(fresh)
    assert fresh.at_hand("flows") and not fresh.at_hand("edges")
    flows, edges = fresh.flows, fresh.edges
    assert same(flows, edges.filter("edge_type = 'material_flow'").select(*flows.columns)) and same(fresh.flows, flows)
    assert same(out, aggregates.g15(fresh))
