"""Invariants of the derived tables."""

import pytest
from pyspark.sql import functions as F

from tradeweave.operators import joins
from tradeweave.sources import contract as C


def test_all_types_present(mart):
    assert {r[0] for r in mart.nodes.select("node_type").distinct().collect()} == set(C.NODE_TYPES)
    assert {r[0] for r in mart.edges.select("edge_type").distinct().collect()} == set(C.EDGE_TYPES)


def test_node_ids_are_unique_and_match_the_type_list(mart):
    n = mart.nodes.count()
    assert n == mart.nodes.select("node_id").distinct().count()
    both = mart.nodes.select("node_id", "node_type")
    assert both.exceptAll(mart.node_types).isEmpty() and mart.node_types.exceptAll(both).isEmpty()


def test_survival_fields(mart):
    bad = mart.nodes.filter(~((F.col("survival_duration_days") > 0) & (F.col("survival_duration_days") <= 730)
                              & F.col("survival_event").isin(0, 1)))
    assert bad.isEmpty()


def test_series_has_no_gaps(mart):
    row = mart.series.groupBy("port").agg(F.count(F.lit(1)).alias("n"), (F.date_diff(F.max("date"), F.min("date")) + 1).alias("d"))
    assert row.filter("n <> d").isEmpty()


def test_shipments_keep_every_line_and_labels_are_binary(mart):
    s = mart.shipments
    assert s.count() == mart.lineitem.count()
    assert s.filter((F.col("delay_days") < 0) | ~F.col("delayed").isin(0, 1) | ~F.col("damaged").isin(0, 1)).isEmpty()


def test_one_letter_of_credit_per_order(mart):
    assert mart.lc.count() == mart.orders.count() == mart.lc.select("lc_id").distinct().count()


def test_ccc_change_is_the_component_sum(mart):
    gap = F.abs(F.col("ccc_change") - (F.col("dio_change") + F.col("dso_change") - F.col("dpo_change")))
    assert mart.shocks.filter(gap > 1e-5).isEmpty()


def test_checked_lookup_rejects_unknown_ids(spark, mart):
    asked = spark.createDataFrame([("SUPP_00000001",), ("SUPP_NOPE",)], "node_id string")
    with pytest.raises(ValueError, match="SUPP_NOPE"):
        joins.checked_lookup(asked, mart.nodes, "node_id")


def test_results_do_not_depend_on_partitioning(spark, mart):
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in (1, 4, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        seen.append(C.entity_nodes(mart).agg(F.sum(F.xxhash64(*C.NODE_COLUMNS).cast("decimal(38,0)"))).first()[0])
    spark.conf.set("spark.sql.shuffle.partitions", keep)
    assert len(set(seen)) == 1


def test_flow_pairs_carry_their_value_alone(mart, monkeypatch):
    asked, grouping = [], C.grouping_pass
    monkeypatch.setattr(C, "grouping_pass", lambda lines, sets, measures: asked.append((sets, measures)) or grouping(lines, sets, measures))
    profile = C.entity_profile(mart)
    assert all(len(measures) == 1 for sets, measures in asked if any(len(s) == 2 for s in sets))
    both = mart.nodes.filter("node_type = 'manufacturer'").join(profile.select("node_id", F.col("supplier_concentration_hhi").alias("again")), "node_id")
    assert both.count() and both.filter(F.col("again") != F.col("supplier_concentration_hhi")).isEmpty()
