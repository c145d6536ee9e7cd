"""Join patterns: checked lookups, typed edges, role lookups, interval matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.functions.vectors import vector_mean, vector_norm


def missing_keys(requests: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return requests.select(key).distinct().join(known, key, "left_anti")


def checked_lookup(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Point lookup of requested keys; raises when any is unknown (one bounded probe, not a collect)."""
    unknown = missing_keys(requests, table.select(key), key).limit(5).collect()
    if unknown:
        raise ValueError(f"unknown {key}: {[r[0] for r in unknown]}")
    return table.join(requests.select(key).distinct(), key, "left_semi")


def typed_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the types of both ends; edges with an unknown end drop out."""
    types = nodes.select("node_id", "node_type")
    return (edges.join(types.select(F.col("node_id").alias("src"), F.col("node_type").alias("src_type")), "src")
            .join(types.select(F.col("node_id").alias("dst"), F.col("node_type").alias("dst_type")), "dst"))


def with_reverse(typed: DataFrame) -> DataFrame:
    """Forward edges plus `rev_` twins, so risk can travel both ways."""
    cols = ["src", "dst", "src_type", "edge_type", "dst_type"]
    rest = [c for c in typed.columns if c not in cols]
    back = typed.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("dst_type").alias("src_type"),
                        F.concat(F.lit("rev_"), "edge_type").alias("edge_type"), F.col("src_type").alias("dst_type"), *rest)
    return typed.select(*cols, *rest).unionByName(back)


def role_vectors(facts: DataFrame, vectors: DataFrame, roles: Sequence[tuple[str, str]]) -> DataFrame:
    """Mean and norm of the vector behind each role's id; a missing vector counts as zeros.

    The two numbers per entity are computed before the join, so the wide vectors are never shuffled.
    """
    stats = vectors.select("node_id", vector_mean(F.col("vec")).alias("m"), vector_norm(F.col("vec")).alias("n"))
    for id_col, prefix in roles:
        look = stats.select(F.col("node_id").alias(id_col), F.col("m").alias(f"{prefix}_emb_mean"),
                            F.col("n").alias(f"{prefix}_emb_norm"))
        facts = facts.join(look, id_col, "left").fillna(0.0, [f"{prefix}_emb_mean", f"{prefix}_emb_norm"])
    return facts


def observed_in_window(claims: DataFrame, observations: DataFrame, days: int) -> DataFrame:
    """claims(asset, start_day, claimed) x observations(asset, obs_day, observed): total observed in
    [start_day, start_day + days].

    A sweep over each asset's days: a start marks the running total before its first day, an end the one after its last,
    and the difference is what was observed between them. Both sides are summed by day first, so a hot asset costs at most
    its calendar, and a longer window costs no more than a short one. Totals of decimals or whole numbers are exact.
    Rows without an asset or a day match nothing; a claim without them stays, with nothing observed.
    """
    per_day = observations.filter("asset IS NOT NULL AND obs_day IS NOT NULL").groupBy("asset", "obs_day").agg(
        F.sum("observed").alias("observed"))
    claimed = claims.groupBy("asset", "start_day").agg(F.sum("claimed").alias("claimed"), F.count(F.lit(1)).alias("n_claims"))
    nothing = F.lit(None).cast(per_day.schema["observed"].dataType)
    money = claimed.schema["claimed"].dataType
    marks = claimed.select("asset", "start_day", "claimed", "n_claims", F.explode(F.array(
        F.struct(F.col("start_day").alias("day"), F.lit(0).alias("step"), F.lit(-1).alias("sign")),
        F.struct(F.date_add("start_day", days).alias("day"), F.lit(2).alias("step"), F.lit(1).alias("sign")))).alias("m"))
    events = marks.select("asset", "start_day", "claimed", "n_claims", "m.day", "m.step", "m.sign", nothing.alias("observed"))
    events = events.unionByName(per_day.select(
        "asset", F.lit(None).cast("date").alias("start_day"), F.lit(None).cast(money).alias("claimed"),
        F.lit(None).cast("long").alias("n_claims"), F.col("obs_day").alias("day"), F.lit(1).alias("step"), F.lit(0).alias("sign"),
        "observed"))
    order = Window.partitionBy("asset").orderBy("day", "step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("total", F.coalesce(F.sum("observed").over(order), F.lit(0))).filter("step != 1")
    return swept.groupBy("asset", "start_day").agg(
        F.max("claimed").alias("claimed"), F.max("n_claims").alias("n_claims"), F.sum(F.col("sign") * F.col("total")).alias("observed"))
