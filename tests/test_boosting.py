"""Models grown together against MLlib's fits of the same rows, one by one."""

from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeweave.operators import boosting, learning, splits
from tradeweave.session import concurrently, stage

COLUMNS = [f"f{i}" for i in range(7)]


def rows_of(spark, n):
    """Columns of one, few and many values, zeros and negative ones among them; label by two columns and noise."""
    u = lambda i: (F.abs(F.xxhash64("id", F.lit(i))) % 100_000) / 100_000.0
    df = spark.range(n).select("id", F.lit(3).alias("f0"), F.floor(u(1) * 2).alias("f1"), F.floor(u(2) * 9).alias("f2"),
                               F.floor(u(3) * 40).alias("f3"), (u(4) - 0.5).alias("f4"), u(5).alias("f5"),
                               F.greatest(u(6) - 0.7, F.lit(0.0)).alias("f6"))
    return df.withColumn("y", (F.col("f3") / 40 + F.col("f4") * F.col("f1") + 0.4 * u(7) > 0.6).cast("int"))


def test_models_grown_together_are_those_of_single_fits(spark):
    df, k, rounds = rows_of(spark, 3000), 2, 6
    model, oof, test = learning.fit_stacking(df, "id", COLUMNS, "y", k, rounds)
    assert oof.columns == ["id", "y", "fold", "p"] and test.columns == ["id", "y", "p"] and len(model.trees) == rounds
    found = {r.id: r.p for r in oof.select("id", "p").unionByName(test.select("id", "p")).collect()}
    rows = stage(splits.hash_split(df, ["id"], 80, "stack").withColumn("fold", splits.fold_of([F.col("id")], k, "stack-fold")))
    train = rows.filter("split = 'train'")
    parts = [train.filter(F.col("fold") != f) for f in range(k)] + [train]
    fits = concurrently([partial(learning.fit_default_classifier, p, COLUMNS, "y", 4, rounds, 0.05) for p in parts])
    scored = [learning.score(fits[f], train.filter(F.col("fold") == f), "p") for f in range(k)] + [
        learning.score(fits[k], rows.filter("split = 'test'"), "p")]
    single = {r.id: r.p for part in scored for r in part.select("id", "p").collect()}
    assert len(found) == len(single) == 3000
    # two columns may part a small node's rows in the same way; rounding tells which one is taken
    assert np.mean([abs(found[i] - single[i]) > 1e-9 for i in found]) < 0.05


def test_blocks_and_parts_do_not_change_the_models(spark, monkeypatch):
    df = splits.hash_split(rows_of(spark, 4000), ["id"], 80, "s").withColumn("fold", (F.col("id") % 2).cast("int"))
    whole = boosting.fit_boosted(df, "id", COLUMNS, "y", 3, 3, 3, 0.1)
    monkeypatch.setattr(boosting, "MOST_PARTS", 1)
    again = boosting.fit_boosted(df.repartition(5), "id", COLUMNS, "y", 3, 3, 3, 0.1)
    for a, b in zip(whole, again):
        assert all(np.array_equal(s.column, t.column) and np.array_equal(s.cut, t.cut) and np.allclose(s.value, t.value)
                   for s, t in zip(a.trees, b.trees))


def test_one_class_and_missing_values(spark):
    df = rows_of(spark, 300).withColumn("fold", (F.col("id") % 2).cast("int"))
    only = boosting.fit_boosted(df.withColumn("y", F.lit(0)), "id", COLUMNS, "y", 3, 2, 3, 0.1)
    p = boosting.scored(df, COLUMNS, only, "p").agg(F.min("p").alias("a"), F.max("p").alias("b")).first()
    assert p.a == p.b < 0.5
    for bad in (df.withColumn("f4", F.when(F.col("id") != 7, F.col("f4"))), df.withColumn("y", F.when(F.col("id") != 7, F.col("y")))):
        with pytest.raises(Exception, match="f4|y must be"):
            boosting.fit_boosted(bad, "id", COLUMNS, "y", 3, 2, 3, 0.1)
