import math
import re

import numpy as np
from pyspark.sql import functions as F

from tradeweave.llm.mixing import mix, source_targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def clamped_targets(totals: list[int]) -> list[float]:
    """Targets by weight, stopped at three times the size, the excess shared again and again."""
    weights = [(5, 2, 1)[i % 3] for i in range(len(totals))]
    fixed = {}
    while True:
        rest = sum(totals) - sum(fixed.values())
        open_weight = sum(w for i, w in enumerate(weights) if i not in fixed)
        share = {i: rest * w / open_weight for i, w in enumerate(weights) if i not in fixed}
        above = {i: 3.0 * totals[i] for i in share if share[i] > 3 * totals[i] + 1e-9}
        if not above:
            return [fixed.get(i, share.get(i)) for i in range(len(totals))]
        fixed.update(above)


def test_targets_agree_with_repeated_clamping(spark):
    for totals in ([100, 20, 30, 1, 400, 5, 7], [1, 1, 1000], [10], [0, 50, 0, 9]):
        table = spark.createDataFrame([(f"0s{i:02d}", t, 1) for i, t in enumerate(totals)], "_key string, _total long, _docs long")
        got = [r["_target"] for r in source_targets(table).orderBy("_key").collect()]
        assert np.allclose(got, clamped_targets(totals))


def test_rates_are_the_entropy_solution_and_words_hit_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(n), "s" + "abc"[i % 3]) for i, n in enumerate(rng.lognormal(4, 1, 900).astype(int) + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(docs).drop("text").toPandas()
    again = mix(docs.repartition(5)).drop("text").toPandas()
    assert got.sort_values("doc_id").copies.tolist() == again.sort_values("doc_id").copies.tolist()
    assert got.copies.between(0, 3).all()
    for _, own in got.groupby("source"):
        target, size = own.target.iloc[0], own["size"].to_numpy(float)
        x, low, high = size / size.mean(), -50.0, 50.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if (size * np.minimum(3, np.exp(middle * x))).sum() < target else (low, middle)
        assert np.allclose(own.rate, np.minimum(3, np.exp(low * x)), rtol=1e-5)
        assert math.isclose((own["size"] * own.copies).sum(), target, rel_tol=0.01)


def test_awkward_rows(awkward, nothing):
    got = mix(awkward).toPandas()
    assert len(got) == awkward.count() and got["size"].dtype == np.int64
    texts = {(r["doc_id"], r["text"]): r for _, r in got.astype({"doc_id": object}).iterrows()}
    assert all(r["size"] == len(WORDS.findall(t or "")) for (_, t), r in texts.items())
    assert (got[got["size"] == 0].copies == 1).all()
    assert got.columns.tolist().count("size") == 1 and "_key" in got.columns
    assert mix(nothing).count() == 0


def test_no_python_on_the_main_path(awkward):
    plan = mix(awkward)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert awkward.filter(F.col("source").isNull()).count() == 1
