"""Exact top-k inner products by pivot-table elimination.

Distances of every vector to a set of pivots are computed once, when vectors are packed into pages. For a query q and
a candidate c the largest difference of their pivot distances is a lower bound of |q - c|, hence
(|q|^2 + |c|^2 - bound^2) / 2 an upper bound of their inner product; the origin is one of the pivots, which makes
|q| |c| one of the bounds. Within a page candidates are evaluated in the order of that bound until the next one can
no longer reach the k-th best score.

Pages of candidates meet groups of query blocks on (salt, group): a call holds a page or a few and some thousand
queries. Scores are whole numbers: components are floor(scale * x).

Defined results: null vectors and vectors with null or non-finite components take no part, nor do rows without an
id; only vectors of equal length meet; rows that share a query's id are its own and no candidates of it, and the
least of their vectors is the query; repeated candidates are listed repeatedly; fewer candidates than k are all
listed; ties go to the smaller id; a product that passes 64 bits raises an OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.session import stage

PIVOTS = 32
PIVOT_SAMPLE = 2000  # vectors (those of least id hash) that pivots are chosen from; bounds are exact with any pivots
PAGE = 4096
BLOCK = 256
GROUP_BLOCKS = 16  # query blocks that meet a page in one call
SLAB = 256  # candidates that are evaluated at first, doubled while none stops the search
_PAGE_TYPE = "dim int, n int, ids binary, vectors binary, distances binary"


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(id, v): vectors that take part, components floor(scale * x) with x as double."""
    return rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("x")).filter(
        F.col("id").isNotNull() & F.col("x").isNotNull() & F.coalesce(all_finite(F.col("x")), F.lit(False))).select(
        "id", F.transform("x", lambda a: F.floor(a.cast("double") * float(scale)).cast("long")).alias("v"))


def all_finite(x: Column) -> Column:
    return F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a.cast("double")) & (
        F.abs(a.cast("double")) < F.lit(float("inf"))))


def choose_pivots(sample: list[np.ndarray], n: int) -> dict[int, np.ndarray]:
    """Per vector length the origin and up to n - 1 vectors, each the farthest from those before."""
    pivots = {}
    for dim in sorted({len(v) for v in sample}):
        own = [v for v in sample if len(v) == dim]
        have = np.array(own, np.float64).reshape(len(own), dim)
        chosen = [np.zeros(dim)]
        nearest = (have ** 2).sum(1)
        while len(chosen) < n and len(have) and nearest.max() > 0:
            chosen.append(have[int(nearest.argmax())])
            nearest = np.minimum(nearest, ((have - chosen[-1]) ** 2).sum(1))
        pivots[dim] = np.array(chosen).reshape(len(chosen), dim)
    return pivots


def pack(rows: DataFrame, pivots: dict[int, np.ndarray], most: int) -> DataFrame:
    """Pages of up to `most` vectors of one length, with their distances to the pivots."""
    def page(ids: list[int], vectors: list) -> tuple:
        dim = len(vectors[0])
        table = np.array(vectors, np.int64).reshape(len(ids), dim)
        real = table.astype(np.float64)
        near = pivots.get(dim, np.zeros((1, dim)))
        apart = np.sqrt(np.maximum(((real[:, None, :] - near[None]) ** 2).sum(2), 0)) if len(ids) * near.size < 1 << 22 \
            else np.stack([np.sqrt(((real - p) ** 2).sum(1)) for p in near], 1)
        return dim, len(ids), np.array(ids, np.int64).tobytes(), table.tobytes(), apart.astype(np.float64).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for i, v in zip(batch["id"], batch["v"]):
                ids, vectors = held.setdefault(len(v), ([], []))
                ids.append(i)
                vectors.append(v)
                if len(ids) == most:
                    yield pd.DataFrame([page(ids, vectors)], columns=names)
                    held.pop(len(v))
        for ids, vectors in held.values():
            yield pd.DataFrame([page(ids, vectors)], columns=names)

    names = [p.split()[0] for p in _PAGE_TYPE.split(", ")]
    return rows.mapInPandas(run, _PAGE_TYPE)


def _products(query: np.ndarray, table: np.ndarray, real: np.ndarray | None, checked: bool = False) -> np.ndarray:
    """Inner products; `checked` ones are summed without a limit first, and one that a long cannot hold raises."""
    if real is not None:
        return (real @ query.astype(np.float64)).astype(np.int64)
    if checked and any(abs(x) >= 1 << 63 for x in table.astype(object) @ query.astype(object)):
        raise OverflowError("an inner product does not fit 64 bits; use a smaller scale")
    return table @ query


def search_page(block: tuple, page: tuple, k: int, floor: np.ndarray) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's best k in the page, but only such that can beat `floor`.

    `floor` holds the k-th best score that each query has met so far and is raised in place.
    """
    q_ids, q_table, q_far = block
    c_ids, c_table, c_far = page
    q_square, c_square = (q_table.astype(np.float64) ** 2).sum(1), (c_table.astype(np.float64) ** 2).sum(1)
    exact = max(q_square.max(initial=0), c_square.max(initial=0)) < 2.0 ** 52
    real = c_table.astype(np.float64) if exact else None
    wide = q_square.max(initial=0) * c_square.max(initial=0) >= 2.0 ** 125  # only then a product can pass 64 bits
    apart = np.zeros((len(q_ids), len(c_ids)))
    for p in range(q_far.shape[1]):
        np.maximum(apart, np.abs(q_far[:, p, None] - c_far[None, :, p]), out=apart)
    both = q_square[:, None] + c_square[None]
    bound = (both - apart ** 2) / 2 + 1e-6 + 1e-9 * both
    found = []
    for i, own in enumerate(q_ids):
        order = np.argsort(-bound[i], kind="stable")
        best: list[tuple[int, int]] = []  # (-score, candidate), ascending
        at, size = 0, SLAB
        while at < len(order):
            least = max(floor[i], -best[k - 1][0]) if len(best) >= k else floor[i]
            if bound[i, order[at]] < least:
                break
            slab = order[at:at + size]
            at, size = at + size, size * 2
            slab = slab[c_ids[slab] != own]
            scores = _products(q_table[i], c_table[slab], None if real is None else real[slab], wide)
            if len(scores) > k:
                cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                slab, scores = slab[scores >= cut], scores[scores >= cut]
            best = sorted(best + [(-int(s), int(c)) for s, c in zip(scores, c_ids[slab])])[:k]
        if len(best) >= k:
            floor[i] = max(floor[i], -best[k - 1][0])
        found += [(int(own), c, -s) for s, c in best]
    return found


def _unpacked(page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(page.ids, np.int64), np.frombuffer(page.vectors, np.int64).reshape(page.n, page.dim),
            np.frombuffer(page.distances, np.float64).reshape(page.n, -1))


def top_k(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50,
          scale: int = 256, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best candidates of each row whose id is divisible by `every`."""
    all_rows = whole_vectors(rows, vec_id, vector, scale)
    sample = all_rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).collect()
    near = choose_pivots([np.array(r["v"], np.int64) for r in sample], pivots)
    pages = stage(pack(all_rows, near, PAGE).withColumn("number", F.monotonically_increasing_id()))
    queries = all_rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    blocks = stage(pack(queries, near, BLOCK).withColumn("number", F.monotonically_increasing_id()))
    salts, groups = max(1, pages.count()), max(1, -(-blocks.count() // GROUP_BLOCKS))
    numbered = pages.withColumn("salt", F.pmod(F.xxhash64("number"), F.lit(salts))).drop("number").withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    copied = blocks.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)).cast("int")).drop("number").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))

    def search(own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        for q in asking.itertuples(index=False):
            block, floor = _unpacked(q), np.full(q.n, -np.inf)
            for c in own.itertuples(index=False):
                if c.dim == q.dim:
                    found += search_page(block, _unpacked(c), k, floor)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype=np.int64)

    found = numbered.groupBy("salt", "group").cogroup(copied.groupBy("salt", "group")).applyInPandas(
        search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
