"""Boosted trees of several cross-fitted models grown together, for tables whose fits take too long one after the other.

The method is MLlib's gradient boosting of a binary label: log loss, the first tree fitted to the labels -1 and 1, the others to
the negative gradient, splits by weighted variance among at most `bins` bins a column, leaves of weighted means. What differs is
how it runs: a row is the bins of its columns, three in a 16-bit number, so one count serves three columns; of two sister nodes
the smaller one is counted and the other is the rest; a level of all models is one pass. Blocks of rows and their margins are kept by the
executors (memory, then disk) and made again from the staged rows if lost. The driver sees sums of fixed size.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.functions.scalar import stable_hash

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the package need not lie where the tasks run
BITS = 5  # of a column's bin
PACK = 3  # columns in one number
CELLS = 1 << (BITS * PACK)
BLOCK_ROWS = 1 << 18
BOUND_ROWS = 100_000  # rows that the bounds of bins are taken from; up to so many, all (MLlib takes 10,000)
MOST_PARTS = 64  # parts whose sums the driver adds itself


class Tree(NamedTuple):
    """Nodes by heap order: column (-1 in a leaf), last bin that goes left, value."""
    column: np.ndarray
    cut: np.ndarray
    value: np.ndarray


class Boosted(NamedTuple):
    bounds: list[np.ndarray]
    trees: list[Tree]
    step: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of rows of columns: 1 / (1 + exp(-2 margin))."""
        packed = pack(x, self.bounds)
        margin = np.zeros(len(x))
        for i, tree in enumerate(self.trees):
            add_values(margin, packed, tree, 1.0 if i == 0 else self.step)
        return 1.0 / (1.0 + np.exp(-2.0 * margin))


# ------------------------------------------------------------------ bins
def column_bounds(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """At most `most` ascending bounds of about equal weight between them, halfway between neighbouring values."""
    distinct, at = np.unique(values, return_inverse=True)
    if len(distinct) - 1 <= most:
        return (distinct[:-1] + distinct[1:]) / 2.0
    sums = np.cumsum(np.bincount(at, weights=weights))
    stride = sums[-1] / (most + 1)
    found, target, i = [], stride, 1
    while i < len(distinct):
        # the next value whose weight leads further from the target than the values before it
        i = max(i, int(np.searchsorted(sums, target)))
        if i < len(distinct) and abs(sums[i - 1] - target) < abs(sums[i] - target):
            found.append((distinct[i - 1] + distinct[i]) / 2.0)
            target += stride
        i += 1
    return np.array(found)


def pack(x: np.ndarray, bounds: Sequence[np.ndarray]) -> np.ndarray:
    """(numbers, rows): PACK columns' bins in one number. A value on a bound lies below it."""
    out = np.zeros((math.ceil(len(bounds) / PACK), len(x)), np.uint16)
    for c, b in enumerate(bounds):
        out[c // PACK] |= np.searchsorted(b, x[:, c], side="left").astype(np.uint16) << np.uint16(BITS * (c % PACK))
    return out


def _left(packed: np.ndarray, rows: np.ndarray, column: int, cut: int) -> np.ndarray:
    codes = packed[column // PACK].take(rows)
    return ((codes >> np.uint16(BITS * (column % PACK))) & np.uint16((1 << BITS) - 1)) <= cut


def rows_by_node(packed: np.ndarray, tree: Tree, rows: np.ndarray, wanted: set[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(node, rows) of the wanted nodes; of the leaves, if none are named."""
    todo = [(0, rows)]
    while todo:
        node, rows = todo.pop()
        leaf = node >= len(tree.column) or tree.column[node] < 0
        if leaf if wanted is None else node in wanted:
            yield node, rows
        elif not leaf:
            left = _left(packed, rows, int(tree.column[node]), int(tree.cut[node]))
            todo += [(2 * node + 1, rows[left]), (2 * node + 2, rows[~left])]


def add_values(margin: np.ndarray, packed: np.ndarray, tree: Tree, step: float) -> None:
    for node, rows in rows_by_node(packed, tree, np.arange(len(margin))):
        margin[rows] += step * tree.value[node]


def cell_sums(packed: np.ndarray, rows: np.ndarray, target: np.ndarray, positive: np.ndarray, columns: int,
              counted: bool = False) -> np.ndarray:
    """(3, columns, bins): rows, positive rows and summed target of some rows, by column and bin. `counted`: the target alone."""
    out = np.zeros((3, math.ceil(columns / PACK) * PACK, 1 << BITS))
    whole = len(rows) == packed.shape[1]
    hits = np.flatnonzero(positive)
    for i, numbers in enumerate(packed):
        codes = (numbers if whole else numbers.take(rows)).astype(np.intp)
        found = [(2, np.bincount(codes, weights=target, minlength=CELLS))]
        if not counted:
            found += [(0, np.bincount(codes, minlength=CELLS)), (1, np.bincount(codes[hits], minlength=CELLS))]
        for j, cells in found:
            cube = cells.reshape((1 << BITS,) * PACK)  # the last axis is the first column
            for c in range(PACK):
                axis = PACK - 1 - c
                out[j, i * PACK + c] = cube.sum(axis=tuple(a for a in range(PACK) if a != axis))
    return out[:, :columns]


# ------------------------------------------------------------------ splits
def best_split(sums: np.ndarray, weight: float) -> tuple[int, int] | None:
    """(column, cut) of the largest gain in weighted variance, the first of equal ones; None if no split gains."""
    n, s = sums[0], np.where(sums[0] > 0, sums[2], 0.0)
    w = n - sums[1] + weight * sums[1]
    n_left, w_left, s_left = n.cumsum(axis=1), w.cumsum(axis=1), s.cumsum(axis=1)
    n_all, w_all, s_all = n_left[:, -1:], w_left[:, -1:], s_left[:, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (s_left ** 2 / w_left + (s_all - s_left) ** 2 / (w_all - w_left) - s_all ** 2 / w_all) / w_all
    # a cut after an empty bin is the cut before it; gains below what rounding leaves are none
    gain = np.where((n > 0) & (n_left < n_all) & np.isfinite(gain), gain, -1.0)
    column, cut = np.unravel_index(int(gain.argmax()), gain.shape)
    return (int(column), int(cut)) if gain[column, cut] > 1e-14 else None


def node_value(sums: np.ndarray, weight: float) -> float:
    n, hits, s = sums[:, 0].sum(axis=1)
    w = n - hits + weight * hits
    return float(s / w) if w else 0.0


class _Growing:
    """The tree that one model grows, as the driver sees it: sums of the nodes of the lowest level."""

    def __init__(self, depth: int, weight: float):
        size = 2 ** (depth + 1) - 1
        self.tree = Tree(np.full(size, -1, np.int16), np.zeros(size, np.int16), np.zeros(size))
        self.depth, self.weight = depth, weight
        self.sums: dict[int, np.ndarray] = {}
        self.asked: list[int] = [0]

    def take(self, found: dict[int, np.ndarray]) -> None:
        """Sums of the asked nodes: their sisters are the rest of the parents; then every node of the level is split."""
        level = dict(found)
        for node, sums in found.items():
            if node:
                sister = node + 1 if node % 2 else node - 1
                level[sister] = self.sums[(node - 1) // 2] - sums
        self.sums, self.asked = {}, []
        for node, sums in sorted(level.items()):
            self.tree.value[node] = node_value(sums, self.weight)
            split = best_split(sums, self.weight)
            if split is None:
                continue
            column, cut = split
            self.tree.column[node], self.tree.cut[node] = split
            left = sums[:, column, :cut + 1].sum(axis=1)
            right = sums[:, column].sum(axis=1) - left
            for child, part in ((2 * node + 1, left), (2 * node + 2, right)):
                w = part[0] - part[1] + self.weight * part[1]
                self.tree.value[child] = part[2] / w if w else 0.0
            if 2 * node + 1 < 2 ** self.depth - 1:
                self.sums[node] = sums
                self.asked.append(2 * node + 1 if left[0] <= right[0] else 2 * node + 2)


# ------------------------------------------------------------------ passes
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray]  # model, packed, sign (1 or -1), margin


def _moved(block: Block, trees: list[Tree], step: float) -> Block:
    model, packed, sign, margin = block
    margin = margin.copy()
    add_values(margin, packed, trees[model], step)
    return model, packed, sign, margin


def _part_sums(blocks: Iterator[Block], asked: dict[int, tuple[Tree, set[int]]], weights: Sequence[float], columns: int,
               first: bool) -> Iterator[dict[tuple[int, int], np.ndarray]]:
    total: dict[tuple[int, int], np.ndarray] = {}
    for model, packed, signs, margin in blocks:
        tree, wanted = asked[model]
        if not wanted:
            continue
        for node, rows in rows_by_node(packed, tree, np.arange(len(margin)), wanted):
            sign = signs.take(rows).astype(np.float64)
            target = sign if first else 4.0 * sign / (1.0 + np.exp(np.minimum(2.0 * sign * margin.take(rows), 700.0)))
            target = np.where(sign > 0, weights[model] * target, target)
            sums = cell_sums(packed, rows, target, sign > 0, columns, counted=node == 0 and not first)  # a root's rows stay
            key = (model, node)
            total[key] = total[key] + sums if key in total else sums
    yield total


def _plus(a: dict, b: dict) -> dict:
    return {k: a[k] + b[k] if k in a and k in b else a.get(k, b.get(k)) for k in {**a, **b}}


def fit_boosted(rows: DataFrame, key: str, columns: Sequence[str], label: str, models: int, rounds: int, depth: int, step: float,
                bins: int = 1 << BITS) -> list[Boosted]:
    """Models of the train rows of `rows`(key, columns, label 0 or 1, fold): model f learns from all folds but f, the last one
    from all. Positives weigh (1 - p) / p, by model. A null or NaN among columns or labels raises.
    """
    spark = rows.sparkSession
    checked = _checked(rows, columns, label)
    counts = {(r.fold, r.y): r.n for r in checked.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    of = [{y: sum(n for (f, v), n in counts.items() if v == y and (m == models - 1 or f != m)) for y in (0, 1)} for m in range(models)]
    if not all(sum(c.values()) for c in of):
        raise ValueError("a model has no rows to learn from")
    weights = [(c[0] / (c[0] + c[1])) / max(c[1] / (c[0] + c[1]), 1e-6) for c in of]
    bounds = _bounds(checked, key, sum(of[-1].values()), [min(bins, sum(c.values())) - 1 for c in of], weights)
    width = len(columns)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def made() -> Iterator[pa.RecordBatch]:
            fold, y = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            x = np.concatenate([h[2] for h in held])
            for m in range(models):
                at = np.arange(len(fold)) if m == models - 1 else np.flatnonzero(fold != m)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([m], pa.int32()), pa.array([pack(x[at], bounds[m]).tobytes()], pa.binary()),
                         pa.array([np.where(y[at] == 1, 1, -1).astype(np.int8).tobytes()], pa.binary())], ["model", "packed", "sign"])

        for batch in batches:
            if batch.num_rows:
                held.append((batch["fold"].to_numpy(), batch["y"].to_numpy(), _matrix(batch["x"], width)))
                n += batch.num_rows
                if n >= BLOCK_ROWS:
                    yield from made()
                    held, n = [], 0
        if n:
            yield from made()

    parts = max(1, min(spark.sparkContext.defaultParallelism, math.ceil(sum(of[-1].values()) / 1000)))
    packed = checked.mapInArrow(blocks, "model int, packed binary, sign binary").repartition(parts)
    state = packed.rdd.map(_opened).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[list[Tree]] = [[] for _ in range(models)]
    roots: dict[int, np.ndarray] = {}
    old = None
    try:
        for i in range(rounds):
            growing = [_Growing(depth, w) for w in weights]
            while any(g.asked for g in growing):
                asked = {m: (g.tree, set(g.asked)) for m, g in enumerate(growing)}
                parted = state.mapPartitions(lambda b, asked=asked, first=i == 0: _part_sums(b, asked, weights, width, first))
                found = parted.treeReduce(_plus) if parts > MOST_PARTS else _all_of(parted.collect())
                if old is not None:
                    old.unpersist()
                    old = None
                for (m, node), sums in found.items():
                    if node == 0:
                        roots.setdefault(m, sums[:2])
                        sums[:2] = roots[m]
                for m, g in enumerate(growing):
                    g.take({node: sums for (of_model, node), sums in found.items() if of_model == m})
            grown = [g.tree for g in growing]
            for m, tree in enumerate(grown):
                trees[m].append(tree)
            if i < rounds - 1:
                old, weight = state, 1.0 if i == 0 else step
                state = state.map(lambda b, grown=grown, weight=weight: _moved(b, grown, weight)).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for kept in (state, old):
            if kept is not None:
                kept.unpersist()
    return [Boosted(bounds[m], trees[m], step) for m in range(models)]


def _all_of(parts: list[dict]) -> dict:
    out: dict = {}
    for p in parts:
        out = _plus(out, p)
    return out


def _opened(row) -> Block:
    sign = np.frombuffer(row[2], np.int8)
    return row[0], np.frombuffer(row[1], np.uint16).reshape(-1, len(sign)), sign, np.zeros(len(sign))


def _matrix(arrays: pa.Array, width: int) -> np.ndarray:
    return arrays.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _arrays(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as the array `x`: a missing value raises when it is read."""
    cells = [F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), F.raise_error(F.lit(f"missing value of {c}")).cast("double"))
             .otherwise(F.col(c).cast("double")) for c in columns]
    return rows.withColumn("x", F.array(*cells)).drop(*columns)


def _checked(rows: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    y = F.when(F.col(label).isin(0, 1), F.col(label).cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"{label} must be 0 or 1, is "), F.coalesce(F.col(label).cast("string"), F.lit("null")))).cast("int"))
    return _arrays(rows, columns).withColumn("y", y)


def _bounds(checked: DataFrame, key: str, n: int, most: Sequence[int], weights: Sequence[float]) -> list[list[np.ndarray]]:
    """Bounds of every model's bins, by its own rows and weights."""
    taken = checked.select("fold", "y", "x")
    if n > BOUND_ROWS:
        share = BOUND_ROWS / n
        taken = checked.filter(stable_hash(F.col(key), salt="bounds") < int(share * 2 ** 32)).select("fold", "y", "x")
    found = taken.toArrow()
    fold, y = found["fold"].to_numpy(), found["y"].to_numpy()
    x = _matrix(found["x"].combine_chunks(), len(found["x"][0])) if found.num_rows else np.zeros((0, 0))
    out = []
    for m, weight in enumerate(weights):
        at = np.arange(len(fold)) if m == len(weights) - 1 else np.flatnonzero(fold != m)
        w = np.where(y[at] == 1, weight, 1.0)
        out.append([column_bounds(x[at, c], w, most[m]) for c in range(x.shape[1])])
    return out


def scored(rows: DataFrame, columns: Sequence[str], models: Sequence[Boosted], out: str) -> DataFrame:
    """`rows` without columns, with `out`: the probability by the model that has not seen the row's fold, by the last one if null."""
    kept = [c for c in rows.columns if c not in columns]
    arrays = _arrays(rows, columns).select(*kept, "x")
    width, last = len(columns), len(models) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch["fold"].fill_null(last).to_numpy()
            x, p = _matrix(batch["x"], width), np.zeros(batch.num_rows)
            for m in np.unique(of).tolist():
                at = np.flatnonzero(of == m)
                p[at] = models[m].probability(x[at])
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(p)], [*kept, out])

    return arrays.mapInArrow(run, T.StructType([*[arrays.schema[c] for c in kept], T.StructField(out, T.DoubleType())]))
