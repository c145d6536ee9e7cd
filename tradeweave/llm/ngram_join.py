"""Jaccard self-join of word shingles by count vectors in R-tree leaves.

A text is the set of its distinct five-word shingles (64-bit hashes). Two texts link when 100 * |A and B| reaches
80 * |A or B|, which needs an overlap of at least 80 * (|A| + |B|) / 180.

* Points. Shingles are dealt into groups by hash; a set's point is its count in each group. An overlap is never
  larger than the sum of coordinate minima of two points, nor than that of two boxes' upper corners. Boxes have 64
  groups; pairs that pass them are bounded again by points of more groups for longer texts, with about sixteen and then
  less than one shingle to a group (four in texts of many thousand words).
* Leaves. One tree over all points would not prune, as unrelated texts of a length have nearly equal counts. So the
  upper level is addressed by shingles instead of coordinates, without loss: in one common order of all shingles, two
  sets that link share one of their first |A| - 0.8 |A| + 1 shingles. The order puts frequent shingles last, by counts of
  all shingles over a table of fixed size, so a passage that many texts share makes no large leaf. Points below one
  shingle are packed by size into boxes, pairs of boxes and then of points are bounded, survivors are verified exactly.
* Copies. Equal sets are one node. Members of a leaf are first verified against its centre, the text that shares most; in large leaves
  those that are still apart meet some more centres. Links found so join near copies into clusters, and leaves that
  hold one cluster are done. Only points of different clusters meet in the rest, so a group of thousands of copies costs
  links in proportion to its size. Large leaves are cut into units of bounded size.

Defined results: a text of one to four words is one shingle, the whole sequence; a text without words, or null, has no
shingles and links with nothing, not even another; rows with equal sets link; rows that share an id are judged by their
own texts; a null id is never the smallest while another is there; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.components import components
from tradeweave.llm.text import Memo, apart, run_hashes, spread_join, word_hashes
from tradeweave.session import stage

GRAM = 5
SHARE = 80  # per cent of the union
GROUPS_BITS = 6
ORDER_BITS = 20  # cells of the frequency table that orders shingles
BOX = 16
UNIT = 256  # points of one part of a large leaf
CENTRES = 8  # that members of a large leaf meet before all that are still apart meet
BROADCAST_ROWS = 1_000_000  # ids, 8 bytes each; more meet in a shuffle
SLICE_BITS = 16
BITMAP_BITS = 29  # of the bitmap of shared shingles at most: 64 MB
SLAB_WORDS = 20_000
TABLE_CELLS = 1 << 23  # counts of opened points held at once
PAIR_CELLS = 1 << 18  # counts of pairs compared at once
OPEN_POINTS = 2048  # opened at once
PIECE_ROWS = 1000
_FIRST = np.array([True])


def shingles(text: str | bytes | None, memo: Memo | None = None) -> np.ndarray:
    """Ascending distinct hashes of a text's shingles."""
    return next(shingle_sets([text], memo))


def shingle_sets(texts: Iterable[str | bytes | None], memo: Memo | None = None) -> Iterator[np.ndarray]:
    """`shingles` of each text; texts are hashed together in slabs of some ten thousand words, or one by one if longer.

    Hashing a word anew takes half the time of looking it up in a `memo` that rare words fill, and no memory."""
    slab, sizes, held = [], [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
        words = data.lower().split()
        slab += words
        sizes.append(len(words))
        held += len(words)
        if held >= SLAB_WORDS:
            yield from _slab_sets(slab, sizes, memo)
            slab, sizes, held = [], [], 0
    yield from _slab_sets(slab, sizes, memo)


def _slab_sets(words: list[bytes], sizes: list[int], memo: Memo | None) -> Iterator[np.ndarray]:
    hashes = word_hashes(words, memo) if memo is not None else np.fromiter(
        map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    runs, start = run_hashes(hashes, GRAM), 0
    for size in sizes:
        if size >= GRAM:
            found = np.sort(runs[start:start + size - GRAM + 1])
            yield found[np.concatenate((_FIRST, found[1:] != found[:-1]))]
        elif size:
            yield np.array([xxhash.xxh3_64_intdigest(hashes[start:start + size].tobytes(), size)], np.uint64)
        else:
            yield np.empty(0, np.uint64)
        start += size


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: what is made of a batch's texts is never all held at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(at, PIECE_ROWS)


def node_of(found: np.ndarray) -> int:
    """Equal sets share a node: 64 bits of their hash."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes(), 1)).astype(np.int64))


def prefix_length(n: int) -> int:
    return n - (SHARE * n + 99) // 100 + 1


def point(found: np.ndarray, bits: int = GROUPS_BITS) -> bytes:
    """Counts of 2^bits groups in bytes; counts beyond a byte are rounded up to a power of two, whose exponent is first."""
    counts = np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    exponent = max(0, int(counts.max(initial=0)).bit_length() - 8)
    if (counts.max(initial=0) + (1 << exponent) - 1) >> exponent > 255:
        exponent += 1
    return bytes([exponent]) + ((counts + (1 << exponent) - 1) >> exponent).astype(np.uint8).tobytes()


def point_bits(n: int, each: int) -> int:
    """Groups for a set of n, about `each` shingles to a group: counts of unrelated texts differ if that is not too many."""
    return min(max((n // each).bit_length(), GROUPS_BITS), 14)


def fine_bits(n: int) -> int:
    """Groups of the finest points: more of them than shingles up to a few thousand, so few unrelated shingles share one."""
    return max(point_bits(n, 4), min(point_bits(n, 1) + 1, 12))


def folded(packed: Sequence[bytes], groups: int) -> np.ndarray:
    """Points of all lengths, a row each, folded to `groups` groups; in bytes where counts fit."""
    sizes = np.fromiter(map(len, packed), np.int64, len(packed))
    parts, wide = [], False
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        table = np.frombuffer(b"".join([packed[i] for i in at]), np.uint8).reshape(len(at), size)
        counts = table[:, 1:]
        if size != groups + 1 or table[:, 0].any():
            counts = (counts.astype(np.int32) << table[:, :1].astype(np.int32)).reshape(len(at), groups, -1).sum(2, dtype=np.int32)
            wide |= bool(counts.max(initial=0) > 255)
        parts.append((at, counts))
    out = np.empty((len(packed), groups), np.int32 if wide else np.uint8)
    for at, counts in parts:
        out[at] = counts
    return out


def coarse(packed: pd.Series) -> np.ndarray:
    """Points of all lengths, folded to the 2^GROUPS_BITS groups of boxes."""
    return folded(packed.to_numpy(), 1 << GROUPS_BITS)


def bounds(packed: Sequence[bytes], x: np.ndarray, y: np.ndarray, squeezed: bool = False) -> np.ndarray:
    """`finest_bound` of the points x[i] and y[i] (`fine_bound` of `squeezed` ones), of pairs with equally many groups at once.

    A point is opened and folded once for many pairs; tables hold TABLE_CELLS counts at most, or the points of one pair.
    """
    used, at = np.unique(np.concatenate((x, y)), return_inverse=True)
    if len(used) > OPEN_POINTS and len(x) > OPEN_POINTS // 2:
        return np.concatenate([bounds(packed, x[i:i + OPEN_POINTS // 2], y[i:i + OPEN_POINTS // 2], squeezed)
                               for i in range(0, len(x), OPEN_POINTS // 2)])
    points = [zlib.decompress(packed[u]) if squeezed else packed[u] for u in used]
    x, y = at[:len(x)], at[len(x):]
    sizes = np.fromiter(map(len, points), np.int64, len(points))
    least, out = np.minimum(sizes[x], sizes[y]), np.empty(len(x), np.int64)
    for size in np.unique(least):
        groups, own = int(size) - 1, np.flatnonzero(least == size)
        several = max(1, TABLE_CELLS // (2 * groups))
        if len(own) > several and len(np.unique(np.concatenate((x[own], y[own])))) <= 2 * several:
            several = len(own)  # few points in many pairs
        for i in range(0, len(own), several):
            part = own[i:i + several]
            rows, back = np.unique(np.concatenate((x[part], y[part])), return_inverse=True)
            table, a, b = folded([points[r] for r in rows], groups), back[:len(part)], back[len(part):]
            step = max(1, PAIR_CELLS // groups)
            for j in range(0, len(part), step):
                out[part[j:j + step]] = np.minimum(table[a[j:j + step]], table[b[j:j + step]]).sum(1, dtype=np.int64)
    return out


def finest_bound(a: bytes, b: bytes) -> int:
    """Sum of coordinate minima of two points; the finer one is folded to the other's groups first."""
    x, y = (np.frombuffer(p, np.uint8, offset=1).astype(np.int64) << p[0] for p in (a, b))
    if len(x) > len(y):
        x = x.reshape(len(y), -1).sum(1)
    elif len(y) > len(x):
        y = y.reshape(len(x), -1).sum(1)
    return int(np.minimum(x, y).sum())


def fine_bound(a: bytes, b: bytes) -> int:
    """`finest_bound` of two finest points, which are kept compressed: most of their counts are zero or one."""
    return finest_bound(zlib.decompress(a), zlib.decompress(b))


def may_link(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether the bound on the overlap leaves a link possible; rows of a and b are points."""
    return (100 + SHARE) * np.minimum(a, b).sum(-1, dtype=np.int64) >= SHARE * (na + nb)


def shingle_order(docs: DataFrame, text: str) -> np.ndarray:
    """Frequency class of each cell of shingle hashes: 0 for the usual, then one more for each doubling."""
    cells, part = 1 << ORDER_BITS, 1 << 12

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(cells, np.int32)
        for batch in _pieces(batches):
            for found in shingle_sets((t.as_py() for t in batch["t"])):
                np.add.at(sums, (found >> np.uint64(64 - ORDER_BITS)).astype(np.int64), 1)
        used = np.flatnonzero(sums.reshape(-1, part).any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(
            [sums.reshape(-1, part)[u].tobytes() for u in used], pa.binary())], ["part", "sums"])

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(s, np.int32).astype(np.int64) for s in group["sums"])
        return pd.DataFrame({"part": [key[0]], "sums": [total.tobytes()]})

    rows = docs.select(F.col(text).cast("binary").alias("t")).mapInArrow(count, "part int, sums binary").groupBy(
        "part").applyInPandas(add, "part int, sums binary").collect()  # a table of fixed size
    sums = np.zeros(cells, np.int64)
    for r in rows:
        sums[r["part"] * part:(r["part"] + 1) * part] = np.frombuffer(r["sums"], np.int64)
    mean = max(sums.mean(), 1.0)
    return np.where(sums > 2 * mean + 30, np.log2(np.maximum(sums / mean, 1.0)).astype(np.uint8) + 1, 0).astype(np.uint8)


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc, spot, body (hash of the text), node, n and, once for each node and task, its prefix and points. Written once, read several times."""
    order = docs.sparkSession.sparkContext.broadcast(shingle_order(docs, text))

    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in _pieces(batches):
            out = []
            for found in shingle_sets((t.as_py() for t in batch["t"])):
                n, node = len(found), node_of(found)
                if not n or node in seen:
                    out.append((node, n, None, None, None))
                    continue
                seen.add(node)
                common = order.value[(found >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
                first = found[np.argsort(common, kind="stable")][:prefix_length(n)]
                out.append((node, n, first.astype(np.int64), point(found, point_bits(n, 16)), zlib.compress(point(found, fine_bits(n)), 1)))
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in ("doc", "spot", "body")] + [pa.array(c, kind) for c, kind in zip(zip(*out), types)],
                ["doc", "spot", "body", "node", "n", "prefix", "point", "fine"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.xxhash64(doc_id).alias("spot"),
                       F.xxhash64(text).alias("body"), F.col(text).cast("binary").alias("t"))
    return stage(rows.mapInArrow(sign, "doc long, spot long, body long, node long, n int, prefix array<long>, point binary, fine binary"))


def _only(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ids: a checked few are broadcast."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, key, "left_semi")


def verified(pairs: DataFrame, signed: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets; texts of nodes in question are shingled anew."""
    nodes = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    spots = stage(_only(signed.filter(F.col("point").isNotNull()), nodes, "node").groupBy("node").agg(
        F.min("spot").alias("spot")).select("spot").distinct())

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor()
        for batch in _pieces(batches):
            node = [node_of(found) for found in shingle_sets((t.as_py() for t in batch["t"]))]
            packed = [squeeze.compress(t.as_py() or b"") for t in batch["t"]]
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(packed, pa.binary())], ["node", "packed"])

    texts = _only(docs.select(F.xxhash64(doc_id).alias("spot"), F.col(text).cast("binary").alias("t")), spots, "spot")
    packed = stage(_only(texts.select("t").mapInArrow(again, "node long, packed binary"), nodes, "node"))

    def common(batches: Iterator[tuple]) -> Iterator[pd.Series]:
        open_up = zstandard.ZstdDecompressor()
        last: dict[bytes, np.ndarray] = {}  # a leaf's least member comes again and again

        def of(key: bytes) -> np.ndarray:
            if key not in last:
                if len(last) >= 32:
                    last.pop(next(iter(last)))
                last[key] = shingles(open_up.decompress(key))
            return last[key]

        for a, b in batches:
            out = []
            for x, y in zip(a, b):
                p, q = of(bytes(x)), of(bytes(y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                out.append(100 * both >= SHARE * (len(p) + len(q) - both))
            yield pd.Series(out, dtype=bool)

    common.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    linked = F.pandas_udf(common, "boolean")
    left = packed.select(F.col("node").alias("a"), F.col("packed").alias("pa"))
    right = packed.select(F.col("node").alias("b"), F.col("packed").alias("pb"))
    return pairs.join(right, "b").join(left, "a").filter(linked("pa", "pb")).select("a", "b").distinct()


def bounded(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) whose fine points leave a link possible."""
    def test(na: pd.Series, nb: pd.Series, pa: pd.Series, pb: pd.Series) -> pd.Series:
        at, points = pd.factorize(np.concatenate((pa.to_numpy(object), pb.to_numpy(object))))
        both = (na.to_numpy(np.int64) + nb.to_numpy(np.int64)) * SHARE
        return pd.Series((100 + SHARE) * bounds(points, at[:len(pa)], at[len(pa):], squeezed=True) >= both)

    test.__annotations__ = {k: pd.Series for k in ("na", "nb", "pa", "pb", "return")}
    possible = F.pandas_udf(test, "boolean")
    left = known.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("fine").alias("pa"))
    right = known.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("pb"))
    sizes_fit = (100 * F.least("na", "nb") >= SHARE * F.greatest("na", "nb"))
    return pairs.join(right, "b").join(left, "a").filter(sizes_fit).filter(possible("na", "nb", "pa", "pb")).select("a", "b")


def _near(n: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows x[i], y[i] those that may link by sizes and coarse points."""
    fits = 100 * np.minimum(n[x], n[y]) >= SHARE * np.maximum(n[x], n[y])
    x, y = x[fits], y[fits]
    fits = may_link(at[x], at[y], n[x], n[y])
    return x[fits], y[fits]


def _pairs(node: np.ndarray, n: np.ndarray, points: list[np.ndarray], near: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Of near rows the pairs of nodes that may link by all `points`, coarse ones first; each pair once."""
    x, y = (np.concatenate([pair[side] for pair in near] + [np.empty(0, np.int64)]) for side in (0, 1))
    both, first = np.unique(np.stack([np.minimum(node[x], node[y]), np.maximum(node[x], node[y])], 1), axis=0, return_index=True)
    x, y = x[first], y[first]
    for packed, squeezed in zip(points, (False, True)):
        fits = (100 + SHARE) * bounds(packed, x, y, squeezed) >= SHARE * (n[x] + n[y])
        both, x, y = both[fits], x[fits], y[fits]
    return both


def leaf_pairs(node: np.ndarray, n: np.ndarray, cluster: np.ndarray, side: np.ndarray, points: list[np.ndarray],
               at: np.ndarray) -> np.ndarray:
    """Pairs of rows of one unit that may link: sizes ascending, boxes of points, then points.

    `side` tells the two parts of a leaf that a unit joins; in a unit of one part (all sides 0) all rows meet.
    """
    order = np.lexsort((node, n))
    boxes = [order[i:i + BOX] for i in range(0, len(order), BOX)]
    corner = np.stack([at[b].max(0) for b in boxes])
    least, most = np.array([n[b[0]] for b in boxes]), np.array([n[b[-1]] for b in boxes])
    whole, found = not side.any(), []
    for i, own in enumerate(boxes):
        near = i + np.flatnonzero(SHARE * least[i:] <= 100 * most[i])
        near = near[may_link(corner[i][None], corner[near], least[i], least[near])]
        if not len(near):
            continue
        others = np.concatenate([boxes[j] for j in near])
        x, y = np.repeat(own, len(others)), np.tile(others, len(own))
        fits = (node[x] != node[y]) & (cluster[x] != cluster[y])
        if not whole:
            fits &= side[x] != side[y]
        found.append(_near(n, at, x[fits], y[fits]))
    return _pairs(node, n, points, found)


def _search_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of rows ordered by unit (key, i, j); a unit may run over the end of a batch."""
    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        columns = [rows[c].to_numpy(np.int64) for c in ("key", "i", "j", "node", "n", "cluster", "side")]
        key, i, j, node, n, cluster, side = columns
        points = [rows["point"].to_numpy(), rows["fine"].to_numpy()]
        at = coarse(rows["point"])
        starts = np.flatnonzero(np.r_[True, (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)])
        sizes = np.diff(np.r_[starts, len(key)])
        unit = np.repeat(np.arange(len(starts)), sizes)
        near = []
        small = np.repeat(sizes <= 8, sizes)
        for step in range(1, 8):  # small units of all kinds at once: rows that are `step` apart
            x = np.flatnonzero(small[:-step] & (unit[:-step] == unit[step:])) if len(unit) > step else np.empty(0, np.int64)
            y = x + step
            fits = (node[x] != node[y]) & (cluster[x] != cluster[y]) & ((i[x] == j[x]) | (side[x] != side[y]))
            near.append(_near(n, at, x[fits], y[fits]))
        found = [_pairs(node, n, points, near)]
        for u in np.flatnonzero(sizes > 8):
            own = slice(starts[u], starts[u] + sizes[u])
            found.append(leaf_pairs(node[own], n[own], cluster[own], side[own],
                                    [p[own] for p in points], at[own]))
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = (rows["key"] == rows["key"].iloc[-1]) & (rows["i"] == rows["i"].iloc[-1]) & (
            rows["j"] == rows["j"].iloc[-1]) if len(rows) else None
        if last is None or last.all():
            held = rows if len(rows) else held
            continue
        held = rows[last]
        yield pairs(rows[~last])
    if held is not None and len(held):
        yield pairs(held)


def leaf_candidates(members: DataFrame, clusters: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (a, b) of different clusters that share a leaf and may link."""
    placed = stage(members.join(clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", "node")))
    mixed_leaves = placed.groupBy("key").agg(
        F.min("cluster").alias("low"), F.max("cluster").alias("high"), F.count(F.lit(1)).alias("size")).filter(
        F.col("low") != F.col("high")).select("key", F.ceil(F.col("size") / UNIT).cast("int").alias("parts"))
    rows = placed.join(mixed_leaves, "key").join(known.select("node", "n", "point", "fine"), "node")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    units = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "node", "n", "cluster",
        (F.col("part") > F.col("other")).cast("int").alias("side"), "point", "fine")
    ordered = units.repartition(F.col("key"), F.col("i"), F.col("j")).sortWithinPartitions("key", "i", "j")
    return ordered.mapInPandas(_search_units, "a long, b long").distinct()


def stars(members: DataFrame, clusters: DataFrame | None = None, centres: int = 1) -> DataFrame:
    """Pairs (a, b) of each leaf's centres, by weight and then some by hash, with the leaf's members of other clusters."""
    placed = members.withColumn("cluster", F.col("node")) if clusters is None else members.join(
        clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    heaviest = F.max(F.struct(F.col("weight").alias("rank"), F.col("node"), F.col("cluster")))
    drawn = [F.max(F.struct(F.xxhash64("node", F.lit(c)).cast("double").alias("rank"), F.col("node"), F.col("cluster")))
             for c in range(1, centres)]
    chosen = F.transform(F.array(heaviest, *drawn), lambda c: F.struct(c["node"].alias("node"), c["cluster"].alias("cluster")))
    leaves = placed.groupBy("key").agg(chosen.alias("chosen"), F.min("cluster").alias("low"), F.max("cluster").alias("high"))
    leaves = leaves.filter(F.col("low") != F.col("high")).select("key", F.explode(F.array_distinct("chosen")).alias("centre")).select(
        "key", F.col("centre.node").alias("a"), F.col("centre.cluster").alias("own"))
    return placed.join(leaves, "key").filter(F.col("cluster") != F.col("own")).select(
        "a", F.col("node").alias("b")).distinct()


def shared_members(signed: DataFrame) -> DataFrame:
    """(key, node, weight): prefix shingles that more than one row has, with the nodes that have them.

    The weight is a node's share of such shingles: the text that others are copies of has the most.

    Most prefix shingles occur once and are counted away as bare keys. A bitmap of bounded size of the shared ones then
    thins out the prefixes where they lie; what it lets through by chance falls out of the join with the keys. A passage
    makes a leaf of each of its shingles, all with the same members: of leaves with the same set of nodes, told by its size
    and 128 bits of hash, one stays, and leaves of one node go. Neither loses a pair.
    """
    prefixes = signed.filter(F.col("prefix").isNotNull())
    shared = stage(prefixes.select(F.explode("prefix").alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("key"))
    bits = min(max((16 * shared.count()).bit_length(), SLICE_BITS), BITMAP_BITS)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.unique(batch["key"].to_numpy(np.int64) & ((1 << bits) - 1))
            for part in np.unique(at >> SLICE_BITS):
                own = slices.setdefault(int(part), np.zeros(1 << SLICE_BITS, bool))
                own[at[at >> SLICE_BITS == part] & ((1 << SLICE_BITS) - 1)] = True
        yield pd.DataFrame([(k, np.packbits(v).tobytes()) for k, v in slices.items()], columns=["part", "bits"])

    def join(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        both = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in group["bits"]])
        return pd.DataFrame({"part": [key[0]], "bits": [both.tobytes()]})

    kind, size = "part int, bits binary", 1 << (SLICE_BITS - 3)
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for r in shared.mapInPandas(mark, kind).groupBy("part").applyInPandas(join, kind).collect():
        bitmap[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    sent = signed.sparkSession.sparkContext.broadcast(bitmap)

    def thin(prefix: pd.Series) -> pd.Series:
        out = []
        for keys in prefix:
            at = keys & ((1 << bits) - 1)
            out.append(keys[(sent.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0])
        return pd.Series(out)

    thin.__annotations__ = {"prefix": pd.Series, "return": pd.Series}
    thinned = prefixes.select("node", "n", F.explode(F.pandas_udf(thin, "array<long>")("prefix")).alias("key"))
    found = stage(thinned.join(shared, "key").select("key", "node", "n").distinct())
    weights = found.groupBy("node").agg((F.count(F.lit(1)) / F.first("n")).alias("weight"))
    leaves = found.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), *[F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"set{i}") for i in (0, 1)])
    chosen = stage(leaves.filter("size > 1").groupBy("size", "set0", "set1").agg(F.min("key").alias("key")).select("key"))
    return stage(_only(found.drop("n"), chosen, "key").join(weights, "node").select("key", "node", "weight"))


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id that links lead to; cluster, the component's own key, which holds
    where ids are null or repeated (one for all texts without words); body, xxhash64 of the text."""
    inner, at = apart(docs)
    key, body = at[doc_id], at[text]
    signed = signatures(inner, key, body)
    known = stage(signed.filter(F.col("point").isNotNull()).select("node", "n", "point", "fine").dropDuplicates(["node"]))
    members = shared_members(signed)
    links = stage(verified(stage(bounded(stars(members), known)), signed, inner, key, body))
    clusters = stage(components(links))
    large = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > UNIT).select("key")
    crowded = stars(members.join(large, "key"), clusters, CENTRES)
    more = stage(verified(stage(bounded(crowded, known)), signed, inner, key, body))
    links = stage(links.union(more))
    clusters = stage(components(links))
    crossing = stage(leaf_candidates(members.select("key", "node"), clusters, known))
    second = stage(verified(crossing, signed, inner, key, body))
    found = stage(components(links.union(second)))
    nodes = signed.filter(F.col("n") > 0).groupBy("node").agg(F.min("doc").alias("low"), F.count(F.lit(1)).alias("rows"))
    nodes = stage(nodes.join(found, "node", "left").withColumn("cluster", F.coalesce("cluster", "node")))
    of_cluster = nodes.groupBy("cluster").agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("held")).filter("held > 1")
    placed = stage(spread_join(nodes, of_cluster, "cluster").withColumn("least", F.coalesce("least", "low")))
    grouped = placed.filter((F.col("rows") > 1) | (F.col("cluster") != F.col("node")) | ~F.col("least").eqNullSafe(F.col("low")))
    rows = spread_join(signed.select("doc", "body", "node", "n"), grouped.select(
        "node", "cluster", "least", F.col("rows").alias("held")), "node")
    return rows.select(
        F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("least", "doc").alias("component_id"), F.coalesce("cluster", "node").alias("cluster"), "body")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id."""
    return jaccard_classes(docs, doc_id, text).select("doc_id", "n_shingles", "component_id")
