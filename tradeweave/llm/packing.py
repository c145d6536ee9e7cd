"""Packing documents into sequences of a fixed length by best fit and swap-based local search.

A document is its token ids and an end id. One longer than a sequence is cut into full sequences, all but its first
piece, which takes what is left over. Full pieces are sequences of their own. The others are dealt at random into groups
of bounded size, and each group is packed alone:

1. best fit, longest first: into the open bin with the least room that is enough;
2. local search over the bins that are not full, emptiest first: move one or two pieces into a fuller bin, or
   exchange one or two for one of it, whenever this raises the sum of squared fills. Fuller bins get fuller and the
   emptiest lose their last pieces; it ends when as few bins are left as can hold the pieces, or no step helps.

A group's last bin is the price of not packing all groups together: about one bin in five thousand.

Defined results: a null or empty text is its end id alone; repeated rows are packed as often as they occur; a special
token's string inside a text is that token, as the tokenizer has it by default; input columns with the names of results are replaced.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.text import Memo, apart, together
from tradeweave.session import stage

LENGTH = 1024
END = 2
GROUP_PIECES = 10_000


# Strings and ids of the tokenizer's special tokens, which the rank file lacks.
SPECIAL = {"<|endoftext|>": 50256}
_SPECIAL = re.compile("|".join(map(re.escape, SPECIAL)))
_SPACE_AFTER_SPACE = re.compile(r"\s ")


class Encoder:
    """Byte-level BPE ids as packed unsigned 32-bit numbers.

    Token boundaries always fall between a character that is no white space and white space after it, so a text that
    has single spaces between words is encoded word by word, and words are remembered. Other texts go as a whole.
    """

    _loaded: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.model = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
        self.after_space = Memo(lambda word: self.plain(" " + word), 300_000)

    @classmethod
    def load(cls, path: str) -> "Encoder":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def plain(self, text: str) -> bytes:
        return np.array(self.model.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if "<|" not in text:
            return self.ordinary(text)
        parts, at = [], 0
        for hit in _SPECIAL.finditer(text):
            parts += [self.ordinary(text[at:hit.start()]), np.array([SPECIAL[hit[0]]], "<u4").tobytes()]
            at = hit.end()
        return b"".join([*parts, self.ordinary(text[at:])])

    def ordinary(self, text: str) -> bytes:
        if _SPACE_AFTER_SPACE.search(text):
            return self.plain(text)
        words = text.split(" ")
        return self.plain(words[0]) + b"".join(map(self.after_space.__getitem__, words[1:]))


def pieces_of(n_tokens: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes what full sequences leave over."""
    first = (n_tokens - 1) % length + 1
    return [(0, first)] + [(s, length) for s in range(first, n_tokens, length)]


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of indices: longest first, each into the open bin with the least room that is enough."""
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    by_room: dict[int, list[int]] = defaultdict(list)
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        at = bisect_left(rooms, size)
        if at == len(rooms):
            bins.append([i])
            b, room = len(bins) - 1, length - size
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del rooms[at]
            bins[b].append(i)
            room -= size
        if room:
            if not by_room[room]:
                insort(rooms, room)
            by_room[room].append(b)
    return bins


class OpenBins:
    """Bins by the size of a piece in them (0: any bin) and by fill."""

    def __init__(self):
        self.sizes: list[int] = []
        self.fills: dict[int, list[int]] = {}
        self.bins: dict[tuple[int, int], dict[int, None]] = defaultdict(dict)

    def add(self, b: int, fill: int, sizes: set[int]) -> None:
        for size in (0, *sizes):
            if size not in self.fills:
                insort(self.sizes, size)
                self.fills[size] = []
            if not self.bins[size, fill]:
                insort(self.fills[size], fill)
            self.bins[size, fill][b] = None

    def remove(self, b: int, fill: int, sizes: set[int]) -> None:
        for size in (0, *sizes):
            del self.bins[size, fill][b]
            if not self.bins[size, fill]:
                del self.bins[size, fill]
                fills = self.fills[size]
                del fills[bisect_left(fills, fill)]
                if not fills:
                    del self.fills[size], self.sizes[bisect_left(self.sizes, size)]

    def fullest(self, size: int, most: int) -> int | None:
        """The largest fill, up to `most`, of a bin that holds a piece of the size."""
        at = bisect_right(self.fills[size], most)
        return self.fills[size][at - 1] if at else None


class LocalSearch:
    """Bins that are not full, kept by fill; steps that raise the sum of squared fills.

    Moving d tokens from a bin of fill a to one of fill b changes the sum by 2 d (b - a + d): any step that leaves
    the fuller bin fuller, or gives it more than the difference, helps. For the emptiest bin the search looks for the
    target that a step fills best: for each size that the target may give back, the fullest bin with room enough.
    """

    def __init__(self, bins: list[list[int]], sizes: list[int], length: int):
        self.sizes, self.length, self.bins = sizes, length, bins
        self.fill = [sum(sizes[i] for i in b) for b in bins]
        self.open = OpenBins()

    def run(self) -> list[list[int]]:
        """Emptiest bins first; ends at the fewest bins that can hold all, or when no step helps any bin.

        A bin without a helpful step is looked at again in the next round, as long as rounds make steps.
        """
        fewest = -(-sum(self.fill) // self.length)
        alive = {b for b in range(len(self.bins)) if self.fill[b] < self.length}
        for b in sorted(alive):
            self.open.add(b, self.fill[b], set(self._by_size(b)))
        count, stepped = len(self.bins), True
        while stepped and count > fewest:
            stepped = False
            queue = [(self.fill[b], b) for b in alive]
            heapq.heapify(queue)
            while queue and count > fewest:
                fill, b = heapq.heappop(queue)
                if fill != self.fill[b] or b not in alive:
                    continue
                c = self._step(b)
                if c is None:
                    continue
                stepped = True
                for x in (b, c):
                    if not self.fill[x] or self.fill[x] == self.length:
                        alive.discard(x)
                        count -= not self.fill[x]
                    else:
                        self.open.add(x, self.fill[x], set(self._by_size(x)))
                        heapq.heappush(queue, (self.fill[x], x))
        return [b for b in self.bins if b]

    def _step(self, b: int) -> int | None:
        """The best move or exchange between bin b and another open one; the other bin, or None. Takes both bins out
        of the open ones when there is one."""
        best, found = 0, None
        own, fill = self._by_size(b), self.fill[b]
        pairs = {x + y: (i, j) for x, i in own.items() for y, j in self._pairs_with(b, x, i)}
        self.open.remove(b, fill, set(own))
        for given in (own, pairs):
            for size, what in given.items():
                for back in self.open.sizes:
                    gain = size - back
                    if gain <= 0 or 2 * gain * (self.length - fill) <= best:  # what a target without room left would give
                        break
                    target = self.open.fullest(back, self.length - gain)
                    if target is not None and (raised := 2 * gain * (target - fill + gain)) > best:
                        best, found = raised, (what, back, target)
        if found is None:
            self.open.add(b, fill, set(own))
            return None
        what, back, target = found
        c = next(iter(self.open.bins[back, target]))
        theirs = self._by_size(c)
        self.open.remove(c, target, set(theirs))
        for i in what if isinstance(what, tuple) else (what,):
            self.bins[b].remove(i)
            self.bins[c].append(i)
        if back:
            self.bins[c].remove(theirs[back])
            self.bins[b].append(theirs[back])
        for x in (b, c):
            self.fill[x] = sum(self.sizes[i] for i in self.bins[x])
        return c

    def _by_size(self, b: int) -> dict[int, int]:
        return {self.sizes[i]: i for i in self.bins[b]}

    def _pairs_with(self, b: int, size: int, i: int) -> Iterator[tuple[int, int]]:
        return ((self.sizes[j], j) for j in self.bins[b] if j != i and self.sizes[j] <= size)


def pack_group(sizes: list[int], length: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece."""
    bins = LocalSearch(best_fit(sizes, length), sizes, length).run()
    placed = [(0, 0)] * len(sizes)
    for b, members in enumerate(bins):
        at = 0
        for i in members:
            placed[i] = (b, at)
            at += sizes[i]
    return placed


def tokenized_pieces(docs: DataFrame, text: str, path: str, length: int = LENGTH, end: int = END,
                     ids: bool = False) -> DataFrame:
    """One row per piece of each document; `_doc` numbers the documents' rows. Only `text` is sent to Python."""
    closing = np.array([end], "<u4").tobytes()

    def cut(texts: pd.Series) -> pd.Series:
        encoder, out = Encoder.load(path), []
        for t in texts:
            data = (encoder.encode(t) if t else b"") + closing
            out.append([(k, s, n, zlib.crc32(data[4 * s:4 * (s + n)]), data[4 * s:4 * (s + n)] if ids else None)
                        for k, (s, n) in enumerate(pieces_of(len(data) // 4, length))])
        return pd.Series(out)

    cut.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    kind = "array<struct<piece int, start bigint, length bigint, crc bigint, ids binary>>"
    found = F.explode(F.pandas_udf(cut, kind)(F.col(text)))
    return docs.withColumn("_piece", found)


def pack(docs: DataFrame, path: str, text: str = "text", length: int = LENGTH, end: int = END,
         ids: bool = False) -> DataFrame:
    """A row per piece: the columns of `docs` and piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Texts are tokenized once, where they are read. What moves are lengths: each piece's row and its place meet on the
    piece's number in the tokenized copy.
    """
    inner, at = apart(docs)
    kept = [c for c in inner.columns if c != at[text]]
    cut = tokenized_pieces(inner, at[text], path, length, end, ids).select(
        *kept, *[F.col(f"_piece.{c}").alias(f"_{c}") for c in ("piece", "start", "length", "crc", "ids")])
    pieces = stage(cut.withColumn("_number", F.monotonically_increasing_id()))
    return _packed(pieces, docs, at[text], length, ids)


def _packed(pieces: DataFrame, docs: DataFrame, text: str, length: int, ids: bool) -> DataFrame:
    short = F.col("_length") < length
    groups = max(1, -(-pieces.filter(short).count() // GROUP_PIECES))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_number", kind="stable").reset_index(drop=True)
        placed = pack_group(group["_length"].tolist(), length)
        first = group["_number"].groupby([b for b, _ in placed]).transform("min")
        return pd.DataFrame({"_number": group["_number"], "_sequence": first, "_offset": [o for _, o in placed]})

    dealt = pieces.filter(short).select("_number", "_length", F.pmod(
        F.xxhash64("_number", F.lit("deal")), F.lit(groups)).alias("_group"))
    places = dealt.groupBy("_group").applyInPandas(place, "_number bigint, _sequence bigint, _offset bigint")
    full = pieces.filter(~short).select("_number", F.col("_number").alias("_sequence"),
                                        F.lit(0).cast("bigint").alias("_offset"))
    joined = pieces.join(places.unionByName(full), "_number")
    names = [n for i, n in enumerate(docs.columns) if f"c{i}" != text]
    renamed = joined.withColumnsRenamed({f"c{i}": f"c{k}" for k, i in enumerate(
        i for i in range(len(docs.columns)) if f"c{i}" != text)})
    new = [("piece", F.col("_piece")), ("start", F.col("_start")), ("length", F.col("_length")),
           ("ids_crc32", F.col("_crc")), ("sequence_id", F.col("_sequence")), ("offset", F.col("_offset"))]
    return together(renamed, names, new + ([("ids", F.col("_ids"))] if ids else []))
