import random
import re
import zlib
from itertools import combinations, product

import numpy as np
import pandas as pd

from tradeweave.llm.components import components
from tradeweave.llm import ngram_join
from tradeweave.llm.ngram_join import coarse, finest_bound, jaccard_components, may_link, point, point_bits, shingles
from tradeweave.llm.text import hash_memo
from tests.llm.conftest import prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_shingles(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_components(rows):
    sets = [plain_shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            parent[root(j)] = root(i)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((d for d in groups[root(i)] if d is not None), default=None)) for i in range(len(rows))]


def edited(text, changes, rng):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng, rows = random.Random(5), []
    passage = prose(99, 60)
    for base in range(12):
        text = prose(1000 + base, rng.randrange(8, 400))
        rows += [text] + [edited(text, rng.randrange(0, 1 + len(text.split()) // 12), rng) for _ in range(6)]
    chain = prose(77, 300)
    for _ in range(14):  # neighbours are near, the ends are far
        rows.append(chain)
        chain = edited(chain, 4, rng)
    rows += [prose(500 + i, rng.randrange(10, 200)) + " " + passage for i in range(25)]  # one passage in many texts
    rows += [edited(prose(3, 90), 1, rng) for _ in range(60)]  # a group of near copies
    rows += [None, "", "  ", "one two", "ONE two", "a b c d", "same"] + ["same"] * 5
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[i], t) for i, t in enumerate(rows)]


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr("tradeweave.llm.ngram_join.UNIT", 8)  # large leaves in parts, as on a cluster
    rows = corpus()
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.collect())) == sorted(plain_components(rows))


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    got = [tuple(r) for r in jaccard_components(awkward).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(plain_components(rows), key=key)
    assert jaccard_components(nothing).count() == 0


def test_bound_is_never_below_the_overlap():
    memo, rng = hash_memo(), random.Random(1)
    for n in (1, 6, 40, 3000, 40_000):
        text = prose(n, n, 10**6)
        a, b = shingles(text, memo), shingles(edited(text, n // 20, rng), memo)
        both = coarse(pd.Series([point(a), point(b, point_bits(len(b), 16))]))
        overlap = len(set(a.tolist()) & set(b.tolist()))
        assert both.min(0).sum() >= overlap
        assert finest_bound(point(a, point_bits(len(a), 4)), point(b, point_bits(len(b), 4) + 1)) >= overlap
        if 180 * overlap >= 80 * (len(a) + len(b)):
            assert may_link(both[:1], both[1:], len(a), len(b))


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7)], "a long, b long")
    found = dict(components(links).collect())
    assert {found[i] for i in range(61)} == {0} and found[100] == found[101] == 100 and len(found) == 63


def test_runs_of_few_words_are_told_apart():
    memo = hash_memo()
    texts = [" ".join(p) for p in product("abc", repeat=5)]
    assert len({int(shingles(t, memo)[0]) for t in texts}) == 3 ** 5
    rng = random.Random(8)
    for words in ("ab", "abcd", ["la", "na", "hey"]):
        text = " ".join(rng.choice(words) for _ in range(2000))
        assert len(shingles(text, memo)) == len(plain_shingles(text))


def test_components_of_texts_of_few_words(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("ab" if i % 2 else "aAbc\x0b") for _ in range(rng.randrange(3, 60)))) for i in range(80)]
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect())) == sorted(plain_components(rows))


def test_bounds_of_many_pairs_equal_single_ones_and_points_are_opened_once(monkeypatch):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 9000, 40)
    sets = [np.sort(rng.integers(0, 2 ** 64, n, dtype=np.uint64)) for n in sizes]
    sets.append(np.arange(1000, dtype=np.uint64))  # all in one group: counts beyond a byte
    points = [point(s, point_bits(len(s), 16)) for s in sets]
    fine = [zlib.compress(point(s, ngram_join.fine_bits(len(s))), 1) for s in sets]
    x, y = (a.ravel() for a in np.indices((len(sets), len(sets))))
    assert ngram_join.bounds(points, x, y).tolist() == [finest_bound(points[i], points[j]) for i, j in zip(x, y)]
    assert ngram_join.bounds(fine, x, y, True).tolist() == [ngram_join.fine_bound(fine[i], fine[j]) for i, j in zip(x, y)]
    monkeypatch.setattr(ngram_join, "OPEN_POINTS", 8)
    monkeypatch.setattr(ngram_join, "TABLE_CELLS", 100)
    monkeypatch.setattr(ngram_join, "PAIR_CELLS", 100)
    assert ngram_join.bounds(fine, x, y, True).tolist() == [ngram_join.fine_bound(fine[i], fine[j]) for i, j in zip(x, y)]
    assert not len(ngram_join.bounds(points, x[:0], y[:0]))
    monkeypatch.undo()

    near = [np.sort(np.r_[sets[0][:200], rng.integers(0, 2 ** 64, 100, dtype=np.uint64)]) for _ in range(200)]
    opened = []
    monkeypatch.setattr(ngram_join.zlib, "decompress", lambda data, real=zlib.decompress: opened.append(1) or real(data))
    near_points = np.array([point(s, point_bits(len(s), 16)) for s in near], object)
    near_fine = np.array([zlib.compress(point(s, ngram_join.fine_bits(len(s))), 1) for s in near], object)
    node = np.arange(len(near))
    ngram_join.leaf_pairs(node, np.full(len(near), 300), node, np.zeros(len(near), np.int64), [near_points, near_fine],
                          coarse(pd.Series(near_points)))
    assert 0 < len(opened) <= len(near)
