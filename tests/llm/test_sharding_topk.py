"""Exact draws beyond the generator's range, and products beyond 64 bits."""

import math

import numpy as np
import pytest

from tradeweave.llm.sharding import _hypergeometric_by_inversion, communication_matrix, shard_sizes
from tradeweave.llm.topk import search_page


@pytest.mark.parametrize("good,bad,drawn", [(7, 13, 9), (3, 40, 41), (50, 2, 30), (1, 1, 1)])
def test_inversion_follows_the_hypergeometric_law(good, bad, drawn):
    rng, n = np.random.default_rng(4), 20_000
    got = np.bincount([_hypergeometric_by_inversion(rng, good, bad, drawn) for _ in range(n)], minlength=drawn + 1) / n
    for x in range(drawn + 1):
        ways = math.comb(good, x) * math.comb(bad, drawn - x) / math.comb(good + bad, drawn)
        assert abs(got[x] - ways) <= 5 * math.sqrt(ways * (1 - ways) / n) + 1e-12


def test_draws_beyond_the_generators_range_have_exact_margins_and_moments():
    rows_in = {p: 2_000_000 + p for p in range(600)}
    sizes = shard_sizes(sum(rows_in.values()), 40)
    matrix = communication_matrix(rows_in, sizes, 7)
    assert (sum(matrix.values()) == sizes).all()
    assert all(matrix[p].sum() == n and (matrix[p] >= 0).all() for p, n in rows_in.items())
    spread = np.array([(matrix[p] - n / 40) / math.sqrt(n * (1 / 40) * (39 / 40)) for p, n in rows_in.items()])
    assert abs(spread.mean()) < 0.05 and 0.97 < spread.std() < 1.03


def test_no_draw_and_whole_draws():
    rng = np.random.default_rng(1)
    big = 3 * 10 ** 12
    assert _hypergeometric_by_inversion(rng, 0, big, 5) == 0 and _hypergeometric_by_inversion(rng, big, 0, 5) == 5
    assert _hypergeometric_by_inversion(rng, big, big, 2 * big) == big
    assert 0 <= _hypergeometric_by_inversion(rng, 5, big, big // 2) <= 5


def page(ids, vectors):
    table = np.array(vectors, np.int64)
    return np.array(ids), table, np.sqrt((table.astype(float) ** 2).sum(1))[:, None]


def test_products_beyond_64_bits_raise():
    huge = 3 * 10 ** 9
    with pytest.raises(OverflowError):
        search_page(page([50], [[huge, huge]]), page([1], [[huge, huge]]), 5, np.full(1, -np.inf))
    found = search_page(page([50], [[huge, huge]]), page([1, 2], [[huge, -huge], [huge, 1 - huge]]), 5, np.full(1, -np.inf))
    assert sorted(found) == [(50, 1, 0), (50, 2, huge)]
