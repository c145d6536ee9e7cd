"""The local search of the packing ends where no step helps, however many bins are not full."""

import numpy as np
import pytest

from tradeweave.llm.packing import LocalSearch, best_fit


def helpful(search, b, c):
    """Whether moving or exchanging one or two pieces of b with c raises the sum of squared fills."""
    size, own, theirs = search.sizes, search.bins[b], search.bins[c]
    given = {size[i] for i in own} | {size[i] + size[j] for k, i in enumerate(own) for j in own[k + 1:]}
    room, ahead = search.length - search.fill[c], search.fill[c] - search.fill[b]
    return any(0 < g - back <= room and ahead + g - back > 0 for g in given for back in {0, *(size[i] for i in theirs)})


@pytest.mark.parametrize("low, high, n", [(330, 360, 9000), (505, 560, 6000), (1, 1024, 3000)])
def test_search_ends_only_when_no_step_helps(low, high, n):
    sizes = np.random.default_rng(7).integers(low, high, n).tolist()
    search = LocalSearch([list(b) for b in best_fit(sizes, 1024)], sizes, 1024)
    bins = search.run()
    assert sorted(i for b in bins for i in b) == list(range(n)) and max(search.fill) <= 1024
    open_bins = [b for b in range(len(search.bins)) if 0 < search.fill[b] < 1024]
    if len(bins) > -(-sum(sizes) // 1024):
        for b in np.random.default_rng(8).choice(open_bins, 60):
            assert not any(helpful(search, int(b), c) for c in open_bins if c != b)
