"""op3: windows come from differencing alone, rise until all fit, and stay full."""

from __future__ import annotations

import collections

import numpy as np
import pytest

from verdant.llm import packing


def held(sizes, capacity):
    windows = packing.fill(np.array(sizes, dtype=np.int64), capacity)
    got = collections.defaultdict(list)
    for w in windows:
        assert sum(n for _, _, n in w) <= capacity
        for item, start, n in w:
            assert n > 0
            got[item].append((start, n))
    for i, size in enumerate(sizes):
        at = 0
        for start, n in sorted(got[i]):
            assert start == at
            at += n
        assert at == size
    assert len(windows) <= max(1, len(sizes))
    return windows


@pytest.mark.parametrize("seed", range(12))
def test_groups_of_the_usual_size(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 2048, 512).tolist()
    windows = held(sizes, 2048)
    assert 1 - sum(sizes) / (2048 * len(windows)) < 0.01                  # padding
    # Every window is one that differencing made from the dealt parts.
    parts = packing.chips(np.array(sizes))
    made = packing.differencing(np.array([p[2] for p in parts]), len(windows))
    assert sorted(np.bincount(made, weights=[p[2] for p in parts], minlength=len(windows))) == \
        sorted(sum(n for _, _, n in w) for w in windows)


@pytest.mark.parametrize("seed", range(60))
def test_any_sizes(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 60))
    held(rng.integers(1, (2048, 200, 2)[seed % 3], n).tolist(), 2048)
    held((rng.integers(1900, 2048, n)).tolist(), 2048)


def test_ties_and_single_items():
    assert packing.fill(np.array([5]), 2048) == [[(0, 0, 5)]]
    held([1] * 3000, 2048)
    held([1025] * 300, 2048)
    held([2047] * 40, 2048)
    held([2047, 1] * 20, 2048)
