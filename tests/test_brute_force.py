"""Vectorised kernels against plain loops."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tremor.operators import spikes


def plain_excursion(level, i):
    before, after = level[max(0, i - 5) : i], level[i + 1 : i + 6]
    if not before or not after:
        return 0.0
    a, b = level[i] - float(np.median(before)), level[i] - float(np.median(after))
    off = min(abs(a), abs(b)) if np.sign(a) == np.sign(b) else 0.0
    return 0.0 if abs(a - b) > 0.6 * off else off


values = st.lists(st.lists(st.floats(-3, 3).map(lambda x: round(x, 3)), max_size=14), min_size=1, max_size=4)


@settings(max_examples=200, deadline=None)
@given(values)
def test_excursions(groups):
    level = np.array([x for g in groups for x in g])
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    if not len(level):
        return
    want = [plain_excursion(g, i) for g in groups for i in range(len(g))]
    assert np.allclose(spikes.excursions(level, group), want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=12), min_size=1, max_size=4))
def test_runs(groups):
    v = np.array([float(x) for g in groups for x in g])
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    if not len(v):
        return
    want = []
    for g in groups:
        for i, x in enumerate(g):
            a = b = i
            while a and g[a - 1] == x:
                a -= 1
            while b + 1 < len(g) and g[b + 1] == x:
                b += 1
            want.append(b - a + 1)
    run, first = spikes.repeat_runs(v, group)
    assert run.tolist() == want and int(first.sum()) == sum(1 for g in groups for i, x in enumerate(g) if not i or g[i - 1] != x)


def test_own_chance_of_a_coarse_scale():
    v = np.array([1.0] * 9 + [2.0] + [1.0] * 8 + [2.0] + [1.0] * 7 + [3.0] * 6)
    run, first = spikes.repeat_runs(v, np.zeros(len(v), int))
    p = spikes.own_chance(v, np.zeros(len(v), int), run, first)
    assert p[0] > 0.8 and p[-1] == 0
