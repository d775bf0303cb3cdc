import datetime as dt

import numpy as np
import pytest

from tremor.operators import spikes

SCHEMA = "reading_id long, point_record_num long, timestamp_utc timestamp, overall_raw float, bands_raw array<float>, ingested_at timestamp"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def series(values, point=1, start=0, bands=None, hours=6):
    return [(start + i, point, T0 + dt.timedelta(hours=hours * i), v, [] if bands is None else bands[i], T0) for i, v in enumerate(values)]


def flagged(spark, data, **more):
    return {r[0] for r in spikes.implausible_readings(spark.createDataFrame(data, SCHEMA), **more).collect()}


def noisy(n=300, level=1.0, seed=0):
    return [float(x) for x in level * np.exp(0.03 * np.random.default_rng(seed).standard_normal(n))]


def test_values_that_cannot_be(spark):
    v = noisy(50)
    v[3], v[4], v[5], v[6], v[7], v[8] = -1.0, 0.0, float("nan"), float("inf"), 1e30, None
    bands = [[0.5, 0.2] for _ in v]
    bands[20] = [0.5, -9999.0]
    bands[21] = [None, 0.2]
    bands[22] = None
    v[9] = 200.0
    got = flagged(spark, series(v, bands=bands))
    assert {3, 4, 5, 6, 7, 20} <= got and not {8, 21, 22} & got


def test_spikes_and_their_copies(spark):
    v = noisy()
    v[100], v[200], v[201] = 5.0, 0.1, 0.15
    data = series(v)
    data += [(900, 1, data[100][2], v[100], [], T0), (901, 1, data[101][2], v[101], [], T0)]
    assert flagged(spark, data) == {100, 200, 201, 900}


def test_shifts_trends_and_seasons_are_none(spark):
    shift = noisy(150) + noisy(150, 4.0, 1)
    trend = [float(x * (1 + i / 100)) for i, x in enumerate(noisy(300, seed=2))]
    season = [float(x * (1 + 0.5 * np.sin(i / 30))) for i, x in enumerate(noisy(300, seed=3))]
    duty = [x * (3 if (i // 20) % 2 else 1) for i, x in enumerate(noisy(300, seed=4))]
    data = []
    for k, s in enumerate((shift, trend, season, duty)):
        data += series(s, point=k, start=1000 * k)
    assert flagged(spark, data) == set()


def test_stuck_runs_against_resolution(spark):
    fine = noisy(200)
    fine[50:60] = [fine[50]] * 10
    coarse = [round(x * 10) / 10 for x in noisy(400, seed=5)]
    data = series(fine) + series(coarse, point=2, start=5000)
    assert flagged(spark, data) == set(range(50, 60))


def test_blocks_find_the_same(spark):
    v = noisy(3000, seed=6)
    for i in (400, 999, 1000, 1001, 2500):
        v[i] = v[i] * 4 if i != 1000 else v[i]
    v[1490:1510] = [v[1490]] * 20
    data = series(v, hours=1)
    assert flagged(spark, data) == flagged(spark, data, block_rows=500)


def test_one_rule_at_every_size(spark):
    """Noise of a part, a channel stuck throughout, own values of a coarse scale and runs over several blocks."""
    loud = noisy(2000, seed=7)
    loud[1000:1500] = [float(np.exp(0.3 * x)) for x in np.random.default_rng(8).standard_normal(500)]
    calm = noisy(2000, seed=9)
    coarse = [1.0 if x < 1.03 else 1.1 for x in noisy(2000, seed=10)]
    coarse[200:212], coarse[480:1260] = [1.1] * 12, [1.1] * 780
    data = series(loud, hours=1) + series(calm, point=2, start=10_000, hours=1, bands=[[0.7]] * 2000) + series(coarse, point=3, start=20_000, hours=1)
    whole = flagged(spark, data)
    assert set(range(10_000, 12_000)) <= whole and set(range(20_480, 21_260)) <= whole and any(1000 <= i < 1500 for i in whole)
    assert flagged(spark, data, block_rows=300) == whole


@pytest.mark.parametrize("seed", [11, 12])
def test_size_of_blocks_has_no_effect(spark, seed):
    """Random series with spikes, runs, gaps, copies and crowded minutes, in blocks of several sizes."""
    rng = np.random.default_rng(seed)
    data, at = [], 0
    for point in range(3):
        t = np.cumsum(rng.choice([0.001, 1, 60, 600], size=900, p=[0.2, 0.2, 0.5, 0.1]))
        v = np.exp(0.05 * rng.standard_normal(900) * (1 + (np.arange(900) // 300 == point)))
        v = np.round(v, int(rng.integers(1, 4)))
        for i in rng.integers(10, 890, 12):
            v[i] *= rng.choice([0.2, 1.4, 3, 6])
        for i in rng.integers(10, 800, 4):
            v[i : i + int(rng.integers(4, 90))] = v[i]
        rows_ = [(at + i, point, T0 + dt.timedelta(minutes=float(t[i])), float(v[i]), [float(v[i] / 2), float(rng.integers(1, 3))], T0) for i in range(900)]
        data += rows_ + [(at + 5000, *rows_[100][1:])]
        at += 10_000
    whole = flagged(spark, data)
    assert whole and all(flagged(spark, data, block_rows=n) == whole for n in (37, 250, 700))


def test_degenerate(spark):
    assert flagged(spark, []) == set()
    assert flagged(spark, [(1, None, None, -5.0, None, None), (2, 1, None, 1.0, [1.0], None), (3, 1, T0, None, None, None), (4, 1, T0, 1.0, [], None)]) == {1}


def test_sketch_median_is_close():
    x = np.random.default_rng(1).lognormal(size=5001)
    _, m, n = spikes.sketch_medians(np.zeros(len(x), int), spikes.bucket(x))
    assert n[0] == 5001 and m[0] == pytest.approx(np.median(x), rel=0.011)
