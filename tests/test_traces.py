"""Traces, medians and suggested bounds against brute force."""

import math
import random
import statistics
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionweave.operators import curation, rtmodel, traces


def brute_sweep(x, first, end, start, height, slope):
    top, total, count = np.full(len(x), -np.inf), np.zeros(len(x)), np.zeros(len(x), int)
    for a, b, s, h, k in zip(first, end, start, height, slope):
        v = h + k * (x[a:b] - s)
        top[a:b] = np.maximum(top[a:b], v)
        total[a:b] += v
        count[a:b] += 1
    return top, total, count


@pytest.mark.parametrize("m,n", [(1, 1), (2, 5), (7, 30), (64, 500), (300, 900)])
def test_sweep_equals_brute_force(m, n):
    rng = np.random.default_rng(m)
    for _ in range(10):
        # whole slopes and few heights: many lines tie
        x = np.sort(rng.choice(m * 5, m, replace=False) / 50.0)
        first = rng.integers(0, m, n)
        end = np.minimum(m, first + 1 + rng.integers(0, max(1, m // 2), n))
        height, slope = rng.integers(-20, 20, n) * 1.0, rng.integers(-5, 6, n) * 1.0
        got, want = traces.sweep(x, first, end, x[first], height, slope), brute_sweep(x, first, end, x[first], height, slope)
        assert np.allclose(got[0], want[0]) and np.allclose(got[1], want[1]) and (got[2] == want[2]).all()


def test_sweep_grows_with_the_files_not_their_square():
    took = []
    for files in (50, 800):
        rng = np.random.default_rng(files)
        x, i = np.sort(rng.random((files, 40)), 1), rng.random((files, 40)) * 1e5
        order = np.argsort(x.ravel())
        rank = np.empty(x.size, int)
        rank[order] = np.arange(x.size)
        rank = rank.reshape(x.shape)
        end = np.hstack([rank[:, 1:], rank[:, -1:] + 1])
        slope = np.hstack([np.diff(i) / np.diff(x), np.zeros((files, 1))])
        arguments = (x.ravel()[order], rank.ravel(), end.ravel(), x.ravel(), i.ravel(), slope.ravel())
        each = []
        for _ in range(3):
            began = time.process_time()
            traces.sweep(*arguments)
            each.append(time.process_time() - began)
        took.append(min(each))
    assert took[1] < 16 * 6 * max(took[0], 0.004)  # 256 times as many pairs


def brute_traces(rows):
    files = {}
    for uid, f, rt, i in rows:
        at = files.setdefault(uid, {}).setdefault(f, {})
        at[rt] = max(at.get(rt, -math.inf), i)
    out = {}
    for uid, by in files.items():
        for rt in {r for t in by.values() for r in t}:
            v = [float(np.interp(rt, sorted(t), [t[r] for r in sorted(t)], left=0, right=0)) for t in by.values()]
            out[uid, rt] = (max(v), sum(v) / len(v))
    return out


@pytest.mark.parametrize("points", [1, 5, 4096])
def test_traces_equal_brute_force(spark, monkeypatch, points):
    """Also where targets are cut into many bins, and groups into many batches."""
    monkeypatch.setattr(curation, "BIN_POINTS", points)
    rng = random.Random(points)
    number = lambda x: float(np.float32(x))
    rows = [(f"u{u}", f"f{f}", number(rng.randrange(400) / 16), number(rng.randrange(-5, 1000))) for u in range(12) for f in range(rng.randint(1, 7)) for _ in range(rng.randint(1, 60))]
    rows += [("alone", "f", 1.5, 7.0), ("pair", "f", 1.0, 2.0), ("pair", "g", 1.0, 4.0), ("far", "f", 0.0, 8.0), ("far", "f", 1e6, 16.0), ("far", "g", 5e5, 1.0)]
    df = spark.createDataFrame(rows, "mz_rt_uid string, filename string, rt float, i float")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {(r.mz_rt_uid, r.rt): (r.max_i, r.mean_i) for r in curation.eic_traces(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_traces(rows)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6), k


def test_traces_of_nothing(spark):
    assert curation.eic_traces(spark.createDataFrame([], "mz_rt_uid string, filename string, rt float, i float")).count() == 0


def test_medians_equal_sorting(spark):
    rng = random.Random(3)
    groups = {
        "one": [5.0], "two": [1.0, 2.0], "ties": [3.0] * 7 + [1.0], "signs": [-1.5, 0.0, -0.0, 2.0, -7.25, 1e-30], "wide": [10.0 ** rng.uniform(-300, 300) * rng.choice([-1, 1]) for _ in range(501)],
        "close": [1.0 + k * 2.0**-50 for k in range(100)], "many": [float(np.float32(rng.lognormvariate(9, 3))) for _ in range(4000)], "ends": [float("inf"), float("-inf"), 1.0],
    }
    rows = [(g, v, float(k)) for g, vs in groups.items() for k, v in enumerate(vs)] + [("two", None, None), ("null", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(7)
    got = {r.g: (r.a, r.b) for r in rtmodel.exact_medians(df, "g", {"a": F.col("a"), "b": F.col("b")}).collect()}
    native = {r.g: (r.a, r.b) for r in df.groupBy("g").agg(F.median("a").alias("a"), F.median("b").alias("b")).collect()}
    for g, vs in groups.items():
        assert got[g][0] == pytest.approx(statistics.median(vs), rel=1e-15), g
    assert got.keys() == native.keys()
    for g in got:
        assert all(a == b or a == pytest.approx(b, rel=1e-15) for a, b in zip(got[g], native[g])), g


def test_rt_stats_are_exact_whatever_the_size(spark):
    """Targets below and beyond what a sketch keeps whole, of odd and even numbers of points, with ties."""
    sizes = {"a": 1, "b": 2, "c": 77, "d": 3_999, "e": 4_000, "f": 4_001, "g": 9_000}
    rng = random.Random(11)
    rows = [(u, rng.choice([rng.random() * 3, rng.randrange(4) * 1.0]), 100.0, rng.lognormvariate(8, 2), 1.0, 100.0, "k", True) for u, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "mz_rt_uid string, rt float, mz double, i float, rt_peak double, atlas_mz double, inchi_key string, in_feature boolean").repartition(9)
    got = {r.mz_rt_uid: (r.rt_median, r.intensity_median, r.observation_count) for r in rtmodel.rt_stats(df).collect()}
    want = {r.mz_rt_uid: (r.a, r.b, r.n) for r in df.groupBy("mz_rt_uid").agg(F.median("rt").alias("a"), F.median("i").alias("b"), F.count("*").alias("n")).collect()}
    assert got == want and {u: n for u, (_, _, n) in got.items()} == sizes
    plan = rtmodel.rt_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan and "median(" not in plan and "collect" not in plan


def brute_bounds(rt, i, want, want_min, want_max):
    """The definition of suggested bounds, word for word and without any care for steps."""
    points = [(r, v) for r, v in zip(rt, i) if v > 0 and not math.isnan(r)]
    n = len(points)
    if n < 5:
        return None
    rt, i = [p[0] for p in points], [p[1] for p in points]
    weights = [math.exp(-0.5 * (j / 0.8) ** 2) for j in range(-3, 4)]
    mirrored = i[2::-1] + i + i[:-4:-1]
    x = []
    for k in range(n):
        value = 0.0
        for j, w in enumerate(weights):
            value += w / sum(weights) * mirrored[k + j]
        x.append(value)
    top = max(x)
    peaks = []
    for k in range(n):
        a, b = k, k
        while a > 0 and x[a - 1] == x[k]:
            a -= 1
        while b < n - 1 and x[b + 1] == x[k]:
            b += 1
        if a > 0 and b < n - 1 and x[a - 1] < x[k] and x[b + 1] < x[k] and k == (a + b) // 2 and x[k] >= 0.1 * top:
            peaks.append(k)
    kept = []
    for k in sorted(peaks, key=lambda k: (-x[k], -k)):
        if all(abs(k - q) >= 3 for q in kept):
            kept.append(k)

    def base(k, step):
        j, at = k, k
        while 0 <= j < n and x[j] <= x[k]:
            if x[j] < x[at]:
                at = j
            j += step
        return at

    prominence = {k: x[k] - max(x[base(k, -1)], x[base(k, 1)]) for k in range(n)}
    shown = {k: prominence[k] for k in sorted(kept) if prominence[k] >= 0.05 * top} or {x.index(top): 0.5 * top}
    peak = min(shown, key=lambda k: (abs(rt[k] - want), k))
    level = x[peak] - prominence[peak] / 2
    sides = []
    for step in (-1, 1):
        j = peak
        while j != base(peak, step) and x[j] > level:
            j += step
        sides.append(j - step * (level - x[j]) / (x[j - step] - x[j]) if x[j] < level else j)
    a, b = max(0, math.floor(sides[0])), min(n - 1, math.ceil(sides[1]))
    pad = max(0.05, 0.05 * (rt[b] - rt[a]))
    low, high = max(rt[a] - pad, rt[0]), min(rt[b] + pad, rt[-1])
    width = high - low
    if width < 0.08:
        low, high = rt[peak] - 0.04, rt[peak] + 0.04
    elif width > 0.6:
        low, high = rt[peak] - 0.3, rt[peak] + 0.3
    reach, off, tails = max(abs(want_max - want_min), 0.5), abs(rt[peak] - want), (peak - a, b - peak)
    even = max(0, 1 - abs(tails[0] - tails[1]) / sum(tails)) if sum(tails) else 0.5
    sure = 0.3 * min(1, x[peak] / max(top, 1e3)) + 0.2 * min(1, shown[peak] / max(x[peak] / 2, 1e3)) + 0.15 * (1 - min(1, abs(width - 0.3) / 0.3)) + 0.2 * max(0, 1 - off / reach) + 0.15 * even
    sure = min(1, max(0, sure))
    if sure < 0.1:
        return None
    return low, high, rt[peak], sure * (0.6 if width > 1.5 * (want_max - want_min) else 1) * (0.5 if off > 1.5 * reach else 1)


def same_bounds(rt, i, want=(2.0, 1.5, 2.5)):
    got, wanted = curation.suggested_bounds(np.array(rt, float), np.array(i, float), *want), brute_bounds(list(rt), list(i), *want)
    assert (got is None) == (wanted is None) and (got is None or got == pytest.approx(wanted, abs=1e-9)), (rt, i)
    return got


def test_bounds_of_plateaus_ties_and_short_traces():
    rt = np.arange(30) * 0.05 + 1
    flat = np.ones(30) * 50
    two = np.exp(-(((rt - 1.4) / 0.1) ** 2)) + np.exp(-(((rt - 2.1) / 0.1) ** 2))
    plateau = np.minimum(np.exp(-(((rt - 1.8) / 0.2) ** 2)), 0.5)
    for i in (flat, two * 1e5, plateau * 1e5, np.arange(30.0), np.arange(30.0)[::-1], np.where(np.arange(30) % 2, 5.0, 1.0), np.zeros(30), flat * 1e-9):
        same_bounds(rt, i)
    assert same_bounds(rt, two * 1e5, (1.45, 1.0, 2.0))[2] == pytest.approx(1.4) and same_bounds(rt, two * 1e5, (2.0, 1.5, 2.5))[2] == pytest.approx(2.1)
    for n in range(8):
        same_bounds(rt[:n], np.full(n, 7.0))
    assert same_bounds(rt[:4], [1.0, 5.0, 1.0, 2.0]) is None
    # as near to the atlas on either side: the first
    same_bounds([1, 1.2, 1.4, 1.6, 1.8, 2.0, 2.2, 2.4, 2.6, 2.8, 3.0], [1, 1, 9, 1, 1, 1, 1, 1, 9, 1, 1])


def test_bounds_equal_brute_force():
    rng = random.Random(8)
    for _ in range(400):
        n = rng.randint(1, 60)
        rt = sorted(rng.sample(range(300), n))
        levels = rng.choice([[0, 1, 2], [0, 10, 500, 900], range(100_000)])
        same_bounds([r / 100 for r in rt], [float(rng.choice(levels)) for _ in range(n)], (rng.uniform(0, 3), 1.0, 1.0 + rng.uniform(0, 1)))


def test_bounds_take_linear_steps():
    falling = np.linspace(2, 1, 60_000) + np.tile([0, 1e-9], 30_000)
    began = time.perf_counter()
    curation.suggested_bounds(np.arange(60_000) / 1e4, falling, 3.0, 2.0, 4.0)
    assert time.perf_counter() - began < 20
