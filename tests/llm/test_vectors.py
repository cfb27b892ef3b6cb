"""The permutation index and the hard negatives against brute force, and on odd rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ionweave.llm import cells, hardneg, pivotindex

KIND = "vec_id long, embedding array<float>, label int"


def unit(rng, dim, near=None, noise=1.0):
    x = rng.normal(size=dim) * noise + (0 if near is None else near)
    return (x / np.linalg.norm(x)).astype(np.float32).tolist()


def table(spark, rows):
    return spark.createDataFrame(rows, KIND)


def exact(rows, query, k):
    own = next(v for i, v, _ in rows if i == query)
    found = sorted((-math.fsum(a * b for a, b in zip(map(float, own), map(float, v))), i) for i, v, _ in rows if i != query)
    return [(i, -s) for s, i in found[:k]]


@pytest.fixture(scope="module")
def many():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=24)
    rows = [(i, unit(rng, 24, centre if i % 3 == 0 else None, 0.5 if i % 3 == 0 else 1.0), i % 4) for i in range(900)]
    # near copies and copies of one vector
    hot = unit(rng, 24)
    rows += [(900 + i, (np.array(hot) + rng.normal(size=24) * 1e-4).astype(np.float32).tolist(), 1) for i in range(150)]
    return rows + [(1100 + i, hot, 2) for i in range(60)]


def test_agreement_is_the_footrule():
    rng = np.random.default_rng(1)
    orders = np.array([rng.permutation(40)[:9] for _ in range(50)], np.int16)
    files, k = pivotindex.InvertedFiles(orders), 9
    places = [{int(p): j for j, p in enumerate(o)} for o in orders]
    for x in (0, 7):
        sums = files.agreement(orders[x])
        for y in range(50):
            foot = sum(abs(places[x].get(p, k) - places[y].get(p, k)) for p in places[x].keys() | places[y].keys())
            assert k * (k + 1) - 2 * sums[y] == foot


def test_search_finds_nine_of_ten(spark, many):
    index = pivotindex.build_index(table(spark, many))
    assert index.count() == len(many)
    found = pivotindex.search(index, index.where("id % 20 = 0"), 20)
    by = {}
    for r in found.collect():
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert by.keys() == {i for i, _, _ in many if i % 20 == 0}
    hits = 0
    for query, got in by.items():
        assert [r for r, _, _ in sorted(got)] == list(range(1, 21))
        want = exact(many, query, 20)
        worst = want[-1][1]
        hits += sum(s >= worst - 1e-9 for _, _, s in got)
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(sorted(got), sorted(got)[1:]))
        assert query not in {i for _, i, _ in got}
    assert hits >= 0.9 * 20 * len(by)


def test_copies_come_by_id(spark, many):
    index = pivotindex.build_index(table(spark, many))
    found = pivotindex.search(index, index.where("id = 1100"), 20).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [i for i, _ in exact(many, 1100, 20)]
    # of a query away from them, all 60 copies are as near: the smallest ids come first
    copies = pivotindex.search(index.where("id >= 1100 or id = 900"), index.where("id = 900"), 20).orderBy("rank").collect()
    assert [r.vec_id for r in copies] == list(range(1100, 1120)) and len({r.score for r in copies}) == 1


ODD = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 2), (6, [None, 1.0], 2), (7, [2.0, 1.0], None), (None, [1.0, 1.0], 1), (8, [], 2), (9, [1.0, 1.0, 1.0], 1), (10, [0.5, 0.5], 2), (10, [0.5, 0.5], 2), (20, [1.0, 0.0], 1)]


def test_search_on_odd_rows(spark):
    clash = table(spark, ODD).withColumns({c: F.lit("x") for c in ("id", "vec", "dim", "order", "cell", "score", "rank", "found")})
    index = pivotindex.build_index(clash)
    assert sorted(r.id for r in index.collect()) == [0, 1, 7, 9, 10, 20]
    found = {}
    for r in pivotindex.search(index, index, 20).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found[0] == [(7, 2.0), (20, 1.0), (1, 0.5), (10, 0.5)]
    assert 9 not in found
    empty = pivotindex.build_index(table(spark, []))
    assert pivotindex.search(empty, empty, 20).count() == 0


def mined(rows, modulus=100):
    """Brute force in whole numbers."""
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = (label, [math.floor(256 * x) for x in v])
    out = []
    for a, (label, v) in usable.items():
        if a % modulus:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in usable.items() if i != a and len(w) == len(v)}
        same = sorted((i for i in score if usable[i][0] == label), key=lambda i: (-score[i], i))[:5]
        for p in same:
            inside = [i for i in score if usable[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            for k, n in enumerate(sorted(inside, key=lambda i: (-score[i], i))[:10], 1):
                out.append((a, p, k, n, score[p], score[n]))
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 3e4, 1e7])
def test_negatives_equal_brute_force(spark, many, scale):
    rows = [(i, [float(np.float32(x * scale)) for x in v], label) for i, v, label in many]
    got = hardneg.mine(table(spark, rows), F.col("id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == mined(rows)


def test_negatives_on_odd_rows(spark):
    clash = table(spark, ODD).withColumns({c: F.lit("x") for c in ("id", "vec", "dim", "means", "deviations", "cell", "score", "positives", "found")})
    got = hardneg.mine(clash, F.col("id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == mined(ODD[:-2] + ODD[-1:], 10)
    assert hardneg.mine(table(spark, []), F.col("id") % 10 == 0).count() == 0


def test_huge_scores_are_the_nearest_long(spark):
    rows = [(0, [3e17, 1.0], 1), (1, [3e17, 1.0], 1), (2, [1e15, 1.0], 2)]
    (r,) = [r for r in hardneg.mine(table(spark, rows), F.col("id") == 0).collect()] or [None]
    assert r is None or (r.positive_score == 2**63 - 1 and r.negative_score <= 2**63 - 1)


def test_bounds_hold_and_leave_out_rows():
    rng = np.random.default_rng(2)
    vecs = np.floor(256 * rng.normal(size=(400, 50)) + rng.normal(size=(400, 1)) * 200)
    means, deviations = hardneg.summaries(vecs)
    rows = hardneg.Rows(pa.table({
        "id": np.arange(400), "label": np.zeros(400, int), "vec": pa.array(vecs.tolist()), "means": pa.array(means.tolist()), "deviations": pa.array(deviations.tolist()),
    }))
    width = []
    for a in (0, 17):
        score, norm = vecs @ vecs[a], float(np.linalg.norm(vecs[a]))
        for level in range(len(hardneg.LEVELS)):
            low, high = rows.bounds(level, np.arange(400), means[a], deviations[a], norm)
            assert (low <= score).all() and (score <= high).all()
            width.append(float((high - low).mean()))
    assert width[0] > width[1] > width[2]


def test_clustered_vectors_are_mostly_left_out():
    """The bounds, not the scores, decide on most rows where vectors have a few directions."""
    rng = np.random.default_rng(3)
    centres = np.repeat(rng.normal(size=(12, 16)), 8, axis=1)
    vecs = np.floor(256 * (centres[np.arange(1200) % 12] + 0.1 * rng.normal(size=(1200, 128))))
    means, deviations = hardneg.summaries(vecs)
    labels = np.arange(1200) % 5
    rows = hardneg.Rows(pa.table({"id": np.arange(1200), "label": labels, "vec": pa.array(vecs.tolist()), "means": pa.array(means.tolist()), "deviations": pa.array(deviations.tolist())}))
    scored, scores = [], rows.scores
    rows.scores = lambda at, v, norm: scored.append(len(at)) or scores(at, v, norm)
    for a in range(0, 1200, 100):
        found = hardneg.positives(rows, labels[a], a, vecs[a], means[a], deviations[a])
        exact = sorted((-int(vecs[a] @ vecs[i]), i) for i in range(1200) if i != a and labels[i] == labels[a])[:5]
        assert [(f["minus"], f["other"]) for f in found] == exact
    assert sum(scored) < 0.6 * 12 * 240


def test_every_pair_meets_once(spark, monkeypatch):
    monkeypatch.setattr(cells, "ROWS", 10)
    monkeypatch.setattr(cells, "ASKING", 7)
    rows, asking = spark.range(95).withColumn("dim", F.lit(1)), spark.range(33).withColumn("dim", F.lit(1))
    a, b, _ = cells.in_cells(rows, asking)
    pairs = a.withColumnRenamed("id", "row").join(b, "cell")
    assert pairs.count() == pairs.distinct().count() == 95 * 33
    assert max(r["count"] for r in a.groupBy("cell").count().collect()) < 40


def test_random_sizes(spark):
    rng, pick = np.random.default_rng(9), random.Random(3)
    for n in (1, 2, 21, 60):
        rows = [(i, unit(rng, pick.choice([3, 3, 5])), pick.randrange(3)) for i in range(n)]
        assert sorted(map(tuple, hardneg.mine(table(spark, rows), F.col("id") % 5 == 0).collect())) == mined(rows, 5)
        index = pivotindex.build_index(table(spark, rows))
        found = pivotindex.search(index, index.where("id % 20 = 0"), 20)
        same = lambda q: sum(len(v) == len(rows[q][1]) for _, v, _ in rows) - 1
        sizes = {r.query_id: r["count"] for r in found.groupBy("query_id").count().collect()}
        assert sizes == {q: min(20, same(q)) for q in range(0, n, 20) if same(q)}
