"""Points of targets as slices, against the table of pairs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ionweave.operators import curation, extract, joins, slices, traces
from ionweave.plans import catalog

SF = "/root/testdata/sf0.001"


def tables(spark, seed, wide=False, twice=False):
    rng = random.Random(seed)
    number = lambda x, odd: rng.choice([None, float("nan")]) if rng.random() < odd else x
    points = [(rng.choice(["a.h5", "b.h5", "c.h5"]), number(rng.choice([100.0, rng.uniform(90, 900), rng.uniform(100, 101)]), 0.05), number(rng.uniform(0, 5), 0.05), number(rng.uniform(0, 9), 0.05)) for _ in range(800)]
    uids = [f"u{k % (50 if twice else 60)}" for k in range(60)]
    targets = [(u, at := rng.choice([100.0, rng.uniform(95, 850)]), at + (rng.uniform(0, 0.6) if k or not wide else 300.0), number(rng.uniform(0, 3), 0.1), rng.uniform(2, 6)) for k, u in enumerate(uids)]
    # one without points, one the wrong way round, one without bounds
    targets += [("far", 5000.0, 5000.1, 0.0, 9.0), ("turned", 300.0, 299.0, 0.0, 9.0), ("none", None, 100.0, 0.0, 9.0)]
    return spark.createDataFrame(points, "filename string, mz float, rt float, i float"), spark.createDataFrame(targets, "mz_rt_uid string, mz_min float, mz_max float, rt_min_pad float, rt_max_pad float")


@pytest.mark.parametrize("shape", ["plain", "wide", "twice", "shuffled"])
def test_slices_hold_the_points_of_the_pairs(spark, monkeypatch, shape):
    if shape == "shuffled":
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(slices, "POINTS", 40)
    points, targets = tables(spark, 3, shape == "wide", shape == "twice")
    text = lambda df: sorted((r.mz_rt_uid, r.filename, str(r.points)) for r in df.collect())
    want = text(extract.widen_ms1(joins.join_ms1_to_atlas(points, targets)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "53")
    try:
        assert text(extract.extract_wide_ms1(points, targets)) == want and len(want) > 50
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_slices_of_nothing(spark):
    points, targets = tables(spark, 3)
    assert extract.extract_wide_ms1(points, targets.where("false")).count() == 0 == extract.extract_wide_ms1(points.where("false"), targets).count()


@pytest.mark.parametrize("shape", ["plain", "wide", "twice", "crowded", "odd"])
def test_traces_of_cells_are_those_of_the_pairs(spark, monkeypatch, shape):
    points, targets = tables(spark, 4, shape == "wide", shape == "twice")
    points = points.where("rt is not null and not isnan(rt) and i is not null and not isnan(i)")
    # some points of one rt
    points = points.withColumn("rt", F.round("rt", 1).cast("float"))
    targets = targets.withColumns({"rt_peak": F.lit(2.0), "rt_min": F.lit(0.5), "rt_max": F.lit(4.0)}).repartition(3)
    if shape == "crowded":
        monkeypatch.setattr(curation, "CELL_POINTS", 60)
    if shape == "odd":
        points = points.union(spark.createDataFrame([("a.h5", 100.0, 1.0, None)], points.schema))
    monkeypatch.setattr(traces, "POINTS", 30)
    of = ("rt_peak", "rt_min", "rt_max")
    first, rest = curation.extract_traces(points, targets, of)
    assert (rest is None) == (shape in ("plain", "wide"))
    # a target's rows stand together by rt
    stood = first.withColumn("at", F.monotonically_increasing_id()).orderBy("at").select("mz_rt_uid", "rt").collect()
    starts = [r.mz_rt_uid for k, r in enumerate(stood) if not k or stood[k - 1].mz_rt_uid != r.mz_rt_uid]
    assert len(starts) == len(set(starts)) > 3 and all(a.rt < b.rt for a, b in zip(stood, stood[1:]) if a.mz_rt_uid == b.mz_rt_uid)
    text = lambda df: sorted((r.mz_rt_uid, r.rt, round(r.max_i, 6), round(r.mean_i, 6)) for r in df.select("mz_rt_uid", "rt", "max_i", "mean_i").collect())
    whole = curation.eic_traces(joins.join_ms1_to_atlas(points, targets))
    both = first.drop(*of) if rest is None else first.drop(*of).unionByName(rest)
    assert text(both) == text(whole)
    bounds = lambda df: sorted((r.mz_rt_uid, *(round(x, 6) for x in r[1:])) for r in df.collect())
    if rest is None:
        want = bounds(curation.suggest_rt_bounds(whole, targets))
        assert bounds(curation.suggest_rt_bounds(first, None)) == want and want


SLICED = ("widen_ms1", "keep_in_feature", "eic_traces", "suggest_rt_bounds")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", SLICED)
def test_pairs_are_not_shuffled(spark, name):
    text = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "Exchange" not in text[: text.index("MapInArrow")]
