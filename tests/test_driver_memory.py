"""Large targets stay off the driver, whatever Spark estimates them at by the size of their files."""

import os

import pytest
from pyspark.sql import functions as F

from ionweave.operators import joins, rtmodel, summary
from ionweave.plans import catalog
from ionweave.plans.views import view

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def targets_and_points(spark):
    targets = joins.expand_atlas_windows(spark.range(300).selectExpr("concat('u', id) as mz_rt_uid", "100.0 + id % 50 as mz", "0.0 as rt_min", "1.0 as rt_max"))
    return targets, spark.range(2000).selectExpr("cast(100 + id % 60 as float) as m", "cast(id as float) as rt")


def test_shuffled_targets_are_not_broadcast_all_the_same(spark, monkeypatch):
    targets, points = targets_and_points(spark)
    want = sorted(joins.interval_join(points, targets, "m", "mz_min", "mz_max").select("rt", "mz_rt_uid").collect())
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    for how in ("inner", "left_semi"):
        met = joins.interval_join(points, targets, "m", "mz_min", "mz_max", how)
        assert "Broadcast" not in plan(met) and "SortMergeJoin" in plan(met)
    assert sorted(joins.interval_join(points, targets, "m", "mz_min", "mz_max").select("rt", "mz_rt_uid").collect()) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_views_of_many_targets_are_not_broadcast_by_estimate(spark):
    atlas, curation = view(spark, SF, "atlas"), view(spark, SF, "curation")
    assert "Broadcast" not in plan(curation)
    some = spark.range(500).select(F.concat(F.lit("mzrt-"), "id").alias("mz_rt_uid"), "id")
    assert "Broadcast" not in plan(some.repartition(4).join(atlas.select("mz_rt_uid", "mz"), "mz_rt_uid"))
    # a hint of their own goes before
    assert "BroadcastHashJoin" in plan(some.join(F.broadcast(atlas.select("mz_rt_uid", "mz")), "mz_rt_uid"))


def test_written_tables_are_not_broadcast_by_the_size_of_their_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(summary, "scratch", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(catalog, "scratch", lambda _, name: str(tmp_path / name))
    rows = spark.range(500).select(F.concat(F.lit("mzrt-"), "id").alias("mz_rt_uid"), "id")
    index = summary.compound_index(rows, ["id"])
    stored = catalog.Views(spark, str(tmp_path)).stored("rows", lambda: rows)
    other = spark.range(400).select(F.concat(F.lit("mzrt-"), "id").alias("mz_rt_uid")).repartition(4)
    for table in (index.select("mz_rt_uid", "compound_index"), stored):
        met = other.join(table, "mz_rt_uid")
        assert "SortMergeJoin" in plan(met) and met.count() == 400
    assert "mz_rt_uid" not in "".join(line for line in plan(other.join(stored, "mz_rt_uid")).splitlines() if "Broadcast" in line)
    assert sorted(index.select("id", "compound_index").collect()) == [(i, i + 1) for i in range(500)]


def test_ids_of_large_targets_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(rtmodel, "SKETCHED", 3)
    monkeypatch.setattr(rtmodel, "HASHES", 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.range(3000).selectExpr("concat('u', id % 100 + if(id % 7 = 0, 1000, 0)) as mz_rt_uid", "cast(id * 37 % 101 as float) as rt", "100f as mz", "cast(id as float) as i", "true as in_feature", "1.0D as rt_peak", "100.0D as atlas_mz")
        rows = rows.union(spark.range(3).selectExpr("'small' as mz_rt_uid", "cast(id as float)", "100f", "1f", "true", "1.0D", "100.0D")).repartition(4)
        stats = rtmodel.rt_stats(rows)
        # hashes of a text are numbers
        assert "BroadcastMode(List(input[0, string" not in plan(stats)
        want = rows.groupBy("mz_rt_uid").agg(F.median(F.col("rt").cast("double")), F.median(F.col("i").cast("double")))
        assert sorted(stats.select("mz_rt_uid", "rt_median", "intensity_median").collect()) == sorted(want.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


#: Queries on the range join of points or scans to targets.
SHUFFLED = (
    "extract_all_runs",
    "filter_ms1_groups",
    "filter_ms2_groups",
    "group_means",
    "hit_threshold",
    "impute_global_min",
    "join_ms1_to_atlas",
    "join_ms2_to_atlas",
    "keep_in_feature",
    "keys_without_refs",
    "log_fold_change",
    "lookup_ms2",
    "melt_lfc",
    "ms1_window_metrics",
    "ms2_candidates",
    "mz_quality",
)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", SHUFFLED)
def test_large_targets_of_a_query_are_shuffled(spark, monkeypatch, name):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(catalog.Views, "stored", lambda self, _, make: make())
    text = plan(catalog.QUERIES[name](spark, SF))
    met = [line for line in text.splitlines() if "Join" in line and "__bin" in line]
    assert met and all("SortMergeJoin" in line for line in met)
