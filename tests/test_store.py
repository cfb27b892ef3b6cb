"""The point store, extraction of both levels from it, stored partitions, and what result files say of themselves."""

import random
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ionweave.operators import extract, joins, results
from ionweave.sources import library, points
from ionweave.sources.runs import parsed_runs

MS2 = "filename string, mz float, i float, rt float, polarity short, precursor_mz float, precursor_intensity float, collision_energy float"


def files_of(path):
    return sorted(p for p in path.rglob("*.parquet"))


def scanned(df):
    """Rows that the Parquet scans of a DataFrame hand on, after what they could skip."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()) if "Scan parquet" in leaves.apply(i).nodeName())


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    rng = random.Random(4)
    base = str(tmp_path_factory.mktemp("store"))
    rows = [(f"run{k % 5}", 100 + rng.random() * 900, rng.random() * 5, float(k), k % 2) for k in range(20_000)]
    points.write_points(spark.createDataFrame(rows, points.MS1_SCHEMA).repartition(6), base, points_per_group=500)
    scans = [(f"run{k % 5}", 50.0 + j, 10.0 * j, k / 100, k % 2, float("nan") if k % 7 == 0 else 100.0 + k, 5.0, 20.0) for k in range(400) for j in range(3)]
    points.write_points(spark.createDataFrame(scans, MS2), base, "ms2", points_per_group=500)
    return base, rows, scans


def test_bounds_skip_files_and_row_groups(spark, store, tmp_path):
    base, rows, _ = store
    found = points.scan_ms1_points(spark, base, 1, (300.0, 310.0))
    want = sorted(r[0] for r in rows if r[4] == 1 and 300 <= r[1] <= 310)
    assert sorted(r.filename for r in found.collect()) == want and len(want) > 50
    assert scanned(found) < 2500  # of 10,000 of this polarity
    groups = [pq.ParquetFile(f).metadata for f in files_of(Path(base) / "ms1")]
    assert max(m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)) <= 500
    assert found.columns == ["filename", "mz", "rt", "i"]


def test_a_store_lists_its_runs(spark, store):
    base, rows, scans = store
    listed = {(r.level, r.filename, r.polarity): r.n for r in points.stored_runs(spark, base).collect()}
    assert sum(n for (level, _, _), n in listed.items() if level == "ms1") == len(rows)
    assert listed["ms2", "run0", 0] == sum(s[0] == "run0" and s[4] == 0 for s in scans)
    assert scanned(points.stored_runs(spark, base).groupBy().count()) < 100


def test_polarity_or_level_that_is_not_stored_is_empty(spark, tmp_path):
    points.write_points(spark.createDataFrame([("r", 100.0, 1.0, 1.0, 1)], points.MS1_SCHEMA), str(tmp_path))
    assert points.scan_ms1_points(spark, str(tmp_path), 0, (1.0, 1000.0)).count() == 0
    assert points.scan_ms2_points(spark, str(tmp_path), 1).columns == [c for c in (f.split()[0] for f in MS2.split(", ")) if c != "polarity"]
    assert points.scan_ms2_points(spark, str(tmp_path), 1).count() == 0
    points.write_points(spark.createDataFrame([("s", 200.0, 1.0, 1.0, 1)], points.MS1_SCHEMA), str(tmp_path))
    assert points.scan_ms1_points(spark, str(tmp_path), 1).count() == 2


def listing(spark, names):
    return spark.createDataFrame([(n, p, f) for n, p, f in names], "filename string, polarity string, file_format string")


@pytest.fixture(scope="module")
def targets(spark):
    atlas = spark.createDataFrame([(f"t{k}", f"key{k}", 100.0 + 3 * k, 1.0, 2.0) for k in range(100)], "mz_rt_uid string, inchi_key string, mz double, rt_min double, rt_max double")
    return joins.expand_atlas_windows(atlas, ppm=200.0)


def test_extraction_of_both_levels(spark, store, targets):
    base, rows, scans = store
    runs = listing(spark, [("run0", "pos", "h5"), ("run1", "fps", "h5"), ("run2", "neg", "h5"), ("run9", "pos", "mzML")])
    found = extract.extract_all_runs(spark, base, runs, targets)
    ms1, ms2 = extract.of_level(found, 1), extract.of_level(found, 2)
    windows = [(r.mz_rt_uid, r.mz_min, r.mz_max) for r in targets.collect()]
    hits = lambda mz: [u for u, lo, hi in windows if lo <= np.float32(mz) <= hi]
    want1 = sorted((u, r[0], r[3]) for r in rows if r[0] in ("run0", "run1") and r[4] == 1 for u in hits(r[1]))
    want2 = sorted((u, s[0], s[1], s[2]) for s in scans if s[0] in ("run0", "run1") and s[4] == 1 and s[5] == s[5] for u in hits(s[5]))
    assert sorted((r.mz_rt_uid, r.filename, r.i) for r in ms1.collect()) == want1 and len(want1) > 30
    assert sorted((r.mz_rt_uid, r.filename, r.frag_mz, r.frag_int) for r in ms2.collect()) == want2 and len(want2) > 9
    assert not {"precursor_mz", "frag_mz"} & set(ms1.columns) and {"precursor_mz", "frag_mz", "scan_rt"} <= set(ms2.columns)
    # the wide forms take them as they are
    assert extract.widen_ms2(ms2).count() == len({(w[0], w[1], s[3]) for s in scans if s[4] == 1 and s[0] in ("run0", "run1") and s[5] == s[5] for w in [(u, s[0]) for u in hits(s[5])]})
    assert extract.extract_all_runs(spark, base, runs, targets, only_in_feature=True).where("not in_feature").count() == 0
    negative = extract.extract_all_runs(spark, base, runs, targets, "NEG")
    assert {r.filename for r in negative.select("filename").distinct().collect()} == {"run2"}


def test_runs_without_points_are_named(spark, store, targets):
    runs = listing(spark, [("run0", "pos", "h5"), ("lost1", "pos", "h5"), ("lost2", "neg", "h5")])
    with pytest.raises(FileNotFoundError, match="lost1"):
        extract.extract_all_runs(spark, store[0], runs, targets)
    with pytest.raises(FileNotFoundError, match="lost2"):
        extract.extract_all_runs(spark, store[0], runs, targets, "NEG")


def test_run_names_lead_to_extraction(spark, tmp_path, targets):
    name = "20240101_JGI_PI_505162_Proj_final_IDX_HILICZ_USX1_POS_MS2_1_groupA_1_Rg_Run1.h5"
    points.write_points(spark.createDataFrame([(name, 103.0, 1.5, 7.0, 1)], points.MS1_SCHEMA), str(tmp_path))
    runs = parsed_runs(spark.createDataFrame([(f"/data/{name}", name)], "path string, filename string"))
    (r,) = extract.extract_all_runs(spark, str(tmp_path), runs, targets).collect()
    assert (r.mz_rt_uid, r.ms_level, r.in_feature) == ("t1", 1, True)


def test_done_partitions_are_listed_not_read(spark, tmp_path):
    base, keys = str(tmp_path / "done"), ["project", "analysis"]
    wanted = spark.createDataFrame([("a b/c", 1), ("a b/c", 2), ("d", 1), (None, 3)], "project string, analysis int")
    assert points.skip_done(wanted, base, keys).count() == 4
    wanted.where("analysis <> 2").withColumn("x", F.lit(1)).write.partitionBy(*keys).parquet(base)
    # files that no reader could open: only their names count
    for f in files_of(tmp_path / "done"):
        f.write_bytes(b"not parquet")
    assert [tuple(r) for r in points.skip_done(wanted, base, keys).collect()] == [("a b/c", 2)]
    (tmp_path / "done/project=e/analysis=1").mkdir(parents=True)
    assert points.skip_done(spark.createDataFrame([("e", 1)], wanted.schema), base, keys).count() == 1


def test_each_analysis_keeps_its_provenance(spark, tmp_path):
    base = str(tmp_path)
    project = "20240101_JGI_PI_505162_Proj_final_IDX_HILICZ_USX1"
    values = {"project_name": project, "chromatography": "HILICZ", "polarity": "POS", "analysis_type": "EMA", "analysis_name": "main"}
    df = results.conform(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "mz_rt_uid string, atlas_mz double"), "compound_file")
    results.write_result_datasets({"compound_file": df}, base, values, provenance={"analysis_number": 1, "rt_alignment_number": 3})
    results.write_result_datasets({"compound_file": df.limit(1)}, base, values | {"polarity": "NEG"}, provenance={"analysis_number": 2})
    read = lambda polarity: results.result_footer_fields(spark, base, "compound_file", values | {"polarity": polarity}).collect()
    (pos,), (neg,) = read("POS"), read("NEG")
    assert (pos.analysis_number, pos.rt_alignment_number, pos.n_rows, pos.polarity, pos.project_id) == ("1", "3", 2, "POS", "505162") and pos.created_date
    assert (neg.analysis_number, neg.n_rows, neg.polarity) == ("2", 1, "NEG")
    assert read("FPS") == []
    # any reader finds it in a file's footer
    file = files_of(tmp_path / "compound_file")[0]
    assert b'"analysis_number"' in pq.ParquetFile(file).schema_arrow.metadata[b"org.apache.spark.sql.parquet.row.metadata"]
    # not overwritten, and written again without: the new files have none
    results.write_result_datasets({"compound_file": df}, base, values, overwrite=False, provenance={"analysis_number": 9})
    assert read("POS")[0].analysis_number == "1"
    results.write_result_datasets({"compound_file": df}, base, values)
    assert read("POS") == [] and read("NEG")[0].analysis_number == "2"
    other = results.provenance_fields(spark, values | {"project_name": "odd"}, {})
    assert other["project_name"] == "odd" and "project_id" not in other


def test_schema_maps_as_json_and_csv(spark, tmp_path):
    values = dict.fromkeys(results.PARTITIONS, "v")
    df = results.conform(spark.createDataFrame([("a", 1.0)], "mz_rt_uid string, atlas_mz double"), "compound_lfc")
    results.write_result_datasets({"compound_lfc": df}, str(tmp_path), values)
    name = str(tmp_path / "schema_maps/v-compound_lfc.schema_map")
    as_json, as_csv = spark.read.json(f"{name}.json"), spark.read.csv(f"{name}.csv", header=True)
    columns = ["name", "dtype", "table", "position", "source"]
    assert as_csv.columns == columns
    rows = [tuple(map(str, r)) for r in as_csv.collect()]
    assert rows == [tuple(map(str, r)) for r in as_json.select(columns).collect()] and rows == sorted(rows)
    assert len(rows) == len(df.columns) + len(results.PARTITIONS) and {r[4] for r in rows} == {"stored", "partition_directory"}


def test_row_groups_of_results_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(results, "ROWS_PER_GROUP", 100)
    df = spark.range(950).select(F.col("id").cast("string").alias("mz_rt_uid"), F.col("id").cast("double").alias("atlas_mz"))
    values = dict.fromkeys(results.PARTITIONS, "v")
    results.write_result_datasets({"compound_lfc": results.sort_for_pruning(results.conform(df, "compound_lfc"), ["atlas_mz"]).coalesce(1)}, str(tmp_path), values)
    (file,) = files_of(tmp_path / "compound_lfc")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups == 10 and meta.row_group(0).num_rows == 100


def test_a_library_with_nothing_left_is_an_error(spark, tmp_path):
    (tmp_path / "library.json").write_text('{"id": "1", "database": "db", "inchi_key": "K", "polarity": "pos", "precursor_mz": 100.0, "mz": [50.0], "intensities": [1.0]}\n')
    path = str(tmp_path / "library.json")
    assert library.scan_reference_spectra(spark, path, polarity="positive").count() == 1
    for asked in ({"polarity": "neg"}, {"database": "other"}, {"keys": spark.createDataFrame([("J",)], "inchi_key string")}):
        with pytest.raises(ValueError, match="no spectra are left"):
            library.scan_reference_spectra(spark, path, **asked)


def test_a_stamp_changes_with_the_files(spark, tmp_path):
    from ionweave.sources.scratch import stamp

    spark.range(5).write.parquet(str(tmp_path / "t"))
    first = stamp(spark, str(tmp_path / "t"))
    assert first == stamp(spark, str(tmp_path / "t"))
    spark.range(6).write.mode("append").parquet(str(tmp_path / "t"))
    assert first != stamp(spark, str(tmp_path / "t"))
