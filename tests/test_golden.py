"""Small cases with known answers."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionweave.functions import names, scores, values
from ionweave.operators import atlas, curation, extract, joins, results, rtmodel, spectra, summary
from ionweave.sources import library, runs


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def targets(spark, rows):
    df = spark.createDataFrame(rows, "mz_rt_uid string, mz double, rt_peak double, rt_min double, rt_max double, inchi_key string, adduct string, compound_name string, compound_uid string")
    return df


ADENINE = ("a", 136.062, 2.68, 1.93, 3.43, "GFFGJBXGBJISGV-UHFFFAOYSA-N", "[M+H]+", "adenine", "c1")
RIBOFLAVIN = ("b", 377.146, 4.56, 3.81, 5.31, "AUNGANRZJHBGPY-SCRDCRAPSA-N", "[M+H]+", "riboflavin", "c2")


def test_interval_join_is_inclusive_and_ignores_nan(spark):
    t = spark.createDataFrame([("a", 136.061, 136.063), ("b", 136.0625, 140.0), ("c", 377.1, 377.2)], "id string, lo double, hi double")
    p = spark.createDataFrame([(136.061,), (136.062,), (136.063,), (377.15,), (200.0,), (float("nan"),), (None,)], "mz double")
    found = sorted((r.mz, r.id) for r in joins.interval_join(p, t, "mz", "lo", "hi").collect())
    assert found == [(136.061, "a"), (136.062, "a"), (136.063, "a"), (136.063, "b"), (377.15, "c")]
    assert joins.interval_join(p, t.limit(0), "mz", "lo", "hi").count() == 0
    assert joins.interval_join(p.limit(0), t, "mz", "lo", "hi").count() == 0


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, -1])
def test_bin_join_equals_nested_loop(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    rng = np.random.default_rng(3)
    p = spark.createDataFrame([(float(x),) for x in rng.uniform(0, 50, 400)], "mz double")
    t = spark.createDataFrame([(i, float(a), float(a + w)) for i, (a, w) in enumerate(zip(rng.uniform(0, 50, 60), rng.uniform(0, 3, 60)))], "id int, lo double, hi double")
    nested = p.crossJoin(t).where("mz between lo and hi")
    assert sorted(joins.interval_join(p, t, "mz", "lo", "hi").select("mz", "id").collect()) == sorted(nested.select("mz", "id").collect())


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, -1])
def test_a_wide_target_has_bins_of_its_own(spark, monkeypatch, limit):
    """One target of 100 Da among narrow ones, and one of no width: rows as in a nested loop, narrow bins stay narrow."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(joins, "CROWDED", 1)
    p = spark.range(3000).select((100 + F.col("id") * 0.1).cast("float").alias("mz"), (F.col("id") % 7).cast("float").alias("rt"))
    narrow = spark.range(2000).select(F.col("id"), (100 + F.col("id") * 0.15).cast("float").alias("mz_min"), (100.001 + F.col("id") * 0.15).cast("float").alias("mz_max"))
    wide = spark.createDataFrame([(9001, 150.0, 250.0), (9002, 130.0, 130.0), (9003, 160.0, 159.0), (9004, 200.0, 205.0)], "id long, mz_min float, mz_max float")
    t = narrow.union(wide).withColumns({"rt_min_pad": F.lit(1.0).cast("float"), "rt_max_pad": F.lit(4.0).cast("float")})
    bins = joins.Bins(t, "mz_min", "mz_max")
    assert len(bins.levels) >= 2 and bins.levels[0][0] == 100 and bins.levels[-1][0] < 0.01
    nested = p.crossJoin(F.broadcast(t)).where("mz between mz_min and mz_max")
    columns = ["mz", "rt", "id"]
    got = joins.interval_join(p, t, "mz", "mz_min", "mz_max")
    assert got.columns == p.columns + t.columns
    assert sorted(got.select(columns).collect()) == sorted(nested.select(columns).collect())
    semi = joins.interval_join(p, t, "mz", "mz_min", "mz_max", "left_semi")
    assert semi.columns == p.columns and sorted(semi.collect()) == sorted(nested.select("mz", "rt").distinct().collect())
    kept = joins.subset_points_to_windows(p, t)
    assert kept.columns == p.columns and sorted(kept.collect()) == sorted(nested.where("rt between rt_min_pad and rt_max_pad").select("mz", "rt").distinct().collect())


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, -1])
def test_joins_with_a_hot_bin_equal_nested_loops(spark, monkeypatch, limit):
    """A third of all points have one m/z, and some rows are there twice."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    rng = np.random.default_rng(4)
    mz = [*rng.uniform(100, 120, 200), *[110.0] * 100]
    rows = [("f", float(m), float(r), 1.0) for m, r in zip(mz, rng.uniform(0, 9, 300))]
    p = spark.createDataFrame(rows + rows[:3] + rows[-3:], "filename string, mz float, rt float, i float")
    t = [(f"u{k}", float(m), float(m + w), float(r), float(r + 2)) for k, (m, w, r) in enumerate(zip([*rng.uniform(100, 120, 30), 109.9], [*rng.uniform(0, 1, 30), 0.2], rng.uniform(0, 7, 31)))]
    w = spark.createDataFrame(t, "mz_rt_uid string, mz_min float, mz_max float, rt_min_pad float, rt_max_pad float")
    nested = p.crossJoin(w).where("mz between mz_min and mz_max")
    inside = nested.where("rt between rt_min_pad and rt_max_pad")
    got = joins.join_ms1_to_atlas(p, w)
    columns = ["mz_rt_uid", "mz", "rt"]
    assert sorted(got.select(columns).collect()) == sorted(nested.select(columns).collect())
    assert sorted(got.where("in_feature").select(columns).collect()) == sorted(inside.select(columns).collect())
    semi = joins.interval_join(p, w, "mz", "mz_min", "mz_max", "left_semi")
    assert semi.columns == p.columns and sorted(semi.collect()) == sorted(p.join(nested.select("mz", "rt").distinct(), ["mz", "rt"]).select(p.columns).collect())
    kept = joins.subset_points_to_windows(p, w)
    assert kept.columns == p.columns and sorted(kept.collect()) == sorted(p.join(inside.select("mz", "rt").distinct(), ["mz", "rt"]).select(p.columns).collect())


def test_ms1_join_flags_and_drops(spark):
    w = joins.expand_atlas_windows(targets(spark, [ADENINE]))
    p = spark.createDataFrame([("f", 136.062, 2.7, 10.0), ("f", 136.062, 99.0, 10.0)], "filename string, mz float, rt float, i float")
    assert sorted(r.in_feature for r in joins.join_ms1_to_atlas(p, w).collect()) == [False, True]
    assert joins.join_ms1_to_atlas(p, w, only_in_feature=True).count() == 1
    m = spark.createDataFrame([("f", v, 2.7) for v in (136.062, 0.0, float("nan"))], "filename string, precursor_mz float, scan_rt float")
    assert joins.join_ms2_to_atlas(m, w).count() == 1


def test_group_filter_bypass(spark):
    rows = spark.createDataFrame([("a", "f", 1.0, False), ("b", "f", 9.0, True)], "mz_rt_uid string, filename string, i float, in_feature boolean")
    count = lambda *a: extract.filter_ms1_groups(rows, *a).count()
    assert (count(None, None), count(0, 0), count(0, None), count(1, 5.0), count(1, 50.0)) == (2, 2, 1, 1, 0)


def test_metrics_of_a_triangle(spark):
    rows = spark.createDataFrame([("a", "f", 1.0, 100.0, 0.0, True), ("a", "f", 2.0, 100.0, 10.0, True), ("a", "f", 3.0, 100.0, 0.0, True), ("b", "f", 1.0, 100.0, 0.0, True)], "mz_rt_uid string, filename string, rt float, mz float, i float, in_feature boolean")
    got = {r.mz_rt_uid: r for r in extract.per_file_peak_metrics(rows).collect()}
    assert (got["a"].peak_height, got["a"].peak_area, got["a"].rt_peak, got["a"].rt_centroid) == (10.0, 10.0, 2.0, 2.0)
    assert got["b"].peak_height is None and got["b"].peak_area is None


def test_best_assignment_beats_greedy_and_equals_brute_force():
    assert sorted(spectra.best_assignment(np.array([[4.0, 0.0], [6.0, 5.7]]))) == [(0, 0), (1, 1)]
    rng = np.random.default_rng(5)
    for _ in range(60):
        w = rng.uniform(0, 1, rng.integers(1, 5, 2)) * (rng.uniform(0, 1, 1) < 0.9)
        small, large = sorted(w.shape)
        m = w if w.shape[0] == small else w.T
        best = max(sum(m[i, c] for i, c in enumerate(p)) for p in itertools.permutations(range(large), small))
        assert sum(w[i, j] for i, j in spectra.best_assignment(w)) == pytest.approx(best)


def spectrum_tables(spark, query, ref):
    q = spark.createDataFrame([(1, float(m), float(i)) for m, i in query], "scan_id long, frag_mz float, frag_int float")
    r = spark.createDataFrame([(7, float(m), float(i)) for m, i in ref], "ref_id long, ref_mz float, ref_int float")
    return spark.createDataFrame([(1, 7)], "scan_id long, ref_id long"), q, r


def test_cosine_of_equal_and_ambiguous_spectra(spark):
    peaks = [(94.04, 1e4), (119.04, 5e4), (136.06, 2e5)]
    c, q, r = spectrum_tables(spark, peaks, peaks)
    got = spectra.cosine_match(spectra.match_spectra(c, q, r)).first()
    assert got.score == pytest.approx(1.0) and got.num_matches == 3
    c, q, r = spectrum_tables(spark, [(100.0, 2), (100.04, 3)], [(100.02, 2), (100.06, 1.9)])
    pairs = spectra.assigned_pairs(spectra.match_spectra(c, q, r))
    assert pairs.agg(F.sum("w")).first()[0] == pytest.approx(4 + 5.7, rel=1e-6)
    aligned = spectra.align_spectra(pairs, q, r).first()
    assert aligned.num_matched == 2 and len(aligned.aligned) == 2


def test_no_pair_beyond_the_tolerance(spark):
    c, q, r = spectrum_tables(spark, [(136.06, 1)], [(136.12, 1)])
    assert spectra.peak_pair_join(c, q, r, 0.05).count() == 0
    assert spectra.peak_pair_join(c, q, r, 0.1).count() == 1


def test_candidates_need_a_near_precursor(spark):
    s = spark.createDataFrame([(1, "K", 136.062)], "scan_id long, inchi_key string, precursor_mz double")
    r = spark.createDataFrame([(1, "K", 136.062), (2, "K", 146.062), (3, "K", None), (4, "L", 136.062)], "ref_id long, inchi_key string, ref_precursor_mz double")
    assert [x.ref_id for x in spectra.ms2_candidates(s, r, 5).collect()] == [1]
    assert spectra.ms2_candidates(s, r, None).count() == 3


def test_a_large_block_of_isomers_is_linear(spark):
    """100,000 targets of one structure: a row for each and one for the block; pairs for the target that is asked for."""
    t = spark.range(100_000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("mz_rt_uid"), (100 + F.col("id").cast("double")).alias("mz"), F.lit("BLOCK-X").alias("inchi_key"), F.lit("n").alias("compound_name"), F.lit("a").alias("adduct"))
    members, blocks = atlas.isomer_blocks(t)
    assert [tuple(r) for r in blocks.collect()] == [("BLOCK", 100_000)] and members.count() == 100_000
    one = spark.createDataFrame([("u5",), ("gone",)], "mz_rt_uid string")
    assert atlas.isomers_of(t, one).count() == 99_999
    found = {r.mz_rt_uid: len(r.isomers) for r in atlas.isomer_pairs(t.limit(50), wanted=one).collect()}
    assert found == {"u5": 49, "gone": 0}


def test_compound_index_counts_over_ranges(spark):
    t = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("place"), F.lit("x").alias("x"))
    got = {r.place: r.compound_index for r in summary.compound_index(t, [F.desc("place")]).collect()}
    assert got == {p: 1000 - p for p in range(1000)}
    assert summary.compound_index(t, ["place"]).columns == ["place", "x", "compound_index"]
    assert summary.compound_index(t.limit(0), ["place"]).count() == 0


def test_rt_model_finds_a_polynomial(spark):
    x = np.linspace(0.5, 12, 40)
    rows = [(f"t{i}", float(v), float(0.3 + 1.01 * v - 0.004 * v * v), 3) for i, v in enumerate(x)]
    stats = spark.createDataFrame(rows, "mz_rt_uid string, atlas_rt_peak double, rt_median double, observation_count long")
    model = rtmodel.fit_rt_model(stats)
    assert model["coefficients"] == pytest.approx([0.3, 1.01, -0.004], abs=1e-8) and model["r2"] > 0.999999
    with pytest.raises(ValueError, match="No compounds"):
        rtmodel.fit_rt_model(stats.limit(0))
    with pytest.raises(ValueError, match="Insufficient"):
        rtmodel.fit_rt_model(stats.limit(1))


def test_rt_model_application(spark):
    t = targets(spark, [ADENINE])
    r = rtmodel.apply_rt_model(t, [0.2, 1.0]).first()
    assert r.rt_peak == pytest.approx(2.88)
    r = rtmodel.apply_rt_model(t, [0.2, 1.0], on_bounds=False).first()
    assert r.rt_max - r.rt_min == pytest.approx(1.5)
    assert rtmodel.apply_rt_model(t, [0.0, -1.0]).first().rt_peak > 0
    assert rtmodel.rt_shift_summary(rtmodel.apply_rt_model(t.limit(0), [0.0, 1.0])).count() == 0


def test_suggested_bounds_of_a_gaussian():
    x = np.linspace(4, 6, 50)
    low, high, peak, _ = curation.suggested_bounds(x, 1e5 * np.exp(-((x - 5) ** 2) / (2 * 0.15**2)), 5.0, 4.5, 5.5)
    assert abs(peak - 5) < 0.3 and low < peak < high
    x = np.linspace(4, 6, 100)
    assert curation.suggested_bounds(x, 1e5 * np.exp(-((x - 5) ** 2) / (2 * 0.1**2)), 5.0, 4.5, 5.5)[3] > 0.3
    assert curation.suggested_bounds(x[:4], np.ones(4), 5.0, 4.5, 5.5) is None
    assert curation.suggested_bounds(x, np.zeros(100), 5.0, 4.5, 5.5) is None


def test_traces_interpolate(spark):
    rows = spark.createDataFrame([("a", "f", 1.0, 10.0), ("a", "f", 3.0, 30.0), ("a", "g", 2.0, 4.0)], "mz_rt_uid string, filename string, rt float, i float")
    assert {r.rt: (r.max_i, r.mean_i) for r in curation.eic_traces(rows).collect()} == {1.0: (10, 5), 2.0: (20, 12), 3.0: (30, 15)}


def test_traces_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for t, files in (("a", 6), ("b", 1), ("c", 3)):
        for f in range(files):
            # unlike spans, gaps, repeated rt and files of one point
            x = rng.choice(np.linspace(1, 3, 41) + f / 500 * (f % 2), 1 if f == 5 else int(rng.integers(4, 30)))
            rows += [(t, f"f{f}", float(v), float(rng.integers(0, 1000))) for v in x]
    df = spark.createDataFrame(rows, "mz_rt_uid string, filename string, rt float, i float")
    got = {(r.mz_rt_uid, r.rt): (r.max_i, r.mean_i) for r in curation.eic_traces(df.repartition(5)).collect()}
    want = {}
    for t in "abc":
        files: dict = {}
        for u, f, x, i in rows:
            if u == t:
                own = files.setdefault(f, {})
                own[float(np.float32(x))] = max(i, own.get(float(np.float32(x)), 0.0))
        for g in {x for own in files.values() for x in own}:
            v = [np.interp(g, sorted(own), [own[x] for x in sorted(own)], left=0, right=0) for own in files.values()]
            want[t, g] = max(v), sum(v) / len(v)
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6)


def test_rt_stats_with_a_sketch_are_near_the_exact_ones(spark):
    rng = np.random.default_rng(6)
    rows = [(u, 100.0, 2.0, "K", float(rng.normal(2, 0.1)), 100.0, float(rng.lognormal(8)), True) for u in ("a", "b") for _ in range(2001)]
    df = spark.createDataFrame(rows, "mz_rt_uid string, atlas_mz double, rt_peak double, inchi_key string, rt float, mz double, i float, in_feature boolean")
    exact, near = ({r.mz_rt_uid: r for r in rtmodel.rt_stats(df, accuracy=a).collect()} for a in (None, 1000))
    for u in ("a", "b"):
        assert near[u].rt_median == pytest.approx(exact[u].rt_median, abs=2e-3)
        assert exact[u].rt_diff_median == pytest.approx(exact[u].rt_median - 2.0, abs=1e-9) and near[u].rt_mean == pytest.approx(exact[u].rt_mean)


def test_quality_edges(spark):
    q = lambda p, d: one(spark, scores.mz_quality(F.lit(p).cast("double"), F.lit(d).cast("double")))
    assert [q(5.0, 1.0), q(-5.0, 1.0), q(50.0, 0.0015), q(10.0, 1.0), q(10.1, 1.0), q(None, 1.0)] == [1.0, 1.0, 1.0, 0.5, 0.0, None]
    t = lambda e, c: one(spark, scores.rt_quality(F.lit(e).cast("double"), F.lit(c)))
    assert [t(0.25, "C18"), t(0.5, "C18"), t(0.51, "C18"), t(0.5, "HILIC"), t(2.0, "HILIC"), t(2.1, "HILIC"), t(0.5, "C18-lipid")] == [1.0, 0.5, 0.0, 1.0, 0.5, 0.0, 1.0]


def test_msi_levels(spark):
    m = lambda *x: one(spark, scores.msi_level(*(F.lit(v).cast("double") for v in (x[1], x[2], x[0]))))
    assert m(1, 1, 1) == "Exceeds Level 1" and m(1, 1, 0.5) == "Level 1" and m(0.5, 0.5, 0.5) == "putative"
    assert m(-1, 1, 1).startswith("REMOVE") and m(None, None, None) == "putative" and m(1, 1, None) == "Level 1" and m(0, 0, 0) == "putative"


def test_names(spark):
    f = one(spark, names.parse_run_filename(F.lit("20240101_JGI_PI_505162-1_P_final_IDX_C18-EP_U1_FPS_MSMS_12_s1___Run3.mzML")))
    assert (f.project_id, f.chromatography, f.replicate, f.run_number, f.ext) == ("505162-1", "c18", "", "Run3", "mzML")
    assert one(spark, names.parse_run_filename(F.lit("x_y.h5"))) is None
    p = one(spark, names.parse_project_name(F.lit("20240101_EB_PI_505162_P_final_IDX_HILICZ_U1_more")))
    assert (p.owner, p.suffix) == ("EB", "more")
    assert one(spark, names.classify_file_type(F.lit(" Blank "), F.lit(""))) == "injbl"


def test_scan_runs_refuses_failed_and_odd_names(spark):
    paths = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    with pytest.raises(ValueError, match="failed"):
        runs.scan_runs(paths("/d/a.failed"))
    with pytest.raises(ValueError, match="convention"):
        runs.scan_runs(paths("/d/a.h5"))
    with pytest.raises(ValueError, match="no runs"):
        runs.scan_runs(paths("/d/a.txt"))


def test_isomers_both_ways_and_never_itself(spark):
    rows = [("l", 132.102, 9.0, 8.5, 10.5, "ROHF-1", "[M+H]+", "leucine", "1"), ("i", 132.1023, 10.0, 9.0, 11.0, "AGPK-1", "[M+H]+", "isoleucine", "2"), ("x", 300.0, 1.0, 0.5, 1.5, "ROHF-2", "[M+Na]+", "other", "3")]
    got = {r.mz_rt_uid: [x.mz_rt_uid for x in r.isomers] for r in atlas.isomer_pairs(targets(spark, rows)).collect()}
    assert got == {"l": ["i", "x"], "i": ["l"], "x": ["l"]}
    blank = targets(spark, [("p", 100.0, 1.0, 0.5, 1.5, "", "", "p", "1"), ("q", 200.0, 1.0, 0.5, 1.5, "", "", "q", "2"), ("r", 300.0, 1.0, 0.5, 1.5, None, "", "r", "3")])
    alone, block = ({r.mz_rt_uid: len(r.isomers) for r in atlas.isomer_pairs(blank, pair_blank_keys=b).collect()} for b in (False, True))
    assert alone == {"p": 0, "q": 0, "r": 0} and block == {"p": 1, "q": 1, "r": 0}


def test_overlaps_join_names(spark):
    t = targets(spark, [("l", 132.102, 9.0, 8.5, 10.5, "L-1", "", "leucine", ""), ("i", 132.102, 10.0, 9.0, 11.0, "I-1", "", "isoleucine", ""), ("x", 132.102, 3.0, 1.0, 5.0, "X-1", "", "x", "")])
    t = t.select("mz_rt_uid", "compound_name", "inchi_key", F.col("mz").alias("atlas_mz"), F.lit(None).cast("double").alias("mono_mass"), "rt_min", "rt_max")
    got = {r.mz_rt_uid: r.overlapping_compound for r in atlas.overlapping_compounds(t).collect()}
    assert got == {"l": "isoleucine//leucine", "i": "isoleucine//leucine", "x": ""}


def test_validation_raises(spark):
    good = targets(spark, [ADENINE, RIBOFLAVIN])
    assert atlas.validate_atlas(good).count() == 2
    for change in ({"mz": F.lit(0.0)}, {"rt_min": F.col("rt_max")}, {"adduct": F.lit(None).cast("string")}):
        with pytest.raises(ValueError):
            atlas.validate_atlas(good.withColumns(change))
    with pytest.raises(ValueError):
        atlas.validate_atlas(good.limit(0))


def test_library_drops_what_cannot_be_used(spark, tmp_path):
    lines = ['{"id":"1","database":"d","inchi_key":"K","polarity":"pos","precursor_mz":100.0,"mz":[90.0,50.0,102.6],"intensities":[1.0,2.0,3.0]}', "{bad", '{"id":"2","mz":[1.0],"intensities":[]}', '{"id":"3","mz":[],"intensities":[]}']
    (tmp_path / "lib.jsonl").write_text("\n".join(lines))
    rows = library.scan_reference_spectra(spark, str(tmp_path), polarity="positive").collect()
    assert [(r.id, r.mz) for r in rows] == [("1", [50.0, 90.0])]


def test_param_query_equals_its_sql(spark):
    df = spark.createDataFrame([(float(i - 5), f"c{i % 3}", "a" if i % 2 else "b", "b" if i % 2 else "a") for i in range(11)], "x double, k string, condition_1 string, condition_2 string")
    df.createOrReplaceTempView("compound_lfc")
    for params in ({"x_abs_min": 3}, {"x_abs_max": 2}, {"x_abs_gt": 3}, {"x_abs_lt": 2}, {"x_min": 1, "k_in": "c1"}, {"k": "c2", "x_max": 0, "nope": 1}, {"condition_pair": ["a", "b"]}, {}):
        ours = sorted(map(tuple, results.param_query(df, params).collect()))
        assert ours == sorted(map(tuple, spark.sql(results.param_query_sql(df.columns, params)).collect())), params


def test_parametric_query_prunes_partitions_and_row_groups(spark, tmp_path):
    df = results.conform(spark.createDataFrame([("a", float(i)) for i in range(50)], "mz_rt_uid string, atlas_mz double"), "compound_lfc")
    values = dict.fromkeys(results.PARTITIONS, "v")
    results.write_result_datasets({"compound_lfc": df}, str(tmp_path), values, provenance={"analysis_number": "3"})
    found = results.param_query(results.read_result_dataset(spark, str(tmp_path), "compound_lfc"), {"project_name": "v", "atlas_mz_min": 40.0})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 10 and "GreaterThanOrEqual(atlas_mz,40.0)" in plan and "PartitionFilters: [isnotnull(project_name" in plan
    assert results.result_footer_fields(spark, str(tmp_path), "compound_lfc", values).first().n_rows == 50


def test_partition_columns_clash(spark):
    with pytest.raises(ValueError):
        results.with_partition_columns(spark.range(1).withColumn("polarity", F.lit("x")), dict.fromkeys(results.PARTITIONS, "v"))


def test_lenient_values(spark):
    assert one(spark, F.size(values.hits_json_decode(F.lit("null")))) == 0
    assert one(spark, values.safe_isnan(F.lit("abc"))) is True
    assert one(spark, values.pick_synonym(F.array(F.lit("CHEMBL1"), F.lit("Cold Cream"), F.lit("12-3"), F.lit("bb"), F.lit("aa")))) == "bb"
    assert one(spark, values.collision_energy_label(F.lit(23.3333))) == "CE102040"
