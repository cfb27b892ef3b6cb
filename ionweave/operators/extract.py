"""From joined points to chromatograms and spectra, and the filters on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.points import scan_ms1_points, scan_ms2_points, stored_runs
from .joins import interval_join, join_ms1_to_atlas, join_ms2_to_atlas, valid_precursor
from .slices import widened

GROUP = ("mz_rt_uid", "filename")


def extract_all_runs(spark: SparkSession, store: str, runs: DataFrame, targets: DataFrame, polarity: str = "POS", only_in_feature: bool = False) -> DataFrame:
    """MS1 and MS2 of all h5 runs of a polarity, from a point store, in one job: of_level() takes either out.

    Both levels are one table to the range join, which meets MS1 points by their m/z and MS2 points by their precursor's; an error
    names runs that the store's list lacks, which reads no points. Runs without MS2 have none."""
    positive = polarity.upper() == "POS"
    runs = runs.where(F.lower("polarity").isin(*(("pos", "fps") if positive else ("neg",))) & (F.col("file_format") == "h5")).select("filename").distinct()
    if missing := [r.filename for r in runs.join(stored_runs(spark, store).select("filename"), "filename", "left_anti").limit(20).collect()]:
        raise FileNotFoundError(f"runs without points: {missing}")
    absent = {c: F.lit(None).cast("float") for c in ("precursor_mz", "precursor_intensity", "collision_energy")}
    ms1 = scan_ms1_points(spark, store, int(positive)).withColumns({"ms_level": F.lit(1), "at": F.col("mz"), **absent})
    ms2 = valid_precursor(scan_ms2_points(spark, store, int(positive))).withColumns({"ms_level": F.lit(2), "at": F.col("precursor_mz")})
    points = ms1.unionByName(ms2).join(runs, "filename", "left_semi")
    met = interval_join(points, targets.withColumnRenamed("mz", "atlas_mz"), "at", "mz_min", "mz_max").drop("at")
    met = met.withColumn("in_feature", F.col("rt").between(F.col("rt_min_pad"), F.col("rt_max_pad")))
    return met.where("in_feature") if only_in_feature else met


def of_level(extracted: DataFrame, level: int) -> DataFrame:
    """The rows of one MS level of extract_all_runs(), under the names of that level; the other's points aren't read for it."""
    rows = extracted.where(F.col("ms_level") == level).drop("ms_level")
    if level == 1:
        return rows.drop("precursor_mz", "precursor_intensity", "collision_energy")
    return rows.withColumnsRenamed({"mz": "frag_mz", "i": "frag_int", "rt": "scan_rt"})


def union_files(parts: list[DataFrame]) -> DataFrame:
    """Extracted tables of single runs, or of groups of them, as one; columns that a part lacks are NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def attach_target_metadata(rows: DataFrame, atlas: DataFrame) -> DataFrame:
    rows = rows.drop("inchi_key", "adduct")
    return rows.join(atlas.select("mz_rt_uid", "inchi_key", "adduct"), "mz_rt_uid", "left")


def drop_orphan_ms2(ms2: DataFrame, ms1: DataFrame) -> DataFrame:
    """MS2 of compounds that have MS1; without any MS1 all stays."""
    return ms2 if ms1.isEmpty() else ms2.join(ms1.select("mz_rt_uid").distinct(), "mz_rt_uid", "left_semi")


def widen_ms1(rows: DataFrame) -> DataFrame:
    """One row per compound and file with its points in order of rt, as an array of structs."""
    return rows.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct("rt", "mz", "i", "in_feature"))).alias("points"))


def extract_wide_ms1(points: DataFrame, targets: DataFrame) -> DataFrame:
    """widen_ms1() of join_ms1_to_atlas(), without a table of pairs in between: a target's points are looked up where they lie in order."""
    return widened(points, targets, lambda p, t: widen_ms1(join_ms1_to_atlas(p, t)))


def ms1_lists(wide: DataFrame) -> DataFrame:
    """The stored form: parallel lists."""
    lists = {"spec_rts": "rt", "spec_ints": "i", "spec_mzs": "mz", "in_feature": "in_feature"}
    return wide.select(*GROUP, *(F.col(f"points.{c}").alias(n) for n, c in lists.items()))


def widen_ms2(rows: DataFrame) -> DataFrame:
    """One row per compound, file and scan with its fragments in order of m/z."""
    constant = ("precursor_mz", "precursor_intensity", "collision_energy", "in_feature")
    wide = rows.groupBy(*GROUP, "scan_rt").agg(*(F.max(c).alias(c) for c in constant), F.array_sort(F.collect_list(F.struct("frag_mz", "frag_int"))).alias("peaks"))
    return wide.withColumns({"frag_mzs": F.col("peaks.frag_mz"), "frag_ints": F.col("peaks.frag_int")}).drop("peaks")


def filter_ms1_groups(rows: DataFrame, min_points: int | None = 5, min_intensity: float | None = 1e5) -> DataFrame:
    """Groups with enough points in the feature, and one bright enough. Both bounds None, or both 0, filter nothing."""
    if (min_points is None and min_intensity is None) or (min_points == 0 and min_intensity == 0):
        return rows
    inside = F.col("in_feature")
    kept = rows.groupBy(*GROUP).agg(F.count_if(inside).alias("n"), F.max(F.when(inside, F.col("i"))).alias("top"))
    kept = kept.where((F.col("n") > 0) & (F.col("n") >= (min_points or 0)) & (F.col("top") >= (min_intensity or 0)))
    return rows.join(kept.select(*GROUP), list(GROUP), "left_semi")


def filter_ms2_groups(scans: DataFrame, min_scans: int | None = 1, min_intensity: float | None = 0.0, ms1: DataFrame | None = None) -> DataFrame:
    """Scans in the feature, of groups with enough of them and one of enough precursor intensity; then of compounds with MS1."""
    if not ((min_scans is None and min_intensity is None) or (min_scans == 0 and min_intensity == 0)):
        w = Window.partitionBy(*GROUP)
        inside = F.col("in_feature")
        scans = scans.withColumns({"__n": F.count_if(inside).over(w), "__top": F.max(F.when(inside, F.col("precursor_intensity"))).over(w)})
        scans = scans.where(inside & (F.col("__n") >= (min_scans or 0)) & (F.col("__top") >= (min_intensity or 0))).drop("__n", "__top")
    return scans if ms1 is None else drop_orphan_ms2(scans, ms1)


def filter_funnel(entries: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """(step, entries, pct_entries, compounds, pct_compounds) after each step in turn, in one pass."""
    passed, out = F.lit(True), []
    for i, (name, condition) in enumerate({"start": F.lit(True), **steps}.items()):
        passed = passed & F.coalesce(condition, F.lit(False))
        out.append((i, name, F.count_if(passed).alias(f"n{i}"), F.count_distinct(F.when(passed, F.col("mz_rt_uid"))).alias(f"c{i}")))
    totals = entries.agg(*(x for o in out for x in o[2:]))
    rows = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(n).alias("step"), F.col(f"n{i}").alias("entries"), F.col(f"c{i}").alias("compounds")) for i, n, *_ in out))
    share = lambda c, whole: F.when(whole > 0, 100.0 * c / whole).otherwise(0.0)
    flat = totals.select("n0", "c0", F.inline(rows))
    return flat.select("step", "entries", share(F.col("entries"), F.col("n0")).alias("pct_entries"), "compounds", share(F.col("compounds"), F.col("c0")).alias("pct_compounds"))


def retag_in_feature(rows: DataFrame, bounds: DataFrame, rt: str = "rt", strict: bool = True) -> DataFrame:
    """in_feature anew from curated (mz_rt_uid, rt_min, rt_max), inclusive. Without bounds: an error if strict, else the old flag."""
    bounds = bounds.select("mz_rt_uid", F.col("rt_min").cast("float").alias("__lo"), F.col("rt_max").cast("float").alias("__hi"))
    if strict and not rows.select("mz_rt_uid").distinct().join(bounds, "mz_rt_uid", "left_anti").isEmpty():
        raise ValueError("compounds without rt bounds")
    rows = rows.join(bounds, "mz_rt_uid", "left")
    return rows.withColumn("in_feature", F.coalesce(F.col(rt).between(F.col("__lo"), F.col("__hi")), F.col("in_feature"))).drop("__lo", "__hi")


def keep_in_feature(wide: DataFrame) -> DataFrame:
    """Wide MS1 with only the points in the feature."""
    return wide.withColumn("points", F.filter("points", lambda p: p.in_feature))


def ms_totals(rows: DataFrame) -> DataFrame:
    inside = F.count_if("in_feature")
    return rows.agg(
        F.count("*").alias("points"), inside.alias("in_feature_points"), (100.0 * inside / F.nullif(F.count("*"), F.lit(0))).alias("pct_in_feature"),
        F.count_distinct(*GROUP).alias("entries"), F.count_distinct("filename").alias("files"), F.count_distinct("mz_rt_uid").alias("compounds"),
    )


def per_file_peak_metrics(rows: DataFrame) -> DataFrame:
    """Height, trapezoid area, apex and centroid of every compound in every run, on the points in the feature.

    Everything is NULL where no point is in the feature or none is bright. Points of one rt stand in order of m/z and intensity."""
    points = rows.withColumn("x", F.when(F.col("in_feature"), F.col("i").cast("double")))
    order = Window.partitionBy(*GROUP).orderBy("rt", "mz", "i")
    inside = points.where("in_feature").withColumns({"__i": F.lag("x").over(order), "__rt": F.lag("rt").over(order)})
    strip = (F.col("x") + F.col("__i")) / 2 * (F.col("rt").cast("double") - F.col("__rt").cast("double"))
    first_top = F.struct(F.col("x"), -F.col("rt"), -F.col("mz"))
    out = inside.groupBy(*GROUP).agg(
        F.max("x").alias("peak_height"),
        F.coalesce(F.sum(strip), F.lit(0.0)).alias("peak_area"),
        F.max_by("rt", first_top).cast("double").alias("rt_peak"),
        F.max_by("mz", first_top).cast("double").alias("mz_peak"),
        (F.sum(F.col("rt").cast("double") * F.col("x")) / F.nullif(F.sum("x"), F.lit(0.0))).alias("rt_centroid"),
        (F.sum(F.col("mz").cast("double") * F.col("x")) / F.nullif(F.sum("x"), F.lit(0.0))).alias("mz_centroid"),
    )
    bright = F.col("peak_height") > 0
    return out.select(*GROUP, *(F.when(bright, F.col(c)).alias(c) for c in out.columns[2:]))


def ms2_targets(points: DataFrame, targets: DataFrame) -> DataFrame:
    return join_ms2_to_atlas(points, targets)
