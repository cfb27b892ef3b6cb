"""Summaries: best files, sheets, control filter, fold changes, polarity merge and identifications. Kept long; pivoted at the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.names import parse_run_filename
from ..sources.scratch import scratch
from .atlas import dedup_first

# What marks a control file, and groups that the merged fold changes leave out.
CONTROLS, LEFT_OUT = ("ExCtrl", "InjBL"), ("QC", "ISTD")
FOLD = 3.0


def any_in(name: Column, marks: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for m in marks:
        hit = hit | F.contains(name, F.lit(m))
    return hit


def with_file_group(metrics: DataFrame) -> DataFrame:
    """metrics with file_group, the sample_name of the file; files whose name doesn't parse are left out."""
    return metrics.withColumn("file_group", parse_run_filename(F.col("filename"))["sample_name"]).where("file_group is not null")


def best_ms1_file(metrics: DataFrame, atlas: DataFrame) -> DataFrame:
    """Per compound the file with the highest peak (NULL last, ties by name), with signed ppm and rt errors."""
    best = dedup_first(metrics, ["mz_rt_uid"], [F.desc_nulls_last("peak_height"), "filename"])
    a = atlas.select("mz_rt_uid", F.col("mz").alias("atlas_mz"), F.col("rt_peak").alias("atlas_rt_peak"))
    return best.join(a, "mz_rt_uid").select(
        "mz_rt_uid", F.col("filename").alias("best_ms1_file"), F.col("rt_peak").alias("best_ms1_rt"), F.col("mz_centroid").alias("best_ms1_mz"), F.col("peak_height").alias("best_ms1_intensity"),
        scores.ppm_error(F.col("mz_centroid"), F.col("atlas_mz"), True).alias("best_ms1_ppm_error"), scores.rt_error(F.col("rt_peak"), F.col("atlas_rt_peak"), True).alias("best_ms1_rt_error"),
    )


def merge_best_ms1(curation: DataFrame, best: DataFrame) -> DataFrame:
    return curation.join(best, "mz_rt_uid", "left")


def top3_mz_average(metrics: DataFrame) -> DataFrame:
    w = Window.partitionBy("mz_rt_uid").orderBy(F.desc_nulls_last("peak_height"), "filename")
    return metrics.withColumn("n", F.row_number().over(w)).where("n <= 3").groupBy("mz_rt_uid").agg(F.avg("mz_centroid").alias("top3_mz"))


def identification_summary(ms1: DataFrame, scans: DataFrame, atlas: DataFrame) -> DataFrame:
    """Per target: MS1 points, MS2 scans and hits."""
    points = ms1.groupBy("mz_rt_uid").agg(F.count("*").alias("ms1_points"))
    found = scans.groupBy("mz_rt_uid").agg(F.count("*").alias("ms2_scans"), F.sum(F.size("hits")).alias("ms2_hits"))
    out = atlas.select("mz_rt_uid").join(points, "mz_rt_uid", "left").join(found, "mz_rt_uid", "left")
    return out.fillna(0, ["ms1_points", "ms2_scans", "ms2_hits"])


def compound_index(curation: DataFrame, order: list[Column | str]) -> DataFrame:
    """1-based place in this order.

    Rows are dealt to ranges of the order and written; a row's place is that within its range, after the counts of the ranges before.
    No task sees more than a range. The result carries a merge hint, as the files just written are far smaller than their rows."""
    spark, path = curation.sparkSession, scratch(curation.sparkSession, "ranges")
    ranged = curation.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    # a row for each range that has rows
    counts = ranged.groupBy("__range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("__range", F.coalesce(before, F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) + F.col("__before")
    return ranged.join(F.broadcast(counts), "__range").withColumn("compound_index", place.cast("int")).select(*curation.columns, "compound_index").hint("merge")


def pivot_metric(metrics: DataFrame, curation: DataFrame, metric: str, exclude_runs: list[str] | None = None) -> DataFrame:
    """Rows of compounds by columns of file stems, for a sheet; rows and columns without a value vanish."""
    keys = ["compound_index", "mz_rt_uid", "compound_name", "inchi_key", "adduct"]
    rows = metrics.where(F.col(metric).isNotNull())
    if exclude_runs:
        rows = rows.where(~F.col("filename").isin(exclude_runs))
    rows = rows.withColumn("stem", F.regexp_replace("filename", r"\.[^.]*$", ""))
    stems = [r.stem for r in rows.select("stem").distinct().orderBy("stem").collect()]
    return rows.join(curation.select(*keys), "mz_rt_uid").groupBy(*keys).pivot("stem", stems).agg(F.first(metric, ignorenulls=True))


def control_filter(heights: DataFrame, fold: float = FOLD) -> DataFrame:
    """(mz_rt_uid, control_filter): keep where the highest sample is there and not below `fold` times the highest control."""
    control = any_in(F.col("filename"), CONTROLS)
    top = heights.groupBy("mz_rt_uid").agg(F.max(F.when(control, F.col("peak_height"))).alias("c"), F.max(F.when(~control, F.col("peak_height"))).alias("s"))
    any_control = heights.agg(F.coalesce(F.max(control), F.lit(False)).alias("any"))
    keep = F.col("s").isNotNull() & (F.col("c").isNull() | (F.col("s") >= fold * F.col("c")))
    return top.crossJoin(F.broadcast(any_control)).select("mz_rt_uid", F.when(~F.col("any") | keep, "keep").otherwise("remove").alias("control_filter"))


def collapse_adducts(heights: DataFrame, curation: DataFrame, filters: DataFrame) -> DataFrame:
    """Per (inchi_key, compound_name, control_filter) and file the highest peak, with the uid, index and adduct of the row
    whose highest sample peak is highest (ties by index)."""
    keys = ["inchi_key", "compound_name", "control_filter"]
    rows = heights.join(curation.select("mz_rt_uid", "inchi_key", "compound_name", "adduct", "compound_index"), "mz_rt_uid").join(filters, "mz_rt_uid")
    top = rows.groupBy(*keys, "mz_rt_uid", "adduct", "compound_index").agg(F.max(F.when(~any_in(F.col("filename"), CONTROLS), F.col("peak_height"))).alias("score"))
    chosen = dedup_first(top, keys, [F.desc_nulls_last("score"), "compound_index"]).drop("score")
    return rows.groupBy(*keys, "filename").agg(F.max("peak_height").alias("peak_height")).join(chosen, keys)


def impute_global_min(heights: DataFrame, keys: list[str]) -> DataFrame:
    """All (keys, file) cells, missing ones at the lowest value of the whole table. The few files multiply the keys."""
    low = heights.agg(F.min("peak_height").alias("low"))
    cells = heights.select(*keys).distinct().crossJoin(F.broadcast(heights.select("filename").distinct()))
    known = heights.select(*(F.col(k).alias(f"__{k}") for k in (*keys, "filename")), "peak_height")
    full = cells.join(known, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in (*keys, "filename")], "left")
    return full.crossJoin(F.broadcast(low)).select(*keys, "filename", F.coalesce("peak_height", "low").alias("peak_height"))


def filtered_peak_heights(heights: DataFrame, curation: DataFrame, fold: float = FOLD) -> DataFrame:
    """Control filter, collapsed adducts and imputed cells, long."""
    collapsed = collapse_adducts(heights, curation, control_filter(heights, fold))
    keys = ["inchi_key", "compound_name", "control_filter", "mz_rt_uid", "adduct", "compound_index"]
    return impute_global_min(collapsed.select(*keys, "filename", "peak_height"), keys)


def group_means(heights: DataFrame, keys: list[str]) -> DataFrame:
    return with_file_group(heights).groupBy(*keys, "file_group").agg(F.avg("peak_height").alias("mean_height"))


def log_fold_change(means: DataFrame, keys: list[str], leave_out: tuple[str, ...] = ()) -> DataFrame:
    """(keys, condition_1, condition_2, log2_fold_change) for each pair of groups in the order of their names."""
    if leave_out:
        means = means.where(~any_in(F.col("file_group"), leave_out))
    a = means.select(*keys, F.col("file_group").alias("condition_1"), F.col("mean_height").alias("m1"))
    b = means.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("file_group").alias("condition_2"), F.col("mean_height").alias("m2"))
    both = a.join(b, [a[k].eqNullSafe(b[f"__{k}"]) for k in keys] + [F.col("condition_1") < F.col("condition_2")])
    value = F.when((F.col("m1") > 0) & (F.col("m2") > 0), F.log2(F.col("m1") / F.col("m2")))
    return both.select(*keys, "condition_1", "condition_2", value.alias("log2_fold_change"))


def melt_lfc(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Columns g1_vs_g2 as rows (condition_1, condition_2, log2_fold_change)."""
    pairs = [c for c in wide.columns if "_vs_" in c]
    long = wide.unpivot(keys, pairs, "pair", "log2_fold_change")
    parts = F.split("pair", "_vs_", 2)
    return long.select(*keys, parts[0].alias("condition_1"), parts[1].alias("condition_2"), "log2_fold_change")


def union_polarities(pos: DataFrame, neg: DataFrame) -> DataFrame:
    """Kept rows of both polarities; columns that one side lacks are NULL."""
    both = pos.withColumn("polarity", F.lit("POS")).unionByName(neg.withColumn("polarity", F.lit("NEG")), allowMissingColumns=True)
    return both.where("control_filter = 'keep'")


def best_polarity_row(both: DataFrame) -> DataFrame:
    """(inchi_key, compound_name, mz_rt_uid, adduct, polarity, top) of the row with the highest sample peak over both polarities."""
    sample = F.when(~any_in(F.col("filename"), CONTROLS), F.col("peak_height"))
    top = both.groupBy("inchi_key", "compound_name", "mz_rt_uid", "adduct", "polarity").agg(F.max(sample).alias("top"))
    return dedup_first(top, ["inchi_key", "compound_name"], [F.desc_nulls_last("top"), F.desc("polarity"), "mz_rt_uid"])


def merged_polarity_table(both: DataFrame, ids: DataFrame) -> DataFrame:
    """Long heights of the best polarity's row of each compound, with its external ids ('' if none)."""
    rows = both.join(best_polarity_row(both), ["inchi_key", "compound_name", "mz_rt_uid", "adduct", "polarity"])
    return rows.join(ids, "inchi_key", "left").withColumn("cpd_ids", F.coalesce("cpd_ids", F.lit("")))


def merged_polarity_lfc(merged: DataFrame) -> DataFrame:
    keys = ["inchi_key", "compound_name"]
    return log_fold_change(group_means(merged, keys), keys, LEFT_OUT)


def boxplot_stats(metrics: DataFrame, metric: str = "peak_height", log: bool = False) -> DataFrame:
    """Per compound and group: n, quartiles and whiskers (farthest values within 1.5 of the box); log takes log10 of positive values."""
    value = F.when(F.col(metric) > 0, F.log10(metric)) if log else F.col(metric)
    rows = with_file_group(metrics).withColumn("v", value)
    w = ["mz_rt_uid", "file_group"]
    box = rows.groupBy(*w).agg(F.count("v").alias("n"), F.percentile("v", [0.25, 0.5, 0.75]).alias("q"))
    box = box.select(*w, "n", *(F.coalesce(F.get("q", F.lit(i)), F.lit(0.0)).alias(c) for i, c in enumerate(("q1", "median", "q3"))))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = rows.join(box, w).where(F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)).groupBy(*w).agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return box.join(inside, w, "left").select(*w, "n", "q1", "median", "q3", F.coalesce("low", F.lit(0.0)).alias("whisker_low"), F.coalesce("high", F.lit(0.0)).alias("whisker_high"))


def final_identifications(curation: DataFrame, best_ms1: DataFrame, best_ms2: DataFrame, overlaps: DataFrame, chromatography: str) -> DataFrame:
    """The identification table: one row per compound, with errors, quality scores and MSI level.

    best_ms2: mz_rt_uid, msms_file, msms_rt, msms_score, msms_mz, msms_numberofions, msms_matchingions."""
    rows = curation.join(best_ms1, "mz_rt_uid", "left").join(best_ms2, "mz_rt_uid", "left").join(overlaps, "mz_rt_uid", "left")
    mz, mz_t, rt, rt_t = (F.col(c) for c in ("best_ms1_mz", "atlas_mz", "best_ms1_rt", "atlas_rt_peak"))
    ppm, da, rt_err = scores.ppm_error(mz, mz_t), scores.da_error(mz, mz_t), scores.rt_error(rt, rt_t)
    q_mz, q_rt, q_ms = scores.mz_quality(ppm, da), scores.rt_quality(rt_err, F.lit(chromatography)), scores.msms_quality(F.col("ms2_notes"))
    single = F.coalesce("overlapping_compound", F.lit("")) == ""
    return rows.select(
        "compound_index", "mz_rt_uid", F.when(single, F.col("compound_name")).otherwise(F.col("overlapping_compound")).alias("identified_metabolite"),
        F.col("compound_name").alias("label"), "overlapping_compound", "overlapping_inchi_keys", "formula", "polarity", F.round("mono_mass", 7).alias("exact_mass"), "inchi_key", "adduct",
        q_ms.alias("msms_quality"), q_mz.alias("mz_quality"), q_rt.alias("rt_quality"), scores.total_score(q_ms, q_mz, q_rt).alias("total_score"), scores.msi_level(q_mz, q_rt, q_ms).alias("msi_level"),
        "isomer_details", "identification_notes", "ms1_notes", "ms2_notes", "other_notes", "analyst_notes",
        F.col("best_ms1_intensity").alias("max_intensity"), F.col("best_ms1_file").alias("max_intensity_file"),
        "msms_file", F.round("msms_rt", 2).alias("msms_rt"), "msms_numberofions", "msms_matchingions", F.round("msms_score", 4).alias("msms_score"),
        F.round(mz_t, 4).alias("mz_theoretical"), F.round(mz, 4).alias("mz_measured"), F.round(da, 4).alias("mz_error"), F.round(ppm, 4).alias("mz_ppmerror"),
        F.round("rt_min", 2).alias("rt_min"), F.round("rt_max", 2).alias("rt_max"), F.round(rt_t, 2).alias("rt_theoretical"), F.round(rt, 2).alias("rt_measured"), F.round(rt_err, 2).alias("rt_error"),
    )
