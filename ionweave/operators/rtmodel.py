"""Retention-time alignment: statistics, polynomial fit and its application."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import format_equation, polynomial

MODEL_SCHEMA = "rt_alignment_number long, atlas_uid string, degree int, coefficients array<double>, r2 double, rmse double, n_compounds long, equation string"


#: Rows up to which a sketch of accuracy 10,000 keeps every value: it may merge two from twice as many on, and misplace one from 5,000 on.
SKETCHED = 4_000
#: Different hashes of targets' ids: so many numbers at most are broadcast to find the points of large targets.
HASHES = 1 << 16
#: Ranges of values for each doubling in which exact medians are looked for.
RANGES = 2048


def _range(value: Column) -> Column:
    """The range of a value, by sign and logarithm: in the order of the values, NaN last."""
    size = F.floor(F.log2(F.abs(value)) * RANGES) + (1 << 22)
    return F.when(F.isnan(value), 1 << 40).when(value == 0, 0).when(F.abs(value) == float("inf"), F.signum(value) * (1 << 39)).otherwise(F.signum(value) * size).cast("long")


def exact_medians(rows: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """(key, a median for each of values) by counting, as F.median gives them; NULLs don't count.

    Equal values are counted where they lie, then shuffled by key, measure and value, so a key with very many rows is no single
    task. Counts of ranges (RANGES for each doubling) say in which one or two of them the middle ranks lie, and only the values in
    these are put in order."""
    measured = F.inline(F.array(*(F.struct(F.lit(n).alias("measure"), v.cast("double").alias("value")) for n, v in values.items())))
    counts = rows.select(key, measured).where("value is not null").groupBy(key, "measure", _range(F.col("value")).alias("range"), "value").agg(F.count("*").alias("n"))
    whole, upto = Window.partitionBy(key, "measure"), Window.partitionBy(key, "measure").orderBy("range")
    ranges = counts.groupBy(key, "measure", "range").agg(F.sum("n").alias("n")).withColumns({"total": F.sum("n").over(whole), "end": F.sum("n").over(upto)})
    ranges = ranges.withColumns({"low": F.expr("(total + 1) div 2"), "high": F.expr("(total + 2) div 2")})
    ranges = ranges.where((F.col("end") >= F.col("low")) & (F.col("end") - F.col("n") < F.col("high"))).select(key, "measure", "range", "low", "high", (F.col("end") - F.col("n")).alias("before"))
    near = counts.join(ranges, [key, "measure", "range"])
    end = F.col("before") + F.sum("n").over(Window.partitionBy(key, "measure", "range").orderBy("value"))
    near = near.withColumn("end", end)
    hit = lambda rank: (F.col("end") >= F.col(rank)) & (F.col("end") - F.col("n") < F.col(rank))
    middle = lambda n: F.avg(F.when(F.col("measure") == n, F.col("value")))
    ends = near.select(key, "measure", F.explode(F.array_compact(F.array(F.when(hit("low"), F.col("value")), F.when(hit("high"), F.col("value"))))).alias("value"))
    return ends.groupBy(key).agg(*(middle(n).alias(n) for n in values))


def rt_stats(rows: DataFrame, exclude: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """Per target, over the points in the feature of all files: counts, moments and differences from the atlas.

    rows: joined points with atlas_mz, rt_peak and inchi_key; a target has one rt_peak. Medians are exact. A sketch of bounded size gives
    the lower middle value, and one of the negative values the upper one; up to SKETCHED rows it drops nothing, and targets of more
    are counted by exact_medians(). `accuracy` asks for a sketch of that accuracy alone (the rank is off by one part in `accuracy` at most)."""
    inside = rows.where("in_feature")
    if exclude:
        inside = inside.where(~F.col("inchi_key").isin(exclude))
    rt, mz, i = (F.col(c).cast("double") for c in ("rt", "mz", "i"))
    shift, ppm = rt - F.col("rt_peak"), (mz - F.col("atlas_mz")) / F.col("atlas_mz") * 1e6
    medians = {"rt_median": rt, "intensity_median": i}
    middle = lambda c: F.percentile_approx(c, 0.5, accuracy or 10_000)
    sketches = [((middle(c) - middle(-c)) / 2 if accuracy is None else middle(c)).alias(n) for n, c in medians.items()]
    stats = inside.groupBy("mz_rt_uid").agg(
        F.max("rt_peak").alias("atlas_rt_peak"), F.count("*").alias("observation_count"),
        F.avg(rt).alias("rt_mean"), F.stddev_pop(rt).alias("rt_std"), F.avg(mz).alias("mz_mean"), F.stddev_pop(mz).alias("mz_std"),
        F.avg(i).alias("intensity_mean"), F.max(i).alias("intensity_max"), F.avg(shift).alias("rt_diff_mean"), F.stddev_pop(shift).alias("rt_diff_std"),
        F.avg(ppm).alias("ppm_mean"), F.stddev_pop(ppm).alias("ppm_std"), *sketches,
    )
    if accuracy is None:
        # a list of ids may be as long as the atlas, so only hashes of them are broadcast; what these let through meets the ids in a shuffle
        large = stats.where(F.col("observation_count") > SKETCHED).select("mz_rt_uid")
        hashed = F.pmod(F.xxhash64("mz_rt_uid"), F.lit(HASHES)).alias("__hash")
        near = inside.withColumn("__hash", hashed).join(F.broadcast(large.select(hashed).distinct()), "__hash", "left_semi").drop("__hash")
        counted = exact_medians(near.join(large.hint("merge"), "mz_rt_uid", "left_semi"), "mz_rt_uid", {f"__{n}": c for n, c in medians.items()})
        stats = stats.join(counted, "mz_rt_uid", "left").withColumns({n: F.coalesce(f"__{n}", n) for n in medians}).drop(*(f"__{n}" for n in medians))
    # rt_peak is the same for all points of a target, so the median of the differences needs no counts of its own
    return stats.withColumn("rt_diff_median", F.col("rt_median") - F.col("atlas_rt_peak"))


def fit_rt_model(stats: DataFrame, degree: int = 2, min_compounds: int = 2, min_observations: int = 1) -> dict:
    """Least squares of the median observed rt on the atlas rt: coefficients from the constant up, r2, rmse, n.

    Power sums of the centred and scaled rt come from one aggregate; only the small normal equations are solved here.
    Three actions read stats, so it should be stored or persisted."""
    used = stats.where(F.col("observation_count") >= min_observations)
    first = used.agg(F.count("*").alias("n"), F.avg("atlas_rt_peak").alias("m"), F.stddev_pop("atlas_rt_peak").alias("s")).first()
    if first.n == 0:
        raise ValueError("No compounds to model")
    if first.n < max(min_compounds, 2):
        raise ValueError(f"Insufficient compounds to model: {first.n}")
    scale = first.s or 1.0
    x, y = (F.col("atlas_rt_peak") - first.m) / scale, F.col("rt_median")
    powers = [F.lit(1.0)]
    for _ in range(2 * degree):
        powers.append(powers[-1] * x)
    sums = used.agg(*(F.sum(p).alias(f"x{k}") for k, p in enumerate(powers)), *(F.sum(powers[k] * y).alias(f"y{k}") for k in range(degree + 1)), F.sum(y * y).alias("yy"), F.avg(y).alias("ym")).first()
    a = np.array([[sums[f"x{i + j}"] for j in range(degree + 1)] for i in range(degree + 1)])
    b = np.array([sums[f"y{k}"] for k in range(degree + 1)])
    centred = np.linalg.lstsq(a, b, rcond=None)[0]
    plain = np.polynomial.Polynomial(centred)(np.polynomial.Polynomial([-first.m / scale, 1 / scale]))
    coefficients = np.resize(np.append(plain.coef, np.zeros(degree + 1 - len(plain.coef))), degree + 1).tolist()
    error = max(0.0, float(used.agg(F.sum(F.pow(y - polynomial(F.col("atlas_rt_peak"), coefficients), 2))).first()[0]))
    total = sums.yy - first.n * sums.ym**2
    return {"degree": degree, "coefficients": coefficients, "r2": 1 - error / total if total > 0 else 1.0, "rmse": (error / first.n) ** 0.5, "n_compounds": first.n}


def rt_residuals(stats: DataFrame, coefficients: list[float]) -> DataFrame:
    predicted = polynomial(F.col("atlas_rt_peak"), coefficients)
    return stats.withColumns({"predicted": predicted, "residual": F.col("rt_median") - predicted, "abs_residual": F.abs(F.col("rt_median") - predicted)})


def apply_rt_model(atlas: DataFrame, coefficients: list[float], on_bounds: bool = True) -> DataFrame:
    """atlas with rt_peak (0.01 at least), rt_min and rt_max through the model, or bounds as wide as before around the peak; and rt_shift."""
    raw = polynomial(F.col("rt_peak"), coefficients)
    peak = F.when(raw <= 0, 0.01).otherwise(raw)
    if on_bounds:
        a, b = polynomial(F.col("rt_min"), coefficients), polynomial(F.col("rt_max"), coefficients)
        low, high = F.least(a, b), F.greatest(a, b)
    else:
        half = (F.col("rt_max") - F.col("rt_min")) / 2
        low, high = peak - half, peak + half
    return atlas.withColumns({"rt_shift": peak - F.col("rt_peak"), "rt_peak": peak, "rt_min": low, "rt_max": high})


def rt_shift_summary(shifted: DataFrame) -> DataFrame:
    """One row of min, max and median shift; none for an empty atlas."""
    out = shifted.agg(F.count("rt_shift").alias("n"), F.min("rt_shift").alias("min_shift"), F.max("rt_shift").alias("max_shift"), F.median("rt_shift").alias("median_shift"))
    return out.where("n > 0").drop("n")


def rt_model_record(spark, model: dict, rt_alignment_number: int, atlas_uid: str) -> DataFrame:
    row = (rt_alignment_number, atlas_uid, model["degree"], model["coefficients"], model["r2"], model["rmse"], model["n_compounds"], format_equation(model["coefficients"]))
    return spark.createDataFrame([row], MODEL_SCHEMA)


def reload_rt_model(records: DataFrame, rt_alignment_number: int, atlas_uid: str) -> dict | None:
    rows = records.where((F.col("rt_alignment_number") == rt_alignment_number) & (F.col("atlas_uid") == atlas_uid)).limit(2).collect()
    if len(rows) > 1:
        raise ValueError("more than one model for this alignment")
    return rows[0].asDict() if rows else None
