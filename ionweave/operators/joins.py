"""Range joins of points to targets."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of targets, all columns and both bins counted, up to which they are broadcast; more are shuffled by bin.
BROADCAST_BYTES = 64 << 20
#: Parts of each bin where the targets are shuffled: a bin in which a third of all points lie goes to so many tasks at least.
SALTS = 8
#: Targets that a bin may hold on average before narrower ones get bins of their own width.
CROWDED = 8


class Bins:
    """How intervals are dealt to bins: in levels, each of bins as wide as its widest interval. An interval lies in one or two bins
    of its level, a value in one bin of each level.

    One pass over the targets counts them by power of two of their width. From the widest on, narrower ones join a level while
    its bins would hold CROWDED targets on average at most; so one careless wide target has a level of its own, and targets of about
    one width share one."""

    def __init__(self, targets: DataFrame, low: str, high: str):
        self.low, self.high, self.kind = low, high, dict(targets.dtypes)[low]
        texts = [c for c, k in targets.dtypes if k == "string"]
        length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(24 * len(targets.columns)))
        wide = F.col(high).cast("double") - F.col(low).cast("double")
        usable = targets.where(F.col(low) <= F.col(high))
        power = F.when(wide > 0, F.ceil(F.log2(wide))).otherwise(-1074).alias("power")
        # as many rows as there are powers of two in the widths
        rows = usable.groupBy(power).agg(F.count("*").alias("n"), F.sum(length).alias("bytes"), F.max(wide).alias("w"), F.min(low).alias("lo"), F.max(high).alias("hi")).collect()
        rows.sort(key=lambda r: -r.power)
        self.lo, self.hi = min((r.lo for r in rows), default=None), max((r.hi for r in rows), default=None)
        self.small = 2 * sum(r.bytes for r in rows) <= BROADCAST_BYTES
        reach = max(float(self.hi) - float(self.lo), 1e-9) if rows else 1.0
        #: (bin width, widest interval, widest interval of the next level) of each level.
        self.levels: list[tuple[float, float, float]] = []
        left = sum(r.n for r in rows)
        for r in rows:
            if not self.levels or left * self.levels[-1][0] / reach > CROWDED:
                self.levels.append((max(r.w, 1e-9), r.w, -math.inf))
                if len(self.levels) > 1:
                    self.levels[-2] = (*self.levels[-2][:2], r.w)
            left -= r.n

    def _at(self, column: str, width: float) -> Column:
        return F.floor(F.col(column).cast("double") / width)

    def of_targets(self, targets: DataFrame, level: int | None = None) -> DataFrame:
        """targets once for each of their bins, as __level and __bin; broadcast while they are small, else with a copy for each __salt."""
        wide = F.col(self.high).cast("double") - F.col(self.low).cast("double")
        parts = []
        for k, (width, most, below) in enumerate(self.levels):
            if level in (None, k):
                bins = F.sequence(self._at(self.low, width), self._at(self.high, width))
                parts.append(F.when((wide <= most) & (wide > below), F.arrays_zip(F.array_repeat(F.lit(k), F.size(bins)).alias("__level"), bins.alias("__bin"))))
        binned = targets.where(F.col(self.low) <= F.col(self.high)).select("*", F.inline(F.coalesce(*parts))) if parts else targets.where("false").withColumns({"__level": F.lit(0), "__bin": F.lit(0).cast("long")})
        if self.small:
            return F.broadcast(binned)
        # the hint keeps Spark from broadcasting them all the same: it estimates their size by the file, which knows of no explode
        return binned.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).hint("merge")

    def of_points(self, points: DataFrame, value: str, level: int | None = None) -> DataFrame:
        """points once for each level, as __own_level and __own_bin, without null, NaN and what lies beyond all targets.

        A bound that the points' type can't hold would cut too much, so the outermost bounds go to the scan only where types agree."""
        usable = points.where(F.col(value).isNotNull() & ~F.isnan(value))
        if self.lo is not None and dict(points.dtypes)[value] == self.kind:
            usable = usable.where(F.col(value).between(F.lit(self.lo).cast(self.kind), F.lit(self.hi).cast(self.kind)))
        at = [F.struct(F.lit(k).alias("__own_level"), self._at(value, w).alias("__own_bin")) for k, (w, _, _) in enumerate(self.levels) if level in (None, k)]
        if len(at) > 1:
            usable = usable.select("*", F.inline(F.array(*at)))
        else:
            usable = usable.withColumns({"__own_level": F.lit(level or 0), "__own_bin": at[0]["__own_bin"] if at else F.lit(0).cast("long")})
        return usable if self.small else usable.withColumn("__part", F.pmod(F.xxhash64(value, *(c for c in ("rt", "scan_rt") if c in points.columns and c != value)), F.lit(SALTS)))

    def met(self, value: str) -> Column:
        hit = (F.col("__own_level") == F.col("__level")) & (F.col("__own_bin") == F.col("__bin")) & (F.col(value) >= F.col(self.low)) & (F.col(value) <= F.col(self.high))
        return hit if self.small else hit & (F.col("__part") == F.col("__salt"))


_DEALT = ("__level", "__bin", "__own_level", "__own_bin", "__part", "__salt")


def expand_atlas_windows(atlas: DataFrame, ppm: float = 5.0, extra_time: float = 0.0) -> DataFrame:
    """atlas with FLOAT windows mz_min, mz_max, rt_min_pad, rt_max_pad; membership is decided at that precision."""
    step = F.col("mz") * ppm * 1e-6
    return atlas.withColumns({
        "mz_min": (F.col("mz") - step).cast("float"),
        "mz_max": (F.col("mz") + step).cast("float"),
        "rt_min_pad": (F.col("rt_min") - extra_time).cast("float"),
        "rt_max_pad": (F.col("rt_max") + extra_time).cast("float"),
    })


def interval_join(points: DataFrame, targets: DataFrame, value: str, low: str, high: str, how: str = "inner") -> DataFrame:
    """All (point, target) with low <= value <= high; NULL and NaN never match. how: inner or left_semi.

    An equi-join on the bins of Bins with a residual predicate. The targets' size is taken first: they are broadcast while they are
    small, else shuffled, each to all SALTS parts of its bins, so that a bin with very many points is no single key. Their outermost
    bounds go to the points as literals, which reach a Parquet scan."""
    bins = Bins(targets, low, high)
    if how == "left_semi":
        return _semi(points, targets, bins, value, F.lit(True))
    return bins.of_points(points, value).join(bins.of_targets(targets), bins.met(value)).drop(*_DEALT)


def _semi(points: DataFrame, targets: DataFrame, bins: Bins, value: str, more: Column) -> DataFrame:
    """Points with a target in any level; a level asks for those alone that no level before has found, so a point comes once."""
    found, left = [], points
    for k in range(max(1, len(bins.levels))):
        dealt, of = bins.of_points(left, value, k), bins.of_targets(targets, k)
        found.append(dealt.join(of, bins.met(value) & more, "left_semi").drop(*_DEALT))
        left = dealt.join(of, bins.met(value) & more, "left_anti").drop(*_DEALT)
    return reduce(DataFrame.unionByName, found)


def mz_bounds(targets: DataFrame) -> tuple[float, float] | None:
    """Lowest and highest m/z of all windows, as literals for a scan; None without targets."""
    r = targets.agg(F.min("mz_min").alias("lo"), F.max("mz_max").alias("hi")).first()
    return None if r.lo is None else (r.lo, r.hi)


def join_ms1_to_atlas(points: DataFrame, targets: DataFrame, only_in_feature: bool = False) -> DataFrame:
    """MS1 points by m/z window, flagged in_feature where rt is in the padded window."""
    out = interval_join(points, targets, "mz", "mz_min", "mz_max") if "mz" not in targets.columns else interval_join(points, targets.withColumnRenamed("mz", "atlas_mz"), "mz", "mz_min", "mz_max")
    out = out.withColumn("in_feature", F.col("rt").between(F.col("rt_min_pad"), F.col("rt_max_pad")))
    return out.where("in_feature") if only_in_feature else out


def valid_precursor(points: DataFrame) -> DataFrame:
    return points.where((F.col("precursor_mz") > 0) & ~F.isnan("precursor_mz"))


def join_ms2_to_atlas(points: DataFrame, targets: DataFrame, only_in_feature: bool = False, rt: str = "scan_rt") -> DataFrame:
    """MS2 rows with a usable precursor by its m/z window, flagged as MS1 points are."""
    targets = targets.withColumnRenamed("mz", "atlas_mz")
    out = interval_join(valid_precursor(points), targets, "precursor_mz", "mz_min", "mz_max")
    out = out.withColumn("in_feature", F.col(rt).between(F.col("rt_min_pad"), F.col("rt_max_pad")))
    return out.where("in_feature") if only_in_feature else out


def subset_points_to_windows(points: DataFrame, targets: DataFrame) -> DataFrame:
    """Points in at least one (m/z, rt) window."""
    windows = targets.select("mz_min", "mz_max", "rt_min_pad", "rt_max_pad")
    return _semi(points, windows, Bins(windows, "mz_min", "mz_max"), "mz", F.col("rt").between(F.col("rt_min_pad"), F.col("rt_max_pad")))


def near_pairs(left: DataFrame, right: DataFrame, a: str, b: str, tolerance: float) -> DataFrame:
    """(left, right) rows with abs(a - b) <= tolerance, by bins of one and a bit tolerances and their neighbours."""
    width = tolerance * 1.000001
    near = left.withColumn("__bin", F.explode(F.array(*(F.floor(F.col(a) / width) + d for d in (-1, 0, 1)))))
    near = near.join(right.withColumn("__own", F.floor(F.col(b) / width)), (F.col("__bin") == F.col("__own")) & (F.abs(F.col(a) - F.col(b)) <= tolerance))
    return near.drop("__bin", "__own")
