"""Run listings: parsing, filters and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import RUN_FORMATS, RUN_PATTERN, classify_file_type, normalize_chromatography, run_fields, run_name_parts


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths (and no contents) below a folder of any store that Spark reads."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")


def scan_runs(paths: DataFrame) -> DataFrame:
    """One row per run of a table of paths; raises where a conversion failed, a name doesn't parse or no run is found."""
    name = F.element_at(F.split("path", "/"), -1)
    named = paths.withColumn("filename", name)
    failed = named.where(F.endswith("filename", F.lit(".failed")))
    kind = F.regexp_extract("filename", r"\.([^.]*)$", 1)
    runs = parsed_runs(named.where(kind.isin(*RUN_FORMATS)))
    bad = runs.where("file_type is null")
    # counted in one pass; names are looked for only where there are some to show
    n = named.agg(
        F.count_if(F.endswith("filename", F.lit(".failed"))).alias("failed"), F.count_if(kind.isin(*RUN_FORMATS)).alias("runs"),
        F.count_if(kind.isin(*RUN_FORMATS) & ~F.col("filename").rlike(RUN_PATTERN)).alias("bad"),
    ).first()
    if n.failed:
        raise ValueError(f"failed conversions: {[r.filename for r in failed.limit(20).collect()]}")
    if n.bad:
        raise ValueError(f"names that don't follow the convention: {[r.filename for r in bad.limit(20).collect()]}")
    if not n.runs:
        raise ValueError("no runs found")
    return runs


def parsed_runs(named: DataFrame) -> DataFrame:
    """(path, filename) with format, file type, chromatography, MS level and polarity; all NULL where the name doesn't parse.

    A name is taken apart once: as columns of a generator, its fields are not put once more into each filter above."""
    f = run_fields(F.col("__parts"))
    kind = F.when(F.col("__parts").isNotNull(), classify_file_type(f["sample_name"], f["run_metadata"]))
    fields = F.struct(f["ext"].alias("file_format"), kind.alias("file_type"), f["chromatography"].alias("chromatography"), F.lower(f["ms_level"]).alias("ms_level"), F.lower(f["polarity"]).alias("polarity"))
    parts = named.withColumn("__parts", run_name_parts(F.col("filename")))
    return parts.select(F.col("path").alias("file_path"), "filename", F.inline(F.array(fields)))


# Another spelling of a file type in older include lists.
_SPELLINGS = {"injblk": "injbl"}


def filter_runs(runs: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, file_format: str | None = "h5", chromatography: str | None = None, polarity: str | None = None, ms_level: str | None = None, fps_for_negative: bool = False) -> DataFrame:
    """Runs by file type, format, chromatography, polarity and MS level, in any case. Positive takes fast-switching runs too."""
    types = lambda names: [_SPELLINGS.get(n.lower(), n.lower()) for n in names]
    if include:
        runs = runs.where(F.lower("file_type").isin(types(include)))
    if exclude:
        runs = runs.where(~F.lower("file_type").isin(types(exclude)) & ~F.lower("polarity").isin(types(exclude)))
    if file_format:
        runs = runs.where(F.lower("file_format") == file_format.lower())
    if chromatography:
        runs = runs.where(normalize_chromatography(F.col("chromatography")) == normalize_chromatography(F.lit(chromatography)))
    if polarity:
        p = polarity.lower()
        wanted = ["pos", "fps"] if p in ("pos", "positive", "fps") else ["neg", *(["fps"] * fps_for_negative)] if p in ("neg", "negative") else [p]
        runs = runs.where(F.lower("polarity").isin(wanted))
    return runs.where(F.lower("ms_level") == ms_level.lower()) if ms_level else runs


def lookup_runs(runs: DataFrame, **filters) -> DataFrame:
    return filter_runs(runs, **filters).orderBy("chromatography", "ms_level", "polarity", "file_path")


def run_counts(runs: DataFrame) -> DataFrame:
    """(file_format, field, value, n): runs of each format by file type, chromatography, MS level and polarity."""
    fields = ["file_type", "chromatography", "ms_level", "polarity"]
    sets = [[F.col("file_format"), F.col(f)] for f in fields]
    counted = runs.groupingSets(sets, "file_format", *fields).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    which = F.coalesce(*(F.when(F.col("g") == 15 - (8 >> i), f) for i, f in enumerate(fields)))
    return counted.select("file_format", which.alias("field"), F.coalesce(*fields).alias("value"), "n")


def unconverted_files(paths: DataFrame) -> DataFrame:
    """Stems of raw files that haven't failed and aren't there as both mzML and h5."""
    name = F.element_at(F.split("path", "/"), -1)
    files = paths.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.regexp_extract(name, r"\.([^.]*)$", 1).alias("ext")).distinct()
    done = files.where("ext in ('mzML', 'h5')").groupBy("stem").agg(F.count("*").alias("n")).where("n = 2")
    raw = files.where("ext = 'raw'").select("stem")
    return raw.join(files.where("ext = 'failed'"), "stem", "left_anti").join(done, "stem", "left_anti")
