"""Reference spectra, compound and atlas tables, id maps, and their exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPECTRUM_SCHEMA = "id string, database string, name string, inchi_key string, polarity string, precursor_mz double, adduct string, collision_energy string, mz array<double>, intensities array<double>, _corrupt string"
#: Peaks so far above the precursor can't be its fragments.
ABOVE_PRECURSOR = 2.5
_POLARITIES = {"pos": "positive", "neg": "negative", "positive": "positive", "negative": "negative"}


def _polarity(c):
    return F.coalesce(F.create_map(*(F.lit(x) for kv in _POLARITIES.items() for x in kv))[F.lower(c)], F.lower(c))


def scan_reference_spectra(spark: SparkSession, path: str, database: str | None = None, polarity: str | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Spectra of a JSON-lines library by database, polarity and inchi_key, peaks in order of m/z.

    Bad lines, spectra without peaks or with lists of unequal length, and peaks far above the precursor are dropped; where none is
    left, an error says what was asked for."""
    raw = spark.read.schema(SPECTRUM_SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    found = clean_spectra(raw.where("_corrupt is null").drop("_corrupt"), database, polarity, keys)
    if found.isEmpty():
        raise ValueError(f"no spectra are left of {path} (database {database!r}, polarity {polarity!r}, {'some' if keys is not None else 'all'} keys)")
    return found


def clean_spectra(raw: DataFrame, database: str | None = None, polarity: str | None = None, keys: DataFrame | None = None) -> DataFrame:
    if database:
        raw = raw.where(F.col("database") == database)
    if polarity:
        raw = raw.where(_polarity(F.col("polarity")) == _POLARITIES.get(polarity.lower(), polarity.lower()))
    if keys is not None:
        raw = raw.join(keys, "inchi_key", "left_semi")
    raw = raw.where((F.size("mz") > 0) & (F.size("mz") == F.size("intensities")))
    near = F.filter(F.arrays_zip("mz", "intensities"), lambda p: F.col("precursor_mz").isNull() | (p.mz < F.col("precursor_mz") + ABOVE_PRECURSOR))
    raw = raw.withColumn("p", F.array_sort(near)).where(F.size("p") > 0)
    return raw.withColumns({"mz": F.col("p.mz"), "intensities": F.col("p.intensities")}).drop("p")


def convert_reference_spectra(spark: SparkSession, source: str, target: str, decimals: int = 4) -> None:
    """A TSV library with spectra as [[mz], [intensity]] text to JSON lines."""
    converted_spectra(spark.read.csv(source, sep="\t", header=True), decimals).write.mode("overwrite").json(target)


def converted_spectra(rows: DataFrame, decimals: int = 4) -> DataFrame:
    """m/z rounded, blanks and bad numbers NULL."""
    lists = F.from_json("spectrum", "array<array<double>>")
    text = {c: F.nullif(F.trim(c), F.lit("")) for c in rows.columns if c not in ("spectrum", "precursor_mz")}
    return rows.withColumns(text).withColumns({
        "precursor_mz": F.col("precursor_mz").try_cast("double"),
        "mz": F.transform(F.get(lists, F.lit(0)), lambda x: F.round(x, decimals)),
        "intensities": F.get(lists, F.lit(1)),
    }).drop("spectrum")


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="," if path.rstrip("/").endswith(".csv") else "\t", header=True)


def _required(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    if lost := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {lost}")
    return df


def compound_columns(df: DataFrame) -> DataFrame:
    """A label wins over the compound_name, which is kept as compound_name_input."""
    if "label" in df.columns:
        df = df.withColumnRenamed("compound_name", "compound_name_input").withColumnRenamed("label", "compound_name")
    return _required(df, ("inchi_key", "compound_name"))


def scan_compound_table(spark: SparkSession, path: str) -> DataFrame:
    return compound_columns(_table(spark, path))


def atlas_columns(df: DataFrame) -> DataFrame:
    """Numbers cast; rt_min, rt_max and mz_tolerance get defaults where a table has no such column."""
    df = _required(compound_columns(df), ("rt_peak", "mz", "adduct"))
    numbers = [c for c in ("rt_peak", "mz", "rt_min", "rt_max", "mz_tolerance") if c in df.columns]
    df = df.withColumns({c: F.col(c).try_cast("double") for c in numbers})
    defaults = {"rt_min": F.col("rt_peak") - 0.5, "rt_max": F.col("rt_peak") + 0.5, "mz_tolerance": F.lit(5.0)}
    return df.withColumns({c: d for c, d in defaults.items() if c not in df.columns})


def scan_atlas_table(spark: SparkSession, path: str) -> DataFrame:
    return atlas_columns(_table(spark, path))


def scan_id_map(spark: SparkSession, paths: list[str]) -> DataFrame:
    return id_map(spark.read.csv(paths, sep="\t", header=True, schema="id string, inchi_key string"))


def id_map(rows: DataFrame) -> DataFrame:
    """(inchi_key, cpd_ids): the ids of each key in order, joined by semicolons."""
    return rows.where("inchi_key is not null").groupBy("inchi_key").agg(F.concat_ws(";", F.array_sort(F.collect_set("id"))).alias("cpd_ids"))


def export_atlas(flat: DataFrame, path: str, sep: str = "\t") -> None:
    """One folder for each atlas_uid."""
    flat.write.mode("overwrite").partitionBy("atlas_uid").option("header", True).option("sep", sep).csv(path)


def read_exported_atlas(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    return atlas_columns(spark.read.csv(path, sep=sep, header=True))


def export_curation(curation: DataFrame, path: str) -> None:
    """CSV; lists and structs as JSON text."""
    nested = {c: F.to_json(c) for c, k in curation.dtypes if k.startswith(("array", "struct", "map"))}
    (curation.withColumns(nested) if nested else curation).write.mode("overwrite").option("header", True).csv(path)


def write_data_sheets(sheets: dict[str, DataFrame], base: str) -> None:
    for metric, df in sheets.items():
        df.write.mode("overwrite").option("header", True).csv(f"{base}/{metric}")
