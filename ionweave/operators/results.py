"""Result datasets: the two wide tables, their Hive layout, and the parametric filter language."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import parse_project_name
from ..functions.values import spectrum_json
from ..sources.scratch import exists

LOG = logging.getLogger(__name__)

# Columns of the two datasets and their partitions, in order.
FILE_TEXT = (
    "mz_rt_uid", "compound_name", "identified_metabolite", "label", "inchi_key", "formula", "smiles", "inchi", "pubchem_cid", "iupac_name", "adduct",
    "best_ms1_file", "filename", "file_group", "ms1_notes", "ms2_notes", "msi_level", "control_filter", "overlapping_compound",
    "overlapping_inchi_keys", "isomer_details", "identification_notes", "analyst_notes", "other_notes", "best_ms2_file", "best_ms2_num_ions",
    "best_ms2_matching_ions", "best_ms2_spectrum_rt_mz", "ms1_spectrum_rt_i", "msms_file", "msms_numberofions", "msms_matchingions",
)
FILE_NUMBERS = (
    "compound_index", "atlas_mz", "atlas_rt_peak", "atlas_rt_min", "atlas_rt_max", "rt_min", "rt_max", "exact_mass", "best_ms1_rt", "best_ms1_mz",
    "best_ms1_intensity", "best_ms1_ppm_error", "best_ms1_rt_error", "best_ms2_rt", "best_ms2_score", "best_ms2_mz", "best_ms2_mz_ppm_error",
    "best_ms2_mz_error_da", "best_ms2_rt_error", "peak_height", "peak_area", "rt_peak", "rt_centroid", "mz_peak", "mz_centroid", "measured_rt",
    "measured_mz", "mz_theoretical", "mz_measured", "mz_error", "mz_ppmerror", "rt_theoretical", "rt_error", "msms_rt", "msms_score", "mz_quality",
    "rt_quality", "msms_quality", "total_score",
)
LFC_TEXT = (
    "mz_rt_uid", "inchi_key", "compound_name", "control_filter", "condition_1", "condition_2", "adduct", "formula", "smiles", "inchi", "pubchem_cid",
    "iupac_name", "ms1_notes", "ms2_notes", "msi_level", "identification_notes", "analyst_notes", "other_notes", "best_ms2_file", "best_ms2_num_ions",
    "best_ms2_matching_ions", "best_ms2_spectrum_rt_mz", "msms_file", "msms_numberofions", "msms_matchingions",
)
LFC_NUMBERS = (
    "compound_index", "log2_fold_change", "rt_min", "rt_max", "best_ms1_rt", "best_ms1_mz", "best_ms1_intensity", "best_ms1_ppm_error",
    "best_ms1_rt_error", "atlas_mz", "atlas_rt_peak", "atlas_rt_min", "atlas_rt_max", "best_ms2_rt", "best_ms2_score", "best_ms2_mz",
    "best_ms2_mz_ppm_error", "best_ms2_mz_error_da", "best_ms2_rt_error", "msms_score", "msms_rt", "mz_theoretical", "mz_measured", "mz_error",
    "mz_ppmerror", "rt_theoretical", "rt_error",
)
PARTITIONS = ("project_name", "chromatography", "polarity", "analysis_type", "analysis_name")
#: Rows of a row group, so that filters skip parts of a file.
ROWS_PER_GROUP = 100_000
GRAINS = {"compound_file": (FILE_TEXT, FILE_NUMBERS), "compound_lfc": (LFC_TEXT, LFC_NUMBERS)}


def conform(df: DataFrame, grain: str) -> DataFrame:
    """df with the grain's columns in order; missing ones are NULL, others are left out."""
    text, numbers = GRAINS[grain]
    kinds = {**dict.fromkeys(text, "string"), **dict.fromkeys(numbers, "double")}
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()))


def _errors(mz: Column, mz_t: Column, rt: Column, rt_t: Column) -> dict[str, Column]:
    ppm = (mz - mz_t) / F.nullif(mz_t, F.lit(0.0)) * 1e6
    return {"mz_theoretical": mz_t, "mz_measured": mz, "mz_error": F.abs(mz - mz_t), "mz_ppmerror": F.abs(ppm), "rt_theoretical": rt_t, "rt_error": F.abs(rt - rt_t)}


def _best_ms2_columns() -> dict[str, Column]:
    """Signed errors of the best MS2 against the atlas, and its columns under the names of the identification table."""
    mz, mz_t = F.col("best_ms2_mz"), F.col("atlas_mz")
    errors = {"best_ms2_mz_ppm_error": (mz - mz_t) / F.nullif(mz_t, F.lit(0.0)) * 1e6, "best_ms2_mz_error_da": F.abs(mz - mz_t), "best_ms2_rt_error": F.col("best_ms2_rt") - F.col("atlas_rt_peak")}
    names = {"msms_file": "best_ms2_file", "msms_rt": "best_ms2_rt", "msms_score": "best_ms2_score", "msms_numberofions": "best_ms2_num_ions", "msms_matchingions": "best_ms2_matching_ions"}
    return errors | {k: F.col(c) for k, c in names.items()}


def compound_file_table(metrics: DataFrame, quality: DataFrame, best_ms2: DataFrame, ms1_wide: DataFrame) -> DataFrame:
    """One row per compound and file: metrics with the compound's quality table, best MS2 and MS1 spectrum, in order of atlas_mz (NULL last)."""
    rows = metrics.join(quality.drop(*(c for c in quality.columns if c in metrics.columns and c != "mz_rt_uid")), "mz_rt_uid", "left")
    rows = rows.join(best_ms2.drop(*(c for c in best_ms2.columns if c in rows.columns and c != "mz_rt_uid")), "mz_rt_uid", "left")
    spectrum = ms1_wide.select("mz_rt_uid", "filename", spectrum_json(F.col("points.rt"), F.col("points.i")).alias("ms1_spectrum_rt_i"))
    rows = rows.join(spectrum, ["mz_rt_uid", "filename"], "left").withColumns(_best_ms2_columns())
    rows = rows.withColumns(_errors(F.col("mz_centroid"), F.col("atlas_mz"), F.col("rt_peak"), F.col("atlas_rt_peak")))
    return sort_for_pruning(conform(rows.withColumns({"measured_mz": F.col("mz_centroid"), "measured_rt": F.col("rt_peak")}), "compound_file"), ["atlas_mz"])


def compound_lfc_table(lfc: DataFrame, quality: DataFrame, best_ms2: DataFrame) -> DataFrame:
    """One row per compound and pair of conditions, in order of the conditions and atlas_mz (NULL last)."""
    rows = lfc.join(quality.drop(*(c for c in quality.columns if c in lfc.columns and c != "mz_rt_uid")), "mz_rt_uid", "left")
    rows = rows.join(best_ms2.drop(*(c for c in best_ms2.columns if c in rows.columns and c != "mz_rt_uid")), "mz_rt_uid", "left")
    rows = rows.withColumns(_best_ms2_columns()).withColumns(_errors(F.col("best_ms1_mz"), F.col("atlas_mz"), F.col("best_ms1_rt"), F.col("atlas_rt_peak")))
    return sort_for_pruning(conform(rows, "compound_lfc"), ["condition_1", "condition_2", "atlas_mz"])


def sort_for_pruning(df: DataFrame, keys: list[str]) -> DataFrame:
    """Ranges of the keys, each sorted, so that readers can skip row groups."""
    order = [F.asc_nulls_last(k) for k in keys]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def control_filter_lookup(filters: DataFrame, order: str = "compound_index") -> DataFrame:
    """(inchi_key, control_filter) of the last row of each key."""
    return filters.groupBy("inchi_key").agg(F.max_by("control_filter", order).alias("control_filter"))


def with_partition_columns(df: DataFrame, values: dict[str, str]) -> DataFrame:
    if clash := set(PARTITIONS) & set(df.columns):
        raise ValueError(f"columns that are partitions too: {sorted(clash)}")
    return df.withColumns({p: F.lit(values[p]) for p in PARTITIONS})


def leaf(base: str, grain: str, values: dict[str, str]) -> str:
    """The folder of one analysis' rows of a grain."""
    return "/".join([base, grain, *(f"{p}={values[p]}" for p in PARTITIONS)])


def provenance_fields(spark: SparkSession, values: dict[str, str], provenance: dict[str, str]) -> dict[str, str]:
    """What a file says of its analysis: partition values, the given fields, the time, and the fields of a project name that parses."""
    row = spark.range(1).select(parse_project_name(F.lit(values["project_name"])).alias("p"), F.date_format(F.current_timestamp(), "yyyy-MM-dd-HH-mm-ss").alias("t")).first()
    parsed = {k: v for k, v in row.p.asDict().items() if v} if row.p else {}
    return {k: str(v) for k, v in ({"created_date": row.t} | parsed | values | provenance).items()}


def write_result_datasets(tables: dict[str, DataFrame], base: str, values: dict[str, str], overwrite: bool = True, provenance: dict[str, str] | None = None) -> None:
    """Each grain below base in Hive layout; only the partitions of these values are replaced. Empty tables aren't written.

    Provenance goes into the footers of the files, as metadata of the first column's schema, so each analysis keeps its own.
    Schema maps stand beside the data by project and grain, as JSON lines and as CSV."""
    for grain, df in tables.items():
        if df.isEmpty():
            continue
        spark, project = df.sparkSession, values["project_name"]
        if not overwrite and exists(spark, leaf(base, grain, values)):
            continue
        maps = schema_map(spark, {grain: with_partition_columns(df, values)}).coalesce(1).orderBy("name").write.mode("overwrite")
        maps.json(f"{base}/schema_maps/{project}-{grain}.schema_map.json")
        maps.option("header", True).csv(f"{base}/schema_maps/{project}-{grain}.schema_map.csv")
        if provenance is not None:
            first, *rest = df.columns
            df = df.select(F.col(first).alias(first, metadata={"provenance": provenance_fields(spark, values, provenance)}), *rest)
        out = with_partition_columns(df, values).write.mode("overwrite").partitionBy(*PARTITIONS).option("compression", "zstd")
        out.option("parquet.block.row.count.limit", ROWS_PER_GROUP).option("partitionOverwriteMode", "dynamic").parquet(f"{base}/{grain}")


def read_result_dataset(spark: SparkSession, base: str, grain: str) -> DataFrame:
    text, numbers = GRAINS[grain]
    schema = ", ".join([*(f"{c} string" for c in text), *(f"{c} double" for c in numbers), *(f"{p} string" for p in PARTITIONS)])
    return spark.read.schema(schema).parquet(f"{base}/{grain}")


def result_footer_fields(spark: SparkSession, base: str, grain: str, values: dict[str, str]) -> DataFrame:
    """Provenance of one analysis as its files' footers have it, as one row, and its number of rows; no row where there is none."""
    path = leaf(base, grain, values)
    rows = spark.read.parquet(path) if exists(spark, path) else None
    fields = rows.schema[0].metadata.get("provenance", {}) if rows is not None else {}
    if not fields:
        return spark.createDataFrame([], "n_rows long")
    return rows.agg(*(F.lit(v).alias(k) for k, v in fields.items()), F.count("*").alias("n_rows"))


def schema_map(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(name, dtype, table, position, source) of all columns, by name."""
    rows = [(f.name, f.dataType.simpleString(), t, i, "partition_directory" if f.name in PARTITIONS else "stored") for t, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(sorted(rows), "name string, dtype string, table string, position long, source string")


# The filter language: a suffix of a parameter names the comparison. Longer suffixes are tried first.
_COMPARE = {
    "_abs_min": (lambda c, v: (c >= v) | (c <= -v), "({c} >= {v} OR {c} <= -{v})"),
    "_abs_max": (lambda c, v: (c >= -v) & (c <= v), "({c} >= -{v} AND {c} <= {v})"),
    "_abs_gt": (lambda c, v: (c > v) | (c < -v), "({c} > {v} OR {c} < -{v})"),
    "_abs_lt": (lambda c, v: (c > -v) & (c < v), "({c} > -{v} AND {c} < {v})"),
    "_min": (lambda c, v: c >= v, "{c} >= {v}"),
    "_max": (lambda c, v: c <= v, "{c} <= {v}"),
    "_in": (lambda c, v: c.isin(v), "{c} IN ({v})"),
    "": (lambda c, v: c == v, "{c} = {v}"),
}


def _quoted(v) -> str:
    if isinstance(v, (list, tuple, set)):
        return ", ".join(map(_quoted, v))
    if isinstance(v, bool):
        return str(v).upper()
    return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def _terms(columns: list[str], params: dict) -> list[tuple[Column, str]]:
    """Column and SQL text of each parameter. An exact column name wins over a suffix; unknown columns are skipped with a message."""
    out = []
    for name, value in params.items():
        if value is None or name == "grain":
            continue
        if name == "condition_pair":
            a, b = value
            c1, c2 = F.col("condition_1"), F.col("condition_2")
            out.append((((c1 == a) & (c2 == b)) | ((c1 == b) & (c2 == a)), f"((condition_1 = {_quoted(a)} AND condition_2 = {_quoted(b)}) OR (condition_1 = {_quoted(b)} AND condition_2 = {_quoted(a)}))"))
            continue
        if name == "lfc_directional_min":
            t, c, least = value["treatment"], value["control"], value["threshold"]
            c1, c2, x = F.col("condition_1"), F.col("condition_2"), F.col("log2_fold_change")
            text = f"((condition_1 = {_quoted(t)} AND condition_2 = {_quoted(c)} AND log2_fold_change >= {least}) OR (condition_1 = {_quoted(c)} AND condition_2 = {_quoted(t)} AND log2_fold_change <= -{least}))"
            out.append((((c1 == t) & (c2 == c) & (x >= least)) | ((c1 == c) & (c2 == t) & (x <= -least)), text))
            continue
        suffix = "" if name in columns else next((s for s in _COMPARE if s and name.endswith(s)), "")
        column = name.removesuffix(suffix) if suffix else name
        if column not in columns:
            LOG.warning("skipped: no column %s", column)
            continue
        if suffix == "_in" and not isinstance(value, (list, tuple, set)):
            value = [value]
        try:
            test, text = _COMPARE[suffix]
            out.append((test(F.col(column), list(value) if isinstance(value, (tuple, set)) else value), text.format(c=column, v=_quoted(value))))
        except (TypeError, ValueError) as e:
            LOG.warning("skipped: %s: %s", name, e)
    return out


def param_query(dataset: DataFrame, params: dict) -> DataFrame:
    """Rows that meet all parameters; partitions and row groups are pruned by Spark."""
    terms = [c for c, _ in _terms(dataset.columns, params)]
    return dataset.where(reduce(lambda a, b: a & b, terms)) if terms else dataset


def param_query_sql(columns: list[str], params: dict) -> str:
    """The same as SQL text over a view named as the grain."""
    terms = [t for _, t in _terms(columns, params)]
    return f"SELECT * FROM {params.get('grain', 'compound_lfc')}" + (" WHERE " + " AND ".join(terms) if terms else "")


def param_query_named(datasets: dict[str, DataFrame], yaml_text: str, name: str) -> DataFrame:
    import yaml

    named = (yaml.safe_load(yaml_text) or {}).get("queries", {})
    if name not in named:
        raise KeyError(f"no query {name}")
    params = named[name]
    return param_query(datasets[params.get("grain", "compound_lfc")], params)
