"""Names of runs and projects as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the naming convention: the fields of a run name and of a project name, in order.
_ANY, _MAYBE, _NUMBERS = "[^_]+", "[^_]*", "[0-9-]+"
RUN_FIELDS = {
    "date": _ANY, "owner": _ANY, "pi": _ANY, "project_id": _NUMBERS, "project_shortname": _ANY, "experiment": _ANY, "instrument": _ANY,
    "chromatography": _ANY, "run_id": _ANY, "polarity": "POS|NEG|FPS", "ms_level": "MS1|MS2|MSMS", "sample_number": _ANY, "sample_name": _ANY,
    "replicate": _MAYBE, "run_metadata": _MAYBE, "run_number": "Run[0-9]+|[0-9]+",
}
RUN_FORMATS = ("raw", "mzML", "h5")
PROJECT_FIELDS = {
    "date": "[0-9]{8}", "owner": "JGI|EB|EGSB", "pi": _ANY, "project_id": _NUMBERS, "project_shortname": _ANY, "experiment": _ANY,
    "instrument": _ANY, "chromatography": _ANY, "run_id": _ANY,
}
CHROMATOGRAPHY_ALIASES = {"hilicz": "hilic", "c18-ep": "c18", "c18ep": "c18"}
# File type by sample name.
FILE_TYPES = {"qc": "qc", "istd": "istd", "exctrl": "exctrl", "txctrl": "exctrl", "injbl": "injbl", "blank": "injbl", "refstd": "refstd", "standard": "refstd"}


def _pattern(fields: dict[str, str]) -> str:
    return "_".join(f"({p})" for p in fields.values())


RUN_PATTERN = f"^{_pattern(RUN_FIELDS)}\\.({'|'.join(RUN_FORMATS)})$"
PROJECT_PATTERN = f"^{_pattern(PROJECT_FIELDS)}(?:_({_ANY}))?$"


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[key]


def normalize_chromatography(c: Column) -> Column:
    return F.coalesce(_lookup(CHROMATOGRAPHY_ALIASES, F.lower(c)), F.lower(c))


def run_name_parts(name: Column) -> Column:
    """The parts of a run name between its underscores; NULL where the name doesn't follow the convention."""
    return F.when(name.rlike(RUN_PATTERN), F.split(name, "_"))


def run_fields(parts: Column) -> dict[str, Column]:
    """The 17 fields of a run name from its parts: no field holds an underscore, and the last part has the format too."""
    out = {f: F.get(parts, F.lit(i)) for i, f in enumerate(RUN_FIELDS)}
    last = out["run_number"]
    out |= {"run_number": F.substring_index(last, ".", 1), "ext": F.regexp_extract(last, rf"\.({'|'.join(RUN_FORMATS)})", 1)}
    return out | {"chromatography": normalize_chromatography(out["chromatography"])}


def parse_run_filename(name: Column) -> Column:
    """Struct of the 17 fields of a run name; NULL where the name doesn't follow the convention."""
    return F.when(name.rlike(RUN_PATTERN), F.struct(*(c.alias(f) for f, c in run_fields(F.split(name, "_")).items())))


def parse_project_name(name: Column) -> Column:
    """Struct of the nine fields of a project name and its suffix; NULL where the name doesn't follow the convention."""
    parts = [F.regexp_extract(name, PROJECT_PATTERN, i).alias(f) for i, f in enumerate([*PROJECT_FIELDS, "suffix"], 1)]
    return F.when(name.rlike(PROJECT_PATTERN), F.struct(*parts))


def classify_file_type(sample_name: Column, run_metadata: Column) -> Column:
    each = (_lookup(FILE_TYPES, F.lower(F.trim(c))) for c in (sample_name, run_metadata))
    return F.coalesce(*each, F.lit("experimental"))


def short_filename(name: Column) -> Column:
    """Fields 13 and 16 of the stem; shorter names give what they have, the empty name 'no data'."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    parts = F.split(stem, "_")
    return (
        F.when(F.coalesce(stem, F.lit("")) == "", "no data")
        .when(F.size(parts) > 15, F.concat_ws("_", F.get(parts, F.lit(12)), F.get(parts, F.lit(15))))
        .when(F.size(parts) > 12, F.get(parts, F.lit(12)))
        .otherwise(stem)
    )


def natural_key(text: Column) -> Column:
    """A sort key in which runs of digits compare as numbers of up to 20 digits."""
    runs = F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.lpad(r, 20, "0")).otherwise(r)), "")


def file_color_key(name: Column, keys: list[str], default: str) -> Column:
    """The first of `keys` that the name contains."""
    out = F.lit(default)
    for k in reversed(keys):
        out = F.when(F.contains(name, F.lit(k)), k).otherwise(out)
    return out


def inchikey_block(key: Column) -> Column:
    return F.split(key, "-")[0]


# Adducts that tell the polarity of a table that doesn't state it.
POSITIVE_ADDUCTS = ("[M+H]+", "[M+Na]+", "[M+NH4]+")
NEGATIVE_ADDUCTS = ("[M-H]-", "[M+Cl]-", "[M-2H]-", "[M+formate]-")


def detect_polarity(polarity: Column, adduct: Column) -> Column:
    """An aggregate: a stated polarity of the rows (the lowest of several), else what the adducts say; NULL if neither does."""

    def any_of(names: tuple[str, ...]) -> Column:
        hit = F.lit(False)
        for n in names:
            hit = hit | F.contains(adduct, F.lit(n))
        return F.max(hit)

    return F.coalesce(F.min(polarity), F.when(any_of(POSITIVE_ADDUCTS), "positive").when(any_of(NEGATIVE_ADDUCTS), "negative"))


def detect_chromatography(chromatography: Column) -> Column:
    return normalize_chromatography(F.nullif(F.trim(chromatography), F.lit("")))
