"""Lenient casts, text clean-up and JSON as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HIT_SCHEMA = "array<struct<database:string,ref_id:string,ref_name:string,score:double,num_matches:int,mz_theoretical:double,mz_measured:double,ppm_error:double>>"


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def safe_float(c: Column) -> Column:
    return nan_to_null(c.try_cast("double"))


def safe_isnan(c: Column) -> Column:
    """True for NULL, NaN and what is no number."""
    return safe_float(c).isNull()


def as_list(c: Column, element: str) -> Column:
    return F.coalesce(c, F.array().cast(f"array<{element}>"))


def jsonable_list(c: Column) -> Column:
    """Numbers of a list as doubles, which JSON can hold; [] for NULL."""
    return F.transform(as_list(c, "double"), lambda x: x.cast("double"))


def json_safe(c: Column) -> Column:
    """NULL for NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def round_list(c: Column, decimals: int = 4) -> Column:
    return F.transform(c, lambda x: F.round(x, decimals))


def strip_nonchars(c: Column) -> Column:
    """Without U+FDD0 to U+FDEF and the last two code points of each plane."""
    ends = "".join(f"\\x{{{p:X}FFFE}}\\x{{{p:X}FFFF}}" for p in range(1, 17))
    return F.regexp_replace(c, f"[\\x{{FDD0}}-\\x{{FDEF}}\\x{{FFFE}}\\x{{FFFF}}{ends}]", "")


def format_ions(mzs: Column) -> Column:
    return F.array_join(F.transform(mzs, lambda x: F.format_string("%.3f", x.cast("double"))), ",")


def spectrum_json(first: Column, second: Column) -> Column:
    return F.to_json(F.array(first, second))


def hits_json_decode(c: Column) -> Column:
    """Hit structs of a JSON list or single object; [] for NULL, '', none, null and bad JSON."""
    t = F.trim(c)
    whole = F.when(t.startswith("{"), F.concat(F.lit("["), t, F.lit("]"))).otherwise(t)
    usable = F.when(~F.lower(t).isin("", "none", "null"), whole)
    return F.coalesce(F.from_json(usable, HIT_SCHEMA), F.array().cast(HIT_SCHEMA))


def collision_energy_label(energy: Column) -> Column:
    """The two stepped energies by their means, else CE and the rounded energy."""
    return (
        F.when(F.abs(energy - 23.333) < 0.01, "CE102040")
        .when(F.abs(energy - 43.333) < 0.01, "CE205060")
        .otherwise(F.concat(F.lit("CE"), F.bround(energy, 0).cast("int").cast("string")))
    )


# Beginnings of synonyms that are database codes.
CODE_PREFIXES = (
    "nan", "Untitled", "Oprea", "Opera", "AKO", "CHEMBL", "SR-", "SCHEM", "EU-", "MLS", "NSC", "ChemDiv", "ST0", "TimTec", "HMS", "BIM", "CB",
    "CCG-", "Cambridge", "SMR", "AB0", "BRD-", "NCG", "BDBM", "CBKinase", "BAS ", "ZINC", "GNF", "SQX", "CDS", "STK", "NCI", "TNP", "Boc-Tyr-OH",
    "PD", "UNM", "BSP", "CCRIS", "MFCD", "IDI", "ST5", "AC1", "WAY-", "KUC", "DTXSID", "MixCom", "CK-", "ASN ", "MMV", "SKI-", "VU", "SMSF", "Bio2",
    "REGID", "SDCC", "BCBc", "SMP", "TCMDC", "cid_", "BCP", "AST ", "SY0", "AM-", "IFLab", "Cream",
)


def pick_synonym(names: Column) -> Column:
    """The shortest synonym (the first of several) that is no database code, no cream and no bare number; else Undefined."""
    code = "^(" + "|".join(CODE_PREFIXES) + ")"
    plain = F.filter(names, lambda n: ~n.rlike(code) & ~F.lower(n).contains("cream") & ~F.regexp_replace(n, r"[A-Z\-]", "").rlike(r"^\d+$"))
    ranked = F.array_min(F.transform(plain, lambda n, i: F.struct(F.length(n).alias("size"), i.alias("place"), n.alias("name"))))
    return F.coalesce(ranked["name"], F.lit("Undefined"))


def find_cas(names: Column) -> Column:
    """The first synonym with exactly two hyphens."""
    return F.get(F.filter(names, lambda n: F.length(n) - F.length(F.replace(n, F.lit("-"), F.lit(""))) == 2), F.lit(0))
