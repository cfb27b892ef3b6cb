"""Errors and quality scores of identifications as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ppm_error(measured: Column, theoretical: Column, signed: bool = False) -> Column:
    e = (measured - theoretical) / F.nullif(theoretical, F.lit(0.0)) * 1e6
    return e if signed else F.abs(e)


def da_error(measured: Column, theoretical: Column, signed: bool = False) -> Column:
    return measured - theoretical if signed else F.abs(measured - theoretical)


def rt_error(measured: Column, theoretical: Column, signed: bool = False) -> Column:
    return measured - theoretical if signed else F.abs(measured - theoretical)


def mz_quality(ppm: Column, da: Column) -> Column:
    p, d = F.abs(ppm), F.abs(da)
    return F.when(p.isNull() | d.isNull(), None).when((p <= 5) | (d <= 0.0015), 1.0).when(p <= 10, 0.5).otherwise(0.0)


def rt_quality(error: Column, chromatography: Column) -> Column:
    """C18 (but not lipid) methods are held to a quarter and half minute, others to half and two minutes."""
    e, method = F.abs(error), F.lower(chromatography)
    tight = method.contains("c18") & ~method.contains("lipid")
    good, fair = F.when(tight, 0.25).otherwise(0.5), F.when(tight, 0.5).otherwise(2.0)
    return F.when(e.isNull(), None).when(e <= good, 1.0).when(e <= fair, 0.5).otherwise(0.0)


def msms_quality(notes: Column) -> Column:
    """The number before the first comma."""
    return F.trim(F.split(notes, ",")[0]).try_cast("double")


def total_score(*parts: Column) -> Column:
    return F.aggregate(F.array_compact(F.array(*parts)), F.lit(0.0), lambda a, x: a + x)


def msi_level(mz: Column, rt: Column, msms: Column) -> Column:
    scores = F.array_sort(F.array_compact(F.array(mz, rt, msms)))
    n = F.size(scores)
    half = F.floor((n - 1) / 2).cast("int")
    median = F.when(n > 0, (F.get(scores, half) + F.get(scores, n - 1 - half)) / 2)
    return (
        F.when(msms == -1, "REMOVE, INVALIDATED BY BAD MSMS MATCH")
        .when((n == 0) | (median < 1), "putative")
        .when(total_score(mz, rt, msms) == 3, "Exceeds Level 1")
        .otherwise("Level 1")
    )


def polynomial(x: Column, coefficients: list[float]) -> Column:
    """Horner's rule; coefficients from the constant up."""
    out = F.lit(0.0)
    for c in reversed(coefficients):
        out = out * x + F.lit(float(c))
    return out


def format_equation(coefficients: list[float]) -> str:
    names = ["", " * RT_atlas", " * RT_atlas^2", " * RT_atlas³"][: len(coefficients)]
    return "RT_aligned = " + " + ".join(f"{c:.6f}{n}" for c, n in zip(coefficients, names))
