"""Atlas, target, compound and curation tables: checks, joins and updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def violations(atlas: DataFrame) -> DataFrame:
    """(mz_rt_uid, reason) for each rule that a row of a flat atlas breaks."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c)) == "")
    number = lambda c: F.col(c).isNull() | F.isnan(c)
    rules = {
        "no compound": blank("compound_uid"),
        "bad mz": number("mz") | (F.col("mz") <= 0),
        "no rt bounds": number("rt_min") | number("rt_max"),
        "rt bounds out of order": F.col("rt_min") >= F.col("rt_max"),
        "no adduct": blank("adduct"),
    }
    reasons = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), name) for name, c in rules.items())))
    return atlas.select("mz_rt_uid", F.explode(reasons).alias("reason"))


def validate_atlas(atlas: DataFrame) -> DataFrame:
    if atlas.isEmpty():
        raise ValueError("an atlas needs at least one compound")
    if found := violations(atlas).limit(8).collect():
        raise ValueError(f"invalid atlas: {[tuple(r) for r in found]}")
    return atlas


def atlas_star_join(atlases: DataFrame, associations: DataFrame, targets: DataFrame, compounds: DataFrame) -> DataFrame:
    """The flat atlas: header, targets in their order, and compound fields where the target has none."""
    c = compounds.select("inchi_key", F.col("compound_name").alias("__name"), F.coalesce("formula", F.lit("")).alias("formula"), F.coalesce("mono_mass", F.lit(0.0)).alias("mono_mass"))
    flat = atlases.join(associations, "atlas_uid").join(targets, "mz_rt_uid").join(c, "inchi_key", "left")
    flat = flat.withColumns({"compound_name": F.coalesce("compound_name", "__name"), "formula": F.coalesce("formula", F.lit("")), "mono_mass": F.coalesce("mono_mass", F.lit(0.0))})
    return flat.drop("__name")


def atlas_from_table(rows: DataFrame, compounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose compound is known, and those whose isn't."""
    known = compounds.select("inchi_key").distinct()
    return rows.join(known, "inchi_key", "left_semi"), rows.join(known, "inchi_key", "left_anti")


def enrich_targets(targets: DataFrame, compounds: DataFrame, texts: tuple[str, ...] = ("formula",), mass: str = "mono_mass") -> DataFrame:
    """Blank texts, and a mass that is missing or not positive, filled from the compounds."""
    right = compounds.select("inchi_key", *(F.col(c).alias(f"__{c}") for c in (*texts, mass)))
    out = targets.join(right, "inchi_key", "left")
    filled = {c: F.when(F.trim(F.col(c)) != "", F.col(c)).otherwise(F.col(f"__{c}")) for c in texts}
    filled[mass] = F.when(F.col(mass) > 0, F.col(mass)).otherwise(F.col(f"__{mass}"))
    return out.withColumns(filled).drop(*(f"__{c}" for c in (*texts, mass)))


def missing_compounds(targets: DataFrame, compounds: DataFrame) -> DataFrame:
    return targets.join(compounds, "inchi_key", "left_anti")


def dedup_first(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in a stated order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def upsert_compounds(compounds: DataFrame, new: DataFrame, order: list[Column | str]) -> DataFrame:
    """compounds and those of `new` that it hasn't yet, the first of each key; blank keys are left out."""
    fresh = dedup_first(new.where(F.trim("inchi_key") != ""), ["inchi_key"], order)
    return compounds.unionByName(fresh.join(compounds, "inchi_key", "left_anti").select(*compounds.columns))


def save_atlas_rows(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Rows (atlas_uid, mz_rt_uid, ...) to append: those of atlases not stored yet, with association_order from 0."""
    fresh = new.join(stored.select("atlas_uid").distinct(), "atlas_uid", "left_anti")
    return fresh.withColumn("association_order", F.row_number().over(Window.partitionBy("atlas_uid").orderBy("rt_peak", "mz_rt_uid")) - 1)


def clone_atlas(atlas: DataFrame, stage: str) -> DataFrame:
    """New uids that follow from the stage and the old uid, so a second run makes the same; the old one is kept as parent."""
    return atlas.withColumns({
        "prev_mz_rt_uid": F.col("mz_rt_uid"),
        "mz_rt_uid": F.concat(F.lit("mzrt-"), F.substring(F.sha2(F.concat(F.lit(stage), F.col("mz_rt_uid")), 256), 1, 32)),
        "atlas_name": F.concat_ws("_", "atlas_name", F.lit(stage)),
    })


def update_targets(atlas: DataFrame, updates: DataFrame, key: str = "mz_rt_uid", fields: tuple[str, ...] = ("mz", "rt_peak", "rt_min", "rt_max")) -> DataFrame:
    """Atlas rows with the fields of their update; rows without one are dropped."""
    new = updates.select(F.col("mz_rt_uid").alias(key), *(F.col(c).alias(f"__{c}") for c in fields))
    out = atlas.join(new, key)
    return out.withColumns({c: F.coalesce(f"__{c}", c) for c in fields}).drop(*(f"__{c}" for c in fields))


def update_curation(curation: DataFrame, edits: DataFrame, fields: tuple[str, ...], key: tuple[str, ...] = ("mz_rt_uid",)) -> DataFrame:
    """curation with the listed fields of the edits' rows, NULLs included."""
    new = edits.select(*key, F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in fields))
    out = curation.join(new, list(key), "left")
    return out.withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) for c in fields}).drop("__hit", *(f"__{c}" for c in fields))


def transfer_istd_curation(curation: DataFrame, istd: DataFrame, fields: tuple[str, ...] = ("rt_min", "rt_max", "rt_peak", "ms1_notes", "ms2_notes")) -> DataFrame:
    """Values of the internal standards' curation where a compound's own are '' or 0; says so in analyst_notes."""
    return _transfer(curation, istd, ["inchi_key", "adduct"], fields, "from ISTD curation")


def transfer_cross_polarity(curation: DataFrame, other: DataFrame) -> DataFrame:
    """ms1 and ms2 notes of the opposite polarity's curation where ms2_notes is ''; says so in analyst_notes."""
    return _transfer(curation, other, ["compound_name", "inchi_key"], ("ms1_notes", "ms2_notes"), "from the opposite polarity", F.col("ms2_notes") == "")


def _transfer(curation: DataFrame, source: DataFrame, keys: list[str], fields: tuple[str, ...], note: str, only: Column | None = None) -> DataFrame:
    first = dedup_first(source, keys, ["mz_rt_uid"]).select(*keys, F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in fields))
    kinds = dict(curation.dtypes)
    out = curation.join(first, keys, "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False)) & (F.lit(True) if only is None else only)
    empty = {c: hit & ((F.col(c) == "") if kinds[c] == "string" else (F.col(c) == 0)) for c in fields}
    used = hit if only is not None else F.greatest(*(F.coalesce(e, F.lit(False)) for e in empty.values()))
    new = {c: F.when(hit if only is not None else e, F.col(f"__{c}")).otherwise(F.col(c)) for c, e in empty.items()}
    new["analyst_notes"] = F.when(used, F.concat_ws("; ", F.nullif("analyst_notes", F.lit("")), F.lit(note))).otherwise(F.col("analyst_notes"))
    return out.withColumns(new).drop("__hit", *(f"__{c}" for c in fields))


def merge_annotation_cache(compounds: DataFrame, cache: DataFrame, fields: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Compounds with missing fields filled from the cache, and the keys that it hasn't."""
    right = cache.select("inchi_key", *(F.col(c).alias(f"__{c}") for c in fields))
    out = compounds.join(right, "inchi_key", "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"__{c}")) if c in compounds.columns else F.col(f"__{c}") for c in fields}
    return out.withColumns(filled).drop(*(f"__{c}" for c in fields)), compounds.select("inchi_key").distinct().join(cache, "inchi_key", "left_anti")


def query_atlases(atlases: DataFrame, **filters: str | None) -> DataFrame:
    """Headers whose columns contain the given texts, in any case; newest first, then by name."""
    for column, text in filters.items():
        if text:
            atlases = atlases.where(F.contains(F.lower(F.col(column)), F.lit(text.lower())))
    return atlases.orderBy(F.desc("created_date"), "atlas_name")


def _isomer_columns(targets: DataFrame) -> DataFrame:
    return targets.select("mz_rt_uid", "mz", *(["mono_mass"] if "mono_mass" in targets.columns else []), F.split("inchi_key", "-")[0].alias("block"))


def isomer_blocks(targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The isomers by structure, as classes: (mz_rt_uid, block) of every target, and (block, size) of every block that has a name.

    This is as long as the targets, whatever the blocks' sizes; isomers_of() makes the pairs of the targets that are asked for."""
    own = _isomer_columns(targets).select("mz_rt_uid", "block")
    return own, own.where(F.trim("block") != "").groupBy("block").agg(F.count("*").alias("size"))


def isomers_of(targets: DataFrame, wanted: DataFrame, tolerance: float = 0.005, pair_blank_keys: bool = False) -> DataFrame:
    """(mz_rt_uid, o_mz_rt_uid): for each target in `wanted` (mz_rt_uid) those of equal m/z or mass within the tolerance, or of the same
    first InChIKey block. Only pairs of wanted targets are made, and blank keys pair if `pair_blank_keys` asks for it."""
    from .joins import near_pairs

    other = _isomer_columns(targets)
    own = other.join(wanted.select("mz_rt_uid"), "mz_rt_uid", "left_semi")
    other = other.select(*(F.col(c).alias(f"o_{c}") for c in other.columns))
    pairs = near_pairs(own, other, "mz", "o_mz", tolerance).select("mz_rt_uid", "o_mz_rt_uid")
    if "mono_mass" in own.columns:
        pairs = pairs.unionByName(near_pairs(own, other, "mono_mass", "o_mono_mass", tolerance).select("mz_rt_uid", "o_mz_rt_uid"))
    keyed = own if pair_blank_keys else own.where(F.trim("block") != "")
    pairs = pairs.unionByName(keyed.join(other, F.col("block") == F.col("o_block")).select("mz_rt_uid", "o_mz_rt_uid"))
    return pairs.where("mz_rt_uid <> o_mz_rt_uid").distinct()


def isomer_pairs(targets: DataFrame, tolerance: float = 0.005, pair_blank_keys: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """(mz_rt_uid, isomers): the isomers of all targets, or of those in `wanted`, by isomers_of(); an empty list where there are none.

    Blank keys name no structure, and all of them would be one block of all pairs. Lists of all targets are as long as the blocks are
    large, for each of their targets; where that is too much, isomer_blocks() is the stored form and `wanted` asks for a few."""
    wanted = targets.select("mz_rt_uid") if wanted is None else wanted.select("mz_rt_uid")
    pairs = isomers_of(targets, wanted, tolerance, pair_blank_keys)
    details = targets.select(F.col("mz_rt_uid").alias("o_mz_rt_uid"), F.struct("mz_rt_uid", "compound_name", "inchi_key", "adduct").alias("isomer"))
    lists = pairs.join(details, "o_mz_rt_uid").groupBy("mz_rt_uid").agg(F.array_sort(F.collect_list("isomer")).alias("isomers"))
    empty = F.array().cast("array<struct<mz_rt_uid:string,compound_name:string,inchi_key:string,adduct:string>>")
    return wanted.join(lists, "mz_rt_uid", "left").select("mz_rt_uid", F.coalesce("isomers", empty).alias("isomers"))


def overlapping_compounds(rows: DataFrame, order: str = "mz_rt_uid", tolerance: float = 0.005) -> DataFrame:
    """(mz_rt_uid, overlapping_compound, overlapping_inchi_keys) joined by // in order; '' where a compound stands alone.

    Rows need atlas_mz, mono_mass (NULL if unknown), rt_min and rt_max."""
    from .joins import near_pairs

    own = rows.select("mz_rt_uid", "compound_name", "inchi_key", "atlas_mz", "mono_mass", "rt_min", "rt_max", F.col(order).alias("place"))
    other = own.select(*(F.col(c).alias(f"o_{c}") for c in own.columns))
    one = near_pairs(own.where("atlas_mz <> 0"), other.where("o_atlas_mz <> 0"), "atlas_mz", "o_atlas_mz", tolerance)
    two = near_pairs(own.where("mono_mass <> 0"), other.where("o_mono_mass <> 0"), "mono_mass", "o_mono_mass", tolerance)
    meet = (F.greatest("rt_min", "o_rt_min") <= F.least("rt_max", "o_rt_max")) & ~F.coalesce((F.col("mono_mass") == 0) & (F.col("o_mono_mass") == 0), F.lit(False))
    found = one.where(meet).unionByName(two.where(meet)).select("mz_rt_uid", "o_mz_rt_uid", "o_place", "o_compound_name", "o_inchi_key").where("mz_rt_uid <> o_mz_rt_uid")
    itself = own.select("mz_rt_uid", F.col("mz_rt_uid").alias("o_mz_rt_uid"), F.col("place").alias("o_place"), F.col("compound_name").alias("o_compound_name"), F.col("inchi_key").alias("o_inchi_key"))
    sets = found.unionByName(itself).distinct().groupBy("mz_rt_uid").agg(F.array_sort(F.collect_list(F.struct("o_place", "o_compound_name", "o_inchi_key"))).alias("s"))
    text = lambda c: F.when(F.size("s") > 1, F.array_join(F.col(f"s.{c}"), "//")).otherwise("")
    return sets.select("mz_rt_uid", text("o_compound_name").alias("overlapping_compound"), text("o_inchi_key").alias("overlapping_inchi_keys"))


def analysis_subset(rows: DataFrame, names: list[str]) -> DataFrame:
    """Rows of the analyses named CHROM-POL-TYPE-NAME."""
    spark = rows.sparkSession
    keys = ["chromatography", "polarity", "analysis_type", "analysis_name"]
    wanted = spark.createDataFrame([(n,) for n in names], "n string").select(F.split(F.lower("n"), "-", 4).alias("p")).select(*(F.get("p", F.lit(i)).alias(f"__{k}") for i, k in enumerate(keys)))
    same = [F.lower(F.col(k)) == F.col(f"__{k}") for k in keys]
    return rows.join(wanted, same, "left_semi")


def resolve_isomers(curation: DataFrame) -> DataFrame:
    """(mz_rt_uid, isomer_uid, overlaps) of isomers that the curation has and didn't remove; overlaps: their rt windows meet."""
    listed = curation.select("mz_rt_uid", "rt_min", "rt_max", F.explode("isomers").alias("x")).where("x.mz_rt_uid <> mz_rt_uid")
    there = curation.where(~F.lower(F.coalesce("ms1_notes", F.lit(""))).contains("remove")).select(
        F.col("mz_rt_uid").alias("isomer_uid"), *(F.col(c).alias(f"__{c}") for c in ("inchi_key", "compound_name", "adduct", "rt_min", "rt_max"))
    )
    same = [F.col(f"x.{c}") == F.col(f"__{c}") for c in ("inchi_key", "compound_name", "adduct")]
    return listed.join(there, same).select("mz_rt_uid", "isomer_uid", ((F.col("rt_min") <= F.col("__rt_max")) & (F.col("__rt_min") <= F.col("rt_max"))).alias("overlaps"))
