"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences, in DataFrame functions alone.

Sections are parted by an empty line, paragraphs by a line feed, leaves are sentences (a sentence of over 400 code
points is cut into pieces of 200). No character is left out, so texts are equal exactly if their roots are. Where roots
differ, the branches that differ say which paragraphs were edited; `likeness` is the share of common leaves.

A null text counts as empty; the empty text has one empty leaf. Repeated texts have equal trees."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONG, PIECE = 400, 200
#: Document ids are first cut at this many quantiles, then evenly within each.
QUANTILES = 256
_LOWEST = -(1 << 63)


def _leaves(paragraph: Column) -> Column:
    sentences = F.split(paragraph, r"(?<=[.!?])(?= )")
    pieces = F.transform(sentences, lambda s: F.when(F.length(s) > LONG, F.regexp_extract_all(s, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).otherwise(F.array(s)))
    return F.flatten(pieces)


def leaf_hashes(text: Column) -> Column:
    """Sections of paragraphs of SHA-256 leaf hashes: array<array<array<string>>>."""
    sections = F.split(F.coalesce(text, F.lit("")), "\n\n")
    return F.transform(sections, lambda s: F.transform(F.split(s, "\n"), lambda p: F.transform(_leaves(p), lambda x: F.sha2(x, 256))))


def _node(kind: str, below: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), F.array_join(below, "")), 256)


def paragraph_hashes(leaves: Column) -> Column:
    return F.transform(leaves, lambda s: F.transform(s, lambda p: _node("p", p)))


def section_hashes(paragraphs: Column) -> Column:
    return F.transform(paragraphs, lambda s: _node("s", s))


def root_hash(sections: Column) -> Column:
    return _node("r", sections)


def leaf_set(leaves: Column) -> Column:
    """Distinct leaves, 64 bits each."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(leaves)), lambda x: F.conv(F.substring(x, 1, 15), 16, 10).cast("long")))


def with_tree(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """df with {prefix}sections (their hashes), {prefix}paragraphs (per section), {prefix}root and {prefix}leaves (the leaf set)."""
    at = f"__{prefix}tree"
    df = df.withColumn(at, leaf_hashes(F.col(text)))
    df = df.withColumns({f"{prefix}paragraphs": paragraph_hashes(F.col(at)), f"{prefix}leaves": leaf_set(F.col(at))}).drop(at)
    df = df.withColumn(f"{prefix}sections", section_hashes(F.col(f"{prefix}paragraphs")))
    return df.withColumn(f"{prefix}root", root_hash(F.col(f"{prefix}sections")))


def likeness(a: Column, b: Column) -> Column:
    """Share of common leaves among all leaves of two leaf sets, 0 to 1."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def differing_paragraphs(a: Column, b: Column) -> Column:
    """(section, paragraph), from 0, of the branches in which two trees' paragraph hashes differ."""
    none = F.array().cast("array<string>")
    spots = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1),
        lambda i: F.transform(
            F.filter(
                F.sequence(F.lit(0), F.greatest(F.size(F.coalesce(F.get(a, i), none)), F.size(F.coalesce(F.get(b, i), none))) - 1),
                lambda j: ~F.get(F.get(a, i), j).eqNullSafe(F.get(F.get(b, i), j)),
            ),
            lambda j: F.struct(i.alias("section"), j.alias("paragraph")),
        ),
    )
    return F.flatten(spots)


def _bucketed(df: DataFrame, key: str, tie: str, buckets: int) -> DataFrame:
    """df with `__bucket`: ranges of the key, about equally full, higher for higher keys. A key that fills several quantiles has ranges
    of `tie` instead, higher for lower ones."""
    q = min(QUANTILES, buckets)
    inner = max(1, -(-buckets // q))
    cuts = df.agg(F.percentile_approx(key, [i / q for i in range(1, q)] or [0.5], 10_000).alias("c"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    bounds = sorted({cuts.lo or 0, *(cuts.c or []), cuts.hi or 0})
    edges = F.array(*(F.lit(b).cast("long") for b in bounds))
    at = F.size(F.filter(edges, lambda b: b <= F.col(key))).cast("long")
    low, high = F.get(edges, (at - 1).cast("int")).cast("double"), F.coalesce(F.get(edges, at.cast("int")), F.get(edges, (at - 1).cast("int")) + 1).cast("double")
    part = F.least(F.lit(inner - 1), F.floor((F.col(key) - low) / F.greatest(high - low, F.lit(1.0)) * inner))
    place = at if inner == 1 else (at * inner + part).cast("long")
    heavy = {k: n * inner for k, n in Counter(cuts.c or []).items() if n > 1}
    if heavy:
        most = max(heavy.values())
        pieces = F.try_element_at(F.create_map(*(F.lit(x).cast("long") for pair in heavy.items() for x in pair)), F.col(key))
        piece = F.floor((F.col(tie).cast("double") / 2.0**64 + 0.5) * pieces)
        place = place * (most + 1) + F.coalesce(most - 1 - F.least(piece, pieces - 1), F.lit(most))
    return df.withColumn("__bucket", place)


def with_next(df: DataFrame, key: str, carried: list[str], buckets: int | None = None, made: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """df with next_<c> for each carried column: its value in the row of the next lower key; after the lowest comes the highest.

    `made` adds columns to rows, a row at a time, once they are dealt; they needn't be shuffled then, and may be carried too.

    Rows are dealt to ranges of the key, a few for each shuffle partition, so one shuffle does; the first row of each range also goes, as a ghost, to the
    range above it. Null keys are lowest; rows of one key stand in the order of their hashes, and a key of very many rows is dealt by these. Only rows of one
    key that are alike in all carried columns can't be parted; their order among themselves changes nothing."""
    buckets = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = [c for c in carried if c in df.columns]
    keyed = df.withColumns({"__key": F.coalesce(F.col(key).cast("long"), F.lit(_LOWEST)), "__tie": F.xxhash64(*given)})
    rows = _bucketed(keyed, "__key", "__tie", buckets)
    # one short row for each range
    heads = rows.groupBy("__bucket").agg(F.max("__key").alias("__key"))
    above = F.lag("__bucket").over(Window.orderBy(F.desc("__bucket")))
    last = F.min("__bucket").over(Window.orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("__bucket", "__key", F.coalesce(above, last).alias("above"))
    ghosts = rows.select("__bucket", "__key", "__tie", *given).join(F.broadcast(heads), ["__bucket", "__key"])
    # several rows may have the highest key of a range
    ghosts = ghosts.groupBy("above").agg(F.min_by(F.struct("__key", "__tie", *given), "__tie").alias("g")).select(F.col("above").alias("__bucket"), "g.*", F.lit(1).alias("__ghost"))
    both = rows.withColumn("__ghost", F.lit(0)).unionByName(ghosts, allowMissingColumns=True)
    if made is not None:
        both = made(both.repartition("__bucket"))
    order = Window.partitionBy("__bucket").orderBy("__ghost", F.desc("__key"), "__tie")
    both = both.withColumn("__next", F.lead(F.struct(*carried)).over(order)).where("__ghost = 0")
    return both.withColumns({f"next_{c}": F.col(f"__next.{c}") for c in carried}).drop("__next", "__ghost", "__key", "__tie", "__bucket")
