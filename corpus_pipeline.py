"""From documents to token ids: quality, language, near duplicates, benchmark passages, encoding.

Each stage works on all that the one before it has kept, and all but the last return the columns of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionweave.llm import bpe, dartminhash, decontam, langid, quality
from ionweave.llm.common import ship_package, stored

VOCABULARY = "byte_bpe_50k.json"
#: A text whose language is less certain than this is rejected.
LEAST_CERTAIN = 0.5


#: Columns of documents that stages read; all others go through them under names that no operator makes.
READ = ("doc_id", "text", "lang")


def _filtered(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that `stage` keeps, with all columns of docs as they were, whatever their names."""
    ship_package(docs.sparkSession)
    plain = docs.toDF(*(c if c in READ else f"__own{i}" for i, c in enumerate(docs.columns)))
    return stage(plain).select(*plain.columns).toDF(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the weak-label scorer calls bad, and texts that are null or without words. Repeated rows fare alike."""
    return _filtered(docs, lambda d: quality.classify(d).where("quality_keep"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts of no certain language, null ones and those without a letter; all texts if no row has a lang to learn from."""

    def stage(d: DataFrame) -> DataFrame:
        found = langid.predict(d, *langid.learn(d))
        return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_CERTAIN))

    return _filtered(docs, stage)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near duplicates, and one row of repeated ones; null counts as the empty text."""
    return _filtered(docs, dartminhash.deduplicated)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents contaminated with benchmark passages; null and empty texts are clean."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _filtered(docs, lambda d: decontam.find_contamination(d, items).where(~decontam.contaminated()))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left (none for null and empty texts); round_trip says whether they decode to the text."""
    import public_tokenizers

    ship_package(spark)
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("BPE encoding and decoding", encoded),
]
#: SQL can't express the trained and hashed stages; tests hold the run against plain versions of the last three stages, and the
#: label model, its scorer and the network against plain versions and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
