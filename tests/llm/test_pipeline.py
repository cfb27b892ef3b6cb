"""The corpus pipeline: each stage on odd rows, and the whole run against plain versions of its stages."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_operators import SF, brute_classes, brute_contamination, prose, real_words, tokenizers

import corpus_pipeline


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, and columns whose names clash with what operators make."""
    rng = random.Random(30)
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", None, None), (3, "*** ### !!!", "en", "s", 11), (4, prose(rng, "en", 20_000), "en", "s", 9)]
    rows += [(10 + i, prose(rng, lang, 60), lang, "s", 1) for i, lang in enumerate(["en", "fr"] * 20)]
    rows += [rows[7], rows[7], (99, rows[8][1], None, "t", None), (99, rows[9][1], "fr", "t", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in ("quality_keep", "lang_pred", "score", "node", "id", "items", "n_words")})


@pytest.fixture()
def folder(spark, tmp_path):
    items = [(1, "some words of a test item that nobody else would ever write down like this here")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_columns_and_whole_rows(spark, odd, folder, stage):
    left = stage[1](spark, odd, folder)
    assert left.schema.names == odd.schema.names
    before = {tuple(r) for r in odd.collect()}
    after = [tuple(r) for r in left.collect()]
    assert set(after) <= before and len(after) > 20
    assert stage[1](spark, odd.limit(0), folder).count() == 0


def test_what_each_stage_rejects_of_odd_rows(spark, odd, folder):
    kept = {name: fn(spark, odd, folder).collect() for name, fn in corpus_pipeline.STAGES[:-1]}
    assert all(real_words(r.text) for r in kept["quality classifier"])
    assert all(any(c.isalpha() for c in r.text or "") for r in kept["language ID"])
    texts = [r.text or "" for r in kept["MinHash near-dedup"]]
    assert len(texts) == len(set(texts))
    assert len(kept["benchmark decontamination"]) == odd.count()
    coded = corpus_pipeline.encoded(spark, odd, folder).collect()
    assert len(coded) == odd.count() and all(r.round_trip for r in coded)
    assert corpus_pipeline.encoded(spark, odd.limit(0), folder).count() == 0


def test_run_equals_plain_stages(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, fn in corpus_pipeline.STAGES[:2]:
        docs = fn(spark, docs, SF)
    rows = sorted(docs.select("doc_id", "text").collect())
    classes = brute_classes([r.text for r in rows])
    rows = [r for i, r in enumerate(rows) if classes[i] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute_contamination([r.text for r in rows], items)
    clean = [r for r, (n, hit, _) in zip(rows, found) if not (hit and 20 * hit >= n)]
    library = Tokenizer.from_file(tokenizers.path(corpus_pipeline.VOCABULARY))
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in clean}
