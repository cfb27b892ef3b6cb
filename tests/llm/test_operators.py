"""The text operators against brute force, round trips and held-out labels, and on odd rows."""

import hashlib
import json
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ionweave.llm import bpe, chat, common, dartminhash, decontam, graph, langid, merkle, ngramlm, quality, records
from ionweave.llm import queries as q

SF = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("public_tokenizers")
SYLLABLES = {"en": "the and ing tion er on st wh ea".split(), "fr": "eau ré çon oi é que le ment".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash."""
    rng = random.Random(1)
    long = prose(rng, "en", 30_000)
    rows = [(1, None), (2, ""), (3, "  \n\n "), (4, "*** 123"), (5, "word"), (6, long), (7, long + " more"), (8, prose(rng, "fr", 300)), (None, "a null id here it is"), (9, "tie one"), (9, "tie two"), (10, "same row"), (10, "same row"), (11, "a\x00b � 漢字 <|endoftext|> it's")]
    df = spark.createDataFrame([(i, t, None if i == 1 else "en", None) for i, t in rows], "doc_id long, text string, lang string, source string")
    clash = "ids decoded lang_pred score quality_score quality_keep n_words spans items n_tokens perplexity node component id root leaves sections paragraphs".split()
    return df.withColumns({c: F.lit("x") for c in clash})


@pytest.fixture(scope="module")
def docs(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isdigit() and c.isascii() or "a" <= c <= "z" or ord(c) > 127 else " " for c in low).split(" ")


def real_words(text):
    return [w for w in words(text) if w]


def test_word_hashes_find_the_words_of_each_row():
    texts = ["One  two", "", None, "two one", "é\tx"]
    (_, _, data, offsets), = common.text_blocks(pa.array(texts))
    h, at = common.word_hashes(data, offsets, common.ALNUM)
    assert np.diff(at).tolist() == [2, 0, 0, 2, 2]
    assert h[0] == h[3] and h[1] == h[2]


def test_long_blocks_are_hashed_as_short_ones(monkeypatch):
    text = prose(random.Random(2), "en", 5000)
    (_, _, data, offsets), = common.text_blocks(pa.array([text]))
    whole = common.word_hashes(data, offsets, common.ALNUM)[0]
    monkeypatch.setattr(common, "_PIECE", 500)
    assert (common.word_hashes(data, offsets, common.ALNUM)[0] == whole).all()


@pytest.mark.parametrize("unit", ["abcdefg1", "\u6f22\u5b57\u4eec\u3042"])
def test_long_words_stay_whole(unit):
    """3 MB without a blank, between short words and across rows, as the library and a plain split have them."""
    from tokenizers import Tokenizer

    long = unit * (3_000_000 // len(unit.encode()))
    texts = ["one " + long + " two", long, long[: len(long) // 2], "two", long + "x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    h, at = common.word_hashes(data, offsets, common.BLANK)
    assert np.diff(at).tolist() == [len(t.split()) for t in texts]
    assert h[1] == h[3] and h[2] == h[5] and len(set(h.tolist())) == 5
    path = tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = records.WordTokenizer(path).encode(data, offsets)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_at_every_cut(monkeypatch):
    rng = random.Random(20)
    texts = ["".join(rng.choice(["a", "b", " ", "\u00e9"]) * rng.choice([1, 1, 1, 30]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    monkeypatch.setattr(common, "_PIECE", 16)
    monkeypatch.setattr(common, "_powers", [])
    (_, _, data, offsets), = common.text_blocks(pa.array(texts), 1 << 20)
    h, at = common.word_hashes(data, offsets, common.BLANK)
    want = [t.split(" ") for t in texts]
    want = [[w for w in ws if w] for ws in want]
    assert np.diff(at).tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_bpe_equals_the_library(spark, odd):
    from tokenizers import Tokenizer

    path = tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(3)
    hard = ["".join(rng.choices(list("ab's'll ré\n\t  12$.<|") + ["<|endoftext|>", "'re", "漢", " ", "\x1c"], k=60)) for _ in range(300)]
    df = odd.unionByName(spark.createDataFrame([(t,) for t in hard], "text string"), allowMissingColumns=True)
    rows = bpe.round_trip(df, path).collect()
    assert len(rows) == df.count()
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want, r.text
        assert r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.round_trip(odd.limit(0), path).count() == 0


def test_bpe_forgets_when_its_cache_is_full(monkeypatch):
    path = tokenizers.path("byte_bpe_50k.json")
    a, b = bpe.Codec(path), bpe.Codec(path)
    b.cache.limit = 20
    texts = pa.array([prose(random.Random(i), "fr", 30) for i in range(20)])
    for i in range(20):
        (_, _, data, offsets), = common.text_blocks(texts.slice(i, 1))
        assert (a.encode(data, offsets)[0] == b.encode(data, offsets)[0]).all()


def test_records_round_trip_and_index(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    path, folder = tokenizers.path("word_bpe_49k.json"), f"file://{tmp_path}/r"
    library = Tokenizer.from_file(path)
    manifest = records.write_records(odd, folder, path, 2, parts=3).collect()
    rows = sorted(records.read_records(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in odd.select("doc_id").collect()), key=lambda k: (k is not None, k))
    want = Counter(tuple([*library.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in odd.select("text").collect())
    assert Counter(tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == want
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    shard = max(manifest, key=lambda m: m.n_records)
    with open(f"{tmp_path}/r/{shard.shard}.rec", "rb") as f:
        assert list(records.records_of(f))[-1] == records.record_at(folder, shard.shard, shard.n_records - 1)
    with open(f"{tmp_path}/r/{shard.shard}.rec", "r+b") as f:
        f.seek(20)
        f.write(b"\xff\xff")
    with open(f"{tmp_path}/r/{shard.shard}.rec", "rb") as f, pytest.raises(ValueError):
        list(records.records_of(f))
    assert records.read_records(spark, _written(odd.limit(0), tmp_path)).count() == 0


def _written(df, tmp_path):
    folder = f"file://{tmp_path}/empty"
    records.write_records(df, folder, tokenizers.path("word_bpe_49k.json"), 2, parts=2)
    return folder


def brute_contamination(texts, items):
    windows = defaultdict(set)
    for i, t in items:
        w = real_words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(str(i))
    out = []
    for t in texts:
        w, hit, found = real_words(t), set(), set()
        for n in set(map(len, windows)):
            for k in range(len(w) - n + 1):
                if (p := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[p]
        out.append((len(w), len(hit), tuple(sorted(found))))
    return out


@pytest.mark.parametrize("limit", [1 << 20, 400])
def test_decontamination_equals_brute_force(spark, odd, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit)
    rng = random.Random(4)
    items = [(i, prose(rng, "en", n)) for i, n in enumerate((30, 30, 13, 12, 5, 2, 1, 40))] + [(50, None), (51, "!!"), (7, "again")]
    texts = [prose(rng, "en", 40) + " " + rng.choice(items[:8])[1] + " " + prose(rng, "en", 200) for _ in range(40)]
    extra = spark.createDataFrame([(1000 + i, t.upper()) for i, t in enumerate(texts)], "doc_id long, text string")
    df = odd.unionByName(extra, allowMissingColumns=True)
    found = decontam.find_contamination(df, spark.createDataFrame(items, "item_id long, text string"))
    got = found.select("text", "n_words", decontam.hit_words().alias("n_hit"), "items").collect()
    assert len(got) == df.count()
    assert [(r.n_words, r.n_hit, tuple(r["items"])) for r in got] == brute_contamination([r.text for r in got], items)
    none = decontam.find_contamination(odd, spark.createDataFrame([], "item_id long, text string"))
    assert none.where(decontam.contaminated()).count() == 0


def shingle_sets(texts):
    out = []
    for t in texts:
        w = real_words(t)
        out.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_classes(texts, weighted=False):
    sets, parent = shingle_sets(texts), list(range(len(texts)))
    if weighted:
        counts = [Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := real_words(t)) else Counter() for t in texts]
        sets = [{(s, i) for s, n in c.items() for i in range(n)} for c in counts]

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if same or (sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def near_copies(rng, groups, most, edits, least, longest):
    texts = []
    for _ in range(groups):
        base = prose(rng, "en", rng.randint(least, longest)).split()
        for _ in range(rng.randint(1, most)):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(99))
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("shape", [(12, 25, 2, 30, 200), (4, 150, 3, 30, 80), (2, 300, 4, 40, 60)])
def test_near_duplicates_equal_brute_force(spark, shape):
    texts = near_copies(random.Random(6), *shape) + ["", None, "short one", "Short, one", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in dartminhash.near_duplicates(df).collect()}
    want = brute_classes(texts)
    assert [got[i].class_id for i in range(len(texts))] == want
    assert sum(r.keep for r in got.values()) == len(set(want))
    assert all(got[i].class_size == Counter(want)[want[i]] for i in got)
    assert sorted(r.doc_id for r in dartminhash.deduplicated(df).collect()) == sorted(set(want))


def test_weighted_near_duplicates_equal_brute_force(spark):
    """Repeated lines: classes by weighted similarity differ from those by sets."""
    rng, texts = random.Random(17), []
    for _ in range(30):
        a, b = prose(rng, "en", 40).split(), prose(rng, "en", 12).split()
        texts += [" ".join(a + b * rng.randint(1, 12)) for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(df, weighted=True).collect()}
    want = brute_classes(texts, weighted=True)
    assert [got[i] for i in range(len(texts))] == want != brute_classes(texts)


@pytest.mark.parametrize("parts", ["2", "23"])
def test_near_duplicates_of_one_template_at_any_partitioning(spark, parts):
    """Chains of pairs just above the threshold in texts of one template: all links are found, however rows are dealt."""
    rng, groups = random.Random(18), 4
    word = lambda: "w" + str(rng.randrange(10**9))
    template, texts = [word() for _ in range(100)], []
    for i in range(800):
        g, k = i % groups, i // groups
        t = list(template)
        t[10], t[20], t[30], t[45], t[60], t[75] = f"g{g}x", f"g{g}y", f"g{g}z", f"a{g}x{(k + 1) // 2}", f"b{g}x{k // 2}", f"c{g}x{k}"
        texts.append(" ".join(t))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert [got[i] for i in range(len(texts))] == [i % groups for i in range(len(texts))]


def test_near_duplicates_among_many_that_are_nearly_as_near(spark, monkeypatch):
    """Pairs at 0.805 to 0.82 among hundreds of texts at 0.79, which share one long passage."""
    monkeypatch.setattr(dartminhash, "BLOCK", 50)
    rng = random.Random(16)
    word = lambda: "w" + str(rng.randrange(10**9))
    passage = [word() for _ in range(304)]
    texts = []
    for i in range(30):
        shared = [word() for _ in range(4 + i % 4)]
        texts += [" ".join([*passage, *shared, *(word() for _ in range(40 - len(shared)))]) for _ in range(2)]
    texts += [" ".join([*passage, *(word() for _ in range(40))]) for _ in range(340)]
    rng.shuffle(texts)
    got = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = brute_classes(texts)
    assert len(set(want)) == 370
    assert [got[i] for i in range(len(texts))] == want


def test_deduplication_leaves_one_row_of_odd_ones(spark, odd):
    left = dartminhash.deduplicated(odd.select("doc_id", "text", "lang", "source"))
    texts = [r.text for r in left.collect()]
    assert len(texts) == len(set(t or "" for t in texts))
    assert sum(t in ("tie one", "tie two") for t in texts) == 2 and texts.count("same row") == 1
    assert dartminhash.near_duplicates(odd.limit(0)).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(7)
    element = rng.integers(0, 1 << 63, 800).astype(np.uint64)
    w = rng.uniform(0.3, 9, 800)
    v = w * rng.uniform(0.4, 1, 800)
    s = dartminhash.signatures(np.concatenate([element, element]), np.array([0, 800, 1600]), np.concatenate([w, v]), 2048)
    assert abs((s[0] == s[1]).mean() - np.minimum(w, v).sum() / np.maximum(w, v).sum()) < 0.05


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(500, 500), (None, 3)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {i: i for e in edges for i in e if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None and b is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    linked = {i for a, b in edges if a is not None and a != b for i in (a, b)}
    assert got == {i: root(i) for i in linked}


def test_quality_agrees_with_the_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.classify(docs).join(labels, "doc_id").select("quality", "quality_keep").collect()
    assert np.mean([r.quality_keep == (r.quality == 1) for r in rows]) > 0.99


def test_label_model_recovers_rates():
    """A labeller whose bad votes are right in 0.46 of cases among better ones, one-sided; and two-sided ones that abstain."""
    rng, n = np.random.default_rng(9), 100_000
    bad = rng.random(n) < 0.3
    draw = lambda on_bad, on_good: np.where(bad, rng.random(n) < on_bad, rng.random(n) < on_good)
    one_sided = [np.where(draw(r, f), -1, 0) for r, f in ((0.6, 0.6 * 0.3 / 0.7 * 0.54 / 0.46), (0.5, 0.02), (0.4, 0.03))]
    two_sided = [np.where(draw(0.8, 0.8), np.where(draw(r, f), -1, 1), 0) for r, f in ((0.7, 0.1), (0.6, 0.3), (0.9, 0.2))]
    for columns in (one_sided, two_sided):
        votes = np.stack(columns, 1)
        kinds, counts = np.unique(votes, axis=0, return_counts=True)
        model = quality.LabelModel(kinds, counts.astype(float))
        truth = [bad[votes[:, j] < 0].mean() for j in range(3)]
        assert model.precisions() == pytest.approx(truth, abs=0.05) and model.share == pytest.approx(0.3, abs=0.03)
    right = [np.mean((votes[:, j] < 0)[votes[:, j] != 0] == bad[votes[:, j] != 0]) for j in range(3)]
    assert model.accuracies() == pytest.approx(right, abs=0.05)


def test_label_model_equals_a_plain_one():
    """The same expectation-maximisation text by text."""
    rng = random.Random(21)
    votes = [[rng.choice([-1, 0, 1]) if rng.random() < 0.3 else (-1 if b else 1) for _ in range(4)] for b in (rng.random() < 0.3 for _ in range(120))]
    bad = [0.95 if -1 in v else 0.02 for v in votes]
    for _ in range(2000):
        mass = [sum(1 - p for p in bad), sum(bad)]
        share = mass[1] / len(votes)
        rate = [[{k: (sum((p if c else 1 - p) for v, p in zip(votes, bad) if v[j] == k) + 0.01) / (mass[c] + 0.03) for k in (-1, 0, 1)} for j in range(4)] for c in (0, 1)]
        was, bad = bad, []
        for v in votes:
            g, b = 1 - share, share
            for j, k in enumerate(v):
                g, b = g * rate[0][j][k], b * rate[1][j][k]
            bad.append(b / (g + b))
        if max(abs(x - y) for x, y in zip(was, bad)) < 1e-9:
            break
    kinds, counts = np.unique(np.array(votes), axis=0, return_counts=True)
    model = quality.LabelModel(kinds, counts.astype(float))
    assert model.share == pytest.approx(share, abs=1e-6)
    assert model.posterior(np.array(votes)) == pytest.approx(bad, abs=1e-6)


def test_quality_scores_equal_plain_ones(spark, docs):
    """Scores of whole texts from the fitted weights, with features counted one by one."""
    _, w = quality.fit(docs)
    rows = {r.text: r.quality_score for r in quality.classify(docs).where("length(text) between 20 and 400").limit(8).collect()}
    assert len(rows) > 3
    half, mask = quality.FEATURES // 2, (1 << 64) - 1
    for text, score in rows.items():
        shape = [quality._SHAPE[b].item() for b in text.encode()]
        grams = Counter((((a << 16) + (b << 8) + c) * 2654435761 & 0xFFFFFFFF) >> 16 for a, b, c in zip(shape, shape[1:], shape[2:]))
        counts = Counter()
        for g, n in grams.items():
            counts[g % half] += n
        x = sum(np.sqrt(n / counts.total()) * w[f] for f, n in counts.items())
        low = text.translate(str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
        tokens, events = [t for t in re.split("[ \t-\r]+", low) if t], Counter()
        for i in range(len(tokens)):
            event = sum(2**back for back in (1, 2, 3) if i >= back and tokens[i] == tokens[i - back])
            events[int(common.mix64(np.array([event * int(common.GOLDEN) & mask], np.uint64))[0]) % half] += 1
        x += sum(np.sqrt(n / events.total()) * w[half + f] for f, n in events.items()) + w[-1]
        assert score == pytest.approx(1 / (1 + np.exp(-np.clip(x, -60, 60))), rel=1e-3, abs=1e-6)


def test_quality_of_odd_rows(spark, odd):
    rows = quality.classify(odd).collect()
    assert len(rows) == odd.count()
    assert all(not r.quality_keep and r.quality_score == 0 for r in rows if not real_words(r.text))
    assert quality.classify(odd.limit(0)).count() == 0


def test_language_on_held_out_texts(spark):
    rng = random.Random(10)
    rows = [(i, prose(rng, lang, rng.randint(5, 200)), lang) for i, lang in enumerate(["en", "fr"] * 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, net = langid.learn(df.where("doc_id < 200"), sample=200)
    got = langid.predict(df.where("doc_id >= 200"), langs, net).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_sample_counts_copies_once(spark):
    rows = [(prose(random.Random(1), "en", 30), "en")] * 900 + [(prose(random.Random(i), "fr", 30), "fr") for i in range(40)] + [("solo", "xx")] * 500
    df = spark.createDataFrame(rows, "text string, lang string")
    langs, _ = langid.learn(df, sample=5)
    assert langs == ["en", "fr", "xx"]


def test_language_of_the_documents(spark, docs):
    """Held-out accuracy on the given documents."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    langs, net = langid.learn(docs.where(~held))
    got = langid.predict(docs.where(held & F.col("lang").isNotNull()), langs, net).select("lang", "lang_pred").collect()
    assert len(got) > 20 and np.mean([r.lang == r.lang_pred for r in got]) > 0.95


def test_language_of_odd_rows(spark, odd):
    langs, net = langid.learn(odd)
    rows = langid.predict(odd, langs, net).collect()
    assert len(rows) == odd.count()
    assert all((r.lang_pred == "und" and r.score == 0) == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    none = langid.predict(odd, *langid.learn(odd.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_network_gradient():
    rng = np.random.default_rng(11)
    net = langid.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    w, y = rng.integers(1, 256, (4, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1])
    loss = lambda: -net.forward(w)[np.arange(4), y].mean()
    g = net.gradient(w, y)
    for name in ("k3", "c2", "out", "embed"):
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        net.p[name][i] += 1e-5
        up = loss()
        net.p[name][i] -= 2e-5
        assert g[name][i] == pytest.approx((up - loss()) / 2e-5, rel=1e-3)
        net.p[name][i] += 1e-5


def test_fingerprints(spark, odd):
    texts = {"a": "One. Two three.\nSecond.\n\nNew part", "b": "One. Two three.\nSecond!\n\nNew part", "c": "One. Two three.\nSecond.\n\n\nNew part", "a2": "One. Two three.\nSecond.\n\nNew part", "long": "x" * 1000, "e": "", "n": None}
    df = merkle.with_tree(spark.createDataFrame(list(texts.items()), "k string, text string"), "text")
    got = {r.k: r for r in df.collect()}
    assert got["a"].root == got["a2"].root and got["e"].root == got["n"].root
    assert len({r.root for r in got.values()}) == 5
    assert len(got["long"].leaves) == 1  # equal pieces
    pair = df.where("k = 'a'").select(F.col("paragraphs").alias("x")).crossJoin(df.where("k = 'b'").select(F.col("paragraphs").alias("y")))
    assert [tuple(d) for d in pair.select(merkle.differing_paragraphs(F.col("x"), F.col("y")).alias("d")).first().d] == [(0, 1)]


@pytest.mark.parametrize("buckets", [1, 4, 900])
def test_next_rows_wrap_around(spark, buckets):
    rng = random.Random(12)
    ids = rng.sample(range(10_000), 70) + list(range(5000, 5030))
    df = spark.createDataFrame([(i, f"t{i}") for i in sorted(set(ids))] + [(None, "null")], "doc_id long, text string")
    order = [f"t{i}" for i in sorted(set(ids), reverse=True)] + ["null"]
    got = {r.text: r.next_text for r in merkle.with_next(df, "doc_id", ["text"], buckets).collect()}
    assert got == dict(zip(order, order[1:] + order[:1]))
    alone = merkle.with_next(df.limit(1), "doc_id", ["text"], buckets).first()
    assert alone.next_text == alone.text
    assert merkle.with_next(df.limit(0), "doc_id", ["text"], buckets).count() == 0


@pytest.mark.parametrize("buckets", [1, 7, 40, 600])
def test_next_rows_of_keys_that_many_rows_have(spark, buckets):
    """A third of all rows without a key, a third with one key, the rest with ties and repeated rows: one ring in the stated order."""
    rows = [(None, f"n{i}") for i in range(200)] + [(7, f"s{i}") for i in range(200)] + [(i // 3, f"t{i}") for i in range(200)] + [(50, "same")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashed = df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    order = [r.text for r in sorted(hashed, key=lambda r: (1 << 63 if r.doc_id is None else -r.doc_id, r.h))]
    got = sorted((r.text, r.next_text) for r in merkle.with_next(df, "doc_id", ["text"], buckets).collect())
    assert got == sorted(zip(order, order[1:] + order[:1]))
    if buckets == 40:
        spread = merkle._bucketed(df.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("h")), "k", "h", buckets)
        assert spread.groupBy("__bucket").count().agg(F.max("count")).first()[0] < 80


def test_fingerprints_of_odd_rows(spark, odd):
    both = merkle.with_next(merkle.with_tree(odd, "text").select("doc_id", "text", "leaves"), "doc_id", ["text", "leaves"])
    assert both.count() == odd.count()
    late = merkle.with_next(odd.select("doc_id", "text"), "doc_id", ["text", "leaves"], made=lambda rows: merkle.with_tree(rows, "text"))
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "")
    for a, b in zip(sorted(both.collect(), key=key), sorted(late.collect(), key=key), strict=True):
        assert a.leaves == b.leaves
    for r in late.join(late.select(F.col("text").alias("next_text"), F.col("leaves").alias("want")).distinct(), "next_text").collect():
        assert r.next_leaves == r.want


def test_chat_escapes_and_reads_back():
    for text in ("", "<|im_end|>", "<\\|x|>", "<\\\\|", "a<b|c", "<|im_start|>assistant\nok<|im_end|>\n", "<", "<\\"):
        formatted = "".join(t for t, _ in chat.segments_of("user", text))
        assert chat.unescape(chat.escape(text)) == text
        assert chat.turn_of(formatted) == ("user", text) and formatted.count("<|im_end|>") == 1
    assert chat.turn_of("".join(t for t, _ in chat.segments_of("odd\n<|role", "x"))) == ("odd\n<|role", "x")


def test_chat_digests_and_machine(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|> é"), (1, 1, "assistant", "<|im_end|> é"), (2, 0, "assistant", None), (None, None, None, "x"), (3, 2, "assistant", "b"), (3, 0, "system", "s"), (3, 1, "user", "a")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("valid", F.lit("x"))
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(df)).collect()}
    assert len(got) == 4 and got[3].valid and not got[2].valid and not got[1].valid
    text = "<|im_end|> é"
    assert got[1].loss_sha256 == hashlib.sha256((text * 2).encode()).hexdigest() and got[1].loss_chars == 2 * len(text)
    assert got[3].turns_sha256 == hashlib.sha256(b"system\ns\nuser\na\nassistant\nb\n").hexdigest()
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def test_chat_digests_read_the_joined_text(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 0, "user", "a<|im_end|>\n<|im_start|>assistant\nb"), (1, 1, "assistant", "c")], "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(rows)
    (good,) = chat.digests(formatted).collect()
    assert good.n_turns == 2 and good.valid
    raw = formatted.withColumn("segments", F.transform("segments", lambda s: F.struct(F.replace(s["text"], F.lit("<\\|"), F.lit("<|")).alias("text"), s["loss"].alias("loss"))))
    (bad,) = chat.digests(raw).collect()
    assert bad.n_turns == 3 and bad.turns_sha256 != good.turns_sha256


def test_pieces_of_a_long_item_have_its_windows():
    text = " ".join(f"w{i}" for i in range(500))
    pieces = decontam.pieces_of(text, 100)
    windows = lambda t: {tuple(w[k : k + 13]) for w in [decontam.words_of(t)] for k in range(len(w) - 12)}
    assert len(pieces) > 10 and set().union(*map(windows, pieces)) == windows(text)
    assert all(len(decontam.words_of(p)) >= 13 for p in pieces)


def test_language_model_equals_brute_force(spark, docs):
    import math

    rows = {r.doc_id: r for r in q.op9_perplexity(spark, SF).collect()}
    lower = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    texts = {r.doc_id: [*re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(lower)), None] for r in docs.select("doc_id", "text").collect()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for i in train for w in texts[i])
    n, v = sum(c.values()), len(c)
    pairs = Counter((a, b) for i in train for a, b in zip(["<s>", *texts[i]], texts[i]))
    cont = Counter(w for _, w in pairs)
    d = (0, *ngramlm.discounts([sum(x == k for x in pairs.values()) for k in (1, 2, 3, 4)]))
    low = (0, *ngramlm.discounts([sum(x == k for x in cont.values()) for k in (1, 2, 3, 4)]))
    total = sum(cont.values())
    spare = sum(low[min(x, 3)] for x in cont.values()) / total
    context, follow = Counter(), defaultdict(lambda: [0] * 4)
    for (a, _), k in pairs.items():
        context[a] += k
        follow[a][min(k, 3)] += 1
    for i, words_ in texts.items():
        s = 0
        for a, w in zip(["<s>", *words_], words_):
            p = max(cont[w] - low[min(cont[w], 3)], 0) / total + spare / (v + 1)
            if context[a]:
                k = pairs[a, w]
                p = (max(k - d[min(k, 3)], 0) + sum(x * y for x, y in zip(d, follow[a])) * p) / context[a]
            s += math.log10(p)
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words_), sum(c[w] > 0 for w in words_), n)
        assert r.score == pytest.approx(s, rel=1e-7)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words_), rel=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def plain_model(texts, order):
    """Log10 probability of a text by an interpolated modified Kneser-Ney model of the order, learned from texts."""
    import math

    pad = lambda t: ["<s>"] * (order - 1) + t
    level = Counter(tuple(pad(t)[i : i + order]) for t in texts for i in range(len(t)))
    levels = []
    for k in range(order, 0, -1):
        d = (0, *ngramlm.discounts([sum(x == j for x in level.values()) for j in (1, 2, 3, 4)]))
        total, spare = Counter(), Counter()
        for g, n in level.items():
            total[g[:-1]] += n
            spare[g[:-1]] += d[min(n, 3)]
        levels.insert(0, (level, d, total, spare))
        level = Counter(g[1:] for g in level)
    share = 1 / (len(levels[0][0]) + 1)

    def score(t):
        s = 0
        for i in range(len(t)):
            p = share
            for k, (level, d, total, spare) in enumerate(levels, 1):
                g = tuple(pad(t)[i + order - k : i + order])
                if total[g[:-1]]:
                    p = (max(level[g] - d[min(level[g], 3)], 0) + spare[g[:-1]] * p) / total[g[:-1]]
            s += math.log10(p)
        return s

    return score


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_models_of_each_order_equal_brute_force(spark, docs, order, monkeypatch):
    lower = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    cut = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)), "</s>"]
    # several shards of each table
    monkeypatch.setattr(ngramlm, "SHARD", 3000)
    train = docs.where("doc_id % 2 = 0")
    plain = plain_model([cut(r.text) for r in train.collect()], order)
    model = ngramlm.train_model(train, order=order)
    assert len(model.words) > 1 and (order == 2 or all(len(grams) > 1 for grams, *_ in model.levels))
    for r in ngramlm.score(docs, model).collect():
        assert r.score == pytest.approx(plain(cut(r.text)), rel=1e-7)


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_sums_to_one(spark, order):
    texts = ["a b a c", "b a", "a b b c a"]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    model = ngramlm.train_model(train, order=order)
    probe = spark.createDataFrame([(w,) for w in ("a", "b", "c", "", "zzz")], "text string")
    first = {}
    for r in ngramlm.score(probe, model).collect():
        first[r.text] = r.score
    assert model.distinct == 4 and model.tokens == 14
    assert sum(10 ** first[""] for _ in [0]) < 1 and all(np.isfinite(list(first.values())))


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_of_odd_rows(spark, odd, order):
    model = ngramlm.train_model(odd, order=order)
    rows = ngramlm.score(odd, model).collect()
    assert len(rows) == odd.count() and all(np.isfinite(r.score) for r in rows)
    empty = ngramlm.score(odd, ngramlm.train_model(odd.limit(0), order=order))
    assert all(r.n_known == 0 and r.score == 0 for r in empty.collect())


def test_sql_equals_queries(spark):
    import duckdb

    if not os.path.isdir(SF):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        path = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    for name, sql in q.ORACLE_SQL.items():
        ours, theirs = q.QUERIES[name](spark, SF).toPandas(), con.execute(sql).df()
        assert sorted(ours.columns) == sorted(theirs.columns), name
        columns = sorted(ours.columns)
        # a column with nulls is one of doubles on one side and of whole numbers on the other
        plain = lambda v: v.item() if hasattr(v, "item") else v
        cell = lambda x: None if pd.isna(x) else x if isinstance(x, (bool, str)) else round(float(x), 9)
        key = lambda df: sorted(json.dumps([cell(plain(x)) for x in r]) for r in df[columns].itertuples(index=False))
        assert key(ours) == key(theirs), name


def test_unfit_vocabularies_are_errors(tmp_path):
    byte, word = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("word_bpe_49k.json")
    bpe.Codec(byte)
    records.WordTokenizer(word)
    with pytest.raises(ValueError, match="a normalizer.*pre-tokenizer.*end_of_word_suffix"):
        bpe.Codec(word)
    with pytest.raises(ValueError, match="hello brave new world"):
        records.WordTokenizer(byte)
    spec = json.load(open(byte))
    for change in ({"pre_tokenizer": None}, {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}}, {"model": {**spec["model"], "ignore_merges": True}}, {"added_tokens": [{**spec["added_tokens"][0], "lstrip": True}]}):
        path = tmp_path / "changed.json"
        path.write_text(json.dumps({**spec, **change}))
        with pytest.raises(ValueError, match="changed.json has"):
            bpe.Codec(str(path))
