"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each whole text. Expectation-maximisation over the counted vote
patterns estimates the share of bad texts and, for each labeller, how it votes on good and on bad ones (a labeller that
doesn't vote tells something too), and so the posterior of every pattern. Votes are taken to be independent given the
class; what names the classes is that labellers on the whole vote bad more often on bad texts than on good ones. Two of them
look at what all kinds of noise spoil, so that each kind is seen by two at least and the class explains why they agree. The
posteriors of a bounded sample of texts train a linear scorer on hashed features (character shapes, and how words repeat),
which then scores every whole text. No given label is used.

Null, empty and wordless texts score 0 and are rejected. Repeated rows score alike; other columns pass through. Where the
labellers find no bad text at all, every text with words is kept."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM, BLANK, GOLDEN, U64, mix64, text_blocks, word_hashes, word_spans

#: Texts that train the scorer, at most about so many; hashed features; texts scored below CUT are rejected.
SAMPLE, FEATURES, CUT = 6000, 4096, 0.5
#: Rows whose features are held at once (16 KB each).
ROWS = 1024
LABELLERS = ("plain_words", "plain_letters", "symbols", "shouting", "bars", "repeats", "sentences", "word_length")
_SHAPE = np.array([ord("A") if 65 <= i <= 90 else ord("0") if 48 <= i <= 57 else ord("a") if 97 <= i <= 122 or i >= 128 else i for i in range(256)], np.uint32)


def _is(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _UPPER, _LOWER = _is(b"*#$%&@^~<>{}[]\\=+_`"), _is(bytes(range(65, 91))), _is(bytes(range(97, 123)))
_BANG, _BAR, _STOP = _is(b"!"), _is(b"|"), _is(b".!?")
#: What running text is made of: small letters, all non-ASCII, numbers, addresses and little punctuation; what clean words are made
#: of; and the bytes that end them.
_PLAIN = _is(bytes([*range(97, 123), *range(128, 256), *b" ,.'-\n0123456789@+()\""]))
_CLEAN, _AFTER = _is(bytes([*range(65, 91), *range(97, 123), *range(128, 256), *b"'-0123456789@+().=\""])), _is(b",;:?!")


def _per_row(hit: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out, filled = np.zeros(len(offsets) - 1), np.flatnonzero(np.diff(offsets))
    if len(filled):
        out[filled] = np.add.reduceat(hit, offsets[filled], dtype=np.int64)
    return out


def votes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 array (rows, labellers), -1 for a vote that the text is bad, 1 for good, 0 for none; and the number of words of each row."""
    rows = len(offsets) - 1
    words, at = word_hashes(data, offsets, ALNUM)
    n = np.diff(at).astype(float)
    some, size = np.maximum(n, 1), np.maximum(np.diff(offsets), 1)
    row = np.repeat(np.arange(rows), np.diff(at))
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    stutter = np.bincount(row[same], minlength=rows) / some
    order = np.lexsort((words, row))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (row[order][1:] != row[order][:-1])
    variety = np.bincount(row[order][fresh], minlength=rows) / some

    # words between blanks that are letters in lower case but for the first, and none that stands before
    starts, ends, hashes = word_spans(data, offsets, BLANK)
    of = np.searchsorted(offsets, starts, "right") - 1
    clean = np.zeros(len(starts), bool)
    if len(starts):
        odd, high = ~_CLEAN[data], _UPPER[data]
        total = lambda hit: np.concatenate([[0], np.cumsum(hit, dtype=np.int32)])
        odds, highs = total(odd), total(high)
        clean = (odds[ends] - odds[starts] - _AFTER[data[ends - 1]] <= 0) & (highs[ends] - highs[starts] - high[starts] <= 0)
        again = np.zeros(len(starts), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        clean &= ~again
    tokens = np.maximum(np.bincount(of, minlength=rows), 1)
    plain_words = np.bincount(of[clean], minlength=rows) / tokens

    upper, lower = _per_row(_UPPER[data], offsets), _per_row(_LOWER[data], offsets)
    letters = _per_row(_PLAIN[data], offsets) / size
    symbols, capitals = _per_row(_SYMBOL[data], offsets) / size, upper / np.maximum(upper + lower, 1)
    bangs, bars = _per_row(_BANG[data], offsets) / some, _per_row(_BAR[data], offsets) / some
    stops, length = some / np.maximum(_per_row(_STOP[data], offsets), 0.5), size / some
    bad_good = (
        (plain_words < 0.75, plain_words > 0.88),
        ((n >= 12) & (letters < 0.86), letters > 0.93),
        (symbols > 0.08, symbols < 0.01),
        ((n >= 4) & ((capitals > 0.6) | (bangs > 0.25)), (capitals < 0.2) & (bangs < 0.05)),
        ((n >= 4) & (bars > 0.15), bars < 0.02),
        ((n >= 12) & ((stutter > 0.2) | ((variety < 0.25) & (n >= 30) & (n < 3000))), (stutter < 0.05) & ((variety > 0.3) | (n >= 3000))),
        ((stops > 150) & (n >= 150), (stops < 60) | (n < 60)),
        ((length > 25) | (length < 2), (length > 3) & (length < 12)),
    )
    out = np.stack([np.where(bad, -1, np.where(good, 1, 0)) for bad, good in bad_good], 1).astype(np.int8)
    out[n == 0] = 0
    return out, n.astype(np.int64)


class LabelModel:
    """Share of bad texts, and P(vote | class) of each labeller, by EM over vote patterns with counts.

    rate[c, j, v] is for class c (0 good, 1 bad), labeller j and vote v (0 bad, 1 none, 2 good)."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 2000):
        self.each = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)
        ever = (patterns < 0).any(1)
        bad = np.where(ever, 0.95, 0.02)
        for _ in range(rounds):
            mass = np.stack([counts * (1 - bad), counts * bad])
            self.share = float(np.clip(mass[1].sum() / mass.sum(), 1e-6, 1 - 1e-6))
            # a hundredth of a text of each vote, so that no rate is 0
            self.rate = (np.einsum("cp,pjv->cjv", mass, self.each) + 0.01) / (mass.sum(1)[:, None, None] + 0.03)
            was, bad = bad, self.posterior(patterns)
            if np.abs(bad - was).max() < 1e-9:
                break
        # labellers on the whole vote bad more often on bad texts: else the classes have changed places
        if (self.rate[1, :, 0] - self.rate[0, :, 0] + self.rate[0, :, 2] - self.rate[1, :, 2]).sum() < 0:
            self.rate, self.share = self.rate[::-1].copy(), 1 - self.share

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that a text with such votes is bad."""
        log = np.log(self.rate)
        good, bad = (np.take_along_axis(log[c], (patterns + 1).T.astype(int), 1).sum(0) for c in (0, 1))
        return 1 / (1 + np.exp(np.clip(good + np.log(1 - self.share) - bad - np.log(self.share), -500, 500)))

    def precisions(self) -> list[float]:
        """For each labeller the probability that a text on which it votes bad is bad."""
        hit, miss = self.rate[1, :, 0] * self.share, self.rate[0, :, 0] * (1 - self.share)
        return (hit / (hit + miss)).tolist()

    def accuracies(self) -> list[float]:
        """For each labeller the probability that its vote is right, where it votes."""
        right = self.rate[1, :, 0] * self.share + self.rate[0, :, 2] * (1 - self.share)
        cast = ((1 - self.rate[:, :, 1]) * np.array([[1 - self.share], [self.share]])).sum(0)
        return (right / cast).tolist()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """float32 array (rows, FEATURES): square roots of hashed shares of shape trigrams and of word events."""
    rows = len(offsets) - 1
    out = np.zeros((rows, FEATURES), np.float32)
    half = FEATURES // 2
    if len(data) >= 3:
        shape = _SHAPE[data]
        code = (shape[:-2] * np.uint32(256) + shape[1:-1]) * np.uint32(256) + shape[2:]
        bucket = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64) % half
        row = np.repeat(np.arange(rows), np.diff(offsets))
        inside = row[:-2] == row[2:]
        counts = np.bincount(row[:-2][inside] * half + bucket[inside], minlength=rows * half).reshape(rows, half)
        out[:, :half] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    words, at = word_hashes(data, offsets, BLANK)
    row = np.repeat(np.arange(rows), np.diff(at))
    event = np.zeros(len(words), np.uint64)
    for back in (1, 2, 3):
        if len(words) > back:
            event[back:] += ((words[back:] == words[:-back]) & (row[back:] == row[:-back])).astype(np.uint64) << U64(back)
    with np.errstate(over="ignore"):
        bucket = (mix64(event * GOLDEN) % U64(half)).astype(np.int64)
    counts = np.bincount(row * half + bucket, minlength=rows * half).reshape(rows, half)
    out[:, half:] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    return out


def fit_linear(x: np.ndarray, good: np.ndarray, steps: int = 150, rate: float = 1.0, decay: float = 1e-5) -> np.ndarray:
    """Weights and bias of a logistic regression on soft labels, classes of equal weight, by AdaGrad."""
    used = np.flatnonzero(x.any(0))
    x = np.hstack([x[:, used], np.ones((len(x), 1), np.float32)])
    w, grown = np.zeros(x.shape[1], np.float32), np.full(x.shape[1], 1e-8, np.float32)
    balance = (good / max(good.sum(), 1e-9) + (1 - good) / max((1 - good).sum(), 1e-9)).astype(np.float32)
    target = good.astype(np.float32)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        g = (balance * (p - target)) @ x + np.float32(decay) * w
        grown += g * g
        w -= np.float32(rate) * g / np.sqrt(grown)
    out = np.zeros(FEATURES + 1)
    out[used], out[-1] = w[:-1], w[-1]
    return out


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> tuple[LabelModel | None, np.ndarray]:
    """The label model of all texts, and the scorer's weights from a sample of about `sample` texts."""

    def vote(batches):
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                v, n = votes(data, offsets)
                kinds, counts = np.unique(v[n > 0], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in kinds], pa.binary()), pa.array(counts, pa.int64())], names=["votes", "n"])

    # at most 3 ** len(LABELLERS) short rows
    counted = docs.select(text).mapInArrow(vote, "votes binary, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    counted = sorted((bytes(r.votes), r.n) for r in counted)
    if not counted:
        return None, np.zeros(FEATURES + 1)
    total = sum(n for _, n in counted)
    patterns = np.frombuffer(b"".join(v for v, _ in counted), np.int8).reshape(len(counted), -1)
    model = LabelModel(patterns, np.array([n for _, n in counted], float))

    def describe(batches):
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0), rows=ROWS):
                v, n = votes(data, offsets)
                x = features(data, offsets).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in v[n > 0]], pa.binary()), pa.array([_sparse(r) for r in x[n > 0]], pa.binary())], names=["votes", "x"])

    share = int(min(1.0, sample / total) * (1 << 20)) + 1
    chosen = docs.select(text).where(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < share).dropDuplicates([text])
    rows = sorted((bytes(r.votes), bytes(r.x)) for r in chosen.mapInArrow(describe, "votes binary, x binary").toLocalIterator())
    if not rows or not (patterns < 0).any():
        return model, np.append(np.zeros(FEATURES), 10.0)
    good = 1 - model.posterior(np.frombuffer(b"".join(v for v, _ in rows), np.int8).reshape(len(rows), -1))
    x = np.zeros((len(rows), FEATURES), np.float32)
    for i, (_, packed) in enumerate(rows):
        at = np.frombuffer(packed, np.uint16).reshape(2, -1)
        x[i, at[0]] = at[1].view(np.float16)
    return model, fit_linear(x, good)


def _sparse(row: np.ndarray) -> bytes:
    at = np.flatnonzero(row)
    return at.astype(np.uint16).tobytes() + row[at].tobytes()


def classify(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """docs with quality_score (0 to 1, probability of a good text) and quality_keep."""
    _, weights = fit(docs, text, sample)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    keep = [f for f in docs.schema.fields if f.name not in ("quality_score", "quality_keep")]
    names = [f.name for f in keep]
    schema = T.StructType([*keep, T.StructField("quality_score", T.DoubleType()), T.StructField("quality_keep", T.BooleanType())])

    def run(batches):
        w = shared.value
        for batch in batches:
            for row, end, data, offsets in text_blocks(batch.column(batch.schema.get_field_index(text)), rows=ROWS):
                part = batch.slice(row, end - row)
                score = 1 / (1 + np.exp(-np.clip(features(data, offsets) @ w[:-1] + w[-1], -60, 60)))
                score[np.diff(word_hashes(data, offsets, ALNUM)[1]) == 0] = 0
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names), pa.array(score), pa.array(score >= CUT)], names=[*names, "quality_score", "quality_keep"])

    return docs.mapInArrow(run, schema)
