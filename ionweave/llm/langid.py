"""Language identification by a byte convolutional network in numpy.

Bytes are embedded, convolved by filters of several widths, max-pooled over a window of fixed length and classified by
softmax. The network is trained on a bounded sample of windows of labelled texts; a whole text is cut into windows, and
the mean of their log probabilities decides.

A text that is null or has no letter is `und` with score 0; so is every text if no label was given. Repeated rows are
predicted alike, and other columns pass through; only the text is read for a prediction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_blocks

WINDOW, EMBED, WIDTHS, FILTERS = 128, 8, (2, 3, 4), 16
#: Texts of each language that training reads, at most about so many, and windows of each.
SAMPLE, WINDOWS_OF_EACH = 1200, 4
UNKNOWN = "und"
_LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)
_LETTER = np.array([65 <= i <= 90 or 97 <= i <= 122 for i in range(256)])


def folded(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capitals of Latin-1 in lower case."""
    out = _LOWER[data]
    if len(out) > 1:
        out[1:] += ((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)).astype(np.uint8) * np.uint8(32)
    return out


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """uint8 array (windows, WINDOW), zero-padded, that covers all rows, and the row of each window."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), counts)
    out = np.zeros(len(row) * WINDOW, np.uint8)
    lower = folded(data)
    for to, a, b in zip(((np.cumsum(counts) - counts) * WINDOW).tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        out[to : to + b - a] = lower[a:b]
    return out.reshape(-1, WINDOW), row


class Network:
    """Embedding, convolutions, max pooling and softmax, with Adam for training."""

    def __init__(self, classes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {"embed": rng.normal(0, 0.5, (256, EMBED))}
        for w in WIDTHS:
            self.p[f"k{w}"] = rng.normal(0, 1 / np.sqrt(w * EMBED), (w * EMBED, FILTERS))
            self.p[f"c{w}"] = np.zeros(FILTERS)
        self.p["out"], self.p["bias"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, classes)), np.zeros(classes)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.p["embed"][0] = 0

    def _columns(self, x: np.ndarray, w: int) -> np.ndarray:
        e = np.lib.stride_tricks.sliding_window_view(x, w, axis=1)
        return e.transpose(0, 1, 3, 2).reshape(-1, w * EMBED)

    def forward(self, windows: np.ndarray, keep: bool = False):
        x = self.p["embed"][windows]
        pooled, kept = [], []
        for w in WIDTHS:
            columns = self._columns(x, w)
            z = (columns @ self.p[f"k{w}"]).reshape(len(windows), -1, FILTERS)
            if keep:
                top = z.argmax(1)
                kept.append((columns, top, z.shape[1]))
                z = np.take_along_axis(z, top[:, None], 1)[:, 0]
            else:
                z = z.max(1)
            pooled.append(z + self.p[f"c{w}"])
        h = np.maximum(np.concatenate(pooled, 1), 0)
        s = h @ self.p["out"] + self.p["bias"]
        s -= s.max(1, keepdims=True)
        logp = s - np.log(np.exp(s).sum(1, keepdims=True))
        return (logp, h, kept) if keep else logp

    def gradient(self, windows: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        logp, h, kept = self.forward(windows, True)
        n = len(windows)
        d = np.exp(logp)
        d[np.arange(n), label] -= 1
        d /= n
        g = {"out": h.T @ d, "bias": d.sum(0), "embed": np.zeros_like(self.p["embed"])}
        dh = (d @ self.p["out"].T) * (h > 0)
        for i, (w, (columns, top, places)) in enumerate(zip(WIDTHS, kept)):
            dz = dh[:, i * FILTERS : (i + 1) * FILTERS]
            g[f"c{w}"] = dz.sum(0)
            at = (np.arange(n)[:, None] * places + top).reshape(-1)
            picked = columns[at].reshape(n, FILTERS, -1)
            g[f"k{w}"] = np.einsum("nfc,nf->cf", picked, dz)
            back = (dz[:, :, None] * self.p[f"k{w}"].T[None]).reshape(-1, w, EMBED)
            symbols = windows[np.repeat(np.arange(n), FILTERS)[:, None], top.reshape(-1)[:, None] + np.arange(w)]
            np.add.at(g["embed"], symbols.reshape(-1), back.reshape(-1, EMBED))
        g["embed"][0] = 0
        return g

    def train(self, windows: np.ndarray, label: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.004, seed: int = 11) -> None:
        rng, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        epochs = max(epochs, min(200, -(-200 * batch // max(1, len(windows)))))
        total = epochs * -(-len(windows) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for a in range(0, len(order), batch):
                step += 1
                pick = order[a : a + batch]
                pace = rate * (1 - step / (total + 1))
                for k, g in self.gradient(windows[pick], label[pick]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.01 * (g * g - v[k])
                    self.p[k] -= (pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> tuple[list[str], Network | None]:
    """Languages and a network trained on windows of at most about `sample` different texts of each; null labels and texts are left out.

    Copies count as one text of a language, so neither the sample nor its languages depend on how often a text is repeated.
    A language always keeps the text of its lowest hash."""
    usable = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and length(text) > 0").withColumn("h", F.xxhash64("text"))
    different = F.approx_count_distinct("h", 0.02)
    counts = sorted((r.lang, r.n, r.low) for r in usable.groupBy("lang").agg(different.alias("n"), F.min("h").alias("low")).collect())
    if not counts:
        return [], None
    share = F.create_map(*(F.lit(x) for k, n, _ in counts for x in (k, int(min(1.0, sample / n) * (1 << 20)) + 1)))
    low = F.create_map(*(F.lit(x) for k, _, h in counts for x in (k, h)))
    chosen = usable.where((F.pmod("h", F.lit(1 << 20)) < share[F.col("lang")]) | (F.col("h") == low[F.col("lang")])).dropDuplicates(["lang", "h"]).select("lang", "text")

    def cut(batches):
        for batch in batches:
            for row, end, data, offsets in text_blocks(batch.column(1)):
                found, of = windows_of(data, offsets)
                first = np.searchsorted(of, np.arange(end - row))
                sizes = np.bincount(of, minlength=end - row)
                # evenly over the whole text
                picks = [(i, first[i] + j * sizes[i] // k) for i in range(end - row) for k in [min(WINDOWS_OF_EACH, sizes[i])] for j in range(k)]
                langs = batch.column(0).slice(row, end - row).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([langs[i] for i, _ in picks], pa.string()), pa.array([found[w].tobytes() for _, w in picks], pa.binary())], names=["lang", "w"])

    rows = sorted((r.lang, bytes(r.w)) for r in chosen.mapInArrow(cut, "lang string, w binary").toLocalIterator())
    langs = sorted({k for k, _ in rows})
    net = Network(len(langs))
    windows = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    net.train(windows, np.array([langs.index(k) for k, _ in rows]))
    return langs, net


def classify_block(langs: list[str], net: Network, data: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    rows = len(offsets) - 1
    windows, row = windows_of(data, offsets)
    total = np.zeros((rows, len(langs)))
    for a in range(0, len(windows), 512):
        np.add.at(total, row[a : a + 512], net.forward(windows[a : a + 512]))
    mean = total / np.maximum(np.bincount(row, minlength=rows), 1)[:, None]
    p = np.exp(mean - mean.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    filled, letters = np.flatnonzero(np.diff(offsets)), np.zeros(rows, bool)
    if len(filled):
        letters[filled] = np.logical_or.reduceat(_LETTER[data], offsets[filled])
    blank = [i for i in np.flatnonzero(~letters).tolist() if not any(c.isalpha() for c in texts[i].as_py() or "")]
    names, score = [langs[i] for i in best], p[np.arange(rows), best]
    for i in blank:
        names[i] = UNKNOWN
    score[blank] = 0
    return names, score


def predict(docs: DataFrame, langs: list[str], net: Network | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score."""
    if net is None:
        return docs.drop("lang_pred", "score").select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((langs, net.p))
    keep = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    names = [f.name for f in keep]
    schema = T.StructType([*keep, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        own, parameters = shared.value
        network = Network(len(own))
        network.p = parameters
        for batch in batches:
            for row, end, data, offsets in text_blocks(batch.column(batch.schema.get_field_index(text)), 512 << 10):
                part = batch.slice(row, end - row)
                found, score = classify_block(own, network, data, offsets, part.column(part.schema.get_field_index(text)))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names), pa.array(found, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)
