"""Byte-level BPE encoding and decoding with a pair occurrence index.

The vocabulary file (tokenizers JSON with a ByteLevel pre-tokenizer) is a parameter. Each task cuts whole texts into
pre-tokens, lays the distinct new ones out in flat linked arrays, maps each mergeable pair to all its positions, and
applies the active ranks in ascending order, updating the lists of the pairs that a merge makes. A table of finished
pre-tokens, bounded by CACHE entries, is kept between batches.

A null or empty text has no ids and decodes to the empty text. Strings of added tokens inside a text become their ids,
as in the library. Repeated rows are encoded alike; other columns pass through."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import IdCache, span_hashes, spread, text_blocks

#: Pre-tokenizer pattern of the byte-level vocabulary (a fixed value of the file format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What may follow an apostrophe in a contraction.
_ONE = {ord(c) for c in "stmd"}
_TWO = {(ord(a), ord(b)) for a, b in ("re", "ve", "ll")}
#: Finished pre-tokens that a worker keeps (about 40 bytes each).
CACHE = 2_000_000


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level vocabulary: printable Latin-1 bytes are themselves, the rest follow from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def character_kind(c: str) -> int:
    """1 for a letter, 2 for a number, 3 for white space, 0 for all else."""
    if c.isspace():
        return 0 if "\x1c" <= c <= "\x1f" else 3
    return {"L": 1, "N": 2}.get(unicodedata.category(c)[0], 0)


def _unfit(spec: dict) -> list[str]:
    """What in a vocabulary file asks for another way of encoding than Codec's."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    wrong = [] if spec.get("normalizer") is None else ["a normalizer"]
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        wrong.append("another pre-tokenizer than ByteLevel with its pattern and without a prefix space")
    if model.get("type", "BPE") != "BPE":
        wrong.append("another model than BPE")
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    wrong += [f"{o} of the model" for o in options if model.get(o)]
    wrong += [f"{o} of an added token" for o in ("single_word", "lstrip", "rstrip", "normalized") if any(t.get(o) for t in spec.get("added_tokens", ()))]
    return wrong


class Codec:
    """A vocabulary file's merges, with encode and decode for batches of texts. A file that asks for more is an error."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if wrong := _unfit(spec):
            raise ValueError(f"{path} has {', '.join(wrong)}")
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        vocab = spec["model"]["vocab"]
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        self.rank, self.merges = {}, []
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            key = vocab[a] << 20 | vocab[b]
            self.rank[key] = len(self.merges)
            self.merges.append((vocab[a], vocab[b], vocab[a + b]))
        self.special = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        self.added = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        spelling = {i: bytes(back[c] for c in t) for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        top = max(spelling) + 1
        self.spelling = np.frombuffer(b"".join(spelling.get(i, b"") for i in range(top)), np.uint8)
        self.spell_size = np.array([len(spelling.get(i, b"")) for i in range(top)])
        self.spell_at = np.cumsum(self.spell_size) - self.spell_size
        self.kinds = np.fromiter(map(character_kind, map(chr, range(0x110000))), np.uint8, 0x110000)
        self.cache = IdCache(self._index_merge, np.int32, CACHE)

    def _index_merge(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pre-tokens end to end, and how many each has."""
        rank, merges, byte_id = self.rank, self.merges, self.byte_id
        sym = [byte_id[b] for b in chain.from_iterable(raw)]
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).tolist()
        for a in bounds[:-1]:
            if a < n:
                prv[a] = -1
        for b in bounds[1:]:
            if b:
                nxt[b - 1] = -1
        where: dict[int, list[int]] = {}
        for i in range(n):
            j = nxt[i]
            if j >= 0 and (r := rank.get(sym[i] << 20 | sym[j])) is not None:
                where.setdefault(r, []).append(i)
        active = list(where)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            left, right, new = merges[r]
            spots = where.pop(r)
            if left == right:
                spots.sort()
            for i in spots:
                if sym[i] != left or (j := nxt[i]) < 0 or sym[j] != right:
                    continue
                sym[i], sym[j], k = new, -1, nxt[j]
                nxt[i] = k
                if k >= 0:
                    prv[k] = i
                    if (q := rank.get(new << 20 | sym[k])) is not None:
                        if (at := where.get(q)) is None:
                            where[q] = [i]
                            heapq.heappush(active, q)
                        else:
                            at.append(i)
                p = prv[i]
                if p >= 0 and (q := rank.get(sym[p] << 20 | new)) is not None:
                    if (at := where.get(q)) is None:
                        where[q] = [p]
                        heapq.heappush(active, q)
                    else:
                        at.append(p)
        flat = np.array(sym, np.int32)
        live = flat >= 0
        return flat[live], np.diff(np.concatenate([[0], np.cumsum(live)])[bounds])

    def _bounds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions at which the pre-tokens of a block begin; PATTERN as rules on neighbouring characters."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        chars = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.kinds[chars]
        n = len(kind)
        fresh = np.zeros(n + 1, bool)
        fresh[np.searchsorted(lead, offsets)] = True
        space, blank = kind == 3, chars == 32
        before, after = np.empty(n, np.uint8), np.empty(n, np.uint8)
        before[1:], after[:-1] = kind[:-1], kind[1:]
        before[0], after[-1] = 9, 9
        before[fresh[:-1]], after[fresh[1:]] = 9, 9
        glued = np.zeros(n, bool)
        glued[1:] = blank[:-1] & ~fresh[1:-1]
        start = fresh[:-1] | (space & (before != 3)) | (space & (before == 3) & (after != 3) & (after != 9)) | (~space & (before == 3) & ~glued) | (~space & (before != 3) & (before != kind))
        for i in np.flatnonzero((chars == 39) & (before != 0) & ~glued).tolist():
            nearby = chars[i + 1 : i + 3].tolist()
            size = 2 if nearby[:1] and nearby[0] in _ONE else 3 if tuple(nearby) in _TWO else 0
            if size and not fresh[i + 1 : i + size].any():
                start[i + 1 : i + size] = False
                if i + size < n:
                    start[i + size] = True
        return lead[start]

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        starts = self._bounds(data, offsets)
        ids, ends = self.cache(data, starts, np.append(starts[1:], len(data)), span_hashes(data, starts))
        return ids, np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a block of UTF-8 bytes, and where each row's ids begin (one more entry at the end)."""
        spots = sorted((m.start(), m.end()) for m in self.added.finditer(data.tobytes())) if self.added else []
        spots = [(a, b) for a, b in spots if offsets[np.searchsorted(offsets, a, "right")] >= b]
        if not spots:
            return self._plain(data, offsets)
        cuts = np.unique(np.concatenate([offsets, *([a, b] for a, b in spots)]))
        ids, at = self._plain(data, cuts)
        parts, last = [], 0
        grown = np.zeros(len(cuts), np.int64)
        for a, b in spots:
            i, j = np.searchsorted(cuts, [a, b])
            parts += [ids[last : at[i]], np.array([self.special[data[a:b].tobytes()]], np.int32)]
            last = at[j]
            grown[j:] += 1 - (at[j] - at[i])
        return np.concatenate([*parts, ids[last:]]), (at + grown)[np.searchsorted(cuts, offsets)]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The text of each row of ids; bytes that are no UTF-8 become U+FFFD."""
        body, ends = spread(self.spelling, self.spell_at[ids], self.spell_size[ids])
        ends = np.concatenate([[0], ends])[at].tolist()
        body = body.tobytes()
        return [body[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def shipped(df: DataFrame, path: str) -> str:
    """Ships a vocabulary file to all executors; returns the name under which they find it."""
    df.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def round_trip(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", block: int = 2 << 20) -> DataFrame:
    """df with the ids of `text` (array<int>) and the text that they decode to; both are replaced if df has such columns.

    Work is cut into blocks of whole rows of about `block` bytes, so memory doesn't grow with a partition."""
    name = shipped(df, vocabulary)
    keep = [c for c in df.columns if c not in (ids, decoded)]
    schema = T.StructType([f for f in df.schema.fields if f.name in keep] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False)), T.StructField(decoded, T.StringType())])

    def run(batches):
        c = codec(SparkFiles.get(name))
        for batch in batches:
            for row, end, data, offsets in text_blocks(batch.column(batch.schema.get_field_index(text)), block):
                part = batch.slice(row, end - row)
                flat, at = c.encode(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))
                back = pa.array(c.decode(flat, at), pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(k)) for k in keep), lists, back], names=[*keep, ids, decoded])

    return df.mapInArrow(run, schema)
