"""Helpers that the text operators share: the shared folder, and vectorised words over Arrow text columns."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: Base of the polynomial word hash; odd, so that it has an inverse modulo 2**64.
_BASE = 0x9B8F4D2A6C35E7D1
_PIECE = 1 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's spark.checkpoint.dir, which driver and executors share.

    Where that is unset, a local session takes a temporary folder of this machine; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the executors' Python once per context, for a session whose workers can't import it."""
    context = spark.sparkContext
    if getattr(context, "_ionweave_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="spark-")) / "ionweave.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    context.addPyFile(str(path))
    context._ionweave_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), offsets


def text_blocks(column: pa.Array, limit: int = _PIECE, rows: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole rows of about `limit` bytes and at most `rows` rows each."""
    data, offsets = text_bytes(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n, row + rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """For each byte its value as part of a word: A-Z in lower case (or as they are), plus one; 0 for a separator."""
    table = np.arange(1, 257, dtype=np.uint64)
    if lower:
        table[65:91] += U64(32)
    table[list(separators)] = 0
    return table


#: Words of letters, digits and all non-ASCII; words between white space.
ALNUM = byte_table(bytes(i for i in range(128) if not (48 <= i <= 57 or 65 <= i <= 90 or 97 <= i <= 122)))
BLANK = byte_table(b" \t\n\x0b\x0c\r")
RAW_BLANK = byte_table(b" \t\n\x0b\x0c\r", lower=False)
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(2 * _PIECE + 1, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans that begin at `starts`, each up to the next."""
    up, down = _power_tables()
    ends = np.append(starts[1:], len(data))
    out = np.zeros(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + 2 * _PIECE, "right")))
        s, e = starts[lo:hi] - starts[lo], ends[lo:hi] - starts[lo]
        body = data[starts[lo] : ends[hi - 1]].astype(np.uint64) + U64(1)
        if len(body) >= len(up):
            out[lo] = int.from_bytes(hashlib.sha256(data[starts[lo] : ends[lo]].tobytes()).digest()[:8], "little")
        else:
            total = np.zeros(len(body) + 1, np.uint64)
            np.cumsum(body * up[: len(body)], out=total[1:])
            out[lo:hi] = mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * GOLDEN)
        lo = hi
    return out


def _hash_piece(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    up, down = _power_tables()
    word = values != 0
    begin = word.copy()
    begin[1:] &= ~word[:-1] | first[1:]
    end = word.copy()
    end[:-1] &= ~word[1:] | first[1:]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return s, e, mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * GOLDEN)


def _long_hash(data: np.ndarray, table: np.ndarray) -> int:
    """Hash of one word of more than a piece, a piece at a time."""
    digest = hashlib.sha256()
    for at in range(0, len(data), _PIECE):
        digest.update(table[data[at : at + _PIECE]].astype("<u2").tobytes())
    return int.from_bytes(digest.digest()[:8], "little")


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of all words of a block.

    A block longer than two pieces is cut at separators and where rows begin, so memory stays bounded; a word without any in
    two pieces stays whole, and every word of more than a piece has a hash of its own kind, wherever it stands."""
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    found, at = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))], 0
    while at < len(data):
        to = min(len(data), at + 2 * _PIECE)
        values = table[data[at:to]]
        if to < len(data):
            cut = max((int(x[-1]) + at + more for x, more in ((np.flatnonzero(values == 0), 1), (np.flatnonzero(first[at + 1 : to]) + 1, 0)) if len(x)), default=0)
            if not cut:
                # one word; it goes on to the next separator or row
                while to < len(data):
                    stop = np.flatnonzero((table[data[to : to + _PIECE]] == 0) | first[to : to + _PIECE])
                    if len(stop):
                        to += int(stop[0])
                        break
                    to = min(len(data), to + _PIECE)
                found.append((np.array([at]), np.array([to]), np.array([_long_hash(data[at:to], table)], np.uint64)))
                at = to
                continue
            to, values = cut, values[: cut - at]
        s, e, h = _hash_piece(values, first[at:to])
        for i in np.flatnonzero(e - s > _PIECE):
            h[i] = _long_hash(data[at + s[i] : at + e[i]], table)
        found.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(c) for c in zip(*found))


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block and, for each row, where its words begin (one more entry at the end)."""
    starts, _, hashes = word_spans(data, offsets, table)
    return hashes, np.searchsorted(starts, offsets)


def spread(body: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """body[a : a + n] for each a of `at` and n of `size`, end to end, and where each ends."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return body[np.repeat(at - ends + size, size) + np.arange(total)], ends


class IdCache:
    """Ids of spans of bytes by the spans' hashes, in sorted arrays; forgets all beyond `limit` spans.

    `encode` gives the ids of a list of byte strings end to end, and how many each has."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], kind: type, limit: int):
        self.encode, self.kind, self.limit = encode, kind, limit
        self.forget()

    def forget(self) -> None:
        self.known, self.body = np.zeros(0, np.uint64), np.zeros(0, self.kind)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans end to end, and where those of each end."""
        distinct, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        have = place < len(self.known)
        have[have] = self.known[place[have]] == distinct[have]
        if not have.all():
            if len(self.known) + int((~have).sum()) > self.limit:
                self.forget()
                have[:] = False
            new = first[~have]
            body, sizes = self.encode([data[a:b].tobytes() for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            known = np.concatenate([self.known, distinct[~have]])
            order = np.argsort(known, kind="stable")
            self.at = np.concatenate([self.at, len(self.body) + np.cumsum(sizes) - sizes])[order]
            self.size = np.concatenate([self.size, sizes])[order]
            self.known, self.body = known[order], np.concatenate([self.body, body])
            place = np.searchsorted(self.known, distinct)
        return spread(self.body, self.at[place][of], self.size[place][of])


def with_columns(batch: pa.RecordBatch, keep: list[str], **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns.values()], names=[*keep, *columns])
