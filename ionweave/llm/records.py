"""Token ids as length-delimited binary records, with a separate offset index.

File format, all little-endian. A shard is a run of records; a record frames one payload:

    length    uint64    bytes of the payload
    check     uint32    masked CRC-32 of the eight length bytes
    payload   int64 document id, uint8 flags (1: the id is null), uint8 bytes per id (2 or 4), then the ids
    check     uint32    masked CRC-32 of the payload

The mask is rotate right by 15 bits plus 0xA282EAD8, so that checks of data which itself holds checks stay sound. Beside
each shard stands its index: the uint64 offset of every record, so readers can seek in shuffled order without a scan.
A Parquet table `manifest` lists the shards that finished tasks have written, in document order, with their counts; a
task that is run again writes new names, and what a lost one left is never read.

Null and empty texts give records of the end id alone. Repeated ids stay repeated rows; null ids come first."""

from __future__ import annotations

import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import shipped
from .common import RAW_BLANK, IdCache, text_blocks, word_spans

#: Bytes after which a shard is closed, and words that a worker keeps with their ids.
SHARD_BYTES, CACHE = 64 << 20, 2_000_000


def masked_crc(data: bytes) -> bytes:
    crc = zlib.crc32(data)
    return (((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF).to_bytes(4, "little")


def frame(payload: bytes) -> bytes:
    size = len(payload).to_bytes(8, "little")
    return b"".join((size, masked_crc(size), payload, masked_crc(payload)))


#: Texts that show whether a vocabulary's pre-tokens hold white space, which must then go to the library as they stand.
PROBES = ("hello brave new world", " a\tb\n\nc  d ", "It's 12\r\n34 \x0b\x0c - - x", "é è\tça 漢 字")


class WordTokenizer:
    """encode() of the tokenizers library for a vocabulary whose pre-tokens hold no white space; another one is an error.

    Such a text's ids are those of its words one after another, so each distinct word goes to the library once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        for text in PROBES:
            words = [w.decode() for w in text.encode().split()]
            apart = [i for e in self.library.encode_batch(words, add_special_tokens=False) for i in e.ids]
            if self.library.encode(text, add_special_tokens=False).ids != apart:
                raise ValueError(f"{path}: ids of {text!r} aren't those of its words, one after another")
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.cache = IdCache(self._ids, np.dtype(f"<u{self.width}"), CACHE)

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        coded = [e.ids for e in self.library.encode_batch([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]
        return np.array(list(chain.from_iterable(coded)), self.cache.kind), np.array(list(map(len, coded)), np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Packed ids of each row of a block of UTF-8 bytes."""
        starts, ends, hashes = word_spans(data, offsets, RAW_BLANK)
        ids, upto = self.cache(data, starts, ends, hashes)
        at = np.concatenate([[0], upto])[np.searchsorted(starts, offsets)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:])]


class ShardWriter:
    """Writes records to shards of bounded size in one folder, and their indexes."""

    def __init__(self, folder: str, part: int):
        self.fs, self.path = fs.FileSystem.from_uri(folder)
        self.part, self.number, self.out, self.shards = part, 0, None, []

    def add(self, payload: bytes, ids: int) -> None:
        if self.out is None:
            self.name = f"shard-{self.part:06d}-{self.number:04d}-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}.rec", buffer_size=1 << 20)
            self.offset, self.offsets, self.ids = 0, [], 0
        record = frame(payload)
        self.out.write(record)
        self.offsets.append(self.offset)
        self.offset += len(record)
        self.ids += ids
        if self.offset >= SHARD_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        with self.fs.open_output_stream(f"{self.path}/{self.name}.idx") as f:
            f.write(np.array(self.offsets, "<u8").tobytes())
        self.shards.append((self.part, self.number, self.name, len(self.offsets), self.ids, self.offset))
        self.out, self.number = None, self.number + 1


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


MANIFEST = "part int, number int, shard string, n_records long, n_tokens long, n_bytes long"


def write_records(df: DataFrame, folder: str, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Encodes df's texts and writes them in ascending order of `key` under `folder`; returns the manifest.

    `parts` ranges of the key are written side by side (default: the session's shuffle partitions)."""
    spark, name = df.sparkSession, shipped(df, vocabulary)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    file_system, path = fs.FileSystem.from_uri(folder)
    file_system.create_dir(path, recursive=True)

    def run(batches):
        encoder = word_tokenizer(SparkFiles.get(name))
        writer = ShardWriter(folder, TaskContext.get().partitionId())
        end = end_id.to_bytes(encoder.width, "little")
        for batch in batches:
            keys, column = batch.column(0).to_pylist(), batch.column(1)
            for row, to, data, offsets in text_blocks(column, 2 << 20):
                for k, ids in zip(keys[row:to], encoder.encode(data, offsets)):
                    head = (k or 0).to_bytes(8, "little", signed=True) + bytes((k is None, encoder.width))
                    writer.add(head + ids + end, len(ids) // encoder.width + 1)
        writer.close()
        columns = list(zip(*writer.shards)) or [()] * 6
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "number", "shard", "n_records", "n_tokens", "n_bytes"])

    rows = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    ordered = rows.repartitionByRange(parts, F.col("k").asc_nulls_first()).sortWithinPartitions(F.col("k").asc_nulls_first(), "t")
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def records_of(stream, size: int = 4 << 20):
    """Payloads of a shard read in order; raises ValueError where a check fails."""
    held = b""
    while chunk := stream.read(size):
        held, at = held + chunk, 0
        while len(held) - at >= 12:
            length = held[at : at + 8]
            if masked_crc(length) != held[at + 8 : at + 12]:
                raise ValueError("a record's length fails its check")
            n = int.from_bytes(length, "little")
            if len(held) - at < n + 16:
                break
            payload = held[at + 12 : at + 12 + n]
            if masked_crc(payload) != held[at + 12 + n : at + 16 + n]:
                raise ValueError("a record's payload fails its check")
            yield payload
            at += n + 16
        held = held[at:]
    if held:
        raise ValueError("a shard ends inside a record")


def record_at(folder: str, shard: str, number: int) -> bytes:
    """The payload of one record by way of the offset index."""
    file_system, path = fs.FileSystem.from_uri(folder)
    with file_system.open_input_file(f"{path}/{shard}.idx") as f:
        f.seek(8 * number)
        at = int.from_bytes(f.read(8), "little")
    with file_system.open_input_file(f"{path}/{shard}.rec") as f:
        f.seek(at)
        size = int.from_bytes(f.read(12)[:8], "little")
        f.seek(at)
        return next(records_of(pa.BufferReader(f.read(size + 16))))


def read_records(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Rows (key, start, n_tokens, ids) of a written folder: start counts the ids before it, ids are uint32 in bytes.

    Shards are read in parallel, each as a stream."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # the window sees one short row for each shard
    before = F.sum("n_tokens").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("shard", F.coalesce(before, F.lit(0)).alias("start"))
    shards = shards.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")
    names = [key, "start", "n_tokens", "ids"]

    def rows(keys, starts, sizes, bodies):
        columns = zip((keys, starts, sizes, bodies), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=names)

    def run(batches):
        file_system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, starts, sizes, bodies, held = [], [], [], [], 0
                with file_system.open_input_stream(f"{path}/{shard}.rec") as f:
                    for p in records_of(f):
                        ids = np.frombuffer(p, f"<u{p[9]}", offset=10).astype("<u4").tobytes()
                        keys.append(None if p[8] else int.from_bytes(p[:8], "little", signed=True))
                        starts.append(start)
                        sizes.append(len(ids) // 4)
                        bodies.append(ids)
                        start, held = start + sizes[-1], held + len(ids)
                        if held > 8 << 20:
                            yield rows(keys, starts, sizes, bodies)
                            keys, starts, sizes, bodies, held = [], [], [], [], 0
                if keys:
                    yield rows(keys, starts, sizes, bodies)

    return shards.mapInArrow(run, f"{key} long, start long, n_tokens long, ids binary")
