"""Scoring by an interpolated modified Kneser-Ney model of any order from 2, counted in Spark and memory-mapped by the workers.

Words are what stands between white space, A-Z in lower case; every text ends with an end token and begins in a context
of its own. Spark counts words, then distinct pairs in buckets, then what follows and precedes each word. The model lies in
the shared folder as sorted hash arrays, in shards whose number grows with the corpus; a worker maps them into memory and
looks up the distinct words and pairs of a block in sorted order.

Pairs, the default, are dealt and merged as compressed arrays. A higher order is counted by DataFrame aggregates: n-grams of
the highest order from the texts, each lower level as the number of different words before its n-grams, and per level the
total and the handed-down mass of its contexts. Texts begin with as many start marks as a context has places.

Null texts count as empty and have the end token alone. Words unseen in training get the share of the uniform distribution
over V+1 words. With no training text every score is that of the uniform distribution. Repeated rows score alike."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANK, U64, mix64, shared_dir, stored, text_blocks, word_hashes

#: Hash of the end token; words that a task counts before it hands them on; pairs and words in a shard, about.
END, HELD, SHARD = U64(0xE5D0_7E5D_07E5_D07E), 1_000_000, 2_000_000
#: Name of pair shards whose counts need 64 bits.
WIDE = "wide-pairs"


@dataclass
class Model:
    """Where a model's shards lie, and its few global numbers. `words` and `pairs` are (file, first key or bucket, length)."""

    folder: str
    tokens: int = 0
    distinct: int = 0
    texts: int = 0
    order: int = 2
    words: list = field(default_factory=list)
    firsts: list = field(default_factory=list)
    buckets: int = 1
    pairs: dict = field(default_factory=dict)
    sides: list = field(default_factory=list)
    discount: tuple = ()
    low_discount: tuple = ()
    low_total: int = 0
    low_spare: float = 1.0
    #: for orders above 2: (n-gram shards, context shards, discounts) of each level from 2 on
    levels: list = field(default_factory=list)


def _write(folder: str, name: str, *arrays: np.ndarray) -> str:
    """Writes arrays end to end under a new name; a task that runs again never touches what another wrote."""
    system, path = fs.FileSystem.from_uri(folder)
    name = f"{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{path}/{name}") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).data)
    return name


def _mapped(folder: str, name: str, *kinds: tuple[str, int]) -> list[np.ndarray]:
    """Arrays of a file, memory-mapped where the folder is a path of the system, else read."""
    system, path = fs.FileSystem.from_uri(folder)
    source = pa.memory_map(f"{path}/{name}") if isinstance(system, fs.LocalFileSystem) else system.open_input_file(f"{path}/{name}")
    with source as f:
        body, at, out = f.read_buffer(), 0, []
    for kind, n in kinds:
        out.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block, an end token after each row, and where each row begins (one more entry at the end)."""
    words, at = word_hashes(data, offsets, BLANK)
    at = at + np.arange(len(at))
    out = np.empty(at[-1], np.uint64)
    ends = np.zeros(len(out), bool)
    ends[at[1:] - 1] = True
    out[ends], out[~ends] = END, words
    return out, at


def _folded(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(n, first) if len(k) else n


class Counter:
    """Counts of keys, folded together as they come; `flush` takes them when they are many."""

    def __init__(self, flush, limit: int = HELD):
        self.flush, self.limit, self.keys, self.counts, self.loose = flush, limit, [], [], 0

    def add(self, keys: np.ndarray):
        k, n = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(n)
        self.loose += len(k)
        if self.loose > self.limit:
            k, n = _folded(self.keys, self.counts)
            self.keys, self.counts, self.loose = [k], [n], 0
            if len(k) > self.limit:
                yield from self.done()

    def done(self):
        if self.keys:
            yield from self.flush(*_folded(self.keys, self.counts))
        self.keys, self.counts, self.loose = [], [], 0


def _count_words(train: DataFrame) -> DataFrame:
    def run(batches):
        def flush(k, n):
            for a in range(0, len(k), 1 << 20):
                yield pa.RecordBatch.from_arrays([pa.array(k[a : a + (1 << 20)].view(np.int64)), pa.array(n[a : a + (1 << 20)])], names=["h", "n"])

        counter = Counter(flush)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                yield from counter.add(_tokens(data, offsets)[0])
        yield from counter.done()

    return train.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _write_sorted(rows: DataFrame, many: int, folder: str, name: str, **kinds: str) -> list[tuple[int, str, int]]:
    """Shards of the columns `kinds` in the order of the column h, about SHARD of the `many` rows each: (first hash, file, length)."""
    bits = max(0, int(np.ceil(np.log2(max(1, many / SHARD)))))
    # the top bits of the hash as an unsigned number
    part = F.lit(0) if bits == 0 else F.shiftrightunsigned("h", 64 - bits).cast("int")

    def write(table: pa.Table) -> pa.Table:
        h = table.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        file = _write(folder, name, h[order], *(table.column(c).to_numpy()[order].astype(k) for c, k in kinds.items()))
        return pa.table({"file": [file], "n": pa.array([len(h)], pa.int64()), "first": pa.array(h[order[:1]].view(np.int64))})

    files = stored(rows.withColumn("part", part).groupBy("part").applyInArrow(write, "file string, n long, first long"), name)
    return sorted((r.first & 0xFFFFFFFFFFFFFFFF, r.file, r.n) for r in files.collect())


def _write_words(counted: DataFrame, model: Model) -> None:
    """Sorted hash shards of the vocabulary; a word's id is its place in the order of all hashes."""
    at = 0
    for first, file, n in _write_sorted(counted, model.distinct, model.folder, "words", n="<u8"):
        model.firsts.append(first)
        model.words.append((file, at, n))
        at += n


class Lookup:
    """A model's arrays as a worker sees them."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}
        self.firsts = np.array(model.firsts, np.uint64)
        self.heavy = model.tokens / (4 * model.buckets)

    def shard(self, file: str, *kinds: tuple[str, int]) -> list[np.ndarray]:
        """A shard's arrays; it is opened when it is first needed."""
        if file not in self.open:
            self.open[file] = _mapped(self.model.folder, file, *kinds)
        return self.open[file]

    def ids(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1 if unseen) and training count of sorted distinct hashes."""
        ids, counts = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct), np.int64)
        cuts = [0, *np.searchsorted(distinct, self.firsts[1:]).tolist(), len(distinct)] if self.model.words else [0]
        for (file, lo, size), a, b in zip(self.model.words, cuts, cuts[1:]):
            if a == b:
                continue
            keys, n = self.shard(file, ("<u8", size), ("<u8", size))
            place = np.minimum(np.searchsorted(keys, distinct[a:b]), len(keys) - 1)
            hit = keys[place] == distinct[a:b]
            ids[a:b][hit], counts[a:b][hit] = lo + place[hit], n[place[hit]]
        return ids, counts

    def bucket(self, before: np.ndarray, before_count: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The bucket of pairs: by their first word, but by the whole pair where that word is frequent."""
        return (np.where(before_count > self.heavy, key, mix64(before.astype(np.uint64))) % U64(self.model.buckets)).astype(np.int64)

    def block(self, data: np.ndarray, offsets: np.ndarray):
        """Row starts and, for each token, id, count, id of the token before (V at the start) and its count."""
        tokens, at = _tokens(data, offsets)
        distinct, of = np.unique(tokens, return_inverse=True)
        ids, counts = (x[of] for x in self.ids(distinct))
        before, before_count = np.empty_like(ids), np.empty_like(counts)
        before[1:], before_count[1:] = ids[:-1], counts[:-1]
        before[at[:-1]], before_count[at[:-1]] = self.model.distinct, self.model.texts
        return at, ids, counts, before, before_count

    def pair_counts(self, before: np.ndarray, ids: np.ndarray, before_count: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), np.int64)
        seen = np.flatnonzero((ids >= 0) & (before >= 0))
        key = mix64(before[seen].astype(np.uint64) << U64(32) | ids[seen].astype(np.uint64))
        bucket = self.bucket(before[seen], before_count[seen], key)
        order = np.lexsort((key, bucket))
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]])) if len(order) else []
        for a, b in zip(cuts, cuts[1:]):
            rows = order[a:b]
            if (found := self.model.pairs.get(int(bucket[rows[0]]))) is not None:
                file, size = found
                keys, n = self.shard(file, ("<u8", size), ("<u8" if file.startswith(WIDE) else "<u4", size))
                place = np.minimum(np.searchsorted(keys, key[rows]), len(keys) - 1)
                out[seen[rows]] = np.where(keys[place] == key[rows], n[place], 0)
        return out

    def values(self, table: list[tuple[int, str, int]], keys: np.ndarray, *kinds: str) -> list[np.ndarray]:
        """The columns of sorted shards at each key, 0 where it is missing."""
        out = [np.zeros(len(keys), k) for k in kinds]
        order = np.argsort(keys)
        cuts = [0, *np.searchsorted(keys[order], np.array([first for first, _, _ in table[1:]], np.uint64)).tolist(), len(keys)] if table else [0]
        for (_, file, size), a, b in zip(table, cuts, cuts[1:]):
            if a == b:
                continue
            rows = order[a:b]
            have, *columns = self.shard(file, ("<u8", size), *((k, size) for k in kinds))
            place = np.minimum(np.searchsorted(have, keys[rows]), size - 1)
            hit = have[place] == keys[rows]
            for o, c in zip(out, columns):
                o[rows[hit]] = c[place[hit]]
        return out

    def interpolated(self, ids: np.ndarray, at: np.ndarray, p: np.ndarray) -> np.ndarray:
        """The probability of each token by all levels above the lowest, whose own is p."""
        p, columns = p.copy(), _windows(ids, at, self.model.order, self.model.distinct)
        for k, (grams, contexts, d) in enumerate(self.model.levels, 2):
            own = columns[-k:]
            rows = np.flatnonzero(np.all([c >= 0 for c in own[:-1]], axis=0))
            total, spare = self.values(contexts, _chained([c[rows] for c in own[:-1]]), "<u8", "<f8")
            rows, total, spare = rows[total > 0], total[total > 0], spare[total > 0]
            (n,) = self.values(grams, _chained([c[rows] for c in own]), "<u8")
            p[rows] = (discounted(n.astype(np.int64), d) + spare * p[rows]) / total
        return p

    def side(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mass that a context hands down, and lower-order probability, of each id (0 and the uniform share where unseen)."""
        spare, low = np.zeros(len(ids)), np.full(len(ids), self.model.low_spare / (self.model.distinct + 1))
        distinct, of = np.unique(ids, return_inverse=True)
        a_spare, a_low = np.zeros(len(distinct)), np.full(len(distinct), low[0] if len(low) else 0.0)
        for file, lo, size in self.model.sides:
            a, b = np.searchsorted(distinct, [lo, lo + size])
            if a == b:
                continue
            s, p = self.shard(file, ("<f8", size), ("<f8", size))
            a_spare[a:b], a_low[a:b] = s[distinct[a:b] - lo], p[distinct[a:b] - lo]
        return a_spare[of], a_low[of]


_lookups: dict[str, Lookup] = {}


def lookup(model: Model) -> Lookup:
    key = f"{model.folder} {len(model.pairs)} {len(model.sides)}"
    if key not in _lookups:
        _lookups.clear()
        _lookups[key] = Lookup(model)
    return _lookups[key]


def _planes(x: np.ndarray, kind: str = "<u4") -> bytes:
    """Bytes of numbers by significance, so that compression finds the empty ones."""
    return np.ascontiguousarray(x.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T).tobytes()


def _unplanes(b: bytes, count: int) -> np.ndarray:
    width = len(b) // count
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(width, -1).T).view(f"<u{width}").reshape(-1).astype(np.int64)


def _count_pairs(train: DataFrame, model: Model) -> DataFrame:
    """Stored rows (file, bucket, n) of written pair shards, and (id, n1, n2, n3, before, n4): what follows and precedes each id."""
    shared = train.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        m = shared.value
        own = lookup(m)

        def flush(keys, n):
            before, after = (keys >> U64(32)).astype(np.int64), (keys & U64(0xFFFFFFFF)).astype(np.int64)
            total = own_counts(own, before)
            bucket = own.bucket(before, total, mix64(keys))
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]]))
            for a, b in zip(cuts, cuts[1:]):
                rows = order[a:b]
                first = np.flatnonzero(np.concatenate([[True], np.diff(before[rows]) != 0]))
                runs = np.diff(np.append(first, len(rows)))
                body = [_planes(np.diff(before[rows][first], prepend=0)), _planes(runs), _planes(after[rows]), _planes(n[rows], "<u8" if int(n[rows].max()) >> 32 else "<u4")]
                yield pa.RecordBatch.from_arrays([pa.array([bucket[rows[0]]], pa.int32()), *(pa.array([x], pa.binary()) for x in body)], names=["bucket", "v", "runs", "w", "n"])

        counter = Counter(flush)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                _, ids, _, before, _ = own.block(data, offsets)
                yield from counter.add(before.astype(np.uint64) << U64(32) | ids.astype(np.uint64))
        yield from counter.done()

    def merge(table: pa.Table) -> pa.Table:
        m = shared.value
        keys, counts = [], []
        for v, runs, w, n in zip(*(table.column(c).to_pylist() for c in ("v", "runs", "w", "n"))):
            # ids and runs have four bytes each
            many, firsts = len(w) // 4, len(v) // 4
            before = np.repeat(np.cumsum(_unplanes(v, firsts)).astype(np.uint64), _unplanes(runs, firsts))
            keys.append(before << U64(32) | _unplanes(w, many).astype(np.uint64))
            counts.append(_unplanes(n, many))
        keys, n = _folded(keys, counts)
        hashed = mix64(keys)
        order = np.argsort(hashed)
        wide = int(n.max()) >> 32 > 0
        name = _write(m.folder, WIDE if wide else "pairs", hashed[order], n[order].astype(np.uint64 if wide else np.uint32))
        before, after = (keys >> U64(32)).astype(np.int64), (keys & U64(0xFFFFFFFF)).astype(np.int64)
        left, of = np.unique(before, return_inverse=True)
        follow = [np.bincount(of, hit, len(left)).astype(np.int64) for hit in (n == 1, n == 2, n >= 3)]
        right, times = np.unique(after, return_counts=True)
        blank_l, blank_r = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        head = {"file": [name], "bucket": table.column("bucket").slice(0, 1).to_pylist(), "n": [len(keys)], "id": [-1], "n1": [int((n == 1).sum())], "n2": [int((n == 2).sum())], "n3": [int((n == 3).sum())], "before": [int((n == 4).sum())]}
        many = len(left) + len(right)
        rest = {"file": pa.nulls(many, pa.string()), "bucket": pa.nulls(many, pa.int32()), "n": pa.nulls(many, pa.int64()), "id": np.concatenate([left, right])}
        rest |= {c: np.concatenate([f, blank_r]) for c, f in zip(("n1", "n2", "n3"), follow)} | {"before": np.concatenate([blank_l, times])}
        schema = pa.schema([("file", pa.string()), ("bucket", pa.int32()), ("n", pa.int64()), ("id", pa.int64()), ("n1", pa.int64()), ("n2", pa.int64()), ("n3", pa.int64()), ("before", pa.int64())])
        return pa.concat_tables([pa.table(head, schema=schema), pa.table(rest, schema=schema)])

    blobs = train.mapInArrow(count, "bucket int, v binary, runs binary, w binary, n binary")
    out = "file string, bucket int, n long, id long, n1 long, n2 long, n3 long, before long"
    # as many tasks as buckets, whose number grows with the tokens; grouping needs no second shuffle
    return stored(blobs.repartition(model.buckets, "bucket").groupBy("bucket").applyInArrow(merge, out), "pairs")


def own_counts(own: Lookup, ids: np.ndarray) -> np.ndarray:
    """Training counts of ids (texts for the start)."""
    out = np.full(len(ids), own.model.texts, np.int64)
    for file, lo, size in own.model.words:
        here = (ids >= lo) & (ids < lo + size)
        if here.any():
            out[here] = own.shard(file, ("<u8", size), ("<u8", size))[1][ids[here] - lo]
    return out


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more from the numbers of counts 1 to 4; 0.5, 1, 1.5 where these are missing."""
    n1, n2, n3, n4 = map(float, n)
    if not n1 or not n2:
        return (0.5, 1.0, 1.5)
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def discounted(c: np.ndarray, d: tuple) -> np.ndarray:
    return np.maximum(c - np.array([0.0, *d])[np.minimum(c, 3)], 0)


def _windows(ids: np.ndarray, at: np.ndarray, order: int, start: int) -> list[np.ndarray]:
    """For each token the ids of the `order` tokens that end with it, a column for each place; `start` before a row's first."""
    place = np.arange(len(ids)) - np.repeat(at[:-1], np.diff(at))
    out = []
    for back in range(order - 1, 0, -1):
        inside = np.flatnonzero(place >= back)
        column = np.full(len(ids), start, np.int64)
        column[inside] = ids[inside - back]
        out.append(column)
    return [*out, ids]


def _chained(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of the ids at each row."""
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        h = mix64(h ^ mix64(c.astype(np.uint64) + U64(1)))
    return h


def _hashed(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with h, the hash of its id columns, in their place."""
    rest = [f for f in df.schema.fields if f.name not in columns]

    def run(batches):
        for b in batches:
            h = _chained([b.column(b.schema.get_field_index(c)).to_numpy() for c in columns])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *(b.column(b.schema.get_field_index(f.name)) for f in rest)], names=["h", *(f.name for f in rest)])

    return df.mapInArrow(run, T.StructType([T.StructField("h", T.LongType()), *rest]))


def _count_levels(train: DataFrame, model: Model) -> None:
    """Counts and writes all levels of an order above 2, from the highest down."""
    shared = train.sparkSession.sparkContext.broadcast(model)
    names = [f"w{k}" for k in range(model.order)]

    def run(batches):
        m = shared.value
        own = lookup(m)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                at, ids, *_ = own.block(data, offsets)
                columns = _windows(ids, at, m.order, m.distinct)
                for a in range(0, len(ids), 1 << 18):
                    yield pa.RecordBatch.from_arrays([pa.array(c[a : a + (1 << 18)]) for c in columns], names=names)

    rows = train.mapInArrow(run, ", ".join(f"{c} long" for c in names))
    ones = lambda c: [F.count_if(F.col(c) == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    for k in range(model.order, 1, -1):
        own = names[-k:]
        rows = stored(rows.groupBy(*own).agg(F.count("*").alias("n")), f"grams{k}")
        sums = rows.agg(F.count("*").alias("many"), *ones("n")).first()
        d = discounts([sums[f"n{j}"] for j in (1, 2, 3, 4)])
        spare = sum(F.count_if(hit) * F.lit(x) for hit, x in zip((F.col("n") == 1, F.col("n") == 2, F.col("n") >= 3), d))
        contexts = stored(rows.groupBy(*own[:-1]).agg(F.sum("n").alias("total"), spare.alias("spare")), f"contexts{k}")
        grams = _write_sorted(_hashed(rows, own), sums.many, model.folder, f"grams{k}", n="<u8")
        model.levels.insert(0, (grams, _write_sorted(_hashed(contexts, own[:-1]), contexts.count(), model.folder, f"contexts{k}", total="<u8", spare="<f8"), d))
    none = F.lit(0).cast("long")
    _write_sides(rows.groupBy(F.col(names[-1]).alias("id")).agg(none.alias("n1"), none.alias("n2"), none.alias("n3"), F.count("*").alias("before")), model)


def train_model(train: DataFrame, text: str = "text", order: int = 2) -> Model:
    """The model of the given order (2 or more) learned from all rows of train."""
    if order < 2:
        raise ValueError("an order of 2 or more is needed")
    spark = train.sparkSession
    train = train.select(text)
    model = Model(shared_dir(spark, "ngrams"), order=order)
    system, path = fs.FileSystem.from_uri(model.folder)
    system.create_dir(path, recursive=True)
    counted = stored(_count_words(train), "counted")
    end = int(END.view(np.int64)) if hasattr(END, "view") else int(np.array([END], np.uint64).view(np.int64)[0])
    sums = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("v"), F.coalesce(F.sum(F.when(F.col("h") == end, F.col("n"))), F.lit(0)).alias("texts")).first()
    model.tokens, model.distinct, model.texts = sums.tokens, sums.v, sums.texts
    if not model.tokens:
        return model
    if model.distinct >= (1 << 32) - 1:
        raise OverflowError("a pair of word ids takes 64 bits: at most 2 ** 32 - 2 different words")
    _write_words(counted, model)
    if order > 2:
        _count_levels(train, model)
        return model
    model.buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-model.tokens // (2 * SHARD)))
    rows = _count_pairs(train, model)
    files = rows.where("id = -1").collect()
    model.pairs = {r.bucket: (r.file, r.n) for r in files}
    model.discount = discounts([sum(getattr(r, c) for r in files) for c in ("n1", "n2", "n3", "before")])
    _write_sides(rows.where("id >= 0").groupBy("id").agg(*(F.sum(c).alias(c) for c in ("n1", "n2", "n3", "before"))), model)
    return model


def _write_sides(sides: DataFrame, model: Model) -> None:
    """Arrays by id of the mass that a one-word context hands down and of the lowest order's probability, from (id, n1, n2, n3, before)."""
    sides = stored(sides, "sides")
    low = sides.where("before > 0").agg(F.sum("before").alias("total"), *(F.count_if(F.col("before") == k).alias(f"k{k}") for k in (1, 2, 3, 4)), F.count_if(F.col("before") >= 3).alias("many")).first()
    model.low_total, model.low_discount = low.total, discounts([low.k1, low.k2, low.k3, low.k4])
    model.low_spare = sum(d * n for d, n in zip(model.low_discount, (low.k1, low.k2, low.many))) / low.total
    shared = sides.sparkSession.sparkContext.broadcast(model)

    def write(table: pa.Table) -> pa.Table:
        m = shared.value
        part = table.column("part")[0].as_py()
        lo = part * SHARD
        size = min(SHARD, m.distinct + 1 - lo)
        at = table.column("id").to_numpy() - lo
        spare, low = np.zeros(size), np.full(size, m.low_spare / (m.distinct + 1))
        spare[at] = sum(d * table.column(c).to_numpy() for d, c in zip(m.discount, ("n1", "n2", "n3")))
        low[at] += discounted(table.column("before").to_numpy(), m.low_discount) / m.low_total
        return pa.table({"part": pa.array([part], pa.int64()), "file": [_write(m.folder, "sides", spare, low)], "n": pa.array([size], pa.int64())})

    files = stored(sides.withColumn("part", F.floor(F.col("id") / SHARD)).groupBy("part").applyInArrow(write, "part long, file string, n long"), "side-files").collect()
    model.sides = [(r.file, r.part * SHARD, r.n) for r in sorted(files)]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with n_tokens, n_known, base_score and score (log10), and perplexity per token."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = {"n_tokens": T.LongType(), "n_known": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType(), "perplexity": T.DoubleType()}
    keep = [f for f in docs.schema.fields if f.name not in made]
    names = [f.name for f in keep]
    schema = T.StructType([*keep, *(T.StructField(n, t) for n, t in made.items())])

    def run(batches):
        m = shared.value
        own = lookup(m)
        for batch in batches:
            for row, end, data, offsets in text_blocks(batch.column(batch.schema.get_field_index(text))):
                part = batch.slice(row, end - row)
                at, ids, counts, before, before_count = own.block(data, offsets)
                owner = np.repeat(np.arange(end - row), np.diff(at))
                low = own.side(ids)[1]
                p = low.copy()
                known = (before >= 0) & (before_count > 0)
                if m.order > 2:
                    p = own.interpolated(ids, at, low)
                elif known.any():
                    spare = own.side(before)[0]
                    c = own.pair_counts(before, ids, before_count)
                    p[known] = ((discounted(c, m.discount) + spare * low)[known]) / before_count[known]
                base = np.log10((counts + 0.1) / (m.tokens + 0.1 * (m.distinct + 1)))
                total = np.bincount(owner, np.log10(p), end - row)
                n = np.diff(at)
                columns = (n, np.bincount(owner[counts > 0], minlength=end - row), np.bincount(owner, base, end - row), total, 10 ** (-total / n))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names), *map(pa.array, columns)], names=[*names, *made])

    return docs.mapInArrow(run, schema)
