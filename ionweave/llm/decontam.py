"""Benchmark decontamination by Wu-Manber search over words.

Patterns are windows of WINDOW consecutive words of a benchmark item (an item of fewer words, but not none, is one
pattern). A shift table over blocks of words says how far a search may skip; where it says 0, the block's bucket lists
the patterns that end so, and a direct comparison confirms them. Patterns of unlike lengths are searched by machines of
their own, so that a short one doesn't shorten the skips of the long ones.

Words are runs of [0-9a-z] and non-ASCII after A-Z are lower-cased. Null and empty texts have no words and are clean.
Repeated items or documents give repeated results; an empty benchmark finds nothing."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

WINDOW = 13
#: Bytes of benchmark text that one broadcast may hold; a larger benchmark is searched block by block.
BROADCAST_BYTES = 16 << 20
_WORD = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


class Machine:
    """Wu-Manber tables for patterns of at least `least` words."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list], least: int):
        self.least, self.block = least, 1 if least < 4 else 2
        self.skip = least - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[tuple[tuple[bytes, ...], list]]] = {}
        for words, owners in patterns.items():
            head = words[:least]
            for i in range(self.block, least + 1):
                key = b" ".join(head[i - self.block : i])
                self.shift[key] = min(self.shift.get(key, self.skip), least - i)
            self.bucket.setdefault(b" ".join(head[least - self.block :]), []).append((words, owners))

    def find(self, words: list[bytes]):
        """(start, length, owners) of all occurrences."""
        shift, skip, two = self.shift.get, self.skip, self.block == 2
        i, n, least = self.least - 1, len(words), self.least
        while i < n:
            key = words[i - 1] + b" " + words[i] if two else words[i]
            if step := shift(key, skip):
                i += step
                continue
            a = i - least + 1
            first = words[a]
            for pattern, owners in self.bucket[key]:
                if pattern[0] == first and tuple(words[a : a + len(pattern)]) == pattern:
                    yield a, len(pattern), owners
            i += 1


def machines(items: list[tuple[object, str | None]]) -> list[Machine]:
    patterns: dict[tuple[bytes, ...], dict] = {}
    for owner, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
            patterns.setdefault(tuple(words[i : i + WINDOW]), {})[owner] = None
    classes = ((WINDOW, WINDOW), (6, WINDOW - 1), (3, 5), (2, 2), (1, 1))
    groups = [{p: list(o) for p, o in patterns.items() if lo <= len(p) <= hi} for lo, hi in classes]
    return [Machine(g, min(map(len, g))) for g in groups if g]


def pieces_of(text: str, size: int) -> list[str]:
    """text, or where it may have more than `size` bytes pieces of about that size that share all but one word of a window."""
    if len(text) * 4 <= size:
        return [text]
    words = words_of(text)
    out, a = [], 0
    while True:
        b, length = a, 0
        while b < len(words) and (length < size or b - a < WINDOW):
            length += len(words[b]) + 1
            b += 1
        out.append(b" ".join(words[a:b]).decode("utf-8", "replace"))
        if b == len(words):
            return out
        a = b - WINDOW + 1


def scan(found: list[Machine], text: str | None) -> tuple[int, list[int], dict]:
    """Number of words, hit intervals as [start, end, ...] in ascending order without overlaps, and the owners found."""
    words = words_of(text)
    spans, owners = [], {}
    for m in found:
        for a, n, who in m.find(words):
            spans.append((a, a + n))
            owners.update(dict.fromkeys(who))
    return len(words), merged(spans), owners


def merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


_built: dict[str, list[Machine]] = {}


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs with n_words, spans (start and end word of each hit stretch, flattened) and items (ids found, sorted as strings).

    Items whose id or text is null are left out, and so are their windows: they couldn't be named.

    A benchmark within BROADCAST_BYTES is broadcast. A larger one is cut into blocks that fit; one block after the other
    is fetched, scans the stored documents, has its hits stored and is released, and the hits of a document are merged by
    its row number. An item longer than a block goes in overlapping pieces that have the same windows."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("t")).where("item is not null and t is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    out = [f for f in docs.schema.fields if f.name not in ("n_words", "spans", "items")]
    names = [f.name for f in out]
    found = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))]
    schema = T.StructType([*out, *found])

    def fetched(block: DataFrame):
        return spark.sparkContext.broadcast([(r.item, r.t) for r in block.select("item", "t").toLocalIterator()])

    def scanned(df: DataFrame, shared, schema: T.StructType, names: list[str]) -> DataFrame:
        name = uuid.uuid4().hex

        def run(batches):
            # a worker builds the tables of a block once, whatever number of tasks it runs
            if name not in _built:
                _built.clear()
                _built[name] = machines(shared.value)
            for batch in batches:
                found = [scan(_built[name], t) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                made = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([sorted(f[2]) for f in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), *made], names=[*names, "n_words", "spans", "items"])

        return df.mapInArrow(run, schema)

    if size <= BROADCAST_BYTES:
        return scanned(docs.select(names), fetched(items), schema, names)
    blocks = -(-2 * size // BROADCAST_BYTES)
    kept = stored(docs.select(names).withColumn("__row", F.monotonically_increasing_id()), "decontam")
    most = BROADCAST_BYTES // 4
    cut = F.udf(lambda t: pieces_of(t, most), "array<string>")
    pieces = items.select("item", F.explode(cut("t")).alias("t"))
    parts = stored(pieces.withColumn("block", F.pmod(F.xxhash64("item", "t"), F.lit(blocks)).cast("int")), "benchmark")
    short = T.StructType([T.StructField("__row", T.LongType()), *found])
    hits = None
    for b in range(blocks):
        shared = fetched(parts.where(F.col("block") == b))
        one = scanned(kept.select("__row", text), shared, short, ["__row"])
        # every document has its row in the first block's hits
        one = stored(one if b == 0 else one.where(F.size("spans") > 0), "hits")
        shared.destroy()
        hits = one if hits is None else hits.unionByName(one)
    merge = F.pandas_udf(lambda s: s.map(lambda x: merged([(v[i], v[i + 1]) for v in x for i in range(0, len(v), 2)])), "array<long>")
    hits = hits.groupBy("__row").agg(F.max("n_words").alias("n_words"), F.collect_list(F.when(F.size("spans") > 0, F.col("spans"))).alias("s"), F.collect_set(F.when(F.size("items") > 0, F.col("items"))).alias("i"))
    hits = hits.select("__row", "n_words", merge("s").alias("spans"), F.array_sort(F.array_distinct(F.flatten("i"))).alias("items"))
    return kept.join(hits, "__row").drop("__row").select(*names, "n_words", "spans", "items")


def hit_words(spans: str = "spans"):
    """Number of hit words of a spans column."""
    ends = F.filter(spans, lambda _, i: i % 2 == 1)
    starts = F.filter(spans, lambda _, i: i % 2 == 0)
    return F.aggregate(F.zip_with(ends, starts, lambda e, s: e - s), F.lit(0).cast("long"), lambda a, b: a + b)


def contaminated(spans: str = "spans", n_words: str = "n_words"):
    """The rule: at least one hit word, and at least one in twenty words hit."""
    return (hit_words(spans) > 0) & (hit_words(spans) * 20 >= F.col(n_words))


def items_digest(items: str = "items"):
    return F.sha2(F.array_join(items, ","), 256)
