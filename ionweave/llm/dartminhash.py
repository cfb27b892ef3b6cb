"""Near-duplicate detection with DartMinHash signatures and banded joining.

A text is a set of shingles of five words (runs of letters and digits in lower case; a text of fewer words, but not none,
is one shingle), or a weighted set. Hashed darts are thrown into the region of each element, as wide as its weight, and
the earliest dart of each coordinate is kept: two signatures agree in a coordinate with the weighted Jaccard similarity
as probability. COORDINATES values are joined in BANDS bands; at similarity 0.8 a pair shares no band with a probability
of 3e-6.

Equal texts are one node. In each bucket of a band the nodes stand in the order of the coordinates after the band, so
that similar ones are near. A node's signature is compared, a byte per coordinate, with those of up to REACH nodes before
it; the NEAREST of them, if their signatures agree in more than LEAST of the coordinates, are candidates, and so is the
lowest node of a bucket that is longer than that. Exact Jaccard similarity of the (weighted) shingle sets confirms a link, and
connected components make first classes. This first pass sees all pairs of a bucket of NEAREST + 1 nodes. In a longer
bucket with nodes of several first classes all pairs of different classes are then compared by signature, block against
block, and those that agree in more than LEAST are confirmed as well, unless they have been joined. So a pair is found whenever
it shares a band, however many others seem nearer; the cost grows with a bucket's rows where one class holds nearly all of
them, and with their square only where they are that alike and still not linked.

Null texts count as empty; texts without words have only exact copies. Ties go to the lowest doc_id. Repeated rows are
copies of each other. Other columns aren't read."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, GOLDEN, U64, mix64, stored, text_blocks, word_hashes
from .graph import components

SHINGLE, THRESHOLD = 5, 0.8
COORDINATES, BANDS = 96, 24
#: Nodes of a bucket before it with which a node's signature is compared, the most that become candidates, and the share
#: of coordinates that has to agree for that (six standard deviations below 0.8).
REACH, NEAREST, LEAST = 512, 6, 0.55
#: Nodes of a block, about, where the blocks of a bucket are compared with each other.
BLOCK = 256
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])
_C = [mix64(np.array([i], np.uint64))[0] for i in range(101, 108)]


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block and where each row's begin (one more entry at the end)."""
    words, at = word_hashes(data, offsets, ALNUM)
    counts = np.diff(at)
    row = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(at[1:], counts) - np.arange(len(words))
    begins = (left >= size) | (np.arange(len(words)) == np.repeat(at[:-1], counts))
    with np.errstate(over="ignore"):
        total = np.zeros(len(words), np.uint64)
        for i in range(size):
            part = np.zeros(len(words), np.uint64)
            part[: len(words) - i] = words[i:]
            part[left <= i] = 0
            total = total * GOLDEN + part
        out = mix64(total[begins])
    return out, np.concatenate([[0], np.cumsum(np.bincount(row[begins], minlength=len(counts)))])


def throw(element: np.ndarray, owner: np.ndarray, reach: np.ndarray, weight: np.ndarray | None = None):
    """All darts (owner, hash, rank) with a rank below the element's `reach` in regions as wide as its weight (default 1).

    Weights are cut into bands [0,1), [1,2), [2,4), ... and ranks into cells of area 1, each of which holds a Poisson
    number of darts at places that depend on element, band and cell alone."""
    out, band, low, width = [], 0, 0.0, 1.0
    here = np.arange(len(element))
    with np.errstate(over="ignore"):
        while len(here):
            cells = np.maximum(1, np.ceil(reach[here] * width)).astype(np.int64)
            of = np.repeat(here, cells)
            cell = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
            base = mix64(element[of] + U64(band) * _C[0] + cell.astype(np.uint64) * GOLDEN)
            count = np.searchsorted(_POISSON, (base >> U64(11)).astype(np.float64) * 2.0**-53, "right")
            for j in range(int(count.max(initial=0))):
                some = np.flatnonzero(count > j)
                dart = mix64(base[some] + U64(j + 1) * _C[1])
                rank = (cell[some] + (dart >> U64(11)).astype(np.float64) * 2.0**-53) / width
                good = rank < reach[of[some]]
                if weight is not None:
                    spot = low + width * (mix64(dart ^ _C[2]) >> U64(11)).astype(np.float64) * 2.0**-53
                    good &= spot < weight[of[some]]
                out.append((owner[of[some[good]]], dart[good], rank[good]))
            low, width, band = (1.0, 1.0, 1) if band == 0 else (low + width, width * 2, band + 1)
            here = np.flatnonzero(weight > low) if weight is not None else here[:0]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out))


def signatures(element: np.ndarray, at: np.ndarray, weight: np.ndarray | None = None, k: int = COORDINATES) -> np.ndarray:
    """uint64 array (rows, k) of the earliest dart per coordinate; rows without elements are 0."""
    counts = np.diff(at)
    row = np.repeat(np.arange(len(counts)), counts)
    mass = counts.astype(float) if weight is None else np.bincount(row, weight, len(counts))
    out = np.zeros((len(counts), k), np.uint64)
    todo, darts = mass > 0, k * (math.log(k) + 4)
    while todo.any():
        mine = np.flatnonzero(todo[row])
        reach = darts / np.maximum(mass, 1e-300)
        owner, dart, rank = throw(element[mine], row[mine], reach[row[mine]], None if weight is None else weight[mine])
        key = owner * k + (mix64(dart ^ _C[3]) % U64(k)).astype(np.int64)
        best = np.full(len(counts) * k, np.inf)
        np.minimum.at(best, key, rank)
        won = rank == best[key]
        out.reshape(-1)[key[won]] = dart[won]
        todo &= np.isinf(best.reshape(-1, k)).any(1)
        darts *= 2
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """int64 array (rows, bands)."""
    parts = signature.reshape(len(signature), bands, -1)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _C[4] + _C[5], parts.shape[:2]).copy()
        for i in range(parts.shape[2]):
            key = mix64(key * GOLDEN ^ parts[:, :, i])
    return key.view(np.int64)


def band_orders(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """int64 array (rows, bands) that sorts a bucket: four bits of each of the sixteen coordinates after the band."""
    rows, k = signature.shape
    parts = (mix64(signature ^ _C[6]) & U64(15)).astype(np.uint8)
    at = (np.arange(1, bands + 1)[:, None] * (k // bands) + np.arange(16)) % k
    parts = parts[:, at]
    return np.ascontiguousarray(parts[:, :, 0::2] << 4 | parts[:, :, 1::2]).view(">i8").reshape(rows, bands).astype(np.int64)


def counted(element: np.ndarray, at: np.ndarray, weighted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each row in order, where each row's begin, and their weights: how often they occur, or 1."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((element, row))
    element, row = element[order], row[order]
    fresh = np.ones(len(element), bool)
    fresh[1:] = (element[1:] != element[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    weight = np.diff(np.append(first, len(element))) if weighted else np.ones(len(first), np.int64)
    return element[first], np.searchsorted(row[first], np.arange(len(at))), weight.astype(np.float64)


def jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum of lower over sum of higher weights of two sets in order."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = float(np.minimum(wa[i], wb[j]).sum())
    total = float(wa.sum() + wb.sum()) - common
    return common / total if total else 0.0


def _signed(df: DataFrame, bands: int, weighted: bool) -> DataFrame:
    """(doc_id, node, bands, orders, signature) of (doc_id, node, text); the signature has a byte per coordinate."""

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in text_blocks(batch.column(2)):
                element, at, weight = counted(*shingles(data, offsets), weighted)
                signature = signatures(element, at, weight if weighted else None)
                has = np.diff(at) > 0
                ends = pa.array(np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x[has].reshape(-1))) for x in (band_keys(signature, bands), band_orders(signature, bands))]
                short = pa.array([x.tobytes() for x in (mix64(signature) & U64(255)).astype(np.uint8)], pa.binary())
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists, short], names=["doc_id", "node", "bands", "orders", "signature"])

    return df.mapInArrow(run, "doc_id long, node binary, bands array<long>, orders array<long>, signature binary")


def nearest_before(bucket: np.ndarray, signature: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, other row) for each row from `first` on: the nearest of those before it in its bucket, REACH back at most."""
    rows, least = len(bucket), int(LEAST * signature.shape[1])
    best, whom = np.full((rows, NEAREST), least, np.int16), np.full((rows, NEAREST), -1)
    at = np.arange(first, rows)
    for back in range(1, REACH + 1):
        at = at[at >= back]
        at = at[bucket[at] == bucket[at - back]]
        if not len(at):
            break
        agree = (signature[at] == signature[at - back]).sum(1).astype(np.int16)
        worst = best[at].argmin(1)
        better = agree > best[at, worst]
        best[at[better], worst[better]], whom[at[better], worst[better]] = agree[better], at[better] - back
    row, place = np.nonzero(whom >= 0)
    return row, whom[row, place]


def _neighbours(member: DataFrame) -> DataFrame:
    """(id, other): the nearest of those before it for each member (bucket, order, id, n, signature) of a bucket of n.

    Rows are sorted by ranges over all partitions, so no long bucket is one task's, and one of NEAREST + 1 rows or less is
    never cut; a partition streams its rows with the last REACH in hand, and gives the outermost ones away too, to be
    compared across the boundary. What is missed there is left to `_blocks`."""
    parts = int(member.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["bucket", "order", "id"]

    def run(batches):
        part, first = TaskContext.get().partitionId(), True
        bucket, ids, signature = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, COORDINATES), np.uint8)

        def out(ids, others, place=0, bucket=None, signature=None):
            n = len(ids)
            packed = pa.nulls(n, pa.binary()) if signature is None else pa.array([x.tobytes() for x in signature], pa.binary())
            columns = [pa.array(ids, pa.int64()), pa.array(others, pa.int64()), pa.array(np.full(n, part), pa.int64()), pa.array(np.full(n, place), pa.int64()), pa.array(np.zeros(n, np.int64) if bucket is None else bucket, pa.int64()), packed]
            return pa.RecordBatch.from_arrays(columns, names=["id", "other", "part", "place", "bucket", "signature"])

        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                piece = batch.slice(a, 4096)
                held = len(ids)
                bucket = np.concatenate([bucket, piece.column(0).to_numpy()])
                ids = np.concatenate([ids, piece.column(2).to_numpy()])
                signature = np.concatenate([signature, np.frombuffer(b"".join(piece.column(3).to_pylist()), np.uint8).reshape(-1, COORDINATES)])
                row, other = nearest_before(bucket, signature, held)
                yield out(ids[row], ids[other])
                if first and len(ids):
                    first = False
                    yield out(ids[:NEAREST], ids[:NEAREST], 1, bucket[:NEAREST], signature[:NEAREST])
                bucket, ids, signature = bucket[-REACH:], ids[-REACH:], signature[-REACH:]
        if len(ids):
            yield out(ids[-NEAREST:], ids[-NEAREST:], 2, bucket[-NEAREST:], signature[-NEAREST:])

    long = F.col("n") > NEAREST + 1
    ranges = member.repartitionByRange(parts, "bucket", F.when(long, F.col("order")), F.when(long, F.col("id")))
    ordered = ranges.select(*order, "signature").sortWithinPartitions(*order)
    found = stored(ordered.mapInArrow(run, "id long, other long, part long, place long, bucket long, signature binary"), "neighbours")
    # a few rows for each partition
    ends = found.where("place > 0").withColumn("part", F.dense_rank().over(Window.orderBy("part")))
    heads = ends.where("place = 1").select("id", "bucket", "part")
    tails = ends.where("place = 2").select(F.col("id").alias("other"), "bucket", (F.col("part") + 1).alias("part"))
    return found.where("place = 0").select("id", "other").unionByName(heads.join(tails, ["part", "bucket"]).select("id", "other"))


def _blocks(member: DataFrame, label: DataFrame) -> DataFrame:
    """(id, bucket, component, block, x, y): the nodes of each two blocks x <= y that are to be compared, in buckets of over
    NEAREST + 1 nodes and several components.

    member: id, bucket, n. label: id, component. The largest component of a bucket has blocks of its own, which are compared
    with those of all others but not with each other; the others are compared among themselves too."""
    member = member.where(F.col("n") > NEAREST + 1).select("id", "bucket").join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    counts = member.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    most = counts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n")).where("n > most.n")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    most = stored(most.select("bucket", F.col("most.component").alias("largest"), blocks(F.col("most.n")).alias("inner"), blocks(F.col("n") - F.col("most.n")).alias("outer")), "buckets")

    mine = F.col("component") == F.col("largest")
    rows = member.join(most, "bucket").withColumn("block", F.when(mine, F.pmod(F.xxhash64("id"), "inner")).otherwise(F.col("inner") + F.pmod(F.xxhash64("id"), "outer")).cast("int"))
    met = F.sequence(F.when(mine, F.col("inner")).otherwise(F.lit(0)), F.col("inner") + F.col("outer") - 1)
    return rows.withColumn("met", F.explode(met)).select("id", "bucket", "component", "block", F.least("block", "met").alias("x"), F.greatest("block", "met").alias("y"))


def _pairs_apart(table: pa.Table):
    """(row, other rows) of two blocks: nodes of different components that agree in more than LEAST of the coordinates, in the
    first bucket that they share."""
    bucket, x, y = (table.column(c)[0].as_py() for c in ("bucket", "x", "y"))
    block, ids, component = (table.column(c).to_numpy() for c in ("block", "id", "component"))
    signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(ids), -1)
    bands = np.array(table.column("bands").to_pylist(), np.int64)
    right = np.flatnonzero(block == y)
    for i in np.flatnonzero(block == x):
        j = right[(component[right] != component[i]) & ((ids[right] < ids[i]) | (x != y))]
        j = j[(signature[j] == signature[i]).sum(1) > int(LEAST * signature.shape[1])]
        if len(j):
            j = j[bands[i][(bands[j] == bands[i]).argmax(1)] == bucket]
        if len(j):
            yield i, j


def _rest(blocks: DataFrame) -> DataFrame:
    """The rows of `blocks` (with bands and signature) that have a pair to be confirmed, once each."""

    def run(table: pa.Table) -> pa.Table:
        has = np.zeros(len(table), bool)
        for i, j in _pairs_apart(table):
            has[i] = has[j] = True
        return table.filter(pa.array(has))

    return blocks.groupBy("bucket", "x", "y").applyInArrow(run, blocks.schema)


def _confirmed_blocks(rest: DataFrame, threshold: float, weighted: bool) -> DataFrame:
    """Links (a, b, similarity) among the pairs of `rest` (with text), but those that join what its block pair has joined already.

    Pairs are made within a task and never are rows, and a block pair gets the text of a node once."""

    def run(table: pa.Table) -> pa.Table:
        sets: list[np.ndarray] = []
        weights: list[np.ndarray] = []
        for _, _, data, offsets in text_blocks(table.column("text"), 512 << 10):
            element, at, weight = counted(*shingles(data, offsets), weighted)
            sets += np.split(element, at[1:-1])
            weights += np.split(weight, at[1:-1])
        words, flat = np.unique(np.concatenate(sets), return_inverse=True)
        sets = np.split(flat, np.cumsum([len(s) for s in sets])[:-1])
        sizes = np.array([w.sum() for w in weights])
        ids, group = table.column("id").to_numpy(), table.column("component").to_numpy().copy()
        have, found = np.zeros(len(words)), []
        for i, others in _pairs_apart(table):
            have[:] = 0
            have[sets[i]] = weights[i]
            for j in others:
                if group[i] != group[j]:
                    common = np.minimum(have[sets[j]], weights[j]).sum()
                    near = common / (sizes[i] + sizes[j] - common)
                    if near >= threshold:
                        found.append((max(ids[i], ids[j]), min(ids[i], ids[j]), near))
                        group[group == group[j]] = group[i]
        a, b, near = list(zip(*found)) or [()] * 3
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(near, pa.float64())], names=["a", "b", "similarity"])

    return rest.groupBy("bucket", "x", "y").applyInArrow(run, "a long, b long, similarity double")


def _confirmed(pairs: DataFrame, threshold: float, weighted: bool) -> DataFrame:
    """The rows (a, b, text_a, text_b) whose shingle sets are similar enough, with `similarity`."""

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in text_blocks(batch.column(2), 512 << 10):
                part = batch.slice(row, end - row)
                left, at, weight = counted(*shingles(data, offsets), weighted)
                near = []
                for row_b, end_b, data_b, offsets_b in text_blocks(part.column(3), 512 << 10):
                    right, bt, weight_b = counted(*shingles(data_b, offsets_b), weighted)
                    for i in range(row_b, end_b):
                        j = i - row_b
                        x, y = slice(at[i], at[i + 1]), slice(bt[j], bt[j + 1])
                        near.append(jaccard(left[x], weight[x], right[y], weight_b[y]))
                near = np.array(near)
                good = pa.array(np.flatnonzero(near >= threshold))
                yield pa.RecordBatch.from_arrays([part.column(0).take(good), part.column(1).take(good), pa.array(near).take(good)], names=["a", "b", "similarity"])

    return pairs.mapInArrow(run, "a long, b long, similarity double")


def text_key(text: str):
    """128 bits that stand for a text; null counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, weighted: bool = False) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, node (key of the text), component (key of its class), class_id (its
    lowest doc_id), class_size (rows), keep (true for the rows with the lowest doc_id of a class).

    weighted: a shingle weighs as much as it has occurrences, in the signatures and in the similarity that confirms a link."""
    keyed = docs.select(F.col("doc_id").cast("long"), text_key("text").alias("node"), "text")
    rows = stored(_signed(keyed, BANDS, weighted), "signed")
    first = F.first(F.struct("bands", "orders", "signature")).alias("s")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), first)
    nodes = stored(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")

    member = nodes.select("id", F.inline(F.arrays_zip("s.bands", "s.orders"))).toDF("id", "bucket", "order")
    shared = member.groupBy("bucket").agg(F.min("id").alias("lowest"), F.count("*").alias("n")).where("n > 1")
    member = stored(member.join(shared, "bucket"), "members")
    signature = nodes.select("id", "s.signature")
    pairs = _neighbours(member.join(signature, "id")).unionByName(member.where(F.col("n") > REACH).select("id", F.col("lowest").alias("other")))
    pairs = stored(pairs.where("other <> id").select(F.greatest("id", "other").alias("a"), F.least("id", "other").alias("b")).distinct(), "pairs")

    def texts_of(wanted: DataFrame) -> DataFrame:
        wanted = nodes.join(wanted, "id", "left_semi").select("id", "node", F.col("doc_id").alias("first"))
        texts = keyed.join(wanted, "node").where(F.col("doc_id").eqNullSafe(F.col("first")))
        return stored(texts.dropDuplicates(["id"]).select("id", "text"), "texts")

    texts = texts_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    links = stored(_confirmed(both, threshold, weighted), "links")
    label = stored(components(links), "labels")
    rest = stored(_rest(_blocks(member, label).join(nodes.select("id", "s.bands", "s.signature"), "id")), "rest")
    if not rest.isEmpty():
        more = _confirmed_blocks(rest.join(texts_of(rest.select("id").distinct()), "id"), threshold, weighted)
        label = components(links.unionByName(stored(more, "more-links")))

    class_of = nodes.select("id", "node", "doc_id", "n").join(label, "id", "left")
    class_of = stored(class_of.select("node", "doc_id", "n", F.coalesce("component", "id").alias("component")), "classes")
    total = class_of.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"))
    class_of = class_of.join(total, "component").select("node", "component", "class_id", "class_size")
    return rows.select("doc_id", "node").join(class_of, "node").select(
        "doc_id", "node", "component", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("keep")
    )


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD, weighted: bool = False) -> DataFrame:
    """docs with one row left of each class, one with its lowest doc_id."""
    found = near_duplicates(docs, threshold, weighted).where("keep")
    same = found.groupBy("component", "node").agg(F.count("*").alias("__rows"), F.min("class_id").alias("__lowest"))
    chosen = same.groupBy("component").agg(F.min(F.struct("node", "__rows", "__lowest")).alias("c")).select("c.*")
    chosen = stored(chosen.withColumnRenamed("node", "__node"), "chosen")
    left = docs.withColumn("__node", text_key("text")).join(chosen, "__node").where(F.col("doc_id").eqNullSafe(F.col("__lowest")))
    if not chosen.where("__rows > 1").isEmpty():
        # whole rows that are given more than once
        left = left.where("__rows = 1").unionByName(left.where("__rows > 1").dropDuplicates(["__node"]))
    return left.select(*docs.columns)
