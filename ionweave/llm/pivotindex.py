"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. A shard of the index posts its vectors in inverted files, one for each
pivot: who has the pivot, and at which place. A query looks into the files of its own pivots, which gives the footrule distance
of its order to that of every vector found there; those within a radius are compared by the exact inner product.

With places 0..k-1 and k for a pivot that isn't among the nearest k, the footrule of two orders is a constant minus twice the
sum, over shared pivots, of k - max(place, place'); that sum is what the files add up. The radius is a share of its highest
value k(k+1)/2, so it means the same at every size, and no number of candidates is capped: near copies of a vector are all
compared. A shard gives its `k` nearest by footrule at least, also where fewer lie within the radius.

Vectors that are null, zero or hold null or non-finite numbers take no part, nor do rows without an id; several rows of one id
count as one, that of the least vector. Vectors of unequal length never meet. Ties of the inner product go to the smaller id.
Orders are by inner product, so the index is meant for vectors of like norm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import best, in_cells, matrix, merged, usable_vectors, vector
from .common import stored

#: The index is fitted on this many different vectors: those of the lowest hashes are the pivots.
PIVOTS = 256
#: Nearest pivots that represent a vector.
LENGTH = 64
#: Least share of the highest possible agreement of two orders that makes a candidate.
RADIUS = 0.19


class InvertedFiles:
    """The files of one shard: for each pivot the rows that have it among their nearest, and the places it has there."""

    def __init__(self, orders: np.ndarray):
        self.rows, self.length = orders.shape
        by = np.argsort(orders.ravel(), kind="stable")
        self.who, self.place = np.divmod(by, max(1, self.length))
        self.begin = np.searchsorted(orders.ravel()[by], np.arange(PIVOTS + 1))

    def agreement(self, order: np.ndarray) -> np.ndarray:
        """For each row the sum of length - max(place, place') over shared pivots: the higher, the less the footrule."""
        total = np.zeros(self.rows, np.int32)
        for mine, pivot in enumerate(order.tolist()):
            file = slice(self.begin[pivot], self.begin[pivot + 1])
            total[self.who[file]] += self.length - np.maximum(self.place[file], mine)
        return total


def choose_pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Of each length the pivots, PIVOTS in all: a sample of different vectors, whichever ids and copies they have."""
    sample = vectors.select("vec", "dim").distinct().orderBy(F.xxhash64("vec"), "vec").limit(PIVOTS).collect()
    return {d: np.array([r.vec for r in sample if r.dim == d]) for d in {r.dim for r in sample}}


def with_orders(vectors: DataFrame, pivots: dict[int, np.ndarray], length: int = LENGTH) -> DataFrame:
    """vectors (id, vec, dim) with `order`: the numbers of the nearest pivots, nearest first; empty where none has this length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vecs = batch.column(2).to_numpy(), batch.column(1)
            orders: list = [[]] * batch.num_rows
            for dim in np.unique(dims):
                if dim not in pivots:
                    continue
                at = np.flatnonzero(dims == dim)
                near = matrix(vecs.take(pa.array(at))) @ pivots[dim].T
                for i, order in zip(at.tolist(), np.argsort(-near, axis=1, kind="stable")[:, :length].tolist()):
                    orders[i] = order
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(orders, pa.list_(pa.int16()))], names=["id", "vec", "dim", "order"])

    return vectors.select("id", "vec", "dim").mapInArrow(run, "id long, vec array<double>, dim int, order array<short>")


def build_index(df: DataFrame, id_column: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(id, vec, dim, order) of every usable row of df, stored."""
    vectors = stored(usable_vectors(df, id_column, vec).where(F.exists("vec", lambda x: x != 0)), "vectors")
    return stored(with_orders(vectors, choose_pivots(vectors)), "orders")


def nearest_in_cell(rows: pa.Table, asking: pa.Table, k: int, radius: float) -> pa.Table:
    """(query_id, cell, found) of a cell: for each asking row its k nearest candidates among the rows, by score upside down."""
    kind = pa.list_(pa.struct([("minus", pa.float64()), ("vec_id", pa.int64())]))
    schema = pa.schema([("query_id", pa.int64()), ("cell", pa.int64()), ("found", kind)])
    if not rows.num_rows or not asking.num_rows:
        return schema.empty_table()
    ids, vecs, files = vector(rows["id"]), matrix(rows["vec"]), InvertedFiles(matrix(rows["order"], np.int16))
    out_ids, found = vector(asking["id"]), []
    least = radius * files.length * (files.length + 1) / 2
    for own, v, order in zip(out_ids, matrix(asking["vec"]), matrix(asking["order"], np.int16)):
        agreement = files.agreement(order)
        agreement[ids == own] = -1
        within = np.flatnonzero(agreement >= max(0.0, least))
        if len(within) < k:
            within = best(agreement, ids, k)
            within = within[agreement[within] >= 0]
        # a sum along each row: the same for equal vectors, wherever they stand
        score = (vecs[within] * v).sum(axis=1)
        top = best(score, ids[within], k)
        found.append([{"minus": -s, "vec_id": i} for i, s in zip(ids[within][top].tolist(), score[top].tolist())])
    return pa.table([pa.array(out_ids, pa.int64()), asking["cell"], pa.array(found, kind)], schema=schema)


def search(index: DataFrame, queries: DataFrame, k: int = 20, radius: float = RADIUS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of queries, which has the index's columns, but itself.

    Queries meet the shards in cells of bounded size; a cell gives k rows of a query at most, and these are merged in two rounds."""
    rows, asking, step = in_cells(index, queries)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return nearest_in_cell(left, right, k, radius)

    kind = "query_id long, cell long, found array<struct<minus:double,vec_id:long>>"
    met = rows.groupBy("cell", "dim").cogroup(asking.groupBy("cell", "dim")).applyInArrow(run, kind)
    ranked = merged(met, ["query_id"], k, step).select("query_id", F.posexplode("found").alias("place", "one"))
    return ranked.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "one.vec_id", (-F.col("one.minus")).alias("score"))
