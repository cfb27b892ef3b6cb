"""A stated set of asking rows against all rows, in cells of bounded size, and vectors as numpy arrays."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and asking rows of a cell, about.
ROWS, ASKING = 1 << 14, 1 << 12


def usable_vectors(df: DataFrame, id_column: str, vector: str, more: dict[str, Column] | None = None) -> DataFrame:
    """(id, vec, more..., dim) of the rows that have an id and a vector of finite numbers; zero vectors are among them.

    Several rows of one id count as one: the least of them by vector, then by the further columns."""
    more = more or {}
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    plain = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), *(c.alias(k) for k, c in more.items())).where(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite)
    one = plain.groupBy("id").agg(F.min(F.struct("vec", *more)).alias("one")).select("id", "one.*")
    return one.withColumn("dim", F.size("vec"))


def in_cells(rows: DataFrame, asking: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Both with a column `cell`, so that each pair of one dim meets in exactly one (cell, dim); and the step that merged() takes.

    Rows are dealt to shards by the hash of their id, ROWS in each at most but for chance, and at least a shard for each shuffle
    partition; asking rows to blocks of about ASKING. A cell is a shard and a block: an asking row is copied to all shards, a
    row to all blocks, and no task holds more than one of each. Both should be stored: they are counted first."""
    n, m = rows.count(), asking.count()
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, math.ceil(m / ASKING))
    shards = max(1, math.ceil(n / ROWS), math.ceil(partitions / blocks))
    of = lambda k: F.pmod(F.xxhash64("id"), F.lit(k).cast("long"))
    upto = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    rows = rows.withColumn("__shard", of(shards)).withColumn("__block", upto(blocks))
    asking = asking.withColumn("__block", of(blocks)).withColumn("__shard", upto(shards))
    cell = (F.col("__shard") * blocks + F.col("__block")).alias("cell")
    # under new names of their own: a cogroup of two sides that come from one table loses columns when Spark prunes it
    rows, asking = (d.select(cell, *(F.col(c).alias(c) for c in d.columns if not c.startswith("__"))) for d in (rows, asking))
    return rows, asking, blocks * math.ceil(math.sqrt(shards))


def merged(found: DataFrame, keys: list[str], k: int, step: int) -> DataFrame:
    """(keys..., found) with the k least elements of the sorted arrays `found` that the cells made for these keys.

    Arrays of about the square root of all shards are merged at a time, in two rounds, and cut to k elements after each: an array
    never holds what all cells have found."""
    best = F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("found")
    return found.groupBy(*keys, F.floor(F.col("cell") / step).alias("part")).agg(best).groupBy(*keys).agg(best)


def matrix(column: pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) and len(flat) else np.zeros((len(column), 0), kind)


def vector(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.combine_chunks().to_numpy(zero_copy_only=False)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores in order, ties to the smaller id."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))[:k]]
