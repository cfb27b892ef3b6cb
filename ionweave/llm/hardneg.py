"""Hard negatives by segment summaries.

A vector is cut into segments, and of each the mean and the deviation are stored, at several levels of ever shorter segments. Over a segment of L components the inner product of two vectors is L * mean * mean' plus the product of what is left
around the means, which lies within L * deviation * deviation' (Cauchy and Schwarz). Summed over segments this bounds a score.
The rows of the highest middles are scored first, which gives a score that is surely reached; rows whose bounds put them below it,
or outside what is asked for, are left out, level by level from the coarsest, and only what remains is scored.

Scores are inner products of whole numbers, floor(256 * x) of each component, and exact: in doubles where no sum can pass 2^53,
else in Python's whole numbers. A score beyond 64 bits ranks by its true value and is given as the nearest 64-bit number.
Rows with a null id, label or vector, or with a null or non-finite component, take no part; several rows of one id count as one.
Vectors of unequal length never meet; an empty vector scores 0 with every other empty one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import in_cells, matrix, merged, usable_vectors, vector
from .common import stored

#: Segments of each level, and rows that are scored first, by the middles of the last level.
LEVELS, FIRST = (4, 16, 32), 64
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is at least and at most so many tenths of its positive's.
LEAST_TENTHS, MOST_TENTHS = 3, 9
#: What a cell finds: scores upside down, so that the least comes first. The lowest score is -(2^63 - 1), which has a negative.
_FOUND = "array<struct<minus:long,other:long>>"
_PAIR = pa.struct([("minus", pa.int64()), ("other", pa.int64())])


def _edges(dim: int, segments: int) -> np.ndarray:
    return np.unique(np.linspace(0, dim, min(dim, segments) + 1).astype(int))[:-1]


def summaries(vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all segments of all levels, level after level; one row for each row of vecs."""
    means, deviations = [np.zeros((len(vecs), 0))], [np.zeros((len(vecs), 0))]
    dim = vecs.shape[1]
    for at in (_edges(dim, s) for s in LEVELS if dim):
        size = np.diff(np.append(at, dim))
        mean = np.add.reduceat(vecs, at, axis=1) / size
        around = vecs - np.repeat(mean, size, axis=1)
        means.append(mean)
        deviations.append(np.sqrt(np.add.reduceat(around * around, at, axis=1) / size))
    return np.hstack(means), np.hstack(deviations)


def with_summaries(rows: DataFrame) -> DataFrame:
    """rows (id, vec, dim, label) with vec as whole numbers, means and deviations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doubles = pa.list_(pa.float64())
        for batch in batches:
            dims, made = batch.column(2).to_numpy(), [[]] * batch.num_rows
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                whole = np.floor(SCALE * matrix(batch.column(1).take(pa.array(at))))
                for i, *each in zip(at.tolist(), whole.tolist(), *(x.tolist() for x in summaries(whole))):
                    made[i] = each
            columns = [pa.array([m[c] for m in made], doubles) for c in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), columns[0], batch.column(2), batch.column(3), *columns[1:]], names=["id", "vec", "dim", "label", "means", "deviations"])

    return rows.select("id", "vec", "dim", "label").mapInArrow(run, "id long, vec array<double>, dim int, label int, means array<double>, deviations array<double>")


class Rows:
    """The rows of a cell, with their summaries."""

    def __init__(self, table: pa.Table):
        self.ids, self.labels = vector(table["id"]), vector(table["label"])
        self.vecs, self.means, self.deviations = matrix(table["vec"]), matrix(table["means"]), matrix(table["deviations"])
        self.norms = np.sqrt((self.vecs * self.vecs).sum(axis=1))
        self.levels, begin, dim = [], 0, self.vecs.shape[1]
        for at in (_edges(dim, s) for s in LEVELS if dim):
            self.levels.append((slice(begin, begin + len(at)), np.diff(np.append(at, dim)).astype(float)))
            begin += len(at)

    def bounds(self, level: int, at: np.ndarray, mean: np.ndarray, deviation: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible scores of the rows `at` with a vector of this mean, deviation and norm."""
        segments, size = self.levels[level]
        middle = self.means[at, segments] @ (mean[segments] * size)
        # and what the doubles' own rounding may take away
        reach = self.deviations[at, segments] @ (deviation[segments] * size) + 1e-9 * norm * self.norms[at]
        return middle - reach, middle + reach

    def promising(self, at: np.ndarray, mean: np.ndarray) -> np.ndarray:
        """Those of the rows `at` that the finest means alone put first."""
        if len(at) <= FIRST or not self.levels:
            return at
        segments, size = self.levels[-1]
        middle = self.means[at, segments] @ (mean[segments] * size)
        return at[np.argpartition(-middle, FIRST)[:FIRST]]

    def scores(self, at: np.ndarray, v: np.ndarray, norm: float) -> np.ndarray:
        if not len(at) or norm * self.norms[at].max() < 2.0**53:
            return (self.vecs[at] @ v).astype(np.int64)
        mine = [int(x) for x in v]
        return np.array([sum(a * int(x) for a, x in zip(mine, row)) for row in self.vecs[at]] + [0], object)[:-1]


def _ranked(score: np.ndarray, ids: np.ndarray, k: int) -> list[int]:
    """Places of the k highest whole numbers in order, ties to the smaller id."""
    if score.dtype != object:
        return np.lexsort((ids, -score))[:k].tolist()
    return sorted(range(len(score)), key=lambda i: (-score[i], ids[i]))[:k]


def _kth(scores: np.ndarray, k: int) -> float:
    """The k-th highest score, or what is below all if there are fewer."""
    return float(np.sort(scores)[len(scores) - k]) if len(scores) >= k else -np.inf


def _long(score) -> int:
    return max(1 - (1 << 63), min((1 << 63) - 1, int(score)))


def positives(rows: Rows, label: int, own: int, v: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> list[dict]:
    """The rows of the same label with the highest scores, without the anchor itself."""
    at, norm = np.flatnonzero((rows.labels == label) & (rows.ids != own)), float(np.sqrt(v @ v))
    reached = _kth(rows.scores(rows.promising(at, mean), v, norm), POSITIVES)
    for level in range(len(rows.levels)):
        if len(at) <= POSITIVES:
            break
        _, high = rows.bounds(level, at, mean, deviation, norm)
        at = at[high >= reached]
    score = rows.scores(at, v, norm)
    return [{"minus": -_long(score[i]), "other": int(rows.ids[at[i]])} for i in _ranked(score, rows.ids[at], POSITIVES)]


def negatives(rows: Rows, label: int, windows: list[tuple[int, int, int]], v: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> list[list[dict]]:
    """For each window (positive, lowest, highest score) the rows of other labels with the highest scores within."""
    at, norm = np.flatnonzero(rows.labels != label), float(np.sqrt(v @ v))
    first = rows.scores(rows.promising(at, mean), v, norm)
    reached = [max(least, _kth(first[(first >= least) & (first <= most)], NEGATIVES)) for _, least, most in windows]
    for level in range(len(rows.levels)):
        low, high = rows.bounds(level, at, mean, deviation, norm)
        needed = np.zeros(len(at), bool)
        for (_, _, most), score in zip(windows, reached):
            needed |= (high >= score) & (low <= most)
        at = at[needed]
    score, out = rows.scores(at, v, norm), []
    for _, least, most in windows:
        inside = np.flatnonzero((score >= least) & (score <= most))
        out.append([{"minus": -_long(score[inside[i]]), "other": int(rows.ids[at[inside[i]]])} for i in _ranked(score[inside], rows.ids[at[inside]], NEGATIVES)])
    return out


def _window(positive: int, score: int) -> tuple[int, int, int]:
    return positive, -(-LEAST_TENTHS * score // 10), MOST_TENTHS * score // 10


def _met(rows: DataFrame, anchors: DataFrame, each, k: int) -> DataFrame:
    """(anchor_id, positive_id, found): the k best that each(Rows, an anchor's fields) finds in all cells, by the positive it is for."""
    cells, asking, step = in_cells(rows, anchors)

    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("cell", pa.int64()), ("found", pa.list_(_PAIR))])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        near, out = Rows(left), []
        more = right["positives"].to_pylist() if "positives" in right.column_names else [None] * right.num_rows
        fields = (vector(right[c]).tolist() for c in ("cell", "id", "label"))
        for cell, i, label, *vectors, given in zip(*fields, *(matrix(right[c]) for c in ("vec", "means", "deviations")), more):
            out += [(i, positive, cell, found) for positive, found in each(near, i, label, *vectors, given) if found]
        columns = zip(*out) if out else [[]] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, schema.types)], schema=schema)

    met = cells.groupBy("cell", "dim").cogroup(asking.groupBy("cell", "dim")).applyInArrow(run, f"anchor_id long, positive_id long, cell long, found {_FOUND}")
    return merged(met, ["anchor_id", "positive_id"], k, step)


def mine(df: DataFrame, anchors, id_column: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    anchors: a condition on `id`. Anchors meet all rows in cells of bounded size, twice: for their positives, then for the
    negatives that these ask for. A cell gives a few rows of an anchor, and the best of all cells are ranked."""
    known = usable_vectors(df.where(F.col(label).isNotNull()), id_column, vec, {"label": F.col(label).cast("int")})
    rows = stored(with_summaries(known), "summaries")
    asking = rows.where(anchors)
    first = _met(rows, asking, lambda near, i, own, v, m, d, _: [(None, positives(near, own, i, v, m, d))], POSITIVES)
    told = stored(asking.join(first.select(F.col("anchor_id").alias("id"), F.col("found").alias("positives")), "id"), "anchors")

    def within(near, i, own, v, m, d, given):
        windows = [w for w in (_window(p["other"], -p["minus"]) for p in given) if w[1] <= w[2]]
        return zip((w[0] for w in windows), negatives(near, own, windows, v, m, d))

    second = _met(rows, told, within, NEGATIVES).select("anchor_id", "positive_id", F.posexplode("found").alias("place", "one"))
    scores = told.select(F.col("id").alias("anchor_id"), F.inline("positives")).select("anchor_id", F.col("other").alias("positive_id"), (-F.col("minus")).alias("positive_score"))
    ranked = second.join(scores, ["anchor_id", "positive_id"])
    return ranked.select("anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.other").alias("negative_id"), "positive_score", (-F.col("one.minus")).alias("negative_score"))
