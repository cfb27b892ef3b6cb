"""Spectra of scans against all references of their key, in cells of bounded size, as array work on batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs of spectra that are looked at together, and places of a dense table of references.
PAIRS, PLACES = 1 << 19, 1 << 22
#: Rows of a batch that is handed on, and pairs of spectra that are solved together peak by peak.
ROWS, SOLVED = 1 << 16, 2048


class Side:
    """The peaks of spectra, end to end: `of` says which spectrum, and peaks stand by m/z."""

    def __init__(self, of: np.ndarray, mz: np.ndarray, i: np.ndarray):
        self.of, self.mz, self.i = of, mz, i
        # peaks of one m/z in a spectrum are one node
        new = np.append(True, (of[1:] != of[:-1]) | (mz[1:] != mz[:-1]))[: len(of)]
        self.node = np.cumsum(new) - 1

    def norms(self, n: int) -> np.ndarray:
        return np.sqrt(np.bincount(self.of, self.i.astype(float) ** 2, n))


def near(q: Side, r: Side, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """(peak of q, peak of r) of the same candidate, no more than the tolerance apart and with a positive product."""
    # m/z shifted by candidate: a power of two, so that sums stay exact
    step = 2.0 ** np.ceil(np.log2(max(1.0, *(float(s.mz.max(initial=0)) for s in (q, r))) + 4 * tolerance + 1) + 1)
    at, there = q.of * step + q.mz, r.of * step + r.mz
    low = np.searchsorted(there, at - tolerance * 1.001 - 1e-6)
    n = np.searchsorted(there, at + tolerance * 1.001 + 1e-6, "right") - low
    a = np.repeat(np.arange(len(at)), n)
    b = np.arange(int(n.sum())) + np.repeat(low - np.cumsum(n) + n, n)
    ok = (np.abs(q.mz[a] - r.mz[b]).astype(float) <= tolerance) & (q.i[a].astype(float) * r.i[b] > 0) & (q.of[a] == r.of[b])
    return a[ok], b[ok]


def best_assignment(w: np.ndarray) -> list[tuple[int, int]]:
    """One-to-one pairs (row, column) of positive weight with the highest sum, by shortest augmenting paths."""
    n = max(w.shape)
    cost = np.zeros((n + 1, n + 1))
    cost[1 : w.shape[0] + 1, 1 : w.shape[1] + 1] = -w
    u, v, row_of, way = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1, int), np.zeros(n + 1, int)
    for i in range(1, n + 1):
        row_of[0], j = i, 0
        least, used = np.full(n + 1, np.inf), np.zeros(n + 1, bool)
        while row_of[j]:
            used[j] = True
            slack = cost[row_of[j]] - u[row_of[j]] - v
            better = ~used & (slack < least)
            better[0] = False
            least[better], way[better] = slack[better], j
            open_ = np.where(used, np.inf, least)
            open_[0] = np.inf
            nearest = int(open_.argmin())
            step = open_[nearest]
            u[row_of[used]] += step
            v[used] -= step
            least[~used] -= step
            j = nearest
        while j:
            row_of[j] = row_of[way[j]]
            j = way[j]
    pairs = [(int(row_of[j]) - 1, j - 1) for j in range(1, n + 1)]
    return [(i, j) for i, j in pairs if i < w.shape[0] and j < w.shape[1] and w[i, j] > 0]


def assigned(q: Side, r: Side, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Places of the one-to-one pairs with the highest sum of each candidate.

    A pair of which both peaks have no other partner is final as it stands; only the rest of a candidate is solved."""
    qn, rn = q.node[a], r.node[b]
    clear = (np.bincount(qn)[qn] == 1) & (np.bincount(rn)[rn] == 1) if len(a) else np.zeros(0, bool)
    kept = [np.flatnonzero(clear)]
    rest = np.flatnonzero(~clear)
    rest = rest[np.lexsort((w[rest], rn[rest], qn[rest], q.of[a[rest]]))]
    for group in np.split(rest, np.flatnonzero(np.diff(q.of[a[rest]])) + 1) if len(rest) else ():
        qs, x = np.unique(qn[group], return_inverse=True)
        rs, y = np.unique(rn[group], return_inverse=True)
        cost, place = np.zeros((len(qs), len(rs))), np.zeros((len(qs), len(rs)), int)
        # by weight, so that of peaks with one m/z the strongest stays
        cost[x, y], place[x, y] = w[group], group
        kept.append(np.array([place[i, j] for i, j in best_assignment(cost)], int))
    return np.sort(np.concatenate(kept))


class Spectra:
    """Spectra of a table with columns (id, at, mzs, ints), at being the precursor's m/z; `plain` ones have finite peaks without
    negative intensities."""

    def __init__(self, table: pa.Table, id_: str):
        self.n, self.ids, self.at = table.num_rows, table[id_].combine_chunks(), table["at"].combine_chunks().to_numpy(zero_copy_only=False)
        lists, ints = table["mzs"].combine_chunks(), table["ints"].combine_chunks()
        self.size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.of = np.repeat(np.arange(self.n), self.size)
        self.mz, self.i = (x.flatten().to_numpy(zero_copy_only=False) for x in (lists, ints))
        self.norm = np.sqrt(np.bincount(self.of, self.i.astype(float) ** 2, self.n))
        self.plain = np.bincount(self.of, ~(np.isfinite(self.mz) & np.isfinite(self.i) & (self.i >= 0)), self.n) == 0

    def only(self, which: np.ndarray) -> Side:
        """The peaks of the spectra `which`, one after the other; one may come several times."""
        n = self.size[which]
        peaks = np.arange(int(n.sum())) + np.repeat(self.begin[which] - np.cumsum(n) + n, n)
        return Side(np.repeat(np.arange(len(which)), n), self.mz[peaks], self.i[peaks])


class References(Spectra):
    """The references of a cell, with their m/z in clusters that lie further than the tolerance apart.

    Where each spectrum has one peak of a cluster at most, and a peak of a scan is near to all of one cluster and to no other, which
    peaks match is a matter of their clusters alone: no peak has a choice, and sums over matches are products of two tables."""

    def __init__(self, table: pa.Table, tolerance: float):
        super().__init__(table, "ref_id")
        self.tolerance = tolerance
        used = self.plain[self.of] & (self.i > 0)
        self.values = np.unique(self.mz[used])
        new = np.append(True, np.diff(self.values).astype(float) > tolerance)[: len(self.values)]
        self.first = np.flatnonzero(new)
        self.last = np.append(self.first[1:], len(self.values)) - 1
        self.cluster = np.cumsum(new) - 1
        place = self.cluster[np.searchsorted(self.values, self.mz[used])]
        self.regular = self.plain & ~_repeated(self.of[used], place, self.n)
        self.order = np.flatnonzero(self.regular)
        kept = self.regular[self.of[used]]
        self.row, self.place, self.weight = self.of[used][kept], place[kept], self.i[used][kept]
        self.block = max(1, PLACES // max(1, len(self.first)))
        self.whole = self._tables(0) if 0 < len(self.order) <= self.block else None

    def _tables(self, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        which = self.order[begin : begin + self.block]
        new = np.full(self.n, -1)
        new[which] = np.arange(len(which))
        inside = new[self.row] >= 0
        table = np.zeros((len(which), len(self.first)))
        table[new[self.row[inside]], self.place[inside]] = self.weight[inside]
        return which, table, (table > 0).astype(np.float32)

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(references, their intensities by cluster, and whether there is any) of regular references."""
        if self.whole:
            yield self.whole
        else:
            yield from (self._tables(k) for k in range(0, len(self.order), self.block))

    def places(self, mz: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cluster of each m/z, -1 for none; and whether that is clear."""
        top = len(self.values) - 1
        if top < 0:
            return np.full(len(mz), -1), np.ones(len(mz), bool)
        close = lambda at: (np.abs(mz - self.values[np.clip(at, 0, top)]).astype(float) <= self.tolerance) & (at >= 0) & (at <= top)
        above = np.searchsorted(self.values, mz)
        low, high = close(above - 1), close(above)
        c = self.cluster[np.clip(np.where(low, above - 1, above), 0, top)]
        first, last = self.first[c], self.last[c]
        clear = close(first) & close(last) & ~close(first - 1) & ~close(last + 1)
        return np.where(low | high, c, -1), clear | ~(low | high)


def _repeated(of: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Which of n spectra have several peaks of one place."""
    out = np.zeros(n, bool)
    order = np.lexsort((place, of))
    of, place = of[order], place[order]
    out[of[1:][(of[1:] == of[:-1]) & (place[1:] == place[:-1])]] = True
    return out


class Found:
    """Matches (scan, reference, score, matched peaks, near pairs of peaks, m/z of the matched peaks) of a few scans."""

    def __init__(self, fragments: bool):
        self.fragments, self.parts = fragments, []

    def add(self, scan: np.ndarray, ref: np.ndarray, score: np.ndarray, matched: np.ndarray, pairs: np.ndarray, mz: np.ndarray | None = None, size: np.ndarray | None = None) -> None:
        if len(scan):
            self.parts.append((scan, ref, score, matched, pairs, mz, size))

    def batches(self, scans: Spectra, refs: References, n: int | None) -> Iterator[pa.RecordBatch]:
        """In rows of the answer; of each scan the n best if n is given, ties to the reference that stands first."""
        for scan, ref, score, matched, pairs, mz, size in self.parts if n is None else self._best(n):
            end = None if size is None else np.append(0, np.cumsum(size))
            for k in range(0, len(scan), ROWS):
                at, to = scan[k : k + ROWS], ref[k : k + ROWS]
                columns = [scans.ids.take(pa.array(at)), refs.ids.take(pa.array(to)), *map(pa.array, (score[k : k + ROWS], matched[k : k + ROWS].astype(np.int64), pairs[k : k + ROWS].astype(np.int64), scans.size[at], refs.size[to]))]
                names = ["scan_id", "ref_id", "score", "num_matches", "num_pairs", "data_frags", "ref_frags"]
                if self.fragments:
                    ends = end[k : k + ROWS + 1]
                    columns.append(pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(mz[ends[0] : ends[-1]])))
                    names.append("matched_fragments")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def _best(self, n: int) -> list[tuple]:
        if not self.parts:
            return []
        columns = [np.concatenate([p[k] for p in self.parts]) for k in range(5)]
        # as in SQL, what is no number stands above all numbers
        order = np.lexsort((columns[1], np.where(np.isnan(columns[2]), -np.inf, -columns[2]), columns[0]))
        scan = columns[0][order]
        kept = order[np.arange(len(order)) - np.searchsorted(scan, scan) < n]
        return [(*(c[kept] for c in columns), None, None)]


def _score(dot: np.ndarray, scan_norm: np.ndarray, ref_norm: np.ndarray) -> np.ndarray:
    """Nine digits are kept, so that scores which differ by the order of their sums alone are ties."""
    with np.errstate(all="ignore"):
        return np.floor(dot / (scan_norm * ref_norm) * 1e9 + 0.5) / 1e9


class Question:
    """What is asked of all pairs of a cell: precursors no more than ppm apart (None takes all), the thresholds, whether the
    m/z of matched peaks are wanted, and how many references of a scan (None takes all)."""

    def __init__(self, tolerance: float, ppm: float | None, min_score: float | None, min_fragments: int, n: int | None, fragments: bool):
        if fragments and n is not None:
            raise ValueError("fragments are given for all pairs alone")
        self.tolerance, self.ppm, self.min_score, self.min_fragments, self.n, self.fragments = tolerance, ppm, min_score, min_fragments, n, fragments

    def candidates(self, scan_at: np.ndarray, ref_at: np.ndarray) -> np.ndarray:
        if self.ppm is None:
            return np.ones(np.broadcast_shapes(scan_at.shape, ref_at.shape), bool)
        # as in SQL, what is no number is near to everything
        return (np.abs(scan_at - ref_at) <= ref_at * (self.ppm * 1e-6)) | np.isnan(ref_at)

    def passed(self, score: np.ndarray, matched: np.ndarray) -> np.ndarray:
        ok = matched >= max(1, self.min_fragments)
        return ok if self.min_score is None else ok & ((score >= self.min_score) | np.isnan(score))

    def answers(self, table: pa.Table, refs: References) -> Iterator[pa.RecordBatch]:
        """The rows of scans against the references of their cell, a few scans at a time."""
        step = max(1, PAIRS // max(1, refs.n))
        for k in range(0, table.num_rows, step):
            scans, found = Spectra(table.slice(k, step), "scan_id"), Found(self.fragments)
            place, clear = refs.places(scans.mz)
            used = (scans.i > 0) & (place >= 0)
            twice = _repeated(scans.of[used], place[used], scans.n)
            regular = scans.plain & ~twice & (np.bincount(scans.of, ~clear & (scans.i > 0), scans.n) == 0)
            self._products(scans, refs, np.flatnonzero(regular), place, used, found)
            for a, b in ((~regular, np.ones(refs.n, bool)), (regular, ~refs.regular)):
                self._solved(scans, refs, np.flatnonzero(a), np.flatnonzero(b), found)
            yield from found.batches(scans, refs, self.n)

    def _products(self, scans: Spectra, refs: References, which: np.ndarray, place: np.ndarray, used: np.ndarray, found: Found) -> None:
        """Regular scans against regular references, by products of their tables."""
        if not len(which):
            return
        new = np.full(scans.n, -1)
        new[which] = np.arange(len(which))
        peaks = np.flatnonzero(used & (new[scans.of] >= 0))
        table = np.zeros((len(which), len(refs.first)))
        table[new[scans.of[peaks]], place[peaks]] = scans.i[peaks]
        some = (table > 0).astype(np.float32)
        for of, theirs, any_ in refs.blocks():
            matched = some @ any_.T
            ok = self.candidates(scans.at[which][:, None], refs.at[of][None, :]) & (matched > 0)
            score = _score(table @ theirs.T, scans.norm[which][:, None], refs.norm[of][None, :]) if ok.any() else matched
            ok &= self.passed(score, matched)
            if self.n is not None and self.n < len(of):
                # what is below the n-th highest of a scan can't be among its n best
                high = np.where(ok, score, -np.inf)
                ok &= score >= np.partition(high, len(of) - self.n, axis=1)[:, len(of) - self.n][:, None]
            a, b = np.nonzero(ok)
            mz, size = self._fragments(scans, peaks, new, place, any_, a, b, matched) if self.fragments else (None, None)
            found.add(which[a], of[b], score[a, b], matched[a, b], matched[a, b], mz, size)

    @staticmethod
    def _fragments(scans: Spectra, peaks: np.ndarray, new: np.ndarray, place: np.ndarray, any_: np.ndarray, a: np.ndarray, b: np.ndarray, matched: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = new[scans.of[peaks]]
        ends, rows, out = np.searchsorted(row, np.arange(len(matched) + 1)), np.searchsorted(a, np.arange(len(matched) + 1)), []
        for s in range(len(matched)):
            own = peaks[ends[s] : ends[s + 1]]
            hit = any_[np.ix_(b[rows[s] : rows[s + 1]], place[own])] > 0
            out.append(scans.mz[own][np.nonzero(hit)[1]])
        return np.concatenate(out) if out else np.zeros(0, np.float32), matched[a, b].astype(np.int64)

    def _solved(self, scans: Spectra, refs: References, which: np.ndarray, of: np.ndarray, found: Found) -> None:
        """All pairs of these scans and references, peak by peak."""
        for k in range(0, len(which) * len(of), SOLVED):
            pair = np.arange(k, min(k + SOLVED, len(which) * len(of)))
            s, t = which[pair // len(of)], of[pair % len(of)]
            ok = self.candidates(scans.at[s], refs.at[t])
            s, t = s[ok], t[ok]
            if not len(s):
                continue
            n, q, r = len(s), scans.only(s), refs.only(t)
            a, b = near(q, r, self.tolerance)
            pairs = np.bincount(q.of[a], minlength=n)
            w = q.i[a].astype(float) * r.i[b].astype(float)
            chosen = assigned(q, r, a, b, w)
            matched = np.bincount(q.of[a[chosen]], minlength=n)
            some = matched > 0
            score = np.zeros(n)
            score[some] = _score(np.bincount(q.of[a[chosen]], w[chosen], n)[some], scans.norm[s][some], refs.norm[t][some])
            good = self.passed(score, matched)
            mz = size = None
            if self.fragments:
                # peaks of one m/z match together
                green = np.isin(q.node, q.node[a[chosen]]) & good[q.of]
                mz, size = q.mz[green], np.bincount(q.of[green], minlength=n)[good]
            found.add(s[good], t[good], score[good], matched[good], pairs[good], mz, size)


def answered(batches: Iterator[pa.RecordBatch], question: Question) -> Iterator[pa.RecordBatch]:
    """The answers for the cells of a partition, whose rows stand by (inchi_key, group, shard, side, ref_id); references come before
    the scans of their cell (side 0 and 1), so that they alone are held."""
    cell, waiting, refs = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for c in ("inchi_key", "group", "shard", "side"):
            new[1:] |= pc.not_equal(batch[c][1:], batch[c][:-1]).to_numpy(zero_copy_only=False).astype(bool)
        begin = np.flatnonzero(new)
        for low, high in zip(begin, np.append(begin[1:], batch.num_rows)):
            part = batch.slice(low, high - low)
            key = tuple(part[c][0].as_py() for c in ("inchi_key", "group", "shard"))
            if key != cell:
                cell, waiting, refs = key, [], None
            if part["side"][0].as_py() == 0:
                waiting.append(part)
            elif waiting or refs is not None:
                if refs is None:
                    refs, waiting = References(pa.Table.from_batches(waiting), question.tolerance), []
                yield from question.answers(pa.Table.from_batches([part]), refs)
