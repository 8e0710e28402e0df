"""Periodic runs of words, found by string synchronising sets.

A run is a maximal stretch with smallest period ``q`` and at least two periods long.  Periods
below ``BASE`` are found by comparing the text with itself moved by ``q``.  For every dyadic
``tau`` the synchronising set supplies periods from ``3 tau`` to ``6 tau``: a position belongs to
it if, among the next ``tau + 1`` windows of ``tau`` words that don't lie in a highly periodic
region (period at most ``tau / 3``), the smallest hash is at the first or the last place.
Membership depends on the ``2 tau`` words from the position only, so in a run it repeats with the
period, and two positions with equal contexts at a distance ``q`` propose the period ``q``.
If no position of a run's first period is in the set, that period lies in a highly periodic region:
the run then spans two regions of one period that touch, and the regions propose it.

Proposals are extended to both sides by hashes of stretches and then compared word by word.
The work is ``n log n`` for ``n`` words; many documents are handled as one array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = 12
MIN_LENGTH = 12
BATCH_WORDS = 1 << 19
PRIMES = (2147483629, 2147483587)
MULTIPLIERS = (1103515245, 1664525)
RUNS = "array<struct<start:long,length:long,period:long>>"


class Stretches:
    """Hashes of stretches of an array of small integers."""

    def __init__(self, words: np.ndarray):
        self.words, n = words, len(words)
        self.sums, self.powers = [], []
        for prime, base in zip(PRIMES, MULTIPLIERS):
            power, have = np.ones(n + 1, np.int64), 1
            step = base
            while have <= n:
                more = min(have, n + 1 - have)
                power[have : have + more] = power[:more] * step % prime
                step, have = step * step % prime, have + more
            mixed = (words.astype(np.int64) + 1) * 0x9E3779B1 % prime
            self.sums.append(np.concatenate([[0], np.cumsum(mixed * power[:n] % prime)]))
            self.powers.append(power)

    def _raw(self, h: int, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[h][at + length] - self.sums[h][at]) % PRIMES[h]

    def windows(self, at: np.ndarray, length: int) -> np.ndarray:
        """One number per stretch ``[at, at + length)``, the same for equal stretches."""
        n = len(self.words)
        a, b = (self._raw(h, at, length) * self.powers[h][n - at] % PRIMES[h] for h in (0, 1))
        return a << 31 | b

    def equal(self, one: np.ndarray, two: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Whether the stretches at ``one <= two`` look equal."""
        same = np.ones(len(one), bool)
        for h in (0, 1):
            same &= self._raw(h, one, length) * self.powers[h][two - one] % PRIMES[h] == self._raw(h, two, length)
        return same

    def after(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Number of equal words from ``one`` and ``two`` (``one < two``) on."""
        return self._grow(one, two, len(self.words) - two, lambda length: (one, two, length))

    def before(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Number of equal words before ``one`` and ``two``."""
        return self._grow(one, two, one, lambda length: (one - length, two - length, length))

    def _grow(self, one: np.ndarray, two: np.ndarray, most: np.ndarray, stretch) -> np.ndarray:
        low, high = np.zeros(len(one), np.int64), most.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self.equal(*stretch(middle))
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _stretches_of(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of every stretch of true values."""
    edges = np.flatnonzero(np.diff(same, prepend=False, append=False))
    return edges[::2], edges[1::2]


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Rows ``start, end, period``, one per stretch: that of the smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[new]


def _base(words: np.ndarray) -> np.ndarray:
    """All runs with a period below ``BASE``."""
    found = [np.empty((0, 3), np.int64)]
    for q in range(1, min(BASE, len(words))):
        a, b = _stretches_of(words[q:] == words[:-q])
        long = b - a >= q
        found.append(np.stack([a[long], b[long] + q, np.full(int(long.sum()), q)], axis=1))
    return _smallest(np.concatenate(found))


def _synchronising(hashes: Stretches, runs: np.ndarray, tau: int) -> np.ndarray:
    """Positions of the synchronising set of ``tau``, ascending."""
    n = len(hashes.words)
    last = n - 2 * tau + 1
    if last <= 0:
        return np.empty(0, np.int64)
    at = np.arange(n - tau + 1)
    ids = hashes.windows(at, tau).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ids = (ids ^ (ids >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(1)
    none = np.uint64(2**64 - 1)
    regions = runs[(runs[:, 2] <= tau // 3) & (runs[:, 1] - runs[:, 0] >= tau)]
    inside = np.zeros(n + 2, np.int64)
    np.add.at(inside, regions[:, 0], 1)
    np.add.at(inside, regions[:, 1] - tau + 1, -1)
    ids[np.cumsum(inside)[: len(ids)] > 0] = none
    low, width = ids, 1
    while width < tau:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    low = np.minimum(low[:last], low[1 : last + 1])
    return np.flatnonzero((low != none) & ((ids[:last] == low) | (ids[tau : tau + last] == low)))


def _pairs(hashes: Stretches, at: np.ndarray, tau: int) -> np.ndarray:
    """``position, distance`` of set members with equal contexts at distances from ``3 tau`` to ``6 tau``, one per stretch."""
    context = hashes.windows(at, 2 * tau)
    order = np.lexsort((at, context))
    at, context = at[order], context[order]
    found, d = [np.empty((0, 2), np.int64)], 1
    while d < len(at):
        same = context[d:] == context[:-d]
        far = at[d:] - at[:-d]
        near = same & (far < 6 * tau)
        if not near.any():
            break
        ok = np.flatnonzero(near & (far >= 3 * tau))
        found.append(np.stack([at[ok], far[ok]], axis=1))
        d += 1
    pairs = np.concatenate(found)
    pairs = pairs[np.lexsort((pairs[:, 0], pairs[:, 1]))]
    first = np.ones(len(pairs), bool)
    first[1:] = (pairs[1:, 1] != pairs[:-1, 1]) | (pairs[1:, 0] - pairs[:-1, 0] > 2 * tau)
    return pairs[first]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts per row: the row of every item, and its number in the row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _junctions(hashes: Stretches, runs: np.ndarray, tau: int) -> np.ndarray:
    """``position, distance`` that touching highly periodic regions of one period propose."""
    regions = runs[(runs[:, 2] <= tau // 3) & (runs[:, 1] - runs[:, 0] >= 3 * tau)]
    regions = regions[np.lexsort((regions[:, 0], regions[:, 2]))]
    one, two = regions[:-1], regions[1:]
    touch = (one[:, 2] == two[:, 2]) & (one[:, 1] >= two[:, 0])
    one, two = one[touch], two[touch]
    if not len(one):
        return np.empty((0, 2), np.int64)
    # The place in the first region's first period at which the second region's first period stands.
    row, shift = _spread(one[:, 2])
    here, there = one[row, 0] + shift, two[row, 0]
    fits = hashes.equal(np.minimum(here, there), np.maximum(here, there), one[row, 2])
    row, here = row[fits], here[fits]
    p, r2 = one[row, 2], two[row, 0]
    most = np.minimum(np.minimum(one[row, 1] - one[row, 0], two[row, 1] - r2), 6 * tau - 1)
    # All distances of that phase from 3 tau on.
    phase = (r2 - here) % p
    least = 3 * tau + (phase - 3 * tau) % p
    again, k = _spread(np.maximum(0, (most - least) // p + 1))
    q = least[again] + k * p[again]
    return np.stack([np.maximum(one[row, 0][again], r2[again] - q), q], axis=1)


def _extended(hashes: Stretches, pairs: np.ndarray) -> np.ndarray:
    """Runs through the proposals, each compared word by word."""
    at, q = pairs[:, 0], pairs[:, 1]
    a, b = at - hashes.before(at, at + q), at + hashes.after(at, at + q)
    long = b - a >= q
    runs = np.unique(np.stack([a[long], b[long] + q[long], q[long]], axis=1), axis=0)
    words, exact = hashes.words, []
    for start, end, period in runs.tolist():
        same = words[start : end - period] == words[start + period : end]
        if same.all():
            exact.append((start, end, period))
        else:  # two hashes collided: take the stretches as they are
            exact += [(start + x, start + y + period, period) for x, y in zip(*_stretches_of(same)) if y - x >= period]
    return np.array(exact, np.int64).reshape(-1, 3)


def runs_of(words: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Every run of an array of integers: rows ``start, end, smallest period``, by start and period.

    ``longest`` bounds the length of a run, if it is known.
    """
    words = np.asarray(words, np.int64)
    longest = len(words) if longest is None else longest
    found = _base(words)
    hashes, tau = None, BASE // 3
    while 6 * tau <= longest:
        hashes = hashes or Stretches(words)
        proposed = np.concatenate([_pairs(hashes, _synchronising(hashes, found, tau), tau), _junctions(hashes, found, tau)])
        if len(proposed):
            found = _smallest(np.concatenate([found, _extended(hashes, proposed)]))
        tau *= 2
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of_many(texts: list[np.ndarray]) -> list[np.ndarray]:
    """``runs_of`` every array, in few passes: arrays are put one after another with a number of its own after each."""
    out: list[np.ndarray] = [np.empty((0, 3), np.int64)] * len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    # Longer texts need more scales, so texts of like length go together.
    for which in _alike(lengths):
        parts, top = [], max(int(texts[i].max(initial=0)) for i in which) + 1
        for k, i in enumerate(which):
            parts += [texts[i], [top + k]]
        starts = np.cumsum(lengths[which] + 1) - lengths[which] - 1
        found = runs_of(np.concatenate(parts), int(lengths[which].max()))
        owner = np.searchsorted(starts, found[:, 0], "right") - 1
        found[:, :2] -= starts[owner][:, None]
        cuts = np.searchsorted(owner, np.arange(len(which) + 1))
        for k, i in enumerate(which):
            out[i] = found[cuts[k] : cuts[k + 1]]
    return out


def _alike(lengths: np.ndarray) -> Iterator[list[int]]:
    held, words = [], 0
    for i in np.argsort(lengths, kind="stable").tolist():
        if held and (words + lengths[i] > BATCH_WORDS or lengths[i] > 4 * lengths[held[0]] + 64):
            yield held
            held, words = [], 0
        held.append(i)
        words += int(lengths[i])
    if held:
        yield held


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, without those that a run contains after its first period."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document.

    ``runs`` lists ``start, length, period`` (in words, by start and period) of every run of at least
    ``min_length`` words and two periods; ``collapsed`` is the text without the words that a run repeats,
    joined by spaces.  A null or empty text, or one of white space, has no runs and an empty ``collapsed``.
    Every row is a document of its own, also with repeated or null ids; an empty table gives an empty
    result; other columns aren't read.  A text is handled whole by one task, in memory that grows with it.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            at = 0
            while at < batch.num_rows:
                words, n, first = [], 0, at
                while at < batch.num_rows and (not words or n < BATCH_WORDS):
                    words.append((texts[at].as_py() or b"").split())
                    n += len(words[-1])
                    at += 1
                yield block(ids.slice(first, at - first), words)

    def block(ids: pa.Array, words: list[list[bytes]]) -> pa.RecordBatch:
        lengths = np.array([len(w) for w in words], np.int64)
        flat = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        found = runs_of_many(np.split(flat.astype(np.int64), np.cumsum(lengths)[:-1]))
        found = [r[r[:, 1] - r[:, 0] >= min_length] for r in found]
        rows = np.concatenate(found)
        runs = pa.StructArray.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1] - rows[:, 0]), pa.array(rows[:, 2])], ["start", "length", "period"])
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(r) for r in found]), pa.int32()), runs)
        collapsed = pa.array([collapse(w, r) for w, r in zip(words, found)], pa.binary()).view(pa.string())
        return pa.RecordBatch.from_arrays([ids, pa.array(lengths), lists, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(find, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
