"""Periodic run detection over multi-scale minimizers.

A run is a stretch of words with smallest period q, at least max(12, 2q) long, that neither
neighbouring word extends.  Texts of a batch are laid one after another with a separator between
them that equals nothing, and are searched together:

* Periods below ``SHORT`` by direct lag scans: words equal to the word q later, in stretches.
* Larger ones scale by scale, [K, 2K) each.  Words in stretches of k = K/4 are hashed, and the
  minima of windows of K words are kept.  A run of period q >= K holds its first window twice, q
  apart, so a minimum repeats at distance q: pairs of equal minima at such distances are the seeds,
  and seeds extend to runs.
* A stretch of k words that lies in a run of period k/2 or less (all of them known by then) is no
  minimum, so equal minima are over k/2 apart and have few partners.  Where all of a window lies in
  such a short run, larger runs start only near that run's end; there words at multiples of each
  lag are compared with the word one lag on, which meets every run of that lag.

No step compares all pairs of positions; the work grows as n log n.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegrid.llm.common import NOT_SPACE, hashed_runs, map_texts, mix64

SHORT = 48
LEAST = 12
_ODD = np.uint64(0x9E3779B97F4A7C15)


def stretches(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the runs of True."""
    padded = np.zeros(len(marked) + 2, bool)
    padded[1:-1] = marked
    change = np.flatnonzero(padded[1:] != padded[:-1])
    return change[::2], change[1::2]


def window_extreme(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of every ``width`` neighbours, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = best(out[:len(out) - step], out[step:])
        have += step
    return out


def _shorter_period(words: np.ndarray, start: int, stop: int, q: int) -> bool:
    """Whether words[start:stop], of period q and 2q or longer, has a smaller period: a divisor."""
    left, prime = q, 2
    while left > 1:
        if prime * prime > left:
            prime = left
        if left % prime == 0:
            p = q // prime
            # the first period decides for all of the stretch
            if np.array_equal(words[start:start + q - p], words[start + p:start + q]) \
                    and np.array_equal(words[start:start + p], words[start + q - p:start + q]):
                return True
            while left % prime == 0:
                left //= prime
        prime += 1
    return False


def _extend(words: np.ndarray, at: int, q: int) -> tuple[int, int]:
    """The stretch of i around ``at`` with words[i] == words[i + q], found in growing steps."""
    stop, n, step = at, len(words) - q, 64
    while stop < n:
        far = min(n, stop + step)
        differ = np.flatnonzero(words[stop:far] != words[stop + q:far + q])
        if len(differ):
            stop += int(differ[0])
            break
        stop, step = far, step * 2
    start, step = at, 64
    while start > 0:
        near = max(0, start - step)
        differ = np.flatnonzero(words[near:start] != words[near + q:start + q])
        if len(differ):
            start = near + int(differ[-1]) + 1
            break
        start, step = near, step * 2
    return start, stop


class _Finder:
    """Runs of one array of word hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.runs: list[tuple[int, int, int]] = []
        self.last: dict[int, int] = {}

    def take(self, start: int, stop: int, q: int) -> None:
        """Keeps the stretch of equal words at lag q, [start, stop), if it makes a run."""
        if stop - start + q >= max(LEAST, 2 * q) and not _shorter_period(
                self.words, start, stop + q, q):
            self.runs.append((start, stop + q, q))

    def scan(self, q: int) -> None:
        if len(self.words) <= q:
            return
        start, stop = stretches(self.words[:-q] == self.words[q:])
        long = stop - start >= max(LEAST - q, q)
        for s, e in zip(start[long].tolist(), stop[long].tolist()):
            self.take(s, e, q)

    def seed(self, at: int, q: int) -> None:
        if at < self.last.get(q, 0):
            return
        start, stop = _extend(self.words, at, q)
        if stop > start:
            self.last[q] = stop
            self.take(start, stop, q)

    def scale(self, low: int, total: np.ndarray, power: np.ndarray, top: int) -> None:
        """Runs of periods in [low, 2 * low), ``top`` at most."""
        words, n = self.words, len(self.words)
        k, width = low // 4, low - low // 4 + 1
        if n < 2 * low:
            return
        grams = (total[k:] - total[:-k]) * power[:n + 1 - k]
        grams = mix64(grams) >> np.uint64(1)
        # stretches inside a known short run are no minima
        known = len(self.runs)
        covered = np.zeros(len(grams) + 1, np.int32)
        for s, e, p in self.runs:
            if 2 * p <= k and e - s >= k:
                covered[s] += 1
                covered[e - k + 1] -= 1
        inside = np.cumsum(covered[:-1]) > 0
        none = np.uint64(2 ** 64 - 1)
        grams[inside] = none
        least = window_extreme(grams, width, np.minimum)
        padded = np.zeros(len(grams) + width - 1, np.uint64)
        padded[width - 1:width - 1 + len(least)] = np.where(least == none, 0, least)
        chosen = np.flatnonzero(window_extreme(padded, width, np.maximum) == grams)
        value = grams[chosen]
        order = np.lexsort((chosen, value))
        chosen, value = chosen[order], value[order]
        step, found = 1, []
        while step < len(chosen):
            gap = chosen[step:] - chosen[:-step]
            near = (value[step:] == value[:-step]) & (gap < 2 * low)
            if not near.any():
                break
            good = near & (gap >= low) & (gap <= top)
            found.append((chosen[:-step][good], gap[good]))
            step += 1
        # windows that lie wholly in one short run: larger runs start only near its end
        short = sorted((s, e, p) for s, e, p in self.runs[:known] if 2 * p <= k and e - s >= low)
        begin, end, period = (np.array(x, np.int64) for x in zip(*short)) if short else [()] * 3
        for stop in set(np.asarray(end).tolist()):
            lo, hi = max(0, stop - k - 2 * low), min(n, stop + 3 * low)
            lags = np.arange(low, min(2 * low, top + 1, max(low, hi - lo)))
            first = -(-lo // lags)
            count = np.maximum((hi - 1 - lags) // lags - first + 1, 0)
            lag = np.repeat(lags, count)
            turn = np.arange(len(lag)) - np.repeat(np.cumsum(count) - count, count)
            at = (np.repeat(first, count) + turn) * lag
            same = words[at] == words[at + lag]
            at, lag = at[same], lag[same]
            # what repeats inside a short run itself is that run again
            for back in (1, 2):
                i = np.maximum(np.searchsorted(begin, at, "right") - back, 0)
                own = (begin[i] <= at) & (at + lag < end[i]) & (lag % period[i] == 0)
                at, lag = at[~own], lag[~own]
            found.append((at, lag))
        if found:
            self._seeds(*(np.concatenate(x) for x in zip(*found)), low // 2, total, power)
        self.last.clear()

    def _seeds(self, at: np.ndarray, lag: np.ndarray, half: int, total: np.ndarray,
               power: np.ndarray) -> None:
        """Extends seeds that agree over ``half`` words on one side: a run's stretch is longer."""
        n = len(self.words)

        def agree(start: np.ndarray) -> np.ndarray:
            ok = (start >= 0) & (start + lag + half <= n)
            s = np.where(ok, start, 0)
            t = np.where(ok, start + lag, 0)
            return ok & ((total[np.minimum(s + half, n)] - total[s]) * power[s]
                         == (total[np.minimum(t + half, n)] - total[t]) * power[t])

        good = agree(at) | agree(at - half)
        for q, i in sorted(set(zip(lag[good].tolist(), at[good].tolist()))):
            self.seed(i, q)


def find_runs(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """All runs (start, stop, period) of an array of 64-bit values, by start, then period.

    ``longest`` bounds how long a run can be where the values are several texts in a row.
    """
    finder = _Finder(words)
    top = (len(words) if longest is None else longest) // 2
    for q in range(1, min(SHORT, top + 1)):
        finder.scan(q)
    if top >= SHORT:
        n = len(words)
        power = np.full(n + 1, _ODD)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        back = np.full(n + 1, np.uint64(pow(int(_ODD), -1, 1 << 64)))
        back[0] = 1
        back = np.cumprod(back, dtype=np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64),
                                np.cumsum(words * power[:n], dtype=np.uint64)])
        low = SHORT
        while low <= top:
            finder.scale(low, total, back, top)
            low *= 2
    return sorted(set(finder.runs), key=lambda r: (r[0], r[2]))


def find_runs_of_texts(hashes: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several texts, whose word hashes follow on from each other.

    Texts are put together with a separator after each.  Every scale takes only texts that are
    long enough for it; they are searched in one array.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    starts = np.cumsum(sizes) - sizes
    # texts of like length go together, so that long ones alone pay for large scales
    level = np.where(sizes < LEAST, -1, np.ceil(np.log2(np.maximum(sizes, 96) / 96)).astype(int))
    for lev in np.unique(level[level >= 0]):
        rows = np.flatnonzero(level == lev)
        length = sizes[rows] + 1
        at = np.cumsum(length) - length
        values = np.empty(int(length.sum()), np.uint64)
        for r, a, s in zip(rows.tolist(), at.tolist(), sizes[rows].tolist()):
            values[a:a + s] = hashes[starts[r]:starts[r] + s]
            values[a + s] = mix64(np.array([r], np.uint64) + np.uint64(1 << 63))[0]
        for s, e, q in find_runs(values, int(sizes[rows].max())):
            i = int(np.searchsorted(at, s, "right")) - 1
            out[rows[i]].append((s - int(at[i]), e - int(at[i]), q))
    return out


def repeats_planted(key: str, n: int) -> np.ndarray | None:
    """Which original word each word of a damaged document is, or None if it is left alone."""
    h = zlib.crc32(key.encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, " \
    "runs_sha256 string, collapsed_sha256 string"
FULL = FIELDS + ", runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, key: str | None = None, text: str = "text",
                  full: bool = False) -> DataFrame:
    """``docs`` with its periodic runs: FIELDS, and with ``full`` the runs and the collapsed text.

    Words are runs without white space; null, empty and blank texts have none, so no run, null
    ``start``, ``length``, ``period`` and ``exponent_milli``, and digests of nothing.  The run
    shown is the longest one (ties: smallest start, then period).  A word goes from the collapsed
    text if a run holds it after the run's first period.  Texts are taken whole, however long.
    Words are told apart by 64-bit hashes.  With ``key``, some texts are given repeats first
    (:func:`repeats_planted`; a null key's text is left alone).  Repeated rows are
    rows like any others, an empty table stays empty, and columns called like new ones are
    replaced.
    """
    fields = FULL if full else FIELDS

    def digest(x: bytes) -> str:
        return hashlib.sha256(x).hexdigest()

    def work(keys: list | None, texts: list) -> dict:
        raw = [(t or "").encode() for t in texts]
        split = [r.split() for r in raw]
        sizes = np.array([len(s) for s in split], np.int64)
        hashes, _ = hashed_runs(texts, NOT_SPACE, lower=False)
        starts = np.cumsum(sizes) - sizes
        if keys is not None:
            for i, k in enumerate(keys):
                source = None if k is None else repeats_planted(str(k), len(split[i]))
                if source is not None:
                    part = slice(starts[i], starts[i] + sizes[i])
                    hashes[part] = hashes[part][source]
                    split[i] = [split[i][j] for j in source.tolist()]
        found = find_runs_of_texts(hashes, sizes)
        columns: dict[str, list] = {n: [] for n in (
            "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
            "collapsed_sha256", "runs", "collapsed")}
        for words, runs in zip(split, found):
            kept = words
            if runs:
                drop = np.zeros(len(words) + 1, np.int32)
                for s, e, q in runs:
                    drop[s + q] += 1
                    drop[e] -= 1
                stay = np.cumsum(drop[:-1]) == 0
                kept = [words[i] for i in np.flatnonzero(stay).tolist()]
                s, e, q = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]))
                facts = (s, e - s, q, 1000 * (e - s) // q)
            else:
                facts = (None,) * 4
            for name, value in zip(("start", "length", "period", "exponent_milli"), facts):
                columns[name].append(value)
            columns["n_runs"].append(len(runs))
            columns["runs_sha256"].append(digest(
                b"".join(b"%d,%d,%d\n" % (s, e - s, q) for s, e, q in runs)))
            joined = b" ".join(kept)
            columns["collapsed_sha256"].append(digest(joined))
            if full:
                columns["runs"].append([{"start": s, "length": e - s, "period": q}
                                        for s, e, q in runs])
                columns["collapsed"].append(joined.decode())
        kinds = {n: pa.int64() for n in ("n_runs", "start", "length", "period", "exponent_milli")}
        if full:
            one = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
            kinds["runs"] = pa.list_(one)
        return {n: pa.array(columns[n], kinds.get(n, pa.string())) for n in columns
                if full or n not in ("runs", "collapsed")}

    return map_texts(docs, text, fields, lambda: work, key)
