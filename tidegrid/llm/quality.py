"""Quality rules: compression bands.

Repetitive text compresses far better than prose, noise far worse.  The zstandard ratio of the
whole document, and of each chunk of it (4096 bytes, the last one up to twice that), is held
against a band for its length, as short texts compress less.  The bands are fitted to the corpus: how
all its texts of like length compress, each distinct size counted once, gives a middle and a spread,
and what lies far from them goes.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import SPACE, chunks, map_texts

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CHUNK = 4096
LEVEL = 3
# At most this share of the chunks may lie outside their band.
CHUNK_SHARE = 1 / 3


class Band(NamedTuple):
    """Limits of bytes / compressed bytes for texts of up to ``size`` bytes."""
    size: float
    low: float
    high: float


# The widest limits.  Prose of languages in Latin script lies at 1.3 to 1.9 below 1 KB and 1.9 to
# 3.5 beyond; random base64 at 1.3, repeated boilerplate above 5.  Short texts carry the frame's header.
BANDS = (Band(256, 0.7, 4.0), Band(1024, 1.05, 4.5), Band(8192, 1.2, 5.0),
         Band(65_536, 1.3, 6.0), Band(float("inf"), 1.35, 7.0))
# Fitted limits: four classes of length for each doubling; a ratio may be so many spreads away from
# the middle of its class; the spread is at least that share of the middle; classes with fewer
# distinct sizes keep the widest limits.
PER_DOUBLING = 4
SPREADS = 5.0
LEAST_SPREAD = 0.02
LEAST_TEXTS = 100
BIN = 0.005

FIELDS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, kept boolean")


def band_of(size: int, bands=BANDS) -> Band:
    return next(b for b in bands if size <= b.size)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, first occurrences included."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    v = len(numbers)
    if v < 2_000_000:
        window = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:  # three numbers no longer fit in 63 bits: number the pairs first
        window = np.unique(ids[:-2] * v + ids[1:-1], return_inverse=True)[1] * v + ids[2:]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def chunked(raw: bytes) -> list[bytes]:
    """Chunks of a text longer than one; what is left over belongs to the last.

    A few bytes on their own are mostly frame and would lie below every band.
    """
    starts = range(0, len(raw) - CHUNK + 1, CHUNK) if len(raw) > CHUNK else []
    return [raw[i:i + CHUNK if i + 2 * CHUNK <= len(raw) else None] for i in starts]


def fails(n: int, repeats: int) -> bool:
    return n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n


def base_failed(raw: bytes) -> bool:
    """Whether the base rules alone reject a text."""
    words = raw.split()
    return fails(len(words), 0) or fails(len(words), repeated_words(words))


def measure(text: str | None, pack: zstandard.ZstdCompressor, bands=BANDS) -> tuple:
    """The values of ``FIELDS`` for one text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    # white space is ASCII: code points of the text, less those of white space
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACE)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    repeats = repeated_words(words)
    failed = fails(n, repeats)
    ratio = len(raw) / len(pack.compress(raw))
    band = band_of(len(raw), bands)
    pieces = chunked(raw)
    bad = 0
    for piece in pieces:
        limits = band_of(len(piece), bands)
        bad += not limits.low <= len(piece) / len(pack.compress(piece)) <= limits.high
    kept = not failed and band.low <= ratio <= band.high and bad <= CHUNK_SHARE * len(pieces)
    return (n, chars, symbols, duplicate_lines(raw), repeats, failed, ratio, len(pieces), bad, kept)


def length_class(size: int) -> int:
    return math.ceil(PER_DOUBLING * math.log2(max(size, 1)))


def fit_bands(docs: DataFrame, text: str = "text") -> tuple[Band, ...]:
    """Bands from all texts that pass the base rules, by a histogram of their ratios.

    Copies and texts of equal size that compress equally count once, so that a group of them does
    not set the limits.  A class takes the widest limits among itself and its two neighbours, and
    never wider ones than ``BANDS``.  What reaches the driver is the histogram: at most some 700
    steps of each of some 100 classes.
    """
    def sizes(batches):
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for _, _, texts in chunks(batch.column(0)):
                raw = [r for r in ((t or "").encode() for t in texts) if not base_failed(r)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(r) for r in raw], pa.int64()),
                     pa.array([len(pack.compress(r)) for r in raw], pa.int64()),
                     pa.array([length_class(len(r)) for r in raw], pa.int64())],
                    names=["size", "packed", "class"])

    pairs = docs.select(text).mapInArrow(sizes, "size long, packed long, class long").distinct()
    step = F.floor(F.col("size") / F.col("packed") / BIN).alias("step")
    counted = pairs.groupBy("class", step).agg(F.count(F.lit(1)).alias("n")).collect()
    classes: dict[int, list] = {}
    for r in counted:
        classes.setdefault(r["class"], []).append((r.step * BIN + BIN / 2, r.n))
    limits = {}
    for c, steps in classes.items():
        if sum(n for _, n in steps) >= LEAST_TEXTS:
            middle = _weighted_median(steps)
            spread = 1.4826 * _weighted_median([(abs(x - middle), n) for x, n in steps])
            width = SPREADS * max(spread, LEAST_SPREAD * middle)
            limits[c] = middle - width, middle + width
    bands = []
    last = length_class(1 << 40)
    for c in range(last + 1):
        size = 2 ** (c / PER_DOUBLING)
        widest = band_of(size)
        low, high = widest.low, widest.high
        if c in limits:
            near = [limits[i] for i in (c - 1, c, c + 1) if i in limits]
            low, high = max(low, min(x for x, _ in near)), min(high, max(x for _, x in near))
        bands.append(Band(size, low, high))
    return (*bands, BANDS[-1])


def _weighted_median(steps: list[tuple[float, int]]) -> float:
    half, seen = sum(n for _, n in steps) / 2, 0
    for x, n in sorted(steps):
        seen += n
        if seen >= half:
            return x
    raise ValueError("no values")


def compression_bands(docs: DataFrame, text: str = "text", bands=None) -> DataFrame:
    """``docs`` with the columns of ``FIELDS``; input columns of those names are replaced.

    ``base_failed``: fewer than 50 words, or over half of them in repeated 3-word windows.
    ``kept``: not that, the whole text's ratio within its band, and at most a third of its
    chunks outside theirs.  Null, empty and blank texts have no words, fail and have ratio 0.
    ``bands`` are fitted to ``docs`` unless given.  Given bands, rows are judged alone, so copies
    fare alike; an empty table stays empty, and long texts are measured whole.
    """
    bands = fit_bands(docs, text) if bands is None else bands
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def make():
        pack = zstandard.ZstdCompressor(level=LEVEL)

        def work(texts: list) -> dict:
            rows = [measure(t, pack, bands) for t in texts]
            return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}
        return work
    return map_texts(docs, text, FIELDS, make)
