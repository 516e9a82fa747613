"""Language ID: segmentation-marginalised unigrams.

Each language has its own probabilities over the pieces of one public vocabulary.  The
probability of a word is the sum over all its segmentations into pieces and single bytes, by a
forward pass over a lattice of trie matches; a text's log probability is the sum over its words.
Probabilities are learnt by expectation maximisation over the same lattice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import map_texts, slice_of
from tidegrid.llm.packing import public_path
from tidegrid.llm.pieces import MARK, Lattice, Vocabulary

MAX_SAMPLE = 1000
ROUNDS = 4
SMOOTHING = 0.1
# Longer words are summed as logarithms: their probabilities leave the range of floats.
LONG = 40
LATTICE_BYTES = 500_000
UNKNOWN = "und"
MAX_LANGUAGES = 400


class Marginal:
    """The lattice of words over one vocabulary, bytes included at every position."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.size = len(self.vocabulary.pieces)

    def lattice(self, words: list[bytes]) -> Lattice:
        def single(data, room, start, length):
            at = np.flatnonzero(room > 0)
            yield at, np.ones(len(at), np.int64), self.vocabulary.byte_ids[data[at]]
        return Lattice(words, self.vocabulary.trie, single)

    @staticmethod
    def forward(lattice: Lattice, p: np.ndarray) -> np.ndarray:
        """Sums of path probabilities to every node, for each row of piece probabilities."""
        alpha = np.zeros((lattice.nodes, p.shape[1]))
        alpha[lattice.first] = 1
        weight = p[lattice.piece]
        for lo, hi, heads in lattice.runs():
            alpha[lattice.end[heads]] = np.add.reduceat(
                alpha[lattice.start[lo:hi]] * weight[lo:hi], heads - lo, axis=0)
        return alpha

    @staticmethod
    def log_forward(lattice: Lattice, p: np.ndarray) -> np.ndarray:
        """Logarithms of :meth:`forward`, for words of any length."""
        alpha = np.full((lattice.nodes, p.shape[1]), -np.inf)
        alpha[lattice.first] = 0
        weight = np.log(p)[lattice.piece]
        for lo, hi, heads in lattice.runs():
            each = alpha[lattice.start[lo:hi]] + weight[lo:hi]
            most = np.maximum.reduceat(each, heads - lo, axis=0)
            size = np.diff(np.append(heads, hi))
            total = np.add.reduceat(np.exp(each - np.repeat(most, size, axis=0)), heads - lo, axis=0)
            alpha[lattice.end[heads]] = most + np.log(total)
        return alpha

    def log_p(self, words: list[bytes], p: np.ndarray) -> np.ndarray:
        """Log probability of each word under each column of ``p``: all its segmentations."""
        out = np.zeros((len(words), p.shape[1]))
        for rows, some, long in batches(words):
            lattice = self.lattice(some)
            out[rows] = self.log_forward(lattice, p)[lattice.last] if long else \
                np.log(self.forward(lattice, p)[lattice.last])
        return out

    def learn(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Piece probabilities that expectation maximisation finds for counted words."""
        p = np.full((self.size, 1), 1 / self.size)
        for _ in range(ROUNDS):
            expected = np.zeros(self.size)
            for rows, some, long in batches(words):
                expected += (self._expected_logs if long else self._expected)(some, counts[rows], p)
            expected += SMOOTHING
            p = (expected / expected.sum())[:, None]
        return p[:, 0]

    def _expected(self, words, counts, p) -> np.ndarray:
        lattice = self.lattice(words)
        alpha = self.forward(lattice, p)[:, 0]
        beta = np.zeros(lattice.nodes)
        beta[lattice.last] = 1
        weight = p[lattice.piece, 0]
        # backwards, all edges of a step end equally far, so their starts differ in distance:
        # sums into starts are plain additions
        for lo, hi, _ in reversed(list(lattice.runs())):
            np.add.at(beta, lattice.start[lo:hi], beta[lattice.end[lo:hi]] * weight[lo:hi])
        owner = np.searchsorted(lattice.first, lattice.start, "right") - 1
        share = alpha[lattice.start] * weight * beta[lattice.end] / alpha[lattice.last][owner]
        return np.bincount(lattice.piece, share * counts[owner], self.size)

    def _expected_logs(self, words, counts, p) -> np.ndarray:
        lattice = self.lattice(words)
        alpha = self.log_forward(lattice, p)[:, 0]
        beta = np.full(lattice.nodes, -np.inf)
        beta[lattice.last] = 0
        weight = np.log(p[lattice.piece, 0])
        for lo, hi, _ in reversed(list(lattice.runs())):
            np.logaddexp.at(beta, lattice.start[lo:hi], beta[lattice.end[lo:hi]] + weight[lo:hi])
        owner = np.searchsorted(lattice.first, lattice.start, "right") - 1
        share = np.exp(alpha[lattice.start] + weight + beta[lattice.end] - alpha[lattice.last][owner])
        return np.bincount(lattice.piece, share * counts[owner], self.size)


def batches(words: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes], bool]]:
    """(places, words, whether long) in lattices of bounded size; a word is never cut."""
    sizes = np.array([len(w) for w in words], np.int64)
    for long in (False, True):
        places = np.flatnonzero((sizes > LONG) == long)
        ends = np.cumsum(sizes[places] + 1)
        lo = 0
        while lo < len(places):
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + LATTICE_BYTES, "right")))
            yield places[lo:hi], [words[i] for i in places[lo:hi].tolist()], long
            lo = hi


_MODELS: dict[str, Marginal] = {}


def marginal(path: str) -> Marginal:
    if path not in _MODELS:
        _MODELS[path] = Marginal(path)
    return _MODELS[path]


def marked_words(text: str) -> list[bytes]:
    """Lower-cased words with the mark before them, whole."""
    return [MARK + w for w in text.lower().encode().split()]


def numbered(texts: list) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the number of every word in all texts, and the text that it is in."""
    number: dict[bytes, int] = {}
    split = [marked_words(t or "") for t in texts]
    at = np.array([number.setdefault(w, len(number)) for s in split for w in s], np.int64)
    return list(number), at, np.repeat(np.arange(len(texts)), [len(s) for s in split])


def fit(docs: DataFrame, taught: Column, text: str = "text", lang: str = "lang",
        path: str | None = None, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(lang, p): piece probabilities, packed as 32-bit floats, of each non-null language.

    Learns from about ``max_sample`` texts a language among those that ``taught`` selects, or
    all if there are fewer: those whose hash is lowest, so the same on every run.  Equal texts
    are one, with a count.  One task learns each language.
    """
    path = path or public_path("piece_bpe_32k.model")
    known = docs.where(F.coalesce(taught, F.lit(False)) & F.col(lang).isNotNull()
                       & F.col(text).isNotNull())
    rows = known.groupBy(lang).count().collect()
    share = F.lit(0)
    for r in rows:  # one value for each language
        share = F.when(F.col("lang") == r[lang],
                       int((1 << 30) * min(1.0, max_sample / r["count"]))).otherwise(share)
    text_only = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sample = text_only.where(slice_of(text_only, 1 << 30) < share) \
        .groupBy(F.col("lang").cast("string").alias("lang"), "text").agg(F.count(F.lit(1)).alias("n"))

    def learn(group: pa.Table) -> pa.Table:
        words, at, owner = numbered(group.column("text").to_pylist())
        copies = group.column("n").to_numpy()[owner].astype(float)
        p = marginal(path).learn(words, np.bincount(at, copies, len(words)))
        return pa.table({"lang": pa.array([group.column("lang")[0].as_py()]),
                         "p": pa.array([p.astype("<f4").tobytes()], pa.binary())})

    return sample.groupBy("lang").applyInArrow(learn, "lang string, p binary")


def predict(docs: DataFrame, model: DataFrame, text: str = "text",
            path: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of that language (0 to 1).

    The score is the language's posterior under equal priors; of equal languages the first in
    alphabetical order is taken.  Texts that are null or have no letter are ``und`` with score
    0, and so is every text if no language was learnt.  Texts and words are scored whole, repeated
    rows alike; an empty table stays empty.  Input columns of these names are replaced.  The
    model, 128 KB a language, is broadcast; more than ``MAX_LANGUAGES`` are refused.
    """
    path = path or public_path("piece_bpe_32k.model")
    rows = sorted(model.collect(), key=lambda r: r["lang"])
    langs = [r["lang"] for r in rows]
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"{len(rows)} languages; the model is broadcast for {MAX_LANGUAGES} at most")
    shared = docs.sparkSession.sparkContext.broadcast([r["p"] for r in rows])

    def make():
        own = marginal(path)
        p = np.stack([np.frombuffer(x, "<f4") for x in shared.value], 1).astype(np.float64) \
            if langs else None

        def work(texts: list) -> dict:
            letters = [bool(t) and any(c.isalpha() for c in t) for t in texts]
            if p is None:
                return {"lang_pred": [UNKNOWN] * len(texts), "score": np.zeros(len(texts))}
            words, at, owner = numbered(texts)
            total = np.zeros((len(texts), len(langs)))
            if words:
                each = own.log_p(words, p)[at]
                for k in range(len(langs)):
                    total[:, k] = np.bincount(owner, each[:, k], len(texts))
            share = np.exp(total - total.max(1, keepdims=True))
            share /= share.sum(1, keepdims=True)
            best = share.argmax(1)
            return {"lang_pred": [langs[b] if x else UNKNOWN for b, x in zip(best, letters)],
                    "score": np.where(letters, share[np.arange(len(texts)), best], 0.0)}
        return work
    return map_texts(docs, text, "lang_pred string, score double", make)
