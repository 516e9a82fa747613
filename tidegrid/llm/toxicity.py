"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of letters and digits, A-Z lower-cased.  Features are words, pairs of
neighbours, and pairs with one or two words between, hashed to 2^22 numbers.  One task fits the
weights on a bounded sample of labelled rows; L1 leaves few of them, which are broadcast to
score every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import STEP, chunks, hashed_runs, map_texts, mix64

BITS = 22
MAX_SAMPLE = 10_000
GAPS = (1, 2, 3)
EPOCHS = 3
ALPHA, BETA, L1, L2 = 3.0, 1.0, 8.0, 0.1
POSITIVE_WEIGHT = 2.0

# Word bytes: ASCII digits and letters, and every byte beyond ASCII; others separate words.
_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def features(texts: list, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text) for every n-gram and skip-gram; repeats are not yet removed."""
    h, owner = hashed_runs(texts, _WORD)
    shift = np.uint64(64 - bits)
    found, where = [h >> shift], [owner]
    for gap in GAPS:
        same = owner[gap:] == owner[:-gap]
        pair = mix64(h[:-gap] * np.uint64(STEP) + h[gap:] + np.uint64(gap))
        found.append((pair >> shift)[same])
        where.append(owner[gap:][same])
    return np.concatenate(found).astype(np.int64), np.concatenate(where)


class Ftrl:
    """FTRL-proximal (McMahan et al., 2013) on rows of distinct binary features."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.bias = 1 << bits

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == self.bias, 0.0, L1)
        rate = (BETA + np.sqrt(self.n[at])) / ALPHA + L2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / rate)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, self.bias)
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = (p - label) * (POSITIVE_WEIGHT if label else 1.0)
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fit(taught: DataFrame, text: str, label: str) -> DataFrame:
    """(feature, weight) of the weights that are not zero; feature 2^22 is the bias.

    ``taught`` must be bounded: its features are packed where the texts are, and one task
    learns from them in the order of a hash, the same on every run.
    """
    known = taught.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"),
                          F.xxhash64(F.coalesce(text, F.lit(""))).alias("at"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, at = batch.column("label").to_pylist(), batch.column("at").to_pylist()
            for lo, hi, texts in chunks(batch.column("text")):
                found, owner = features(texts)
                both = np.unique(owner * (1 << BITS) + found)
                cuts = np.searchsorted(both >> BITS, np.arange(1, hi - lo))
                parts = np.split((both & (1 << BITS) - 1).astype(np.uint32), cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at[lo:hi], pa.int64()), pa.array(labels[lo:hi], pa.int32()),
                     pa.array([p.tobytes() for p in parts], pa.binary())],
                    names=["at", "label", "found"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((a, f, y) for b in batches for a, f, y in
                      zip(*(b.column(c).to_pylist() for c in ("at", "found", "label"))))
        model = Ftrl()
        for _ in range(EPOCHS):
            for _, found, y in rows:
                model.learn(np.frombuffer(found, np.uint32).astype(np.int64), int(y))
        at = np.flatnonzero(model.n)
        w = model.weights(at)
        yield pa.RecordBatch.from_arrays([pa.array(at[w != 0]), pa.array(w[w != 0])],
                                         names=["feature", "weight"])

    packed = known.mapInArrow(pack, "at long, label int, found binary")
    return packed.repartition(1).mapInArrow(learn, "feature long, weight double")


def score(docs: DataFrame, weights: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    A text is scored by the distinct features that it holds; null and empty texts by the bias.
    Without any weight every score is 0.
    The weights, at most 2^22 of them, are broadcast.  Input columns named ``score`` or
    ``predicted`` are replaced.
    """
    rows = weights.toPandas()
    shared = docs.sparkSession.sparkContext.broadcast(
        (rows.feature.to_numpy(np.int32), rows.weight.to_numpy(np.float32)))

    def make():
        at, w = shared.value
        dense = np.zeros((1 << BITS) + 1, np.float32)
        dense[at] = w
        bias = float(dense[1 << BITS]) if len(at) else -1e9

        def work(texts: list) -> dict:
            found, owner = features(texts)
            hit = dense[found] != 0
            both = np.unique(owner[hit] * (1 << BITS) + found[hit])
            total = np.bincount(both >> BITS, dense[both & (1 << BITS) - 1], len(texts)) + bias
            p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}
        return work
    return map_texts(docs, text, "score double, predicted int", make)


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             label: str = "toxic", max_sample: int = MAX_SAMPLE) -> DataFrame:
    """``docs`` scored by weights learnt from those that ``labels`` (key, label) marks.

    Learns from about ``max_sample`` labelled keys, or from all if there are fewer: those whose
    hash is lowest, so the same on every run.  That many rows are broadcast to find the texts.
    Only the text is an input of a score.  Rows of ``docs`` without a label, or with a null
    key, are scored but teach nothing; without any labelled row every score is 0.  Positive
    labels count as 1, null ones are left out, and of several for a key the highest counts.
    Repeated rows each get their score, and teach once.  Where sampled keys have over twice
    ``max_sample`` rows, the sample is cut once more, by a hash of the text.  An empty table stays
    empty, long texts are read whole.
    """
    marks = labels.select(F.col(key).alias("_key"), (F.col(label) > 0).cast("int").alias("_label")) \
        .where("_key IS NOT NULL AND _label IS NOT NULL") \
        .groupBy("_key").agg(F.max("_label").alias("_label"))
    share = max_sample / max(1, marks.count())
    if share < 1:
        marks = marks.where(F.pmod(F.xxhash64("_key"), F.lit(1 << 40)) < int((1 << 40) * share))
    taught = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")) \
        .join(F.broadcast(marks), "_key")
    # a key with very many rows must not fill the one task that learns
    rows = docs.select(F.col(key).alias("_key")).join(F.broadcast(marks), "_key").count()
    if rows > 2 * max_sample:
        taught = taught.where(F.pmod(F.xxhash64("_text"), F.lit(1 << 30))
                              < int((1 << 30) * max_sample / rows))
    taught = taught.distinct()
    return score(docs, fit(taught, "_text", "_label"), text)
