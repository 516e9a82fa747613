"""Line dedup: lines that many documents share are dropped.

Line keys are hashed to 64 bits and a 32-bit fingerprint.  The hash space is cut into shards;
one task per shard builds a minimal perfect hash over the shard's distinct hashes, which indexes
an array of fingerprints and an array of document counts, and answers the probes of all slices
of documents from these arrays.  Lines never join lines: a slice sends each shard one packed
array of its distinct hashes and gets back the few that are frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import SPACE, blob, chunks, extended, mix64, slice_of, without, \
    SLICE_BYTES

SHARD_LINES = 200_000


def line_key(line: bytes) -> bytes:
    """A line without white space at both ends, A-Z lower-cased."""
    return line.strip(SPACE).lower()


def line_hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and 32-bit fingerprint of each key, from 128 bits of XXH3."""
    raw = b"".join([xxhash.xxh3_128_digest(k) for k in keys])
    pairs = np.frombuffer(raw, "<u8").reshape(-1, 2)
    return pairs[:, 0].astype(np.uint64), (pairs[:, 1] >> np.uint64(32)).astype(np.uint32)


class MinimalPerfectHash:
    """Distinct 64-bit keys to 0..n-1, by levels of bit arrays.

    At each level the keys still left hash into twice as many slots; those alone in their slot
    set its bit, the others go on.  A key's number is the rank of its bit, from a count per
    64-bit word.  A key outside the set gets some number: compare a fingerprint.
    """

    def __init__(self, keys: np.ndarray, spread: float = 2.0):
        self.size, self.levels, base = len(keys), [], 0
        left, seed = keys.astype(np.uint64), 0
        while len(left):
            slots = max(64, int(len(left) * spread) + 63 & ~63)
            at = self._slot(left, seed, slots)
            alone = np.bincount(at, minlength=slots) == 1
            words = np.packbits(alone, bitorder="little").view("<u8")
            ranks = base + np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((seed, slots, words, ranks))
            base, left, seed = int(ranks[-1]), left[~alone[at]], seed + 1

    @staticmethod
    def _slot(keys: np.ndarray, seed: int, slots: int) -> np.ndarray:
        salt = np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        return (mix64(keys + salt) % np.uint64(slots)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        open_ = np.arange(len(keys))
        for seed, slots, words, ranks in self.levels:
            at = self._slot(keys[open_], seed, slots)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (ranks[at >> 6] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
        return out


def _per_slice(text: str, shards: int):
    """Packed probes: for each slice and shard the distinct hashes and in how many documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            slices = batch.column("_slice").to_pylist()
            for lo, hi, texts in chunks(batch.column(text)):
                for s, t in zip(slices[lo:hi], texts):
                    keys = {line_key(x) for x in (t or "").encode().split(b"\n")} - {b""}
                    if keys:
                        seen.setdefault(s, []).append(line_hashes(list(keys)))
        for s, found in seen.items():
            h = np.concatenate([x[0] for x in found])
            h, first, n = np.unique(h, return_index=True, return_counts=True)
            fp = np.concatenate([x[1] for x in found])[first]
            shard = (mix64(h) % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            cuts = np.flatnonzero(np.diff(shard[order])) + 1
            parts = np.split(order, cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shard[p[0]]) for p in parts], pa.int32()),
                 pa.array([s] * len(parts), pa.int32()),
                 pa.array([blob(h[p]) for p in parts], pa.binary()),
                 pa.array([blob(fp[p]) for p in parts], pa.binary()),
                 pa.array([blob(n[p].astype(np.uint32)) for p in parts], pa.binary())],
                names=["shard", "_slice", "hashes", "prints", "counts"])
    return run


def _answer(min_docs: int):
    """Builds the arrays of a shard and probes them for every slice."""
    def run(probes: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, "<u8") for x in probes.column("hashes").to_pylist()]
        prints = [np.frombuffer(x, "<u4") for x in probes.column("prints").to_pylist()]
        counts = [np.frombuffer(x, "<u4") for x in probes.column("counts").to_pylist()]
        every = np.concatenate(hashes)
        distinct, first = np.unique(every, return_index=True)
        mph = MinimalPerfectHash(distinct)
        kept = np.zeros(mph.size, np.uint32)
        kept[mph.index(distinct)] = np.concatenate(prints)[first]
        docs = np.bincount(mph.index(every), weights=np.concatenate(counts),
                           minlength=mph.size).astype(np.int64)
        out_slice, out_hash = [], []
        for s, h, fp in zip(probes.column("_slice").to_pylist(), hashes, prints):
            at = mph.index(h)
            often = (kept[at] == fp) & (docs[at] >= min_docs)
            if often.any():
                out_slice.append(s)
                out_hash.append(blob(h[often]))
        return pa.table({"_slice": pa.array(out_slice, pa.int32()),
                         "frequent": pa.array(out_hash, pa.binary())})
    return run


def drop_frequent_lines(docs: DataFrame, text: str = "text", min_docs: int = 10) -> DataFrame:
    """``docs`` with lines removed whose key is in at least ``min_docs`` documents.

    A line's key has white space stripped at both ends and A-Z lower-cased; empty keys always
    stay.  Every row is a document of its own, also where ids are equal or null.  A null or
    empty text is one empty line and becomes (or stays) "".  Adds ``n_lines`` (before) and
    ``n_dropped`` and replaces ``text``; input columns named ``n_lines`` or ``n_dropped`` are
    replaced, all others pass through.  An empty table gives an empty table.

    Two keys count as one only if 64 hash bits are equal.
    """
    base = without(docs, ["n_lines", "n_dropped", "_slice"])
    size = base.agg(
        F.sum(F.octet_length(text).cast("long")), F.count(F.lit(1)),
        F.sum(F.length(text) - F.length(F.translate(text, "\n", "")) + 1)).first()
    slices = max(1, -(-(int(size[0] or 0) + 64 * size[1]) // SLICE_BYTES))
    shards = max(1, -(-int(size[2] or 0) // SHARD_LINES))
    sliced = base.withColumn("_slice", slice_of(base, slices)).repartition(slices, "_slice")
    probes = sliced.mapInArrow(
        _per_slice(text, shards),
        "shard int, _slice int, hashes binary, prints binary, counts binary")
    replies = probes.groupBy("shard").applyInArrow(_answer(min_docs),
                                                   "_slice int, frequent binary")
    schema = extended(base.schema, "n_lines long, n_dropped long")
    columns = base.columns

    def rebuild(documents: pa.Table, answers: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x, "<u8") for x in answers.column("frequent").to_pylist()]
        frequent = set(np.concatenate(blobs).tolist()) if blobs else set()
        texts, before, dropped = [], [], []
        for value in documents.column(text).to_pylist():
            lines = (value or "").encode().split(b"\n")
            before.append(len(lines))
            if frequent:
                keys = [line_key(x) for x in lines]
                hashes = line_hashes(keys)[0].tolist()
                lines = [x for x, k, h in zip(lines, keys, hashes) if not k or h not in frequent]
            texts.append(b"\n".join(lines).decode())
            dropped.append(before[-1] - len(lines))
        made = {text: pa.array(texts, pa.string()), "n_lines": pa.array(before, pa.int64()),
                "n_dropped": pa.array(dropped, pa.int64())}
        names = columns + ["n_lines", "n_dropped"]
        return pa.table([made[c] if c in made else documents.column(c) for c in names], names=names)

    return sliced.groupBy("_slice").cogroup(replies.groupBy("_slice")).applyInArrow(rebuild, schema)
