"""SimHash near-dedup by anchor-point covering.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most 1 bit of one of two
31-bit blocks.  The anchors of a block are the 2^26 words of the perfect Hamming code of
length 31: every block value is within covering radius 1 of exactly one anchor, its home.  A
fingerprint is replicated to all anchors within covering radius plus threshold, 1 + 1: 16 of
them, or 1 if it is itself an anchor.  So of two linked fingerprints one visits the other's
home, and only home fingerprints and visitors of one anchor are compared.

Copies meet before that: only distinct fingerprints are replicated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import map_texts, shielded, unshielded, without, written
from tidegrid.llm.components import components

BLOCK = 31
TILE = 1024


def _bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, bit 0 first."""
    total = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65_536):
        part = hashes[lo:lo + 65_536].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return total


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text's word shingles as a signed 64-bit number; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        values = [hashed(b" ".join(words), 42)]
    else:
        join = b" ".join
        values = [hashed(join(w), 42) for w in zip(*[words[i:] for i in range(shingle)])]
    ones = _bits(np.array(values, "<u8")) * 2 > len(values)
    return int(np.packbits(ones, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with a column ``fingerprint`` (long); one of that name is replaced.

    A-Z are lower-cased, words are runs without white space, shingles keep their repeats, and
    a bit is 1 if it is set in over half of the shingles' XXH64 (seed 42).  A text of fewer
    words than a shingle is one shingle; null, empty and blank texts have fingerprint 0.
    """
    def make():
        return lambda texts: {"fingerprint": np.array([fingerprint(t, shingle) for t in texts],
                                                      np.int64)}
    return map_texts(docs, text, "fingerprint long", make)


def anchors_near(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) for all anchors within distance 2 of each 31-bit value."""
    block = block.astype(np.uint64)
    syndrome = np.zeros(len(block), np.int64)
    for k in range(5):
        mask = np.uint64(sum(1 << (j - 1) for j in range(1, BLOCK + 1) if j >> k & 1))
        syndrome |= (np.bitwise_count(block & mask).astype(np.int64) & 1) << k
    flip = lambda j: np.where(j > 0, np.uint64(1) << (np.maximum(j, 1) - 1).astype(np.uint64),
                              np.uint64(0))
    every = np.arange(len(block))
    rows, found, home = [every], [block ^ flip(syndrome)], [np.ones(len(block), bool)]
    for i in range(1, BLOCK + 1):
        j = syndrome ^ i
        at = every[(syndrome > 0) & (j > i)]
        rows.append(at)
        found.append(block[at] ^ flip(np.full(len(at), i)) ^ flip(j[at]))
        home.append(np.zeros(len(at), bool))
    return np.concatenate(rows), np.concatenate(found), np.concatenate(home)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
        node = batch.column("node").to_numpy(zero_copy_only=False)
        for lo in range(0, len(prints), 4096):
            fp, who = prints[lo:lo + 4096], node[lo:lo + 4096]
            for side in (0, 1):
                block = fp >> np.uint64(side * BLOCK) & np.uint64((1 << BLOCK) - 1)
                rows, anchor, home = anchors_near(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((anchor | np.uint64(side << BLOCK)).astype(np.int64)),
                     pa.array(fp[rows].view(np.int64)), pa.array(who[rows]), pa.array(home)],
                    names=["anchor", "fingerprint", "node", "home"])


def links_within(fp: np.ndarray, node: np.ndarray, home: np.ndarray, max_bits: int):
    """A forest (node, smaller node) that joins what links of one anchor join.

    Compares home fingerprints with all, tile by tile, and lets smallest labels spread until
    nothing changes; pairs are never listed.
    """
    rank = np.argsort(np.argsort(node, kind="stable"), kind="stable")
    label = rank.copy()
    homes = np.flatnonzero(home)
    while True:
        before = label.copy()
        for a in range(0, len(homes), TILE):
            own = homes[a:a + TILE]
            for b in range(0, len(fp), TILE):
                near = np.bitwise_count(fp[own, None] ^ fp[None, b:b + TILE]) <= max_bits
                cols = slice(b, b + TILE)
                label[own] = np.minimum(
                    label[own], np.where(near, label[None, cols], len(fp)).min(1, initial=len(fp)))
                label[cols] = np.minimum(
                    label[cols], np.where(near, label[own, None], len(fp)).min(0, initial=len(fp)))
        if (label == before).all():
            break
    by_rank = np.empty(len(node), node.dtype)
    by_rank[rank] = node
    moved = label != rank
    return node[moved], by_rank[label[moved]]


def _compare(max_bits: int):
    """Reads rows sorted by anchor; the last anchor of a batch waits for the next batch."""
    names = ("anchor", "fingerprint", "node", "home")

    def linked(anchor, fp, node, home):
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        sizes = np.diff(np.r_[starts, len(anchor)])
        a, b = [], []
        pairs = starts[sizes == 2]
        near = (home[pairs] | home[pairs + 1]) \
            & (np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= max_bits) if len(pairs) else pairs > 0
        a.append(node[pairs[near]])
        b.append(node[pairs[near] + 1])
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            if home[s:s + n].any():
                x, y = links_within(fp[s:s + n], node[s:s + n], home[s:s + n], max_bits)
                a.append(x)
                b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))],
                                          names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []
        for batch in batches:
            part = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            part[1] = part[1].view(np.uint64)
            if not len(part[0]):
                continue
            last = int(np.searchsorted(part[0], part[0][-1], "left"))
            if last == 0 and waiting and waiting[-1][0][-1] == part[0][-1]:
                waiting.append(part)
                continue
            done = [np.concatenate(x) for x in zip(*waiting, [c[:last] for c in part])]
            waiting = [[c[last:] for c in part]]
            if len(done[0]):
                yield linked(*done)
        if waiting:
            yield linked(*[np.concatenate(x) for x in zip(*waiting)])
    return run


def print_roots(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fingerprint, root) of distinct ``prints``: root is the same for all that links join.

    Fingerprints are the nodes: a key may come with several of them, and that is no link.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the covering is exact for 0 to 3 bits")
    node = prints.select("fingerprint", F.col("fingerprint").alias("node"))
    spread = node.mapInArrow(_replicate, "anchor long, fingerprint long, node long, home boolean")
    links = spread.repartition("anchor").sortWithinPartitions("anchor") \
        .mapInArrow(_compare(max_bits), "a long, b long")
    return node.join(components(links), "node", "left") \
        .select("fingerprint", F.coalesce("root", "node").alias("root"))


def near_groups(docs: DataFrame, key: str = "doc_id", max_bits: int = 3) -> DataFrame:
    """``docs`` (with ``fingerprint``, see :func:`fingerprints`) with ``component_id``.

    Rows link when their fingerprints differ in at most ``max_bits`` (0 to 3) bits;
    ``component_id`` is the smallest ``key`` that can be reached over links.  Copies have one
    fingerprint and are compared once.  Null keys are never an id: a component of null keys
    alone has a null id.  Repeated rows keep their place, an empty table gives an empty one, and
    long texts are nothing special here.  A column named ``component_id`` is replaced.
    """
    docs = without(docs, ["component_id"])
    distinct = written(docs.groupBy("fingerprint").agg(F.min(key).cast("long").alias("least")),
                       "prints")
    roots = print_roots(distinct, max_bits)
    found = distinct.join(roots, "fingerprint").select(
        F.col("fingerprint").alias("_print"), F.col("root").alias("_root"), "least")
    ids = found.groupBy("_root").agg(F.min("least").alias("component_id"))
    found = found.join(ids, "_root").select("_print", "component_id")
    return docs.join(found, F.col("fingerprint") == F.col("_print")).drop("_print")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                max_bits: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of linked fingerprints: that of the smallest ``key``.

    Of several rows with that key one stays; a row with a null key stays only where its group has
    no key.  All columns of ``docs`` come back as they were, whatever their names.
    """
    inner, names = shielded(docs, (key, text))
    printed = written(fingerprints(inner, text, shingle)
                      .withColumn("_row", F.monotonically_increasing_id()), "simhash")
    best = F.min(F.struct(F.col(key).isNull().alias("no"), F.col(key).alias("id"),
                          F.col("_row").alias("row"))).alias("best")
    distinct = written(printed.groupBy("fingerprint").agg(best), "prints")
    chosen = distinct.join(print_roots(distinct, max_bits), "fingerprint") \
        .groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("_row"))
    return unshielded(printed.join(chosen, "_row", "left_semi"), names)


def hex_print(column: str = "fingerprint"):
    """The fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
