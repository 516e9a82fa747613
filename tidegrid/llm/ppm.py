"""LM scoring: prediction by partial matching over a byte-context trie.

A text is its words, A-Z lower-cased, one space between them, then an end byte.  The trie holds
how often each byte followed each context of up to five bytes, over all training texts.  A byte
is coded in the longest context known; where it is new there, an escape is coded and the next
shorter context tried, in which the bytes already ruled out are excluded.

Nothing bounds the trie or the counts of words, so neither is ever in one place.  Documents are
dealt into slices; each slice sends its distinct words and grams (a context and its byte) with
their training counts to shards, and each shard sums them up.  The trie is then cut by the last
three bytes of the context: all that the code length of a gram depends on lies in its part, but
for contexts of two bytes or less, which every part gets (at most 256^3 entries).  Code lengths go
back to the shards, and each slice gets those of its own grams, as it gets its words' counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import NOT_SPACE, blob, chunks, extended, hashed_runs, mix64, \
    slice_count, slice_of, without, written

ORDER = 5
# Contexts up to this length are known to every part of the trie.
SHORT = 2
# Taken from every count and given to the escape, as in the method's variant D.
DISCOUNT = 0.5
END = 10
SLICES_PER_SHARD = 4
MERGE_AT = 1_500_000
PART_GRAMS = 1_000_000
# Bytes of text worked on at once: a byte takes some hundred bytes of arrays meanwhile.
TEXT_AT_ONCE = 1_000_000


def byte_grams(texts: list, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(context and byte as one number, text) for every byte coded; missing context is END."""
    pad = bytes([END]) * order
    parts = [pad + b" ".join((t or "").encode().lower().split()) + bytes([END]) for t in texts]
    sizes = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(pad + b"".join(parts), np.uint8).astype(np.uint64)
    gram = data[order:].copy()
    for j in range(1, order + 1):
        gram |= data[order - j:len(data) - j] << np.uint64(8 * j)
    coded = np.ones(len(gram), bool)
    starts = np.cumsum(sizes) - sizes
    for j in range(order):
        coded[starts + j] = False
    return gram[coded], np.repeat(np.arange(len(texts)), sizes - order)


def merged(found: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in found]), len(keys)).astype(np.int64)


def distinct_grams(texts: list, train: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of some texts, ascending, and how often each is in a text learnt from."""
    grams, owner = byte_grams(texts, order)
    keys, at = np.unique(grams, return_inverse=True)
    return keys, np.bincount(at, train[owner], len(keys)).astype(np.int64)


class HashIndex:
    """Positions of distinct 64-bit keys, by open addressing at a quarter full."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.at = np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            _, first = np.unique(slot, return_index=True)
            first = first[self.at[slot[first]] < 0]
            self.at[slot[first]] = left[first]
            self.keys[slot[first]] = keys[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.at[slot]
        open_ = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            found = self.at[slot]
            out[open_] = found
            on = (self.keys[slot] != keys[open_]) & (found >= 0)
            open_, slot = open_[on], slot[on]
        return out


def _log(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1e-300))


class Trie:
    """Code lengths (log10) from trie entries, every step an array operation."""

    def __init__(self, depth: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int = ORDER):
        self.order, self.levels = order, []
        for k in range(order + 1):
            at = depth == k
            keys, counts = gram[at].astype(np.uint64), n[at].astype(np.float64)
            by = np.argsort(keys)
            keys, counts = keys[by], counts[by]
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            less = counts - DISCOUNT
            kept = np.bincount(of, less, len(contexts))
            kinds = np.bincount(of, minlength=len(contexts)) * DISCOUNT
            level = {"grams": HashIndex(keys), "log_n": _log(less), "of": of, "kinds": kinds,
                     "kept": kept, "contexts": HashIndex(contexts), "less": less}
            if k:
                shorter = self.levels[-1]
                suffix = np.uint64((1 << 8 * k) - 1)
                excluded = np.bincount(of, shorter["less"][
                    shorter["grams"].find(keys & suffix)], len(contexts))
                up = shorter["contexts"].find(contexts & (suffix >> np.uint64(8)))
                left = shorter["kept"][up] - excluded
                escape = shorter["kinds"][up] - kinds
                level["log_left"] = _log(left + escape)
                level["log_on"] = np.where(escape > 0, _log(escape) - level["log_left"], 0.0)
            level["log_all"] = _log(kept + kinds)
            level["log_escape"] = _log(kinds) - level["log_all"]
            level["first"] = (level["log_n"] - level["log_all"][of]).astype(np.float32)
            self.levels.append(level)
        self.kinds0 = float(self.levels[0]["kinds"].sum()) / DISCOUNT

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of each byte after its context."""
        top = self.levels[-1]
        hit = top["grams"].find(grams)
        out = np.where(hit >= 0, top["first"][hit] if len(top["first"]) else 0.0, 0.0)
        open_ = np.flatnonzero(hit < 0)
        rest, before = grams[open_], np.full(len(open_), -1)
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            key = rest & np.uint64((1 << 8 * (k + 1)) - 1)
            hit = level["grams"].find(key)
            here = level["contexts"].find(key >> np.uint64(8))
            longer = self.levels[k + 1] if k < self.order else None
            fresh = before < 0
            done = hit >= 0
            gain = np.zeros(len(rest))
            a = np.flatnonzero(done & fresh)
            gain[a] = level["first"][hit[a]]
            a = np.flatnonzero(~done & fresh & (here >= 0))
            gain[a] = level["log_escape"][here[a]]
            if longer is not None:
                a = np.flatnonzero(done & ~fresh)
                gain[a] = level["log_n"][hit[a]] - longer["log_left"][before[a]]
                a = np.flatnonzero(~done & ~fresh)
                gain[a] = longer["log_on"][before[a]]
            out[open_] += gain
            open_, rest, before = open_[~done], rest[~done], here[~done]
        out[open_] -= np.log10(max(1.0, 256 - self.kinds0))
        return out


def _levels(gram: np.ndarray, n: np.ndarray, depths: range) -> list[tuple]:
    """(depth, gram, n) of all shorter grams that these end in."""
    out = []
    for k in depths:
        keys, counts = merged([(gram & np.uint64((1 << 8 * (k + 1)) - 1), n)])
        out.append((np.full(len(keys), k), keys, counts))
    return out


def code_lengths(short: tuple[np.ndarray, np.ndarray], order: int):
    """log10 of the probability of every gram of a part, by the part's own trie.

    ``short`` has the counts of all contexts of :data:`SHORT` bytes with their bytes."""
    def run(part: pa.Table) -> pa.Table:
        gram = np.asarray(part.column("gram")).view(np.uint64)
        n = np.asarray(part.column("n"))
        low, seen = min(SHORT, order), n > 0
        entries = _levels(*short, range(low + 1)) \
            + _levels(gram[seen], n[seen], range(low + 1, order + 1))
        trie = Trie(*map(np.concatenate, zip(*entries)), order)
        bits = np.concatenate([trie.log10(gram[lo:lo + PART_GRAMS])
                               for lo in range(0, len(gram), PART_GRAMS)])
        return pa.table({"shard": part.column("shard"), "gram": part.column("gram"),
                         "bits": pa.array(bits.astype(np.float32))})
    return run


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(hashes + np.uint64(1)) % np.uint64(shards)).astype(np.int32)


def _gram_shard(grams: np.ndarray, shards: int) -> np.ndarray:
    """Grams that differ in their last two bytes alone stay together: they pack well."""
    return _shard_of(grams >> np.uint64(16), shards)


WORDS, GRAMS = 0, 1


def _requests(shards: int, order: int):
    """For each slice and shard the distinct word hashes, then the distinct grams, ascending,
    and their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}

        def add(kind, s, keys, n):
            parts = found.setdefault((kind, int(s)), [])
            parts.append((keys, n))
            if sum(len(k) for k, _ in parts[1:]) > max(MERGE_AT, len(parts[0][0])):
                parts[:] = [merged(parts)]

        for batch in batches:
            slices = np.asarray(batch.column("_slice"))
            train = np.asarray(batch.column("_train")).astype(bool)
            for lo, hi, texts in chunks(batch.column("_text"), TEXT_AT_ONCE):
                hashes, owner = hashed_runs(texts, NOT_SPACE)
                of = slices[lo:hi][owner]
                for s in np.unique(slices[lo:hi]):
                    mine = of == s
                    keys, at = np.unique(hashes[mine], return_inverse=True)
                    n = np.bincount(at, train[lo:hi][owner[mine]], len(keys)).astype(np.int64)
                    add(WORDS, s, keys, n)
                    rows = np.flatnonzero(slices[lo:hi] == s)
                    add(GRAMS, s, *distinct_grams([texts[i] for i in rows], train[lo:hi][rows],
                                                  order))
        for (kind, s), parts in found.items():
            keys, n = merged(parts)
            shard = _gram_shard(keys, shards) if kind == GRAMS else _shard_of(keys, shards)
            for d in np.unique(shard):
                mine = shard == d
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind], pa.int32()), pa.array([d], pa.int32()),
                     pa.array([s], pa.int32()), pa.array([blob(keys[mine])], pa.binary()),
                     pa.array([blob(n[mine].astype("<u4"))], pa.binary())],
                    names=["kind", "shard", "_slice", "hashes", "counts"])
    return run


def _blobs(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _gram_totals(parts: pa.Table) -> pa.Table:
    """(shard, gram, n) of the corpus; n is 0 where a gram is in held-out texts alone."""
    keys, n = merged(list(zip(_blobs(parts.column("hashes"), "<u8"),
                              _blobs(parts.column("counts"), "<u4"))))
    shard = np.full(len(keys), parts.column("shard")[0].as_py(), np.int32)
    return pa.table({"shard": shard, "gram": keys.view(np.int64), "n": n})


def _gram_replies(parts: pa.Table, coded: pa.Table) -> pa.Table:
    """Code lengths of each slice's grams, in its order."""
    gram = np.asarray(coded.column("gram")).view(np.uint64)
    by = np.argsort(gram)
    gram, bits = gram[by], np.asarray(coded.column("bits"))[by]
    replies = [blob(bits[np.searchsorted(gram, k)]) for k in _blobs(parts.column("hashes"), "<u8")]
    return pa.table({"kind": pa.array([GRAMS] * len(replies), pa.int32()),
                     "shard": parts.column("shard"), "_slice": parts.column("_slice"),
                     "totals": pa.array(replies, pa.binary())})


def _total_counts(parts: pa.Table) -> pa.Table:
    """Each slice's counts over the whole corpus, in its order; in slice -1 the shard's totals."""
    shard = parts.column("shard")[0].as_py()
    hashes, counts = _blobs(parts.column("hashes"), "<u8"), _blobs(parts.column("counts"), "<u4")
    keys, at = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(at, np.concatenate(counts), len(keys)).astype(np.uint64)
    replies = np.split(total[at], np.cumsum([len(h) for h in hashes])[:-1])
    slices = parts.column("_slice").to_pylist()
    n = len(slices) + 1
    return pa.table({
        "_slice": pa.array(slices + [-1], pa.int32()), "shard": pa.array([shard] * n, pa.int32()),
        "totals": pa.array([blob(r) for r in replies] + [None], pa.binary()),
        "kinds": pa.array([0] * (n - 1) + [int((total > 0).sum())], pa.int64()),
        "words": pa.array([0] * (n - 1) + [int(total.sum())], pa.int64())})


FIELDS = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def ppm_scores(docs: DataFrame, train: str, text: str = "text", order: int = ORDER) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``train``, a SQL condition, says which rows are learnt from (null: not); all are scored.
    ``score`` is log10 of the text's probability under the trie, ``base_score`` that of its
    words and its end under add-one counts.  A null or blank text is its end alone.  Every row
    is a text of its own, repeated or not; without training rows each byte has probability
    1/256.  Input columns with the names of results are replaced.
    """
    names = [f.split()[0] for f in FIELDS.split(", ")]
    base = without(docs, names).withColumn("_train", F.coalesce(F.expr(train), F.lit(False)))
    ends = base.where("_train").count()
    slices = slice_count(base, text)
    shards = -(-slices // SLICES_PER_SHARD)
    sliced = base.withColumn("_text", F.col(text)).withColumn("_slice", slice_of(base, slices)) \
        .drop(text).repartition(slices, "_slice")
    asked = written(sliced.select("_slice", "_train", "_text").mapInArrow(
        _requests(shards, order),
        "kind int, shard int, _slice int, hashes binary, counts binary"), "asked")

    words = written(asked.where(F.col("kind") == WORDS).groupBy("shard").applyInArrow(
        _total_counts, "_slice int, shard int, totals binary, kinds long, words long"), "counts")
    kinds, total = words.agg(F.sum("kinds"), F.sum("words")).first()
    tokens, kinds = int(total or 0) + ends, int(kinds or 0) + (ends > 0)
    below = float(np.log10(tokens + kinds + 1))

    asked_grams = asked.where(F.col("kind") == GRAMS).select("shard", "_slice", "hashes", "counts")
    coded = _coded(asked_grams, order)
    bits = asked_grams.drop("counts").groupBy("shard").cogroup(coded.groupBy("shard")) \
        .applyInArrow(_gram_replies, "kind int, shard int, _slice int, totals binary")
    replies = bits.unionByName(words.where("_slice >= 0").select(
        F.lit(WORDS).alias("kind"), "shard", "_slice", "totals"))
    columns = [c for c in base.columns if c != "_train"]
    schema = extended(base.select(*[f"`{c}`" for c in columns]).schema, FIELDS)

    def score(documents: pa.Table, told: pa.Table) -> pa.Table:
        held = documents.column("_text").combine_chunks()
        held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
        seen = []
        for _, _, texts in chunks(held, TEXT_AT_ONCE):
            seen.append((len(texts), _spelt(*byte_grams(texts, order), len(texts)),
                         _spelt(*hashed_runs(texts, NOT_SPACE), len(texts))))
        log10 = _known([g[0] for _, g, _ in seen], GRAMS, lambda k: _gram_shard(k, shards), told,
                       "<f4")
        known = _known([w[0] for _, _, w in seen], WORDS, lambda k: _shard_of(k, shards), told,
                       "<u8")
        made = []
        for n, (grams, at, sizes), (hashes, word_at, words) in seen:
            bits = np.bincount(np.repeat(np.arange(n), sizes), log10(grams)[at], n)
            mine, where = known(hashes)[word_at], np.repeat(np.arange(n), words)
            n_tokens = words + 1
            base_score = np.bincount(where, np.log10(mine + 1.0), n) + np.log10(ends + 1.0) \
                - n_tokens * below
            made.append((n_tokens, np.bincount(where, mine > 0, n).astype(np.int64) + (ends > 0),
                         np.full(n, tokens), base_score, bits))
        arrays = [pa.array(np.concatenate(x)) for x in zip(*made)]
        return pa.table([documents.column("_text" if n == text else n) for n in columns] + arrays,
                        names=columns + names)

    return sliced.groupBy("_slice").cogroup(replies.groupBy("_slice")).applyInArrow(score, schema)


def _coded(asked: DataFrame, order: int) -> DataFrame:
    """(shard, gram, bits) of all grams asked for."""
    counted = written(asked.groupBy("shard").applyInArrow(
        _gram_totals, "shard int, gram long, n long"), "grams")
    low = F.col("gram").bitwiseAND(F.lit((1 << 8 * (min(SHORT, order) + 1)) - 1))
    short = counted.where("n > 0").groupBy(low.alias("gram")).agg(F.sum("n").alias("n")).toPandas()
    held = counted.sparkSession.sparkContext.broadcast(
        (short.gram.to_numpy(np.int64).view(np.uint64), short.n.to_numpy(np.int64)))
    parts = max(1, -(-counted.count() // PART_GRAMS))
    ending = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * (SHORT + 1)) - 1))
    return counted.withColumn("part", F.pmod(F.xxhash64(ending), F.lit(parts))) \
        .groupBy("part").applyInArrow(lambda part: code_lengths(held.value, order)(part),
                                      "shard int, gram long, bits float")


def _spelt(keys: np.ndarray, owner: np.ndarray, n: int):
    """(distinct keys, ascending; where each key is among them; keys of each text)."""
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, at.astype(np.int32), np.bincount(owner, minlength=n)


def _known(parts: list, kind: int, shard_of, told: pa.Table, number: str):
    """A lookup of what the shards answered for the distinct keys of a slice."""
    keys = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys
    shard, values = shard_of(keys), np.zeros(len(keys), number)
    for k, d, t in zip(*[told.column(c).to_pylist() for c in ("kind", "shard", "totals")]):
        if k == kind:
            values[shard == d] = np.frombuffer(t, number)
    return lambda distinct: values[np.searchsorted(keys, distinct)]
