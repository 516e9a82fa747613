"""Benchmark decontamination over a distributed positional inverted index.

The documents are the training side.  Stretches of about 2 MB of text are segments of the index,
one stored row each: the segment's distinct terms (64-bit hashes, sorted), how many postings each
has, and the positions themselves, term by term, as variable-length gaps.  The index is a table
in the shared folder, spread over the cluster; segments follow the documents, so building it
moves nothing.

The test side is cut into windows of words and goes to the segments in blocks of bounded size.
In a segment, windows with a term that is not there are gone at once.  The others begin with the
postings of their rarest term, shifted by its offset, and are intersected with the shifted lists
of the next rarest, and so on: what is left are exact phrase matches.  With ``slop`` the terms may
have other words between them; then the neighbours of each posting of the rarest term are sought
to its right and left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import blob, chunks, hashed_runs, shipped, text_bytes, written

BLOCK_BYTES = 8_000_000
CANDIDATES = 1_000_000
# Fixed value: words are what is left outside these bytes, [\x00-\x2F\x3A-\x60\x7B-\x7F].
WORD = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])


def gaps_to_bytes(values: np.ndarray) -> bytes:
    """Non-negative numbers below 2^35, seven bits a byte, low bits first, the last byte below 128."""
    values = values.astype(np.uint64)
    size = 1 + sum((values >> np.uint64(7 * k) > 0).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    at = ends - size
    for k in range(5):
        more = size > k
        part = (values[more] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8)
        out[at[more] + k] = part | ((size[more] > k + 1) * 128).astype(np.uint8)
    return out.tobytes()


def bytes_to_gaps(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    at = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    size = ends - at + 1
    out = (raw[at] & 127).astype(np.int64)
    for k in range(1, 5):
        more = np.flatnonzero(size > k)
        if len(more):
            out[more] |= (raw[at[more] + k] & 127).astype(np.int64) << (7 * k)
    return out


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in turn, and the number of words of each text."""
    hashes, row = hashed_runs(texts, WORD)
    return hashes, np.bincount(row, minlength=len(texts)).astype(np.int64)


def _segment(hashes: np.ndarray, sizes: np.ndarray) -> dict[str, bytes]:
    """Packed postings.  A text's words stand one after another; one place is free after each."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(hashes), dtype=np.int64) + row
    order = np.argsort(hashes, kind="stable")
    terms, first, counts = np.unique(hashes[order], return_index=True, return_counts=True)
    gaps = np.diff(place[order], prepend=0)
    gaps[first] = place[order][first]
    return {"sizes": blob(sizes.astype("<u4")), "terms": blob(terms.astype("<u8")),
            "counts": blob(counts.astype("<u4")), "places": gaps_to_bytes(gaps)}


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: (segment, keys, sizes, terms, counts, places), one row a segment.

    Null and empty texts have no words but a place in ``keys`` and ``sizes``.
    """
    base = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind = base.schema["_key"].dataType.simpleString()
    names = ["sizes", "terms", "counts", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in chunks(batch.column("_text")):
                packed = _segment(*word_hashes(texts))
                keys = batch.column("_key").slice(lo, hi - lo)
                listed = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), keys)
                yield pa.RecordBatch.from_arrays(
                    [listed] + [pa.array([packed[n]], pa.binary()) for n in names],
                    names=["keys"] + names)

    index = base.mapInArrow(run, f"keys array<{kind}>, " + ", ".join(f"{n} binary" for n in names))
    return written(index.withColumn("segment", F.monotonically_increasing_id()), "postings")


def _blocks(items: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """Test items in packed blocks: (keys, terms, table, lengths, owners)."""
    base = items.select(F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"))
    size, rows = text_bytes(base, "_text")
    parts = max(1, -(-(size + 64 * rows) // BLOCK_BYTES))
    names = ["terms", "table", "lengths", "owners"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches), base_schema).combine_chunks()
        for batch in whole.to_batches():
            for lo, hi, texts in chunks(batch.column("_text"), BLOCK_BYTES):
                hashes, sizes = word_hashes(texts)
                count = np.where(sizes < window, sizes > 0, sizes - window + 1).astype(np.int64)
                owner = np.repeat(np.arange(len(sizes)), count)
                nth = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
                at = (np.cumsum(sizes) - sizes)[owner] + nth
                length = np.minimum(sizes[owner], window)
                terms, number = np.unique(hashes, return_inverse=True)
                # short windows repeat their last word at its own offset
                table = number[at[:, None] + np.minimum(np.arange(window), length[:, None] - 1)] \
                    if len(at) else np.zeros((0, window), np.int64)
                cells = [terms.astype("<u8"), table.astype("<u4"), length.astype("<u4"),
                         owner.astype("<u4")]
                keys = batch.column("_key").slice(lo, hi - lo)
                listed = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), keys)
                yield pa.RecordBatch.from_arrays(
                    [listed] + [pa.array([blob(c)], pa.binary()) for c in cells],
                    names=["keys"] + names)

    base_schema = pa.schema([("_key", pa.string()), ("_text", pa.string())])
    dealt = base.repartition(parts, F.xxhash64("_key", "_text"))
    return written(dealt.mapInArrow(run, "keys array<string>, "
                                    + ", ".join(f"{n} binary" for n in names)), "test-blocks")


class _Postings:
    """One segment, unpacked: postings as sorted numbers of term (high half) and place."""

    def __init__(self, sizes: bytes, terms: bytes, counts: bytes, places: bytes):
        self.sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.terms = np.frombuffer(terms, "<u8")
        self.counts = np.frombuffer(counts, "<u4").astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        gaps = bytes_to_gaps(places)
        total = np.cumsum(gaps)
        base = total[self.first] - gaps[self.first] if len(gaps) else total
        self.place = total - np.repeat(base, self.counts)
        self.key = np.repeat(np.arange(len(self.terms)) << 32, self.counts) | self.place

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """The number of each term here, or -1."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        want = term << 32 | place
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return (place >= 0) & (self.key[at] == want)

    def beside(self, term: np.ndarray, place: np.ndarray, after: bool) -> np.ndarray:
        """The nearest posting of ``term`` after or before ``place``; -1 if there is none."""
        at = np.searchsorted(self.key, term << 32 | place, "right" if after else "left") - (not after)
        safe = np.clip(at, 0, len(self.key) - 1)
        found = (at == safe) & (self.key[safe] >> 32 == term) & (place >= 0)
        return np.where(found, self.key[safe] & 0xFFFFFFFF, -1)


def _match(seg: _Postings, terms: np.ndarray, table: np.ndarray, lengths: np.ndarray,
           slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, from, to) of the matches, some candidates at a time."""
    number = seg.numbers(terms)
    count = np.where(number >= 0, seg.counts[number] if len(seg.counts) else 0, 0)
    alive = np.flatnonzero(count[table].min(1, initial=1) > 0) if len(table) else []
    if not len(alive):
        return
    term, length = number[table[alive]], lengths[alive]
    order = np.argsort(seg.counts[term], axis=1, kind="stable")
    rarest = np.take_along_axis(term, order[:, :1], 1)[:, 0]
    many = seg.counts[rarest]
    ends = np.cumsum(many)
    lo = 0
    while lo < len(alive):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CANDIDATES, "right")))
        w = np.repeat(np.arange(lo, hi), many[lo:hi])
        nth = np.arange(len(w)) - np.repeat(ends[lo:hi] - many[lo:hi] - (ends[lo - 1] if lo else 0),
                                            many[lo:hi])
        place = seg.place[seg.first[rarest[w]] + nth]
        offset = np.minimum(order[w, 0], length[w] - 1)
        if slop:
            w, start, stop = _stretch(seg, term, length, w, place, offset, slop)
        else:
            start = place - offset
            for j in range(1, table.shape[1]):
                column = order[w, j]
                ok = seg.has(term[w, column], start + np.minimum(column, length[w] - 1))
                w, start = w[ok], start[ok]
            stop = start + length[w]
        yield alive[w], start, stop
        lo = hi


def _stretch(seg: _Postings, term: np.ndarray, length: np.ndarray, w: np.ndarray,
             place: np.ndarray, offset: np.ndarray, slop: int):
    """The tightest stretch through each posting that holds the terms in order."""
    right, left = place.copy(), place.copy()
    ok = np.ones(len(w), bool)
    for step in range(1, term.shape[1]):
        for after in (True, False):
            column = offset + step if after else offset - step
            go = np.flatnonzero(ok & (column >= 0) & (column < length[w]))
            side = right if after else left
            side[go] = seg.beside(term[w[go], column[go]], side[go], after)
            ok[go] &= side[go] >= 0
    text = np.searchsorted(seg.starts, place, "right")
    ok &= (np.searchsorted(seg.starts, left, "right") == text) \
        & (np.searchsorted(seg.starts, right, "right") == text) \
        & (right - left + 1 <= length[w] + slop)
    return w[ok], left[ok], right[ok] + 1


def find_phrases(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text",
                 window: int = 10, slop: int = 0) -> DataFrame:
    """(segment, doc_no, item, start, stop) of every match of a window of the items' words.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is
    one window.  ``start`` and ``stop`` count the document's words.  With ``slop`` the window's
    words must follow in order with at most so many other words between them in all; given are
    the tightest such stretches.  ``item`` is the item's key as text, null for a null key.
    """
    return _searched(index, items, key, text, window, slop, _all_matches,
                     "segment long, doc_no int, item string, start int, stop int")


def _searched(index: DataFrame, items: DataFrame, key: str, text: str, window: int, slop: int,
              rows_of, fields: str) -> DataFrame:
    """``rows_of`` of every segment and block; blocks reach the segments one by one."""
    spark = shipped(index.sparkSession)
    out = None
    for row in _blocks(items, key, text, window).toLocalIterator():
        block = spark.sparkContext.broadcast(row.asDict())
        part = index.select("segment", "sizes", "terms", "counts", "places") \
            .mapInArrow(_finder(block, window, slop, rows_of), fields)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], fields) if out is None else out


def _finder(block, window: int, slop: int, rows_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        terms = np.frombuffer(own["terms"], "<u8")
        table = np.frombuffer(own["table"], "<u4").astype(np.int64).reshape(-1, window)
        lengths = np.frombuffer(own["lengths"], "<u4").astype(np.int64)
        owners = np.frombuffer(own["owners"], "<u4").astype(np.int64)
        keys = pa.array(own["keys"], pa.string())
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                number = row.pop("segment")
                seg = _Postings(**row)
                yield from rows_of(number, seg, _match(seg, terms, table, lengths, slop), owners,
                                   keys)
    return run


def _all_matches(number: int, seg: _Postings, matches, owners: np.ndarray, keys: pa.Array):
    for w, start, stop in matches:
        start, stop, owner = np.unique(np.stack([start, stop, owners[w]], 1), axis=0).T
        doc = np.searchsorted(seg.starts, start, "right") - 1
        base = seg.starts[doc]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(doc), number, np.int64)), pa.array(doc.astype(np.int32)),
             keys.take(pa.array(owner)), pa.array((start - base).astype(np.int32)),
             pa.array((stop - base).astype(np.int32))],
            names=["segment", "doc_no", "item", "start", "stop"])


def _by_document(number: int, seg: _Postings, matches, owners: np.ndarray, keys: pa.Array):
    """One row a document with a match: its items, and its matches as merged stretches."""
    edge = np.zeros(int((seg.sizes + 1).sum()) + 1, np.int32)
    pairs = np.zeros((0, 2), np.int64)
    for w, start, stop in matches:
        edge += np.bincount(start, minlength=len(edge)).astype(np.int32)
        edge -= np.bincount(stop, minlength=len(edge)).astype(np.int32)
        doc = np.searchsorted(seg.starts, start, "right") - 1
        pairs = np.unique(np.concatenate([pairs, np.stack([doc, owners[w]], 1)]), axis=0)
    if not len(pairs):
        return
    docs, first = np.unique(pairs[:, 0], return_index=True)
    hit = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]])
    change = np.flatnonzero(hit[1:] != hit[:-1])
    start, stop = change[::2], change[1::2]
    home = np.searchsorted(docs, np.searchsorted(seg.starts, start, "right") - 1)
    cuts = pa.array(np.searchsorted(home, np.arange(len(docs) + 1)).astype(np.int32))
    base = seg.starts[docs[home]]

    def listed(at, values):
        return pa.ListArray.from_arrays(at, values)

    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(docs), number, np.int64)), pa.array(docs.astype(np.int32)),
         listed(pa.array(np.r_[first, len(pairs)].astype(np.int32)),
                keys.take(pa.array(pairs[:, 1]))),
         listed(cuts, pa.array((start - base).astype(np.int32))),
         listed(cuts, pa.array((stop - base).astype(np.int32)))],
        names=["segment", "doc_no", "items", "starts", "stops"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts together what several blocks found in a document."""
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
    for batch in batches:
        items, spans, n_hit = [], [], []
        for own, starts, stops in zip(*(batch.column(n).to_pylist()
                                        for n in ("items", "starts", "stops"))):
            items.append(sorted({x for part in own for x in part if x is not None}))
            merged: list[list[int]] = []
            for s, e in sorted((s, e) for x, y in zip(starts, stops) for s, e in zip(x, y)):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            spans.append([{"start": s, "stop": e} for s, e in merged])
            n_hit.append(sum(e - s for s, e in merged))
        yield pa.RecordBatch.from_arrays(
            [batch.column("segment"), batch.column("doc_no"), pa.array(items, pa.list_(pa.string())),
             pa.array(spans, pa.list_(span)), pa.array(n_hit, pa.int64())],
            names=["segment", "doc_no", "item_ids", "spans", "n_hit"])


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            sizes = np.frombuffer(batch.column("sizes")[i].as_py(), "<u4").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sizes), batch.column("segment")[i].as_py(), np.int64)),
                 pa.array(np.arange(len(sizes), dtype=np.int32)), batch.column("keys")[i].values,
                 pa.array(sizes)], names=["segment", "doc_no", "key", "n_words"])


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", window: int = 10,
                  slop: int = 0) -> DataFrame:
    """What each document shares with the test items: one row a row of ``docs``.

    Columns: ``key``, ``n_words``, ``n_hit`` (words inside a match), ``item_ids`` (distinct keys of
    items with a match, as text, sorted), ``spans`` (matches put together to stretches of words,
    structs of start and stop), ``contaminated``; other columns of ``docs`` are left out.  A-Z are
    lower-cased, words are runs of digits, letters and anything beyond ASCII.  Null, empty and
    wordless texts hit nothing, on either side; an item with a null key hits words but has no id
    to list, items of one key count as one.  Repeated documents have a row each, a null ``key``
    stays null, texts are searched whole, empty tables on either side give no match.
    """
    index = build_index(docs, key, text)
    kind = index.schema["keys"].dataType.elementType.simpleString()
    rows = index.select("segment", "keys", "sizes").mapInArrow(
        _sizes, f"segment long, doc_no int, key {kind}, n_words long")
    hits = _searched(index, items, item_key, item_text, window, slop, _by_document,
                     "segment long, doc_no int, items array<string>, starts array<int>, "
                     "stops array<int>")
    # one row a block and document is all that moves
    found = hits.groupBy("segment", "doc_no").agg(
        *[F.collect_list(F.struct(n)).alias(n) for n in ("items", "starts", "stops")]) \
        .select("segment", "doc_no", *[F.col(f"{n}.{n}").alias(n)
                                       for n in ("items", "starts", "stops")]) \
        .mapInArrow(_fold, "segment long, doc_no int, item_ids array<string>, "
                    "spans array<struct<start:int,stop:int>>, n_hit long")
    return rows.join(found, ["segment", "doc_no"], "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,stop:int>>)"))
        .alias("spans"), F.col("n_hit").isNotNull().alias("contaminated"))
