"""Packing: first-fit decreasing over a tournament tree of bin capacities.

Documents are tokenised where they are and cut into whole sequences and a rest.  Only the
rests' sizes travel: they are dealt by a hash into groups of bounded size, each packed alone.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegrid.llm.common import LOWER, chunks, run_hashes

SEQUENCE = 4096
END_ID = 2
GROUP_PIECES = 4096
COPY_RUN = 100_000
CACHED_PARTS = 500_000
# Text worked on at once; a byte takes some hundred bytes of arrays meanwhile.
TEXT_AT_ONCE = 1_000_000

# Texts of these characters are in NFC already and lower-case the same way everywhere.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
# What a byte of a plain text is: white space, a letter (or part of one), a digit, anything else.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.array([_SPACE if b in b" \t\n\x0b\x0c\r" else _DIGIT if 0x30 <= b <= 0x39
                  else _LETTER if 0x61 <= b <= 0x7A or b >= 0x80 else _OTHER for b in range(256)])


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def lowered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Plain texts as lower-case bytes, a space after each, and where each one ends."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    data = LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    # the two-byte letters from U+00C0 to U+00DE, apart from the multiplication sign
    upper = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    data[1:][upper] += 0x20
    return data, ends


def pre_tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the tokenizer's pre-tokens in plain lower-case text.

    They are runs of letters, single digits, runs of anything else, and after an apostrophe that
    begins such a run the contractions 's 't 're 've 'm 'll 'd as one.
    """
    kind = np.zeros(len(data) + 4, np.int8)
    kind[1:len(data) + 1] = _KIND[data]
    begins = (kind[1:] != kind[:-1]) & (kind[1:] != _SPACE) | (kind[1:] == _DIGIT)
    at = np.flatnonzero(begins[:len(data)] & (data == 0x27) & (kind[2:len(data) + 2] == _LETTER))
    if len(at):
        one, two = (np.append(data, [0, 0, 0]).astype(np.uint8)[at + k] for k in (1, 2))
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        pair = np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e")) \
            | (one == ord("l")) & (two == ord("l"))
        size = np.where(short, 2, np.where(pair, 3, 0))
        at, size = at[size > 0], size[size > 0]
        begins[at + 1] = False
        begins[at + size] = kind[at + size + 1] != _SPACE
    begins = begins[:len(data)]
    starts = np.flatnonzero(begins)
    inside = kind[1:len(data) + 1] != _SPACE
    last = inside & np.append(begins[1:] | ~inside[1:], True)
    return starts, np.flatnonzero(last) + 1


class WordIds:
    """Ids of the tokenizer's pre-tokens, each encoded once.

    The tokenizer drops white space and never merges across it or across pre-tokens, so a text's ids
    are those of its pre-tokens in turn.  Unseen ones are encoded many at a time, and fall apart
    again at the ids that end a word.  They are told apart by 64-bit hashes.  Texts that the split
    could treat differently (other scripts, special tokens) go word by word, their own words whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.number: dict[int, int] = {}
        self.flat, self.start = array("I"), array("q", [0])

    def _put(self, keys: list[int], ids, ends) -> None:
        """New entries: their ids one after the other, and where each one's end."""
        base, n = len(self.flat), len(self.start) - 1
        self.flat.extend(ids)
        self.start.extend((np.asarray(ends, np.int64) + base).tolist())
        self.number.update(zip(keys, range(n, n + len(keys))))

    def _encode_alone(self, keys: list[int], parts: list[bytes]) -> None:
        for key, part in zip(keys, parts):
            ids = self.tokenizer.encode(part.decode(), add_special_tokens=False).ids
            self._put([key], ids, [len(ids)])

    def learn(self, keys: list[int], parts: list[bytes], plain: bool) -> None:
        if not plain:
            self._encode_alone(keys, parts)
            return
        for i in range(0, len(parts), 2000):
            some = parts[i:i + 2000]
            ids = self.tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False).ids
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                self._put(keys[i:i + 2000], ids, ends)
            else:
                self._encode_alone(keys[i:i + 2000], some)

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries ``at`` one after the other, and where each entry's end."""
        start = np.frombuffer(self.start, np.int64)
        size = (start[1:] - start[:-1])[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        if not total:
            return np.zeros(0, np.uint32), ends
        flat = np.frombuffer(self.flat, np.uint32)
        return flat[np.repeat(start[at] - ends + size, size) + np.arange(total)], ends

    def _ids(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, salt: int,
             plain: bool) -> tuple[np.ndarray, np.ndarray]:
        hashed, first, which = np.unique(run_hashes(data, starts, stops) ^ np.uint64(salt),
                                         return_index=True, return_inverse=True)
        keys = hashed.tolist()
        missing = [i for i, k in enumerate(keys) if k not in self.number]
        if missing:
            if len(self.number) + len(missing) > CACHED_PARTS:
                self.clear()
                missing = list(range(len(keys)))
            raw = data.tobytes()
            at = first[missing]
            self.learn([keys[i] for i in missing],
                       [raw[s:e] for s, e in zip(starts[at].tolist(), stops[at].tolist())], plain)
        at = np.fromiter(map(self.number.__getitem__, keys), np.int64, len(keys))
        return self._gather(at[which])

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        data, ends = lowered(texts)
        starts, stops = pre_tokens(data)
        ids, ids_end = self._ids(data, starts, stops, 0, True)
        last = np.searchsorted(starts, ends)
        return np.split(ids, np.r_[0, ids_end][last][:-1])

    def _any(self, text: str) -> np.ndarray:
        """A text word by word: runs of plain words together, others alone."""
        out = []
        for plain, words in groupby(text.encode().split(), lambda w: bool(
                _PLAIN.fullmatch(w.decode())) and b"<|" not in w):
            words = list(words)
            if plain:
                out += self._plain([b" ".join(words)])
            else:
                data = np.frombuffer(b" ".join(words), np.uint8)
                stops = np.cumsum([len(w) + 1 for w in words]) - 1
                out.append(self._ids(data, np.r_[0, stops[:-1] + 1], stops, 1, False)[0])
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def encode(self, texts: list) -> list[np.ndarray]:
        """The ids of each text; none for null, empty and blank texts."""
        texts = [t or "" for t in texts]
        plain = [i for i, t in enumerate(texts) if _PLAIN.fullmatch(t) and "<|" not in t]
        out: list = [None] * len(texts)
        for i, ids in zip(plain, self._plain([texts[i].encode() for i in plain]) if plain else ()):
            out[i] = ids
        return [self._any(t) if ids is None else ids for t, ids in zip(texts, out)]


# One per Python worker and file: workers live on from task to task.
_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def first_fit_decreasing(sizes: np.ndarray, capacity: int = SEQUENCE) -> tuple[list, list]:
    """(bin, offset) of each size, in bins of ``capacity``; ties keep the given order.

    Leaves of the tree are the capacities left in the bins, inner nodes the larger of their
    two children: the first bin that fits is found by going left wherever the left child fits.
    """
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node >>= 1
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins, offsets


def token_pieces(docs: DataFrame, path: str, key: str, text: str, with_ids: bool) -> DataFrame:
    """One row per piece of each document: all of 4096 tokens but the last."""
    base = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    key_type = base.schema["_key"].dataType.simpleString()
    schema = f"`{key}` {key_type}, start long, length long, ids_crc32 long, doc_tokens long" \
        + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path).encode
        for batch in batches:
            for lo, hi, texts in chunks(batch.column("_text"), TEXT_AT_ONCE):
                row, start, length, crc, whole, parts = [], [], [], [], [], []
                for i, ids in enumerate(encode(texts)):
                    ids = np.append(ids, END_ID).astype("<u4")
                    for at in range(0, len(ids), SEQUENCE):
                        piece = ids[at:at + SEQUENCE]
                        row.append(lo + i)
                        start.append(at)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        whole.append(len(ids))
                        if with_ids:
                            parts.append(piece)
                keys = batch.column("_key").take(pa.array(row, pa.int64()))
                columns = [keys] + [pa.array(c, pa.int64()) for c in (start, length, crc, whole)]
                if with_ids:
                    columns.append(pa.array(parts, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    columns, names=[key, "start", "length", "ids_crc32", "doc_tokens"]
                    + ["ids"] * with_ids)

    return base.mapInArrow(run, schema)


def pack(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text",
         with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens.

    Columns: ``key``, ``start`` (tokens of the document before the piece), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and the ids
    themselves with ``with_ids``.  A document's tokens are its ids and one end id, so a null or
    empty text is one token.  A piece of 4096 tokens is a sequence of its own; rests of
    documents are packed in groups of about 4096, dealt by a hash of the piece and, for repeated
    rows, of the copy's number.  Null keys are packed like any others, an empty table gives an empty
    one; other columns of ``docs`` are left out.
    """
    groups = max(1, -(-docs.count() // GROUP_PIECES))
    pieces = token_pieces(docs, path or public_path("word_bpe_49k.json"), key, text, with_ids)
    # equal rows are counted and numbered, in runs, so that they too are dealt evenly
    names = pieces.columns
    counted = pieces.groupBy(*[f"`{n}`" for n in names]).agg(F.count(F.lit(1)).alias("_copies"))
    runs = counted.withColumn("_run", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPY_RUN).cast("long"))))
    pieces = runs.withColumn("_copy", F.explode(F.sequence(
        "_run", F.least(F.col("_run") + COPY_RUN, F.col("_copies")) - 1)))
    pieces = pieces.withColumn("_group", F.pmod(F.xxhash64(
        key, "start", "length", "ids_crc32", "_copy"), F.lit(groups)).cast("long"))
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes if n in names) \
        + ", sequence_id long, offset long"

    def fill(group: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in ("length", "ids_crc32", "start", key)]
        group = group.sort_by(order)
        number = group.column("_group")[0].as_py()
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy())
        return group.select(names) \
            .append_column("sequence_id", pa.array([number << 32 | b for b in bins], pa.int64())) \
            .append_column("offset", pa.array(offsets, pa.int64()))

    return pieces.select(*[f"`{n}`" for n in names], "_group").groupBy("_group").applyInArrow(fill, schema)
