"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

White space becomes a mark, a mark goes before the text, and the best-scoring sequence of pieces
is found; a character that no piece holds falls back to its bytes.  Pieces never reach over the
start of a word, so a text's pieces are those of its words, and each distinct word of a batch is
searched once, all of them side by side.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame

from tidegrid.llm.common import map_texts
from tidegrid.llm.packing import public_path
from tidegrid.llm.pieces import MARK, Lattice, Vocabulary

_WORD = re.compile(rb"(?:\xe2\x96\x81)*(?:(?!\xe2\x96\x81).)*", re.DOTALL)


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, scores: np.ndarray | None = None):
        self.vocabulary = Vocabulary(path)
        self.scores = self.vocabulary.scores if scores is None else scores
        self.unknown = len(self.vocabulary.pieces)
        self.edge_scores = np.append(self.scores, self.vocabulary.unknown_score)
        sizes = [len(p) for p in self.vocabulary.pieces]
        self.size, self.place = np.array(sizes), np.cumsum(sizes) - np.array(sizes)
        self.bytes = np.frombuffer(b"".join(self.vocabulary.pieces), np.uint8)

    def split(self, text: str) -> list[bytes]:
        marked = MARK + text.replace(" ", "▁").encode()
        return _WORD.findall(marked)[:-1] if self.vocabulary.words_apart else [marked]

    def _fallback(self, data, room, start, length):
        """An edge over every character that is no piece by itself."""
        head = np.flatnonzero((room > 0) & ((data & 0xC0) != 0x80))
        byte = data[head]
        size = 1 + (byte >= 0xC0) + (byte >= 0xE0) + (byte >= 0xF0)
        whole = np.zeros(len(data), np.int64)
        whole[head] = size
        known = np.zeros(len(data), bool)
        known[start[length == whole[start]]] = True
        open_ = head[~known[head]]
        yield open_, whole[open_], np.full(len(open_), self.unknown)

    def words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word on its best path; of equal paths, that of the longest last piece."""
        v = self.vocabulary
        lattice = Lattice(words, v.trie, self._fallback)
        best = np.full(lattice.nodes, -np.inf)
        best[lattice.first] = 0
        via = np.zeros(lattice.nodes, np.int64)
        score = self.edge_scores[lattice.piece]
        for lo, hi, heads in lattice.runs():
            value = best[lattice.start[lo:hi]] + score[lo:hi]
            top = np.maximum.reduceat(value, heads - lo)
            group = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, hi]))
            tops = np.flatnonzero(value == top[group])
            _, one = np.unique(group[tops], return_index=True)
            best[lattice.end[heads]] = top
            via[lattice.end[heads]] = lo + tops[one]
        node, open_, steps = lattice.last.copy(), np.arange(len(words)), []
        while len(open_):
            open_ = open_[node[open_] > lattice.first[open_]]
            edge = via[node[open_]]
            steps.append((open_, edge))
            node[open_] = lattice.start[edge]
        owner = np.concatenate([o for o, _ in steps])
        edge = np.concatenate([e for _, e in steps])
        order = np.lexsort((edge_start := lattice.start[edge], owner))
        owner, edge = owner[order], edge[order]
        ids = lattice.piece[edge]
        lost = np.flatnonzero(ids == self.unknown)
        if len(lost):  # characters that fall back: one id for each of their bytes
            joined = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
            size = np.ones(len(ids), np.int64)
            size[lost] = lattice.end[edge[lost]] - lattice.start[edge[lost]]
            owner, wide = np.repeat(owner, size), np.repeat(ids, size)
            at = np.flatnonzero(wide == self.unknown)
            ends = np.cumsum(size)
            within = at - np.repeat(ends - size, size)[at]
            wide[at] = v.byte_ids[joined[np.repeat(lattice.start[edge], size)[at] + within]]
            ids = wide
        del edge_start
        return np.split(ids, np.searchsorted(owner, np.arange(1, len(words))))

    def encode(self, texts: list) -> list[np.ndarray]:
        split = [self.split(t) if t else [] for t in texts]
        number: dict[bytes, int] = {}
        at = np.array([number.setdefault(w, len(number)) for s in split for w in s], np.int64)
        if not number:
            return [np.zeros(0, np.int64) for _ in texts]
        ids = self.words(list(number))
        size = np.array([len(x) for x in ids])
        start = np.cumsum(size) - size
        flat, lens = np.concatenate(ids), size[at]
        ends = np.cumsum(lens)
        out = flat[np.repeat(start[at] - ends + lens, lens) + np.arange(int(ends[-1]))]
        last = np.cumsum([len(s) for s in split]).astype(np.int64)
        return np.split(out, np.r_[0, ends][last][:-1])

    def decode(self, ids: np.ndarray) -> str:
        """Text of the pieces; marks are spaces, the first of them goes, odd bytes are U+FFFD."""
        if not len(ids):
            return ""
        size = self.size[ids]
        ends = np.cumsum(size)
        raw = self.bytes[np.repeat(self.place[ids] - ends + size, size) + np.arange(int(ends[-1]))]
        text = raw.tobytes().decode("utf-8", "replace").replace("▁", " ")
        return text[1:] if text.startswith(" ") else text


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, one per Python process."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, path: str | None = None, text: str = "text",
           ids: str = "ids") -> DataFrame:
    """``docs`` with the array column ``ids``; empty for null and empty texts."""
    path = path or public_path("piece_bpe_32k.model")

    def make():
        own = codec(path)
        return lambda texts: {ids: [x.astype(np.int32) for x in own.encode(texts)]}
    return map_texts(docs, text, f"{ids} array<int>", make)


def encoding_facts(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_ids``, ``n_byte_ids``, ``ids_crc32`` (unsigned, little-endian 32-bit
    ids), the ``decoded`` text and ``round_trip``: whether that is the text (null as empty).

    A text that holds the mark itself comes back with a space in its place and is no round
    trip.  Input columns of these names are replaced.
    """
    path = path or public_path("piece_bpe_32k.model")

    def make():
        own = codec(path)
        is_byte = np.zeros(len(own.vocabulary.pieces), bool)
        is_byte[own.vocabulary.byte_ids] = True

        def work(texts: list) -> dict:
            found = own.encode(texts)
            back = [own.decode(x) for x in found]
            return {"n_ids": [len(x) for x in found],
                    "n_byte_ids": [int(is_byte[x].sum()) for x in found],
                    "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in found],
                    "decoded": back, "round_trip": [b == (t or "") for b, t in zip(back, texts)]}
        return work
    return map_texts(docs, text, "n_ids long, n_byte_ids long, ids_crc32 long, decoded string, "
                                 "round_trip boolean", make)
