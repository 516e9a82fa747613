"""A piece vocabulary in a double-array trie, matched at every position of many words at once."""

from __future__ import annotations

import numpy as np
import sentencepiece

MARK = "▁".encode()


class DoubleArray:
    """Trie over byte strings: child ``c`` of node ``s`` is ``base[s] + c`` if its check is s."""

    def __init__(self, words: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for word, value in sorted(words.items()):
            node = 0
            for byte in word:
                after = children[node].get(byte)
                if after is None:
                    after = children[node][byte] = len(children)
                    children.append({})
                    values.append(-1)
                node = after
            values[node] = value
        size = 4 * len(children) + 4096
        base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        value, used = np.full(size, -1, np.int32), np.zeros(size, bool)
        used[0], check[0] = True, 0
        # families of siblings look for room from ``tail`` on, single children fill the holes
        place, queue, tail = np.zeros(len(children), np.int64), [0], 257
        alone = []
        for node in queue:
            queue.extend(children[node].values())
            if len(children[node]) < 2:
                alone.append(node)
        for node in queue:
            codes = np.array(sorted(children[node]), np.int64)
            if len(codes) < 2:
                continue
            while True:
                starts = np.arange(tail, tail + 512)
                fits = np.flatnonzero(~used[starts[:, None] + (codes - codes[0])].any(1))
                if len(fits):
                    break
                tail += 256
            start = int(starts[fits[0]] - codes[0])
            base[node] = start
            used[start + codes] = True
            for c in codes.tolist():
                place[children[node][c]] = start + c
            tail += max(0, int(fits[0]) - 64)
        holes = iter(np.flatnonzero(~used[257:]) + 257)
        for node in alone:
            for c, child in children[node].items():
                place[child] = next(holes)
                base[node] = place[child] - c
        own = base[:len(children)].copy()
        base[:] = 0
        for node in queue:
            base[place[node]] = own[node]
            value[place[node]] = values[node]
            for child in children[node].values():
                check[place[child]] = place[node]
        last = int(np.flatnonzero(check >= 0)[-1]) + 257
        self.base, self.check, self.value = base[:last], check[:last], value[:last]

    def matches(self, data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, length, value) of every word that starts at a position and fits its room."""
        at, state = np.arange(len(data)), np.zeros(len(data), np.int64)
        starts, lengths, found, depth = [], [], [], 0
        while len(at):
            fits = room[at] > depth
            at, state = at[fits], state[fits]
            after = self.base[state] + data[at + depth]
            on = (after < len(self.check)) & (after > 0)
            on[on] = self.check[after[on]] == state[on]
            at, state = at[on], after[on]
            depth += 1
            value = self.value[state]
            hit = value >= 0
            starts.append(at[hit])
            lengths.append(np.full(int(hit.sum()), depth))
            found.append(value[hit])
        if not starts:
            return (np.zeros(0, np.int64),) * 3
        return np.concatenate(starts), np.concatenate(lengths), np.concatenate(found)


def log_scores(scores: np.ndarray) -> np.ndarray:
    """A file's scores as logs of probabilities.

    Files made by pair merging hold minus the rank instead: the whole numbers from 0 down.
    Pieces are then given Zipf's law, a probability in proportion to 1 / (rank + 2.7).
    """
    if not (scores == np.round(scores)).all():
        return scores
    weight = 1 / (2.7 - scores)
    return np.log(weight / weight.sum())


class Vocabulary:
    """Pieces, scores and byte pieces of a public tokenizer's file."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i).encode() for i in range(n)]
        self.scores = log_scores(np.array([sp.get_score(i) for i in range(n)], np.float64))
        self.byte_ids = np.full(256, -1, np.int64)
        words = {}
        for i, piece in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.pieces[i] = bytes([int(piece[3:5], 16)])
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.pieces[i] = b""
            else:
                words[piece] = i
        self.unknown_score = min(self.scores[i] for i in words.values()) - 10.0
        self.trie = DoubleArray(words)
        # a mark inside a piece, after another character, would tie words together
        self.words_apart = not any(MARK in w.lstrip(MARK) for w in words)


class Lattice:
    """All matches in a batch of words, in the order in which a pass over positions needs them.

    Word w takes the nodes ``first[w]`` to ``first[w] + len(w)``; an edge leads from node to
    node.  ``steps`` are runs of edges that end equally far into their words: within a run no
    edge starts where another ends.
    """

    def __init__(self, words: list[bytes], trie: DoubleArray, more=None):
        sizes = np.array([len(w) for w in words], np.int64)
        self.words = len(words)
        self.first = np.cumsum(sizes + 1) - (sizes + 1)
        self.last = self.first + sizes
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), sizes + 1)
        room = self.last[owner] - np.arange(len(data))
        start, length, piece = trie.matches(data, room)
        if more is not None:
            extra = more(data, room, start, length)
            start, length, piece = (np.concatenate(x) for x in
                                    zip((start, length, piece), *extra))
        end = start + length
        depth = end - self.first[owner[start]]
        by = np.lexsort((start, end, depth))
        self.start, self.end, self.piece = start[by], end[by], piece[by]
        depth = depth[by]
        self.nodes = len(data)
        cuts = np.flatnonzero(np.diff(depth)) + 1
        self.steps = list(zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(depth)].tolist())) \
            if len(depth) else []
        self.heads = np.flatnonzero(np.r_[True, self.end[1:] != self.end[:-1]]) \
            if len(depth) else np.zeros(0, np.int64)
        self.groups = np.searchsorted(self.heads, [b for _, b in self.steps]).tolist()

    def runs(self):
        """(edges from, to, heads of equal ends within them)."""
        g = 0
        for (lo, hi), stop in zip(self.steps, self.groups):
            yield lo, hi, self.heads[g:stop]
            g = stop
