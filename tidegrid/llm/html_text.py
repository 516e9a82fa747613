"""HTML extraction: a bidirectional LSTM labels the leaf blocks of a page.

A page is read as its sequence of leaf blocks, each with the path of tags above it.  Hashed tag
path, hashed words and a few figures make a vector per block; a numpy LSTM reads the vectors
forwards and backwards and says of every block, in the light of the whole page, whether it is
main text.

The model learns from a bounded sample of the pages themselves.  Pages that mark their article
teach what is around it; into these, blocks are woven in places where other sites put menus,
notices, forms and comments, and marks are taken away, so that the model reads more than one
layout.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import NOT_SPACE, hashed_runs, map_texts, slice_of

MAX_PAGES = 600
EPOCHS = 10
HIDDEN = 16
PATH_BUCKETS, WORD_BUCKETS, FIGURES = 256, 64, 8
WIDTH = PATH_BUCKETS + WORD_BUCKETS + FIGURES
BATCH_BLOCKS = 16_384

# Elements whose content is never text; the first few run on to the page's end if not closed.
RAW = frozenset("script style textarea".split())
UNSEEN = RAW | frozenset("noscript template svg iframe select".split())
# As in browsers, elements nested deeper than this become neighbours.
MAX_DEPTH = 512
_TAG = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)")
_STOP = re.compile("[>\"']")
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))",
                    re.IGNORECASE)
_NAME = re.compile(r"[a-zA-Z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label "
                   "mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr"
                   .split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start tag of these ends an open one of the same kind.
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
# Names, in tags, classes, ids and roles, that mark a region of a page for teaching.
MAIN = frozenset("article main".split())
AROUND = frozenset(
    "nav header footer aside form button menu ad ads advert advertisement banner sidebar comment "
    "comments reply notice cookie cookies consent newsletter subscribe social share related promo "
    "breadcrumb navigation head title popup modal login search copyright legal".split())


class Block(NamedTuple):
    path: tuple[str, ...]
    text: str
    link_chars: int


class _Scanner:
    """The tags of a page in one pass: every character is looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.lower = page, page.lower()
        if len(self.lower) != len(page):  # a few letters change their length
            self.lower = page
        self.unclosed: set[str] = set()
        self.quotes = True

    def _end_of_tag(self, at: int) -> int:
        """Where the tag that is open at ``at`` ends, after its ``>``; -1 if nowhere.

        A ``>`` in quotes does not count.  Once a quoted value runs to the end of the page, quotes
        are no longer trusted.
        """
        page, start = self.page, at
        while self.quotes:
            found = _STOP.search(page, at)
            if found and found[0] == ">":
                return found.end()
            close = page.find(found[0], found.end()) if found else -1
            if close < 0:
                self.quotes = False
                break
            at = close + 1
        return page.find(">", start) + 1 or -1

    def tokens(self):
        """(from, to, tag, whether an end tag, attributes); tag is None for what is skipped."""
        page, page_end, at = self.page, len(self.page), 0
        while True:
            at = page.find("<", at)
            if at < 0:
                return
            if page.startswith("<!--", at):
                stop = page.find("-->", at + 4)
                stop = stop + 3 if stop >= 0 else page_end
                yield at, stop, None, False, ""
                at = stop
                continue
            if page[at + 1:at + 2] in ("!", "?"):
                stop = page.find(">", at) + 1 if "markup" not in self.unclosed else 0
                if not stop:
                    self.unclosed.add("markup")
                    at += 1
                    continue
                yield at, stop, None, False, ""
                at = stop
                continue
            found = _TAG.match(page, at)
            stop = self._end_of_tag(found.end()) if found and "markup" not in self.unclosed else -1
            if stop < 0:  # no tag: a sign in the text
                if found:
                    self.unclosed.add("markup")
                at += 1
                continue
            tag = found["tag"].lower()
            if tag in UNSEEN and not found["end"]:
                close = self._closing(tag, stop)
                if close is not None:
                    yield at, close, None, False, ""
                    at = close
                    continue
                # not closed: only its start tag goes, the page goes on
                yield at, stop, None, False, ""
            elif tag in UNSEEN:
                yield at, stop, None, False, ""
            else:
                yield at, stop, tag, bool(found["end"]), page[found.end():stop - 1]
            at = stop

    def _closing(self, tag: str, at: int) -> int | None:
        """Where an unseen element ends; None if it is not closed and must not run on."""
        close = -1
        if tag not in self.unclosed:
            close = self.lower.find("</" + tag, at)
        if close < 0:
            self.unclosed.add(tag)
            return len(self.page) if tag in RAW else None
        stop = self.page.find(">", close)
        return stop + 1 if stop >= 0 else len(self.page)


def leaf_blocks(page: str | None) -> list[Block]:
    """Runs of text between block tags, with the tags (and their class words) above them.

    Comments, scripts, styles and other unseen content are skipped; character references are
    decoded and white space becomes one space.  Broken markup is read as far as it goes: an end
    tag closes up to its start tag if there is one, and of unseen elements only scripts, styles and
    text areas run on when they are not closed.  A path names each word once, where it last
    occurs.  The work grows with the page's length.
    """
    if not page:
        return []
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    link, in_link = 0, 0

    def close() -> None:
        nonlocal text, link
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                blocks.append(Block(stack[-1][1] if stack else (), whole, link))
        text, link = [], 0

    at = 0
    for start, stop, tag, ends, attrs in _Scanner(page).tokens():
        if start > at:
            piece = page[at:start]
            text.append(piece)
            link += len(piece) * (in_link > 0)
        at = stop
        if tag is None:
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if ends else 1
            continue
        if tag == "br":
            text.append(" ")
            continue
        close()
        if ends:
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] != tag:
                depth -= 1
            if depth >= 0:
                del stack[depth:]
                in_link = 0
        elif tag not in EMPTY:
            if stack and (tag in SELF_CLOSING and stack[-1][0] == tag or len(stack) >= MAX_DEPTH):
                stack.pop()
            names = [tag]
            if attrs:
                for found in _MARKS.finditer(attrs):
                    names += [x.lower() for x in _NAME.findall(found[1] or found[2] or found[3] or "")]
            above = stack[-1][1] if stack else ()
            own = dict.fromkeys(reversed(names))
            path = [n for n in above if n not in own] + list(reversed(own))
            stack.append((tag, tuple(path)))
    if at < len(page):
        text.append(page[at:])
    close()
    return blocks


def guessed_labels(blocks: list[Block]) -> list[int]:
    """1 for blocks that look like running text, for sites that mark no article anywhere."""
    out = []
    for b in blocks:
        words = b.text.split()
        prose = len(words) >= 8 or len(words) >= 4 and b.text[-1:] in ".!?"
        out.append(int(prose and 3 * b.link_chars <= len(b.text) and not set(b.path) & AROUND))
    return out


def taught_labels(blocks: list[Block]) -> list[int] | None:
    """1 for blocks of a marked article, 0 for others; None if the page marks none."""
    labels, seen = [], False
    for b in blocks:
        regions = [n in MAIN for n in b.path if n in MAIN or n in AROUND]
        inside = bool(regions) and regions[-1] and not set(b.path) & {"head", "nav"}
        seen |= inside
        labels.append(int(inside))
    return labels if seen else None


_PLACES = [p.split() for p in (
    "html body nav ul li|html body header div|html body div menu ul li|html body aside div p|"
    "html body div sidebar ul li|html body div sidebar p|html body div notice p|html body div cookie p|"
    "html body div notice|html body form label|html body form p|html body section comments div comment p|"
    "html body div comments p|html body div comment|html body div ad|html body div banner|"
    "html body footer p|html body div footer|html body div related ul li|html body div share|"
    "html body article aside p|html body article div ad|html body article section comments p|"
    "html body article form p|html body article footer p|html body article nav ul li|"
    "html body main aside p|html body main form div|html body main div comments p|html body div newsletter p"
).split("|")]
_HOMES = [p.split() for p in (
    "html body article|html body main|html body main article|html body div content|"
    "html body div main|html body div post|html body div article body|html body section content|"
    "html body div wrapper article|html body div container main").split("|")]


def varied(blocks: list[Block], labels: list[int], pool: list[str],
           rnd: random.Random) -> tuple[list[Block], list[int]]:
    """The page in another layout: its article elsewhere, other blocks woven in."""
    home = rnd.choice(_HOMES) if rnd.random() < 0.6 else None
    out: list[tuple[Block, int]] = []
    for b, y in zip(blocks, labels):
        if y and home:
            after = [i for i, n in enumerate(b.path) if n in MAIN]
            b = b._replace(path=tuple(home) + b.path[after[-1] + 1 if after else len(b.path):])
        out.append((b, y))
    for _ in range(rnd.randrange(0, 6)):
        place = tuple(rnd.choice(_PLACES))
        at, many = rnd.randrange(0, len(out) + 1), rnd.randrange(1, 4)
        woven = []
        for _ in range(many):
            words = rnd.choice(pool).split()
            lo = rnd.randrange(0, len(words))
            some = " ".join(words[lo:lo + rnd.choice([2, 5, 12, 40, 100])])
            woven.append((Block(place, some, len(some) if rnd.random() < 0.3 else 0), 0))
        out[at:at] = woven
    return [b for b, _ in out], [y for _, y in out]


def _bucket(name: str, leaf: bool) -> int:
    value = 7 if leaf else 1
    for c in name.encode():
        value = (value * 31 + c) & 0xFFFFFFFF
    return (value * 2654435761 & 0xFFFFFFFF) * PATH_BUCKETS >> 32


_PATHS: dict[tuple, list[int]] = {}


def _path_buckets(path: tuple[str, ...]) -> list[int]:
    if path not in _PATHS:
        if len(_PATHS) > 20_000:
            _PATHS.clear()
        _PATHS[path] = sorted({_bucket(n, False) for n in path}
                              | {_bucket(n, True) for n in path[-2:]})
    return _PATHS[path]


def vectors(blocks: list[Block]) -> np.ndarray:
    """A row for each block: hashed path, hashed words, figures."""
    x = np.zeros((len(blocks), WIDTH), np.float32)
    rows, cols = [], []
    for i, b in enumerate(blocks):
        at = _path_buckets(b.path)
        rows += [i] * len(at)
        cols += at
    x[rows, cols] = 1
    texts = [b.text for b in blocks]
    hashes, owner = hashed_runs(texts, NOT_SPACE)
    n_words = np.bincount(owner, minlength=len(blocks)) if len(owner) else np.zeros(len(blocks))
    if len(owner):
        bucket = (hashes >> np.uint64(58)).astype(np.int64)
        counts = np.bincount(owner * WORD_BUCKETS + bucket, minlength=len(blocks) * WORD_BUCKETS)
        x[:, PATH_BUCKETS:PATH_BUCKETS + WORD_BUCKETS] = \
            counts.reshape(-1, WORD_BUCKETS) / np.sqrt(np.maximum(n_words, 1))[:, None]
    chars = np.array([len(t) for t in texts])
    stops = np.array([sum(map(t.count, ".,;!?")) for t in texts])
    links = np.array([b.link_chars for b in blocks])
    figures = x[:, PATH_BUCKETS + WORD_BUCKETS:]
    figures[:, 0] = np.log1p(n_words) / 5
    figures[:, 1] = np.minimum(1, links / np.maximum(chars, 1))
    figures[:, 2] = np.minimum(1, 4 * stops / np.maximum(n_words, 1))
    figures[:, 3] = n_words < 5
    figures[:, 4] = n_words > 30
    figures[:, 5] = np.arange(len(blocks)) / max(1, len(blocks))
    figures[:, 6] = [t.startswith("©") for t in texts]
    figures[:, 7] = 1
    return x


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Bidirectional LSTM with a logistic output for each block."""

    NAMES = ("wx_f", "wh_f", "b_f", "wx_b", "wh_b", "b_b", "out", "bias")

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 5):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.w = weights or {
            name: (rng.normal(0, 0.1, shape) if name[0] != "b" else np.zeros(shape))
            .astype(np.float32)
            for name, shape in (("wx_f", (WIDTH, 4 * h)), ("wh_f", (h, 4 * h)), ("b_f", 4 * h),
                                ("wx_b", (WIDTH, 4 * h)), ("wh_b", (h, 4 * h)), ("b_b", 4 * h),
                                ("out", 2 * h), ("bias", 1))}

    def _pass(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None = None):
        """Hidden states over time; where the mask is 0 the state goes on unchanged."""
        steps, batch, h = x.shape[0], x.shape[1], HIDDEN
        pre = x @ self.w["wx_" + side] + self.w["b_" + side]
        state, cell = np.zeros((batch, h), np.float32), np.zeros((batch, h), np.float32)
        out = np.zeros((steps, batch, h), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            gates = pre[t] + state @ self.w["wh_" + side]
            i, f, o = (_sigmoid(gates[:, k * h:(k + 1) * h] + (k == 1)) for k in range(3))
            g = np.tanh(gates[:, 3 * h:])
            new = f * cell + i * g
            squashed = np.tanh(new)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, state, cell, i, f, o, g, squashed, m))
            state = m * o * squashed + (1 - m) * state
            cell = m * new + (1 - m) * cell
            out[t] = state
        return out

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(steps, pages) from (steps, pages, width)."""
        both = np.concatenate([self._pass(x, mask, "f"), self._pass(x, mask, "b")], 2)
        return _sigmoid(both @ self.w["out"] + self.w["bias"])

    def gradients(self, x, y, mask) -> dict[str, np.ndarray]:
        kept: dict[str, list] = {"f": [], "b": []}
        outs = {s: self._pass(x, mask, s, kept[s]) for s in "fb"}
        both = np.concatenate([outs["f"], outs["b"]], 2)
        err = (_sigmoid(both @ self.w["out"] + self.w["bias"]) - y) * mask / mask.sum()
        grad = {"out": np.tensordot(err, both, ((0, 1), (0, 1))),
                "bias": np.array([err.sum()], np.float32)}
        d_both = err[:, :, None] * self.w["out"]
        h = HIDDEN
        for s, part in (("f", d_both[:, :, :h]), ("b", d_both[:, :, h:])):
            d_pre = np.zeros((*x.shape[:2], 4 * h), np.float32)
            d_wh = np.zeros_like(self.w["wh_" + s])
            d_state, d_cell = np.zeros_like(part[0]), np.zeros_like(part[0])
            for t, state, cell, i, f, o, g, squashed, m in reversed(kept[s]):
                d_state = d_state + part[t]
                d_new = d_cell * m + d_state * m * o * (1 - squashed ** 2)
                gates = np.concatenate([d_new * g * i * (1 - i), d_new * cell * f * (1 - f),
                                        d_state * m * squashed * o * (1 - o),
                                        d_new * i * (1 - g ** 2)], 1)
                d_pre[t] = gates
                d_wh += state.T @ gates
                d_state = d_state * (1 - m) + gates @ self.w["wh_" + s].T
                d_cell = d_cell * (1 - m) + d_new * f
            grad["wx_" + s] = np.tensordot(x, d_pre, ((0, 1), (0, 1)))
            grad["wh_" + s], grad["b_" + s] = d_wh, d_pre.sum((0, 1))
        return grad

    def learn(self, pages: list[tuple[np.ndarray, np.ndarray]], rnd: random.Random,
              epochs: int = EPOCHS, batch: int = 32, rate: float = 0.01) -> None:
        """Adam over batches of pages of similar length."""
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        groups = [order[i:i + batch] for i in range(0, len(order), batch)]
        step = 0
        for _ in range(epochs):
            rnd.shuffle(groups)
            for group in groups:
                x, mask = padded([pages[i][0] for i in group])
                y = np.zeros(mask.shape, np.float32)
                for k, i in enumerate(group):
                    y[:len(pages[i][1]), k] = pages[i][1]
                step += 1
                for name, g in self.gradients(x, y, mask).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.99 * second[name] + 0.01 * g * g
                    self.w[name] = (self.w[name] - rate * (first[name] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), WIDTH), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, 1
    return x, mask


def fit(pages: DataFrame, text: str = "html", max_pages: int = MAX_PAGES) -> DataFrame:
    """One row with the weights, by name, learnt from about ``max_pages`` pages in one task.

    The sample is the marked pages (those with an ``article`` or ``main`` tag) whose hash is lowest,
    or all if there are fewer; equal pages are one.  Where no page is marked, the sample is of all
    pages, and running text outside of menus, forms and the like teaches.  No page, no row.
    """
    named = pages.where(F.col(text).isNotNull()).select(F.col(text).alias("html"))
    mark = F.col("html").rlike(r"(?i)<(?:article|main)[\s>]")
    n = named.agg(F.count_if(mark).alias("marked"), F.count(F.lit(1)).alias("n")).first()
    chosen = named.where(mark) if n.marked else named
    share = int((1 << 30) * min(1.0, max_pages / max(1, n.marked or n.n)))
    sample = chosen.where(slice_of(chosen, 1 << 30) < share).distinct()
    marked = n.marked > 0

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for page in sorted(p for b in batches for p in b.column("html").to_pylist()):
            blocks = leaf_blocks(page)
            labels = taught_labels(blocks) if marked else guessed_labels(blocks)
            if labels:
                found.append((blocks, labels))
        rnd = random.Random(11)
        pool = [b.text for blocks, _ in found for b in blocks]
        taught = []
        for blocks, labels in found:
            # long pages in stretches: what is around a stretch is still seen, training is even
            taught.append((blocks, labels))
            taught.append(varied(blocks, labels, pool, rnd))
        taught = [(vectors(b[i:i + 200]), np.array(y[i:i + 200], np.float32))
                  for b, y in taught for i in range(0, len(b), 200)]
        if not taught:
            return
        model = BlockLabeller()
        model.learn(taught, rnd)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(model.NAMES)),
             pa.array([model.w[n].astype("<f4").tobytes() for n in model.NAMES], pa.binary())],
            names=["name", "weights"])

    return sample.repartition(1).mapInArrow(learn, "name string, weights binary")


def main_text(pages: DataFrame, text: str = "html", model: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text, and ``n_chars``, its code points.

    Null and empty pages, and pages without a main block, give "".  Without ``model`` one is
    learnt from a sample of ``pages`` (:func:`fit`).  Pages are labelled whole, however long or
    broken; repeated rows fare alike, an empty table stays empty.  Input columns of these names are
    replaced.
    """
    rows = (fit(pages, text) if model is None else model).collect()
    shared = pages.sparkSession.sparkContext.broadcast({r["name"]: r["weights"] for r in rows})
    shapes = {n: w.shape for n, w in BlockLabeller().w.items()}

    def make():
        weights = {n: np.frombuffer(b, "<f4").reshape(shapes[n]) for n, b in shared.value.items()}
        own = BlockLabeller(weights) if weights else None

        def work(htmls: list) -> dict:
            found = [leaf_blocks(h) for h in htmls]
            out = [""] * len(found)
            order = sorted((i for i, b in enumerate(found) if b and own), key=lambda i: len(found[i]))
            while order:  # longest first: a group's first page says how long all are padded
                many = max(1, BATCH_BLOCKS // len(found[order[-1]]))
                group, order = order[-many:][::-1], order[:-many]
                every = vectors([b for i in group for b in found[i]])
                cuts = np.cumsum([len(found[i]) for i in group])[:-1]
                p = own.probabilities(*padded(np.split(every, cuts)))
                for k, i in enumerate(group):
                    out[i] = " ".join(b.text for b, q in zip(found[i], p[:, k]) if q >= 0.5)
            return {"text": out, "n_chars": [len(t) for t in out]}
        return work
    base = pages.withColumnRenamed(text, "_html") if text.lower() in ("text", "n_chars") else pages
    return map_texts(base, "_html" if base is not pages else text, "text string, n_chars long", make)
