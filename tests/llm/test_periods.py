"""Periodic runs against their definition, on small alphabets, nested repeats and whole tables."""

import hashlib
import random
import zlib

import numpy as np

from tidegrid.llm.common import mix64
from tidegrid.llm.periods import find_runs, find_runs_of_texts, periodic_runs


def brute(words):
    """Every maximal stretch of each lag; kept if no smaller lag holds all over it."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([number[w] for w in words], np.int64)
    n, out = len(x), []
    for q in range(1, n // 2 + 1):
        same = np.r_[False, x[:-q] == x[q:], False]
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), (edges[1::2] + q).tolist()):
            if e - s >= max(12, 2 * q) and not any(
                    (x[s:e - p] == x[s + p:e]).all() for p in range(1, q)):
                out.append((s, e, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def hashed(words):
    return mix64(np.array(words, np.uint64) + np.uint64(77))


def cases():
    dice = random.Random(4)
    for letters in (1, 2, 3, 40):
        for _ in range(6):
            yield [dice.randrange(letters) for _ in range(dice.randrange(0, 260))]
    for unit in list(range(46, 56)) + [64, 95, 96, 97, 110]:
        for letters in (1, 2, 6):
            block = [dice.randrange(letters) for _ in range(unit)]
            whole = block * 2 + block[:dice.randrange(unit)]
            yield [9] * dice.randrange(5) + whole + [7] * dice.randrange(20)
    # short runs that fill whole windows of larger ones, broken in all sorts of places
    for _ in range(60):
        p = dice.randrange(1, 7)
        short = [dice.randrange(2) for _ in range(p)] * 60
        block = short[:dice.randrange(40, 130)] + [5] * dice.randrange(0, 3) \
            + short[:dice.randrange(0, 60)]
        yield [3] * dice.randrange(3) + block * 2 + block[:dice.randrange(len(block))] \
            + short[:dice.randrange(50)]
    # two stretches of one short period that meet out of phase: a square across the joint
    for p in (2, 3, 5, 6):
        short = [i % p for i in range(200)]
        for cut in range(1, p):
            yield short[:130] + short[cut:cut + 130]
            yield short[:60] + short[cut:cut + 120] + short[:90]


def test_against_the_definition():
    for words in cases():
        assert find_runs(hashed(words)) == brute(words), words


def test_texts_in_a_row_do_not_mix():
    some = list(cases())
    got = find_runs_of_texts(np.concatenate([hashed(w) for w in some]),
                             np.array([len(w) for w in some]))
    assert got == [brute(w) for w in some]


def test_one_word_and_two_words_without_end():
    n = 300_000
    assert find_runs(hashed([1] * n)) == [(0, n, 1)]
    words = [1] * n + [2] * n
    assert find_runs(hashed(words)) == [(0, n, 1), (n, 2 * n, 1)]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2])) if runs else None
    facts = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) \
        if best else (None,) * 4
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *facts, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def test_query_rows(spark, sf_dir):
    from tidegrid.llm.queries import op13
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in op13(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    few = [k for k, t in texts.items() if len((t or "").split()) < 800]
    assert len(few) > 0.8 * len(texts) and any(got[k][0] for k in few)
    for k in few:
        assert got[k] == expected(k, texts[k]), k


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, " \n\t", 5), (None, "a b " * 20, 5), (None, None, None),
            (4, "x", 5), (4, "x", 5), (5, "go on and " * 30_000, 5), (6, "é ü\x0b" * 8, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = periodic_runs(df, key="doc_id", full=True).collect()
    assert len(got) == len(rows)
    for r, (k, t, _) in zip(got, rows):
        if k != 5:
            assert tuple(r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli",
                                        "runs_sha256", "collapsed_sha256")) == expected(k, t)
    long = next(r for r in got if r.doc_id == 5)
    assert long.n_runs >= 1 and long.length >= 12 and long.collapsed
    assert periodic_runs(df.limit(0)).count() == 0
