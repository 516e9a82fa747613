"""Phrase and proximity matches, and the query's columns, against plain searches."""

import random
import re

import numpy as np

from tests.compare import connect, differences
from tidegrid.llm import postings
from tidegrid.llm.postings import build_index, bytes_to_gaps, decontaminate, find_phrases, \
    gaps_to_bytes


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def windows(text, size):
    w = words(text)
    return [w[i:i + size] for i in range(max(1, len(w) - size + 1))] if w else []


def brute(doc, want, slop):
    """The tightest stretches that hold the words in order: for every last start before each end."""
    out = set()
    for i in range(len(doc)):
        if doc[i] != want[0]:
            continue
        at = i
        for w in want[1:]:
            at = next((j for j in range(at + 1, len(doc)) if doc[j] == w), None)
            if at is None:
                break
        if at is not None and at + 1 - i <= len(want) + slop:
            out.add((i, at + 1))
    return {(s, e) for s, e in out if not any((a, b) != (s, e) and s <= a and b <= e for a, b in out)}


def test_gap_codes():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2 ** 21, 2 ** 28, 2 ** 34, 5])
    assert (bytes_to_gaps(gaps_to_bytes(values)) == values).all()
    assert len(bytes_to_gaps(gaps_to_bytes(values[:0]))) == 0


def tables(spark, seed, n=120):
    dice = random.Random(seed)

    def text(least, most):
        return " ".join(dice.choice("aa Bb c d é 7x".split()) for _ in range(dice.randrange(least, most)))
    docs = [(i, text(0, 60)) for i in range(n)] + [(3, None), (None, "aa Bb c"), (4, ""), (4, " ;! ")]
    items = [(i, text(0, 9)) for i in range(12)] + [(5, None), (None, "c d c d"), (5, "d c aa")]
    return spark.createDataFrame(docs, "doc_id long, text string"), \
        spark.createDataFrame(items, "item_id long, text string"), docs, items


def test_phrases(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_BYTES", 200)  # several blocks
    for seed, size in ((1, 3), (2, 4)):
        docs, items, plain, tests = tables(spark, seed)
        got = sorted(decontaminate(docs.repartition(5), items, window=size).collect(), key=str)
        want = []
        for k, t in plain:
            d = words(t)
            hit, ids = set(), set()
            for item, x in tests:
                for w in windows(x, size):
                    for s in range(len(d) - len(w) + 1):
                        if d[s:s + len(w)] == w:
                            hit |= set(range(s, s + len(w)))
                            ids.add(item)
            want.append((k, len(d), len(hit), sorted(str(i) for i in ids - {None}), bool(hit), sorted(hit)))
        assert sorted(map(str, ((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated,
                                 [i for s in r.spans for i in range(s.start, s.stop)])
                                for r in got))) == sorted(map(str, want))


def test_proximity(spark):
    docs, items, plain, tests = tables(spark, 3)
    size, slop = 3, 2
    found = find_phrases(build_index(docs.coalesce(1)), items, window=size, slop=slop)
    got = {(r.doc_no, r.item, r.start, r.stop) for r in found.collect()}
    want = {(no, None if k is None else str(k), s, e) for no, (_, t) in enumerate(plain)
            for k, x in tests for w in windows(x, size) for s, e in brute(words(t), w, slop)}
    # a stretch through every posting of the rarest term holds all that are tightest
    assert want <= got
    for no, item, s, e in got:
        d = words(plain[no][1])
        assert any(len(w) <= e - s <= len(w) + slop and d[s] == w[0] and d[e - 1] == w[-1]
                   and brute(d[s:e], w, slop) for k, x in tests
                   if (None if k is None else str(k)) == item for w in windows(x, size))
    exact = find_phrases(build_index(docs.coalesce(1)), items, window=size)
    assert {(r.doc_no, r.start, r.stop) for r in exact.collect()} <= {(n, s, e) for n, _, s, e in got}


def test_empty_tables_and_long_texts(spark):
    docs, items, _, _ = tables(spark, 4, 5)
    assert decontaminate(docs.limit(0), items).count() == 0
    none = decontaminate(docs, items.limit(0)).collect()
    assert len(none) == 9 and not any(r.contaminated or r.n_hit for r in none)
    long = spark.createDataFrame([(1, "go on " * 400_000 + "the end of all this talk is near now and here it is",
                                   "z", "z")], "doc_id long, text string, n_words string, item string")
    item = spark.createDataFrame([(9, "end of all this talk is near now and here")],
                                 "item_id long, text string")
    row = decontaminate(long, item, window=10).first()
    assert (row.n_words, row.n_hit, row.item_ids) == (800_013, 10, ["9"])


def test_query_against_sql(spark, sf_dir):
    from tidegrid.llm.queries import ORACLES, QUERIES
    name = "op12_decontamination"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []
