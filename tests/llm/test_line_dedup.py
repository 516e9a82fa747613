"""Line dedup against brute force and SQL."""

import hashlib
from collections import Counter

import numpy as np

from tests.compare import connect, differences
from tidegrid.llm import queries
from tidegrid.llm.line_dedup import MinimalPerfectHash, drop_frequent_lines, line_key

SPACE = " \t\n\x0b\x0c\r"


def brute(texts, min_docs):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(SPACE))
    lines = [(t or "").split("\n") for t in texts]
    docs = Counter(k for one in lines for k in {key(x) for x in one} if k)
    kept = [[x for x in one if not key(x) or docs[key(x)] < min_docs] for one in lines]
    return [("\n".join(k), len(one), len(one) - len(k)) for one, k in zip(lines, kept)]


def test_minimal_perfect_hash_numbers_every_key_once():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        mph = MinimalPerfectHash(keys)
        assert sorted(mph.index(keys).tolist()) == list(range(len(keys)))


def test_keys():
    assert line_key(b" \t A\xc3\x84b\r\x0b") == b"a\xc3\x84b"


def test_odd_rows_against_brute_force(spark):
    texts = [None, "", "\n", " \n \n", "A\nb", "a \nÄ", "ä\nA", " \nx", "x" * 100_000 + "\nA",
             "a\na\na"] + ["Same line\nown %d" % i for i in range(6)]
    rows = [(i if i != 5 else None, t, 7, "old") for i, t in enumerate(texts)]
    rows += [rows[4], rows[4]]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra int, n_lines string")
    got = drop_frequent_lines(df, min_docs=5)
    assert got.columns == ["doc_id", "text", "extra", "n_lines", "n_dropped"]
    want = brute([r[1] for r in rows], 5)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == \
        Counter((r[0], *w) for r, w in zip(rows, want))
    assert drop_frequent_lines(df.limit(0)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {(d.doc_id, n, gone, hashlib.sha256(t.encode()).hexdigest())
            for d, (t, n, gone) in zip(docs, brute([d.text for d in docs], 10))}
    got = queries.QUERIES["op5_line_dedup"](spark, sf_dir)
    assert {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got.collect()} == want
    assert differences(got, connect(sf_dir), queries.ORACLES["op5_line_dedup"]) == []
