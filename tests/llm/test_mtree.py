"""Exact top-k search against brute force and SQL."""

import numpy as np
import pytest

from tests.compare import connect, differences
from tidegrid.llm import mtree, queries
from tidegrid.llm.mtree import build_pages, search_block, top_k


def brute(rows, every, k):
    kept = [(i, np.floor(256 * np.array(v, float))) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    width = max((len(v) for _, v in kept), default=0)
    kept = [(i, np.r_[v, np.zeros(width - len(v))]) for i, v in kept]
    out = set()
    for q, v in kept:
        if q % every == 0:
            best = sorted((-int(v @ w), i, n) for n, (i, w) in enumerate(kept) if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i, _) in enumerate(best, 1)}
    return out


def test_pages_hold_their_bounds_and_search_is_exact():
    rng = np.random.default_rng(1)
    x = np.floor(256 * np.r_[rng.normal(size=(500, 8)), np.ones((300, 8)), np.zeros((3, 8))])
    ids = rng.permutation(len(x)).astype(np.int64)
    most = float((x * x).sum(1).max())
    pivot = np.r_[x[0], np.sqrt(most - x[0] @ x[0])]
    pages = build_pages(ids, x, pivot, most, page=32)
    assert sorted(np.concatenate([p["ids"] for p in pages]).tolist()) == sorted(ids.tolist())
    for p in pages:
        assert len(p["ids"]) <= 32 and (p["near"] <= p["radius"]).all()
        assert abs(np.linalg.norm(p["centre"] - pivot) - p["parent"]) < 1e-6
    for q in (x[3], x[600], np.zeros(8)):
        d = float(np.linalg.norm(np.r_[q, 0.0] - pivot))
        want = sorted(zip((x @ q).tolist(), (-ids).tolist()))[-7:]
        for floor in (-np.inf, want[0][0]):
            assert sorted(search_block(pages, d, q, -1, most, 7, floor)) == want


@pytest.mark.parametrize("block", [4096, 40])
def test_odd_rows_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(mtree, "BLOCK", block)
    monkeypatch.setattr(mtree, "QUERY_PART", 5)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(150)]
    rows += [(i, [0.5] * 6) for i in range(150, 260)]  # a third are one vector
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")]),
             (None, [1.0] * 6), (304, []), (305, [2.0, -1.0]), (9, rows[9][1]), (10, [0.1] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>") \
        .selectExpr("*", "'x' AS score", "1 AS rank")
    got = top_k(df, every=10, k=5).collect()
    kept = {(i, tuple(v)): (i, v) for i, v in rows if v is not None}  # repeated rows that ask
    want = brute(rows, 10, 5)
    assert {tuple(r) for r in got} == want
    assert len(got) == 5 * len({k for k in kept if k[0] is not None and k[0] % 10 == 0
                                and k[0] != 300})


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_k(spark.createDataFrame([], schema)).count() == 0
    assert top_k(spark.createDataFrame([(50, [1.0])], schema)).count() == 0
    two = top_k(spark.createDataFrame([(50, [1.0]), (51, [-1.0])], schema)).collect()
    assert [tuple(r) for r in two] == [(50, 1, 51, -65536)]


def test_query(spark, sf_dir):
    got = queries.QUERIES["op4_mtree"](spark, sf_dir)
    assert differences(got, connect(sf_dir), queries.ORACLES["op4_mtree"]) == []
