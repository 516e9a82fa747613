"""Fitted bands: by their definition over a whole table, and what they let go and keep."""

import math
from collections import defaultdict

import zstandard

from tidegrid.llm import quality
from tidegrid.llm.quality import BANDS, CHUNK, chunked, compression_bands, fit_bands
from tests.llm.test_quality import brute


def middle(values):
    return sorted(values)[(len(values) + 1) // 2 - 1]


def brute_limits(texts, least):
    """(low, high) of each class, over distinct (size, packed size)."""
    pack = zstandard.ZstdCompressor(level=3)
    pairs = {(len(t.encode()), len(pack.compress(t.encode()))) for t in texts if not brute(t)[5]}
    classes = defaultdict(list)
    for size, packed in pairs:
        classes[math.ceil(4 * math.log2(size))].append(
            math.floor(size / packed / 0.005) * 0.005 + 0.0025)
    out = {}
    for c, ratios in classes.items():
        if len(ratios) >= least:
            m = middle(ratios)
            width = 5 * max(1.4826 * middle([abs(r - m) for r in ratios]), 0.02 * m)
            out[c] = m - width, m + width
    return out


def limits_for(size, limits):
    wide = next(b for b in BANDS if 2 ** (math.ceil(4 * math.log2(max(size, 1))) / 4) <= b.size)
    c = math.ceil(4 * math.log2(max(size, 1)))
    near = [limits[i] for i in (c - 1, c, c + 1) if i in limits]
    if c not in limits:
        return wide.low, wide.high
    return max(wide.low, min(lo for lo, _ in near)), min(wide.high, max(hi for _, hi in near))


def test_kept_by_definition(spark, monkeypatch):
    monkeypatch.setattr(quality, "LEAST_TEXTS", 25)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    limits = brute_limits([t for _, t in rows], 25)
    assert len(limits) > 5
    pack = zstandard.ZstdCompressor(level=3)

    def inside(raw):
        lo, hi = limits_for(len(raw), limits)
        return lo <= len(raw) / len(pack.compress(raw)) <= hi
    want = {}
    for k, t in rows:
        raw = t.encode()
        bad = sum(not inside(p) for p in chunked(raw))
        want[k] = not brute(t)[5] and inside(raw) and 3 * bad <= len(raw) // CHUNK * (len(raw) > CHUNK)
    got = {r.doc_id: r.kept for r in compression_bands(docs).collect()}
    off = [k for k in want if want[k] != got[k]]
    assert off == []
    # the bands decide: some that pass the base rules go
    assert any(not got[k] and not brute(t)[5] for k, t in rows)


def test_clean_texts_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    kept = compression_bands(docs).where("not base_failed").join(marks, "doc_id") \
        .selectExpr("quality", "cast(kept as int) as k").groupBy("quality") \
        .agg({"k": "avg", "quality": "count"}).collect()
    share = {r.quality: r["avg(k)"] for r in kept}
    assert share[1] > 0.999 and share[0] < 0.75


def test_copies_do_not_set_the_limits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    one = docs.where("length(text) between 3000 and 3900").limit(1).crossJoin(spark.range(3000)) \
        .select("doc_id", "text")
    assert fit_bands(docs.union(one)) == fit_bands(docs)
    assert fit_bands(docs.limit(0))[-1] == BANDS[-1]
