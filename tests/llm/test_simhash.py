"""SimHash groups against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegrid.llm import queries
from tidegrid.llm.simhash import anchors_near, fingerprint, fingerprints, near_groups


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = len(words)
    shingles = [" ".join(words[i:i + 3]) for i in range(n - 2)] if n > 3 else [" ".join(words)] * (n > 0)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, max_bits=3):
    """{row index: smallest id}, rows being (id, fingerprint)."""
    fp = np.array([r[1] for r in rows], np.int64).view(np.uint64)
    ids = [r[0] if r[0] is not None else 1 << 62 for r in rows]
    label = np.array(ids)
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= max_bits
    while True:
        new = np.where(near, label[None], 1 << 63 - 1).min(1)
        if (new == label).all():
            return [None if x == 1 << 62 else int(x) for x in label]
        label = new


def test_fingerprint_by_definition():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 4, 5, 60):
        text = " \t".join(rnd.choice(["A", "bé", "Z y", "É", "x"]) for _ in range(n))
        assert fingerprint(text) & (1 << 64) - 1 == plain_print(text)
    assert fingerprint(None) == fingerprint(" \n\x0b") == 0


def test_every_close_pair_shares_a_home():
    rng = np.random.default_rng(2)
    block = rng.integers(0, 1 << 31, 300).astype(np.uint64)
    other = block ^ (np.uint64(1) << rng.integers(0, 31, 300).astype(np.uint64))
    seen = lambda v: {(int(r), int(a)): bool(h) for r, a, h in zip(*anchors_near(v))}
    x, y = seen(block), seen(other)
    homes = {r: a for (r, a), h in x.items() if h}
    assert len(homes) == 300
    assert all((r, a) in y for r, a in homes.items())
    for (r, a) in x:
        assert int(block[r] ^ np.uint64(a)).bit_count() <= 2


@pytest.mark.parametrize("seed", [3, 4])
def test_groups_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    fp = list(rng.integers(-2 ** 63, 2 ** 63 - 1, 120))
    for _ in range(500):  # chains of small steps, one dense cluster, exact copies
        base = fp[int(rng.integers(0, len(fp)))] if rng.random() < .5 else fp[0]
        flips = rng.choice(64, rng.integers(0, 5), replace=False)
        fp.append(int(np.int64(base) ^ np.array([1 << int(b) for b in flips] or [0], np.uint64)
                      .sum(dtype=np.uint64).view(np.int64)))
    rows = [(int(i), int(f), "x") for i, f in zip(rng.permutation(len(fp)), fp)]
    rows += [rows[5], (None, rows[7][1], "n"), (None, 12345, None)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint long, component_id string")
    got = near_groups(df).collect()
    want = {(r[0], r[1]): c for r, c in zip(rows, brute(rows))}
    assert len(got) == len(rows)
    assert all(want[r.doc_id, r.fingerprint] == r.component_id for r in got)


def test_query_against_brute_force(spark, sf_dir):
    got = queries.QUERIES["op7_simhash"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = {d.doc_id: plain_print(d.text) for d in docs}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == prints
    rows = [(k, np.uint64(v).view(np.int64)) for k, v in prints.items()]
    assert {r.doc_id: r.component_id for r in got} == dict(zip(prints, brute(rows)))


def test_odd_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string, fingerprint string")
    assert near_groups(fingerprints(df)).count() == 0
    rows = [(4, None, "a"), (2, "", "b"), (9, " \n", None), (None, "word", "c"), (7, "word", "c")]
    out = near_groups(fingerprints(spark.createDataFrame(rows, df.schema)))
    assert {(r.doc_id, r.component_id) for r in out.collect()} == \
        {(4, 2), (2, 2), (9, 2), (None, 7), (7, 7)}
    with pytest.raises(ValueError):
        near_groups(out.drop("component_id"), max_bits=4)
    assert dict(out.select(F.col("fingerprint")).dtypes) == {"fingerprint": "bigint"}
