"""Toxicity by held-out accuracy, and odd tables."""

import random

import numpy as np

from tidegrid.llm import queries
from tidegrid.llm.toxicity import GAPS, features, toxicity


def test_features_are_those_of_each_text_alone():
    texts = ["One, two THREE four", None, "", "one two three four", "é-é"]
    found, owner = features(texts)
    by = [sorted(found[owner == i].tolist()) for i in range(len(texts))]
    assert by[0] == by[3] and by[1] == by[2] == []
    assert len(by[0]) == 4 + sum(max(0, 4 - g) for g in GAPS)
    for i, t in enumerate(texts):
        assert sorted(features([t])[0].tolist()) == by[i]


def corpus(spark, n=600):
    rnd = random.Random(3)
    plain = ["word%d" % i for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randrange(5, 80))]
        bad = i % 6 == 0
        if bad:
            for w in ("vile", "nasty", "awful"):
                words.insert(rnd.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), \
        spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    got = toxicity(docs, labels.where("doc_id % 5 <> 0")).where("doc_id % 5 = 0").collect()
    assert np.mean([(r.doc_id % 6 == 0) == r.predicted for r in got]) > 0.97
    again = toxicity(docs, labels.where("doc_id % 5 <> 0")).where("doc_id % 5 = 0").collect()
    assert {r.doc_id: r.score for r in got} == {r.doc_id: r.score for r in again}


def test_sample_is_bounded(spark):
    docs, labels = corpus(spark)
    assert toxicity(docs, labels, max_sample=100).count() == 600


def test_odd_rows(spark):
    docs, labels = corpus(spark, 120)
    odd = spark.createDataFrame([(1000, None), (1001, ""), (None, "vile nasty awful"),
                                 (3, "repeated"), (1002, "vile " * 60_000)], docs.schema)
    marks = labels.union(spark.createDataFrame([(None, 1), (4, None), (6, 1), (6, 0)], labels.schema))
    got = toxicity(docs.union(odd).selectExpr("*", "'x' AS score"), marks).collect()
    assert len(got) == 125
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1000] == by[1001] < 0.5 < by[None]
    assert toxicity(docs.limit(0), labels).count() == 0
    none = toxicity(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(none[0].score, 0)} and none[0].score < 1e-9


def test_query(spark, sf_dir):
    got = queries.QUERIES["op1_toxicity"](spark, sf_dir)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_a_third_of_all_rows_equal(spark):
    """One id with most of the rows: its copies teach once, its other texts are sampled."""
    from tidegrid.llm import toxicity as module
    rows = [(1, "you are a wretched vile fool")] * 2000 + [(1, f"vile fool number {i}") for i in range(3000)]
    rows += [(i, f"the weather is fine on day {i}") for i in range(2, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "9 AS _key", "8 AS _text")
    labels = spark.createDataFrame([(1, 1)] + [(i, 0) for i in range(2, 300)], "doc_id long, toxic int")
    got = module.toxicity(docs, labels, max_sample=300)
    assert got.count() == len(rows)
    by_id = {r.doc_id: r.s for r in got.groupBy("doc_id").agg({"score": "min"})
             .withColumnRenamed("min(score)", "s").collect()}
    assert by_id[1] > max(v for k, v in by_id.items() if k != 1)


def test_whole_result_by_plain_ftrl(spark, sf_dir):
    """Every score of the query, by FTRL-proximal written out coordinate by coordinate."""
    import math
    import zlib
    from collections import defaultdict

    import xxhash

    from tidegrid.llm import toxicity as module
    from tidegrid.llm.queries import op1
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: int(r.toxic > 0) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
              if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5}

    def found(text):
        return sorted(set(module.features([text])[0].tolist()))

    def order(item):
        text, y = item
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        return h - (1 << 64) if h >> 63 else h, np.array(found(text), np.uint32).tobytes(), y
    rows = sorted(((texts[k], y) for k, y in labels.items() if k in texts), key=order)
    z, n, bias = defaultdict(float), defaultdict(float), "bias"

    def weight(i):
        l1 = 0.0 if i == bias else module.L1
        if abs(z[i]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((module.BETA + math.sqrt(n[i])) / module.ALPHA + module.L2)

    def chance(items):
        return 1 / (1 + math.exp(-max(-35, min(35, sum(map(weight, items))))))
    for _ in range(module.EPOCHS):
        for text, y in rows:
            items = [*found(text), bias]
            w = {i: weight(i) for i in items}
            g = (chance(items) - y) * (module.POSITIVE_WEIGHT if y else 1)
            for i in items:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / module.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    got = {r.doc_id: r for r in op1(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for k, text in texts.items():
        assert abs(got[k].score - chance([*found(text), bias])) < 1e-4
        assert got[k].predicted == int(got[k].score >= 0.5)
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0)
