"""Language ID: sums over segmentations by enumeration, and held-out accuracy."""

import math

import numpy as np
from pyspark.sql import functions as F

from tidegrid.llm import queries
from tidegrid.llm.language import LONG, Marginal, fit, marked_words, numbered, predict
from tidegrid.llm.packing import public_path

MODEL = Marginal(public_path("piece_bpe_32k.model"))
WORDS = ["▁the".encode(), "▁öl".encode(), b"ing", b"\x00", "▁日".encode()]


def segmentations(word):
    """Every way to write a word in pieces and single bytes, as lists of piece ids."""
    v = MODEL.vocabulary
    pieces = {}
    for i, p in enumerate(v.pieces):
        if p and i not in set(v.byte_ids.tolist()):
            pieces[p] = i
    if not word:
        return [[]]
    out = [[int(v.byte_ids[word[0]])] + rest for rest in segmentations(word[1:])]
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            out += [[pieces[word[:n]]] + rest for rest in segmentations(word[n:])]
    return out


def test_forward_sums_all_segmentations():
    p = np.random.default_rng(1).dirichlet(np.ones(MODEL.size), 2).T
    for word, got in zip(WORDS, MODEL.log_p(WORDS, p)):
        for k in range(2):
            want = sum(math.prod(p[i, k] for i in s) for s in segmentations(word))
            assert math.isclose(got[k], math.log(want), rel_tol=1e-9)


def summed(word, p):
    """Log of the sum over all segmentations, position by position, in exact fractions."""
    from fractions import Fraction
    v = MODEL.vocabulary
    single = set(v.byte_ids.tolist())
    pieces = {q: i for i, q in enumerate(v.pieces) if q and i not in single}
    longest = max(map(len, pieces))
    total = [Fraction(1)] + [Fraction(0)] * len(word)
    for end in range(1, len(word) + 1):
        total[end] = total[end - 1] * Fraction(p[int(v.byte_ids[word[end - 1]])])
        for n in range(1, min(longest, end) + 1):
            i = pieces.get(word[end - n:end])
            if i is not None:
                total[end] += total[end - n] * Fraction(p[i])
    whole = total[len(word)]
    return math.log(whole.numerator) - math.log(whole.denominator)


def test_long_words_are_summed_whole():
    p = np.random.default_rng(7).dirichlet(np.ones(MODEL.size), 2).T
    words = [("▁" + w).encode() for w in (
        "donaudampfschifffahrtsgesellschaftskapitänsmützenabzeichen",
        "ภาษาไทยเขียนโดยไม่เว้นวรรคระหว่างคำและยาวมาก", "これは空白のない長い日本語の文章です" * 6,
        "x" * 500, "short", "y" * (LONG - 3), "y" * (LONG - 2))]
    assert sum(len(w) > LONG for w in words) == 5
    for word, got in zip(words, MODEL.log_p(words, p)):
        for k in range(2):
            assert math.isclose(got[k], summed(word, p[:, k]), rel_tol=1e-9)


def test_expected_counts_in_logs():
    p = np.random.default_rng(3).dirichlet(np.ones(MODEL.size))
    counts = np.array([3.0, 1.0, 2.0])
    words = WORDS[:2] + ["▁longer".encode()]
    assert np.allclose(MODEL._expected_logs(words, counts, p[:, None]),
                       MODEL._expected(words, counts, p[:, None]))


def test_equal_rows_are_one_with_a_count(spark):
    rows = [("the cat and the dog", "en")] * 3000 + [("the house by the sea", "en"),
                                                     ("der hund und die katze", "de")]
    df = spark.createDataFrame(rows, "text string, lang string")
    few = fit(df, F.lit(True), max_sample=100_000)
    want = MODEL.learn(*(lambda w, a, o: (w, np.bincount(a, np.array([3000.0, 1.0])[o], len(w))))(
        *numbered(["the cat and the dog", "the house by the sea"])))
    got = {r.lang: np.frombuffer(r.p, "<f4") for r in few.collect()}
    assert np.allclose(got["en"], want, rtol=1e-5) and set(got) == {"en", "de"}


def test_expected_counts():
    p = np.random.default_rng(2).dirichlet(np.ones(MODEL.size))
    counts = np.array([3.0, 1.0])
    got = MODEL._expected(WORDS[:2], counts, p[:, None])
    want = np.zeros(MODEL.size)
    for word, n in zip(WORDS, counts):
        paths = segmentations(word)
        weight = np.array([math.prod(p[i] for i in s) for s in paths])
        for s, w in zip(paths, weight / weight.sum()):
            for i in s:
                want[i] += n * w
    assert np.allclose(got, want)


def test_words():
    assert marked_words(" Ab\ncd") == ["▁ab".encode(), "▁cd".encode()]
    long = marked_words("x" * 1000)
    assert long == ["▁".encode() + b"x" * 1000]
    words, at, owner = numbered(["a b", None, "b"])
    assert [words[i] for i in at] == ["▁a".encode(), "▁b".encode(), "▁b".encode()]
    assert owner.tolist() == [0, 0, 2]


def test_odd_rows(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([
        ("the cat and the dog are in the house", "en"), ("der hund und die katze im haus", "de"),
        ("the house of the dog", "en"), ("die katze und der hund", "de"), (None, "en"),
        ("12 34 !!", "en"), ("", None), ("ein haus der katze", None), ("x" * 30_000, "en")] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string") \
        .selectExpr("*", "0 AS score")
    got = predict(df, fit(df, F.col("doc_id") >= 0)).collect()
    assert len(got) == len(rows)
    for r in got:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif len(r.text) < 1000:
            assert r.lang_pred == ("en" if "the" in r.text else "de") and 0.5 < r.score <= 1
    assert {(r.lang_pred, r.score) for r in predict(df, fit(df, F.lit(False))).collect()} == {("und", 0)}
    assert predict(df.limit(0), fit(df, F.lit(True))).count() == 0
    assert predict(df, fit(df, F.lit(None).cast("boolean"))).count() == len(rows)


def test_held_out_accuracy(spark, sf_dir):
    got = queries.QUERIES["op6_language"](spark, sf_dir)
    lang = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    right, n = got.where("held_out").join(lang, "doc_id").agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 20 and right / n > 0.97
