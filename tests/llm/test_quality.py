"""Quality rules: base counts by definition, and what the bands reject."""

import base64
import random
import re

import numpy as np

from tidegrid.llm import queries
from tidegrid.llm.quality import compression_bands, repeated_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_repeated_windows():
    assert repeated_words([]) == repeated_words([b"a"] * 3) == 0
    assert repeated_words([b"a"] * 4) == 4
    rnd = random.Random(2)
    for n in (5, 40, 300):
        words = [rnd.choice("abc") for _ in range(n)]
        assert repeated_words([w.encode() for w in words]) == brute(" ".join(words))[4]


def test_odd_rows_and_bands(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 9)))
             for _ in range(4000)]
    prose = " ".join(words)
    noise = " ".join(base64.b64encode(np.random.default_rng(1).bytes(90)).decode().translate(
        {ord(c): chr(0x4E00 + 61 * ord(c)) for c in "+/"}) + chr(rnd.randrange(0x4E00, 0x9FFF))
        for _ in range(60))
    copied = (" ".join(words[:9]) + "\n") * 400
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, prose), (4, prose), (5, copied),
            (6, "é # $ <x>\n\né # $ <x>"), (None, " ".join(words[:60])), (8, noise)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS ratio")
    got = compression_bands(df).collect()
    assert len(got) == len(rows) and compression_bands(df.limit(0)).count() == 0
    for r in got:
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                    "n_repeat_words", "base_failed")) == brute(r.text)
    kept = {r.doc_id: r.kept for r in got}
    assert kept == {1: False, 2: False, 3: False, 4: True, 5: False, 6: False, None: True, 8: kept[8]}


def test_query_against_brute_force(spark, sf_dir):
    texts = {d.doc_id: d.text for d in
             spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op8_quality_rules"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                    "n_repeat_words", "base_failed")) == brute(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
