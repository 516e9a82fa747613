"""Packing: ids against the tokenizer, sequences by their rules, first fit by its definition."""

import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from tidegrid.llm import queries
from tidegrid.llm.packing import WordIds, first_fit_decreasing, pack, public_path

PATH = public_path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def odd_texts():
    rnd = random.Random(0)
    return ["", None, " ", "Hello <|endoftext|> wörld's 12 ①İ ΣΑΣ   x\x1cy é ñandú's--'s ''ll",
            "don't I'LL she'S 'S'T x'y'z \x85 tab\tb\x0bc　日本語テキスト한국어 à́", "A" * 5000,
            "ǰJ̌ µ ª º ×÷"] + ["".join(rnd.choice("aB'sTlm ré.,-!\n12<|>éÉßñ́日") for _ in range(120))
                              for _ in range(100)]


def test_ids_are_the_tokenizers():
    words = WordIds(PATH)
    for _ in range(2):  # unseen words, then known ones
        for text, ids in zip(odd_texts(), words.encode(odd_texts())):
            assert ids.tolist() == ids_of(text)[:-1]


def test_first_fit_decreasing():
    rng = np.random.default_rng(4)
    for n in (1, 2, 37, 400):
        sizes = rng.integers(1, 101, n)
        bins, offsets = first_fit_decreasing(sizes, 100)
        left, want = [], {}
        for i in sorted(range(n), key=lambda i: -sizes[i]):
            b = next((b for b, c in enumerate(left) if c >= sizes[i]), len(left))
            if b == len(left):
                left.append(100)
            want[i] = (b, 100 - left[b])
            left[b] -= sizes[i]
        assert {i: x for i, x in enumerate(zip(bins, offsets))} == want


def check(rows, texts):
    """Every id in one piece, sequences gapless and not too long; gives the padding's share."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(texts)
    for key, pieces in docs.items():
        ids, at = ids_of(texts[key]), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            at += p.length
            part = np.array(ids[p.start:at], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
        assert at == len(ids)
    used = []
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
        used.append(at)
    return 1 - sum(used) / (4096 * len(used))


def test_query(spark, sf_dir):
    texts = {d.doc_id: d.text for d in
             spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert check(queries.QUERIES["op9_packing"](spark, sf_dir).collect(), texts) < 0.03


def test_odd_rows(spark):
    texts = dict(enumerate(odd_texts()))
    texts[None] = "null id"
    texts[5000] = "long text " * 20_000
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string") \
        .selectExpr("*", "1 AS start", "'x' AS `offset`")
    rows = pack(df, with_ids=True).collect()
    check(rows, texts)
    assert all(len(r.ids) == r.length for r in rows)
    assert pack(df.limit(0)).count() == 0
    twice = pack(df.where("doc_id = 5").union(df.where("doc_id = 5")))
    assert twice.count() == 2 * pack(df.where("doc_id = 5")).count()


def test_a_third_of_all_rows_equal(spark, monkeypatch):
    from tidegrid.llm import packing
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    monkeypatch.setattr(packing, "COPY_RUN", 16)
    df = spark.createDataFrame([(1, "one and the same")] * 500 + [(i, f"text {i}") for i in range(2, 900)],
                               "doc_id long, text string")
    rows = pack(df).collect()
    assert len(rows) == 500 + 898 and sum(r.doc_id == 1 for r in rows) == 500
    groups = {r.sequence_id >> 32 for r in rows if r.doc_id == 1}
    assert len(groups) > 20  # no group holds all copies
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length


def test_whole_result_by_first_fit(spark, sf_dir):
    """Every group of the query's result, bin by bin and offset by offset, by a plain first fit."""
    groups = defaultdict(list)
    for r in queries.QUERIES["op9_packing"](spark, sf_dir).collect():
        groups[r.sequence_id >> 32].append(r)
    assert groups
    for rows in groups.values():
        rows.sort(key=lambda r: (r.length, r.ids_crc32, r.start, r.doc_id))
        rows.sort(key=lambda r: -r.length)
        left = []
        for r in rows:
            b = next((b for b, room in enumerate(left) if room >= r.length), None)
            if b is None:
                b = len(left)
                left.append(4096)
            assert (r.sequence_id & 0xFFFFFFFF, r.offset) == (b, 4096 - left[b])
            left[b] -= r.length
