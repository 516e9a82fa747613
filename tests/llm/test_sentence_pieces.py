"""SentencePiece encoding against a plain Viterbi, decoding against round trips."""

import random

import numpy as np
import sentencepiece

from tidegrid.llm import queries
from tidegrid.llm.packing import public_path
from tidegrid.llm.pieces import DoubleArray
from tidegrid.llm.sentence_pieces import Codec, encode, encoding_facts

PATH = public_path("piece_bpe_32k.model")
CODEC = Codec(PATH)


def plain(text):
    """Best (score) over all segmentations of the whole text, character by character."""
    v = CODEC.vocabulary
    words = {p: i for i, p in enumerate(v.pieces) if p and i not in set(v.byte_ids.tolist())}
    chars = [c.encode() for c in "▁" + text.replace(" ", "▁")]
    best = [0.0] + [-np.inf] * len(chars)
    for j in range(1, len(chars) + 1):
        for i in range(max(0, j - 20), j):
            piece = words.get(b"".join(chars[i:j]))
            if piece is not None:
                best[j] = max(best[j], best[i] + v.scores[piece])
            elif j - i == 1:
                best[j] = max(best[j], best[i] + v.unknown_score)
    return best[-1]


def score_of(ids):
    """Score of encoded ids: a run of bytes that makes a character counts once."""
    v, total, left = CODEC.vocabulary, 0.0, 0
    for i in ids.tolist():
        at = np.flatnonzero(v.byte_ids == i)
        if len(at):
            if left == 0:
                b = int(at[0])
                left = 1 + (b >= 0xC0) + (b >= 0xE0) + (b >= 0xF0)
                total += v.unknown_score
            left -= 1
        else:
            total += v.scores[i]
    return total


def texts():
    rnd = random.Random(4)
    return ["a", " a", "  a  b ", "日本語 é\n\n☃x", "\x00\t", "x" * 70] + [
        "".join(rnd.choice("ab thé ingon \n日☃.,1😀") for _ in range(50)) for _ in range(40)]


def test_best_scores_and_round_trips():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text, ids in zip(texts(), CODEC.encode(texts())):
        assert abs(score_of(ids) - plain(text)) < 1e-6
        assert CODEC.decode(ids) == text == sp.decode(ids.tolist())


def test_double_array_finds_all_and_only_its_words():
    words = {b"a": 0, b"ab": 1, b"abc": 2, b"b": 3, b"\xff\x00": 4, b"cab": 5}
    data = np.frombuffer(b"abcab\xff\x00z", np.uint8).astype(np.int64)
    trie = DoubleArray(words)
    got = {(int(s), int(n), int(v)) for s, n, v in zip(*trie.matches(data, len(data) - np.arange(len(data))))}
    raw = data.astype(np.uint8).tobytes()
    assert got == {(i, len(w), v) for w, v in words.items() for i in range(len(raw))
                   if raw.startswith(w, i)}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " "), (3, " "), (None, "▁ mark"), (5, "long " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, decoded string").withColumnRenamed("decoded", "text")
    got = encoding_facts(df.selectExpr("*", "'old' AS n_ids")).collect()
    by = {(r.doc_id, r.text): r for r in got}
    assert len(got) == 6 and by[1, None].n_ids == by[2, ""].n_ids == 0
    assert by[5, "long " * 50_000].round_trip and not by[None, "▁ mark"].round_trip
    assert by[1, None].round_trip and by[3, " "].decoded == " "
    assert encode(df.limit(0)).count() == 0
    assert encode(df).where("doc_id = 2").first().ids == []


def test_query_round_trips(spark, sf_dir):
    got = queries.QUERIES["op2_sentence_pieces"](spark, sf_dir)
    assert got.where("NOT round_trip").count() == 0
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_whole_result_by_plain_viterbi(spark, sf_dir):
    """Every document of the query: ids of best score, decoded to the text, and their digests."""
    import zlib
    v = CODEC.vocabulary
    single = set(v.byte_ids.tolist())
    words = {p.decode("utf-8", "surrogateescape"): v.scores[i] for i, p in enumerate(v.pieces)
             if p and i not in single}
    longest = max(map(len, words))

    def best(text):
        chars = "▁" + text.replace(" ", "▁")
        score = [0.0] + [-np.inf] * len(chars)
        for j in range(1, len(chars) + 1):
            for i in range(max(0, j - longest), j):
                piece = words.get(chars[i:j])
                if piece is not None:
                    score[j] = max(score[j], score[i] + piece)
                elif j - i == 1:
                    score[j] = max(score[j], score[i] + v.unknown_score)
        return score[-1]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in queries.QUERIES["op2_sentence_pieces"](spark, sf_dir).collect()}
    rows = encode(docs).collect()
    assert len(rows) == len(got)
    for r in rows:
        ids, text = np.array(r.ids, np.int64), r.text or ""
        assert got[r.doc_id].n_ids == len(ids)
        assert got[r.doc_id].ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
        assert got[r.doc_id].n_byte_ids == sum(i in single for i in r.ids)
        if text and len(text) < 6000:
            assert abs(score_of(ids) - best(text)) < 1e-6 * max(1, len(text))
