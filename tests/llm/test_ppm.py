"""PPM scores against a dictionary version of the method, counts by definition."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from tidegrid.llm import queries
from tidegrid.llm.ppm import DISCOUNT, END, HashIndex, Trie, byte_grams, ppm_scores

ORDER = 3


def coded(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return " ".join(re.findall(r"[^\x20\x09-\x0D]+", low)).encode() + bytes([END])


def tokens(text):
    return coded(text)[:-1].decode().split(" ") * (len(coded(text)) > 1) + [None]


class Plain:
    """The same model by dictionaries, one byte at a time, nothing cut off."""

    def __init__(self, texts):
        self.after = defaultdict(Counter)
        for t in texts:
            data = bytes([END]) * ORDER + coded(t)
            for i in range(ORDER, len(data)):
                for k in range(ORDER + 1):
                    self.after[data[i - k:i]][data[i]] += 1
        # how often a context was a byte string coded: what it lacks in followers is escape
        self.seen = Counter()
        for c, n in self.after.items():
            for b, m in n.items():
                self.seen[c + bytes([b])] += m

    def byte(self, context, b):
        p, out, known = 1.0, set(), None
        for k in range(ORDER, -1, -1):
            c = context[len(context) - k:]
            if c not in self.after:
                continue
            n = self.after[c]
            lost = max(0, self.seen[c] - sum(n.values())) if k else 0
            rest = {x: m - DISCOUNT for x, m in n.items() if x not in out}
            escape = DISCOUNT * len(rest) + lost
            total = sum(rest.values()) + escape
            if b in rest:
                return p * rest[b] / total
            if total:
                p *= escape / total if escape else 1.0
            out |= set(n)
            known = c
        return p / max(1, 256 - len(self.after[b""])) if known is not None else p / 256

    def log10(self, text):
        data = bytes([END]) * ORDER + coded(text)
        return sum(math.log10(self.byte(data[i - ORDER:i], data[i])) for i in range(ORDER, len(data)))


def some_texts(n, seed):
    rnd = random.Random(seed)
    return [" ".join("".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 6)))
                     for _ in range(rnd.randrange(0, 12))) for _ in range(n)]


def trie_of(texts):
    grams, n = np.unique(byte_grams(texts, ORDER)[0], return_counts=True)
    parts = []
    for k in range(ORDER + 1):
        keys, at = np.unique(grams & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
        parts.append((np.full(len(keys), k), keys, np.bincount(at, n)))
    return Trie(*map(np.concatenate, zip(*parts)), ORDER)


def test_grams():
    found, owner = byte_grams(["Ab  c", None], 2)
    text = b"\n\nab c\n"
    want = [int.from_bytes(text[i - 2:i + 1], "big") for i in range(2, len(text))]
    assert found[owner == 0].tolist() == want and found[owner == 1].tolist() == [0x0A0A0A]


def test_hash_index():
    keys = np.random.default_rng(1).choice(2 ** 40, 3000, replace=False).astype(np.uint64)
    index = HashIndex(keys[:2000])
    assert index.find(keys[:2000]).tolist() == list(range(2000))
    assert (index.find(keys[2000:]) == -1).all()
    assert (HashIndex(keys[:0]).find(keys) == -1).all()


def test_trie_against_dictionaries():
    train = some_texts(40, 1)
    trie, plain = trie_of(train), Plain(train)
    for t in some_texts(20, 2) + ["zebra éé", "", None, "日本"]:
        found, _ = byte_grams([t], ORDER)
        assert math.isclose(trie.log10(found).sum(), plain.log10(t), rel_tol=1e-4)


def test_probabilities_sum_to_one():
    trie = trie_of(some_texts(40, 1))
    for context in (b"abc", b"\n\n\n", b"zzz", b" ab", b"qa "):
        grams = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert abs((10 ** trie.log10(grams)).sum() - 1) < 1e-4


def base_by_definition(texts, train):
    counts = Counter(w for t, is_train in zip(texts, train) if is_train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return [(len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
             sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t))) for t in texts]


def test_odd_rows(spark):
    texts = some_texts(60, 3) + [None, "", " \n", "LONG Word " * 30_000, "x" * 50_000]
    rows = [(i if i % 9 else None, t, i % 4 != 0 if i % 11 else None) for i, t in enumerate(texts)]
    rows += rows[5:7]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean") \
        .selectExpr("*", "'x' AS score", "1 AS n_known")
    got = ppm_scores(df, "learn", order=ORDER).collect()
    plain = Plain([r[1] for r in rows if r[2]])
    want = base_by_definition([r[1] for r in rows], [bool(r[2]) for r in rows])
    facts = {(r[0], r[1], r[2]): w for r, w in zip(rows, want)}
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base = facts[r.doc_id, r.text, r.learn]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        if len(r.text or "") < 1000:
            assert math.isclose(r.score, plain.log10(r.text), rel_tol=1e-3)
    assert ppm_scores(df.limit(0), "learn").count() == 0
    untaught = ppm_scores(df.where("doc_id < 9"), "false").collect()
    assert all(math.isclose(r.score, -len(coded(r.text)) * math.log10(256), rel_tol=1e-6)
               and r.n_known == 0 for r in untaught)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    train = [zlib.crc32(str(d.doc_id).encode()) % 7 != 2 for d in docs]
    want = dict(zip([d.doc_id for d in docs], base_by_definition([d.text for d in docs], train)))
    for r in queries.QUERIES["op10_ppm"](spark, sf_dir).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert math.isclose(r.base_score, want[r.doc_id][3], rel_tol=1e-9) and r.score < 0


def test_whole_result_by_dictionaries(spark, sf_dir, monkeypatch):
    """The query's scores by the plain model of its own order: all held-out texts, many others."""
    monkeypatch.setitem(globals(), "ORDER", 5)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    plain = Plain([t for k, t in texts.items() if not held[k]])
    counts = Counter(w for k, t in texts.items() if not held[k] for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in queries.QUERIES["op10_ppm"](spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for k, t in texts.items():
        r, own = got[k], tokens(t)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[k], len(own), total)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        if held[k] or k % 3 == 0 and len(t or "") < 3000:
            assert math.isclose(r.score, plain.log10(t), rel_tol=1e-4, abs_tol=1e-3)
