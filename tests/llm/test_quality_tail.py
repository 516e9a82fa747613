"""Quality rules: a short tail is no chunk of its own."""

import random

from tidegrid.llm.quality import CHUNK, FIELDS, chunked, compression_bands

NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def test_every_byte_is_in_one_chunk():
    raw = random.Random(1).randbytes(5 * CHUNK)
    for n in [0, 1, CHUNK] + [k * CHUNK + d for k in (1, 2, 4) for d in (0, 1, 20, CHUNK - 1)]:
        pieces = chunked(raw[:n])
        assert b"".join(pieces) == (raw[:n] if n > CHUNK else b"")
        assert all(CHUNK <= len(p) < 2 * CHUNK for p in pieces)
        assert len(pieces) == (n // CHUNK if n > CHUNK else 0)


def test_clean_prose_just_over_a_chunk_stays(spark):
    rnd = random.Random(5)
    prose = " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 9)))
                     for _ in range(4000))
    rows = [(n, prose[:n]) for n in [*range(4090, 4121), 8193, 12290]]
    got = compression_bands(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.kept and r.n_bad_chunks == 0 for r in got)
