"""What the operators share: slices of a corpus, scratch tables, Arrow helpers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.session import scratch_path

# Fixed value: the white space of every contract, [\x20\x09-\x0D].
SPACE = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 8_000_000
CHUNK_CHARS = 2_000_000


def shipped(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package when the session began without it on its path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str) -> tuple[int, int]:
    """Bytes of text and rows.  Reads one column and computes two sums."""
    row = df.agg(F.sum(F.octet_length(F.col(text)).cast("long")), F.count(F.lit(1))).first()
    return int(row[0] or 0), int(row[1])


def slice_count(df: DataFrame, text: str, slice_bytes: int = SLICE_BYTES) -> int:
    """How many slices of about ``slice_bytes`` of text (a row counts as 64 bytes more)."""
    size, rows = text_bytes(df, text)
    return max(1, -(-(size + 64 * rows) // slice_bytes))


def slice_of(df: DataFrame, slices: int) -> Column:
    """A slice number from a hash of the whole row: even, whatever source, id or text is hot."""
    plain = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    return F.pmod(F.xxhash64(*plain) if plain else F.lit(0), F.lit(slices)).cast("int")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add: its own win."""
    clash = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in clash])


def shielded(df: DataFrame, keep: Iterable[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """``df`` with all columns but ``keep`` under names that no operator uses, and the way back.

    Columns of the input called like those that an operator adds come through it unharmed.
    """
    keep = {n.lower() for n in keep}
    names = [(c if c.lower() in keep else f"c{i}__", c) for i, c in enumerate(df.columns)]
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in names]), names


def unshielded(df: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """The columns of :func:`shielded` under their own names, without what was added since."""
    return df.select(*[F.col(n).alias(c) for n, c in names])


def extended(schema: T.StructType, fields: str) -> T.StructType:
    return T.StructType(list(schema.fields) + list(T._parse_datatype_string(fields).fields))


def chunks(texts: pa.Array, chars: int = CHUNK_CHARS) -> Iterator[tuple[int, int, list]]:
    """(from, to, texts) runs of about ``chars`` bytes, so that Python holds few texts at a time."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + chars, "right")))
        yield start, stop, texts.slice(start, stop - start).to_pylist()
        start = stop


def map_texts(df: DataFrame, text: str, fields: str, make: Callable[[], Callable],
              *keys: str | None) -> DataFrame:
    """``df`` with columns ``fields`` that a Python function computes from the texts.

    ``make`` runs once per task and returns a function from a list of texts (or None) to a
    list or array for each new column; lists of the columns ``keys`` (None for no column) come
    before the texts.  All columns of ``df`` pass through as Arrow, untouched.
    """
    names = T._parse_datatype_string(fields).fieldNames()
    base = without(df, names)
    schema = extended(base.schema, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for lo, hi, texts in chunks(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                others = [k and part.column(part.schema.get_field_index(k)).to_pylist()
                          for k in keys]
                new = work(*others, texts)
                yield pa.RecordBatch.from_arrays(
                    list(part.columns) + [pa.array(new[n]) for n in names],
                    names=list(part.schema.names) + names)

    return base.mapInArrow(run, schema)


def blob(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit of a 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
NOT_SPACE = np.array([b not in SPACE for b in range(256)])
# An odd multiplier for prefix hashes, and its inverse modulo 2^64.
STEP = 0x9E3779B97F4A7C15
_BACK = pow(STEP, -1, 1 << 64)


_KEPT_POWERS = 4_000_000
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ...; up to some length they are kept for the next call."""
    if n <= len(_POWERS.get(base, ())):
        return _POWERS[base][:n]
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    out = np.cumprod(out, dtype=np.uint64)
    if n <= _KEPT_POWERS:
        _POWERS[base] = out
    return out


_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64))


def run_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes ``data[start:stop]``, whatever stands around it.

    It is the difference of two prefix sums, moved back to position 0.
    """
    values = _BYTE_VALUES[data] * _powers(STEP, len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return mix64((total[stops] - total[starts]) * _powers(_BACK, len(data))[starts])


def hashed_runs(texts: list, inside: np.ndarray,
                lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every run of bytes marked in ``inside``, and the text that each is in.

    A-Z are lower-cased, unless told otherwise.
    """
    raw = [(t or "").encode() for t in texts]
    if not raw:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.cumsum([len(r) + 1 for r in raw])
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    data = LOWER[data] if lower else data
    marked = np.zeros(len(data) + 1, bool)
    marked[1:] = inside[data]
    change = np.flatnonzero(marked[1:] != marked[:-1])
    starts, stops = change[::2], change[1::2]
    return run_hashes(data, starts, stops), np.searchsorted(ends, starts, "right")
