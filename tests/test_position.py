"""Every plan of the positional index against plain Python, on data with hot keys, hot
buckets and copies."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import position
from tidegrid.operators.position import with_position

SCHEMA = "k string, t bigint, tie int, tags map<string,string>"


def fixture():
    random.seed(7)
    rows = []
    for i in range(900):
        key = random.choice(["hot"] * 6 + ["a", "b", None])
        t = 50 if random.random() < 0.5 else random.randrange(100)
        rows.append((key, t, random.randrange(4), {"x": key or ""}))
    rows += [("copy", 7, 1, {"x": "c"})] * 300
    return rows


def expected(rows):
    by_key = defaultdict(list)
    for k, t, tie, _ in rows:
        by_key[k].append((t, tie))
    out = []
    for k, items in by_key.items():
        out += [(k, t, tie, i, len(items)) for i, (t, tie) in enumerate(sorted(items))]
    return sorted(out, key=str)


@pytest.mark.parametrize("slices", [None, 1, 7, 40])
def test_plans_agree(spark, monkeypatch, slices):
    monkeypatch.setattr(position, "COPY_RUN", 17)
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = with_position(df, ["k"], ["t", "tie"], F.call_function("div", F.col("t"), F.lit(10)),
                        total_out="n", slices=slices)
    assert got.columns == ["k", "t", "tie", "tags", "position", "n"]
    found = sorted(((r["k"], r["t"], r["tie"], r["position"], r["n"]) for r in got.collect()),
                   key=str)
    assert found == expected(rows)


@pytest.mark.parametrize("slices", [None, 5])
def test_no_key(spark, slices):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA)
    got = with_position(df, [], ["t", "tie"], F.col("t"), slices=slices).collect()
    order = sorted((t, tie) for _, t, tie, _ in rows)
    assert sorted((r["position"], r["t"], r["tie"]) for r in got) == \
        [(i, t, tie) for i, (t, tie) in enumerate(order)]


@pytest.mark.parametrize("slices", [None, 5])
def test_weights(spark, slices):
    rows = [("a", i, (i * 7) % 5) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, t int, w int")
    got = with_position(df, ["k"], ["t"], F.floor(F.col("t") / 25), weight="w", total_out="n",
                        slices=slices)
    before, run = {}, 0
    for _, t, w in rows:
        before[t] = run
        run += w
    assert {r["t"]: r["position"] for r in got.collect()} == before
    assert {r["n"] for r in got.collect()} == {run}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert with_position(df, ["k"], ["t"], F.col("t")).count() == 0


@pytest.mark.parametrize("slices", [None, 1, 6])
@pytest.mark.parametrize("width", [1, 10, 1000])
def test_null_times_and_ties_are_numbered_alike(spark, slices, width):
    rows = [("k", None if i % 5 == 0 else i % 3, (i * 7) % 11) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, t bigint, v int").repartition(4)
    got = with_position(df, ["k"], ["t"], F.call_function("div", F.col("t"), F.lit(width)),
                        slices=slices).collect()
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    assert sorted((r["position"], r["t"], r["v"]) for r in got) == \
        [(i, t, v) for i, (_, t, v) in enumerate(order)]


def test_nothing_runs_at_call_time(spark):
    df = spark.createDataFrame([("a", 1)], "k string, t bigint")
    broken = df.withColumn("t", F.when(F.col("t") > 0, F.raise_error(F.lit("ran")).cast("bigint")))
    with_position(broken, ["k"], ["t"], F.col("t"))
