"""Interval joins over bins, and what merged sketches promise."""

import random

from pyspark.sql import functions as F

from tidegrid.operators import fetch as op
from tidegrid.operators import sketches

POINT = "namespace string, name string, series_key string, tags map<string,string>, ts timestamp_ntz, value double"


def made(spark, rows):
    """(series, minute, value) as points."""
    df = spark.createDataFrame(rows, "k string, minute int, value double")
    start = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    return df.select(F.lit("default").alias("namespace"), F.lit("m").alias("name"),
                     F.col("k").alias("series_key"), F.create_map(F.lit("k"), "k").alias("tags"),
                     (start + F.make_dt_interval(mins=F.col("minute"))).alias("ts"), "value")


def asked(spark, rows):
    df = spark.createDataFrame(rows, "k string, lo int, hi int, policy string")
    start = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    return df.select(F.col("k").alias("series_key"), "policy", *[
        (start + F.make_dt_interval(mins=F.col(c))).alias(n)
        for c, n in (("lo", "range_start"), ("hi", "range_end"))])


def test_binned_join_with_a_hot_series(spark):
    dice = random.Random(8)
    rows = [("hot", dice.randrange(3000), float(i)) for i in range(2000)] \
        + [(f"s{i % 40}", dice.randrange(3000), float(i)) for i in range(4000)] + [("hot", 77, 1.0)] * 50
    wants = []
    for i in range(300):
        lo = dice.randrange(-100, 3000)
        wants.append(("hot" if i % 3 == 0 else f"s{dice.randrange(50)}", lo, lo + dice.randrange(-5, 700),
                      str(i)))
    wants += [("hot", None, 50, "null"), ("hot", 60, 60, "empty"), ("hot", 5, 80, "twice")] * 2
    points, requests = made(spark, rows), asked(spark, wants)
    want = sorted((k, m, v, p) for k, m, v in rows for key, lo, hi, p in wants
                  if key == k and lo is not None and lo <= m < hi)
    minute = ((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(
        F.lit("2024-03-01 00:00:00").cast("timestamp"))) / 60_000_000).cast("int").alias("minute")
    for how in ({}, {"width": "1h"}, {"width": "1h", "rows_per_key": 7}):
        got = op.fetch_binned(points, requests, **how).select("series_key", minute, "value", "policy")
        assert sorted(map(tuple, got.collect())) == want
    plain = op.fetch_requests(points, requests.where("range_start is not null")) \
        .select("series_key", minute, "value", "policy")
    assert sorted(map(tuple, plain.collect())) == want
    kept = op.fetch_binned(points, requests).columns
    assert kept == [*points.columns, "range_start", "range_end", "policy"]


def test_no_key_above_its_share(spark):
    """A third of all samples in one bin of one series: the join's keys stay small."""
    rows = [("hot", 5, float(i)) for i in range(3000)] + [(f"s{i}", i % 500, 0.0) for i in range(6000)]
    requests = asked(spark, [("hot", 0, 60, "a")])
    joined = op.fetch_binned(made(spark, rows), requests, rows_per_key=100)
    assert joined.count() == 3000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__row" in plan and "Join Inner" in plan and "Cartesian" not in plan


def test_quantile_sketches_merge(spark):
    dice = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"s{i % 20}", i % 7000, dice.gauss(0, 1)) for i in range(30_000)] \
        + [("none", 5, float("nan"))] * 3 + [("hot", 5, float("nan"))]
    points = made(spark, rows)
    state = sketches.quantile_state(points, "12h")
    assert sketches.merge_quantiles(state).first().n == 30_000
    whole = sketches.merge_quantiles(state, ["namespace"], "240h")
    row = whole.first()
    assert (row.n, row.missing) == (30_000, 4)
    values = sorted(v for _, _, v in rows if v == v)
    for q in (0.0, 0.01, 0.5, 0.9, 1.0):
        got = sketches.sketch_quantile(whole, q).first().value
        rank = sum(v <= got for v in values) / len(values)
        assert abs(rank - q) <= 3 * sketches.RANK_ERROR + 1 / len(values)
        back = sketches.sketch_rank(whole, got).first().rank
        assert abs(back - rank) <= 3 * sketches.RANK_ERROR
    assert sketches.sketch_quantile(whole, 1.5).first().value == float("inf")
    alone = sketches.sketch_quantile(sketches.merge_quantiles(
        state.where("series_key = 'none'"), ["series_key"]), 0.5).first()
    assert alone.value is None and alone.missing == 3
    # the state of one series is bounded whatever its samples
    assert state.select(F.max(F.length("sketch")).alias("n")).first().n < 16 * sketches.KLL_SIZE


def test_series_sketches_merge(spark):
    rows = [(f"s{i % 5000}", i % 6000, 0.0) for i in range(40_000)] + [("hot", i % 6000, 0.0) for i in range(9000)]
    state = sketches.series_state(made(spark, rows), "24h")
    daily = {r.block_ts.day: r.n_series for r in sketches.series_estimate(state).collect()}
    exact = {}
    for k, m, _ in rows:
        exact.setdefault(1 + m // 1440, set()).add(k)
    for day, n in daily.items():
        assert abs(n - len(exact[day])) <= 2 * sketches.COUNT_ERROR * len(exact[day])
    total = sketches.series_estimate(sketches.merge_series(state)).first().n_series
    assert abs(total - 5001) <= 2 * sketches.COUNT_ERROR * 5001
