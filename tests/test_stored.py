"""Bucketed tables, block tables, pages, rollups, resent feeds, series as state."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tidegrid.operators.grid import consolidate, regrid
from tidegrid.plans.catalog import streams
from tidegrid.sinks.points import fanout_write, read_points, write_bucketed
from tidegrid.sinks.records import write_requests_of
from tidegrid.sinks import block_table
from tidegrid.sources.pages import page_list, read_pages, write_pages
from tidegrid.sources.points import events_points
from tidegrid.sources.stores import Store, StoreType, allow_all, append_pages
from tidegrid.sources.wire import write_request_points
from tidegrid.streaming import ingest, rollup
from tests.test_ranges_and_sketches import made

SETTINGS = ingest.NamespaceSettings.of("48h", "2h", "10m", "10m")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_over_buckets(spark, sf_dir, tmp_path):
    points = events_points(spark, sf_dir)
    write_bucketed(points, "tidegrid_test_buckets", str(tmp_path / "b"), buckets=4, keep=["event_id"])
    try:
        table = spark.table("tidegrid_test_buckets")
        for fn in ("avg", "last"):
            folded = consolidate(table, {"default": "1h"}, fn)
            assert "Exchange" not in physical(folded)
            assert sorted(folded.collect()) == sorted(consolidate(points, {"default": "1h"}, fn).collect())
        placed = regrid(table, "2024-01-01", "1m", tie=["event_id"], whole=True)
        assert "Exchange" not in physical(placed)
        got = placed.select("event_id", "step_idx").collect()
        want = regrid(points, "2024-01-01", "1m", tie=["event_id"]).select("event_id", "step_idx")
        assert sorted(got) == sorted(want.collect())
    finally:
        spark.sql("DROP TABLE tidegrid_test_buckets")


def test_block_table_keeps_every_value(spark, tmp_path):
    rows = [(f"s{i % 90}", i * 7 % 4000, float(i)) for i in range(5000)] \
        + [("hot", m, float(m)) for m in range(4000)] + [("nan", 3, float("nan"))]
    points = made(spark, rows)
    path = str(tmp_path / "t")
    block_table.write_block_table(points, path, "5m", "6h", "last", series_per_row=10, groups=3)
    table = block_table.read_block_table(spark, path)
    shape = table.select(F.max(F.size("keys")).alias("k"), F.max(F.size("values")).alias("v")).first()
    assert shape.k == 10 and shape.v == 10 * 72
    assert table.where(F.size("values") != F.size("keys") * 72).count() == 0
    want = {}
    for k, m, v in rows:
        if not math.isnan(v):
            cell = want.setdefault((k, m // 5), (m, v))
            want[k, m // 5] = max(cell, (m, v))
    got = block_table.table_points(table)
    minute = ((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(
        "2024-03-01 00:00:00").cast("timestamp"))) / 300_000_000).cast("int")
    assert sorted((r.series_key, r.at, r.value) for r in got.select("series_key", minute.alias("at"), "value")
                  .collect()) == sorted((k, i, v) for (k, i), (_, v) in want.items())
    assert got.first().tags
    arrays = block_table.blocks_by_series(table).where("series_key = 'hot'").collect()
    assert len(arrays) == 12 and all(len(r["values"]) == 72 for r in arrays)
    steps = {r.step_ts: (r.n_values, r.value_sum) for r in block_table.blocks_by_step(table).collect()}
    sums = {}
    for (k, i), (_, v) in want.items():
        n, s = sums.get(i, (0, 0.0))
        sums[i] = (n + 1, s + v)
    start = datetime.datetime(2024, 3, 1)
    assert {int((t - start).total_seconds() // 300): x for t, x in steps.items()} == sums
    with pytest.raises(ValueError):
        block_table.block_rows(points, "7m", "6h")


def test_pages_outside_are_not_opened(spark, tmp_path):
    points = made(spark, [("a", m, 1.0) for m in range(0, 6000, 10)])
    root = str(tmp_path / "p")
    write_pages(points, root, "24h")
    assert page_list(spark, root).count() == 5
    part = read_pages(spark, root, "2024-03-02 12:00:00", "2024-03-03 06:00:00")
    days = {datetime.datetime.fromtimestamp(int(f.split("page=")[1].split("/")[0]) / 1000,
                                            datetime.timezone.utc).day for f in part.inputFiles()}
    assert days == {2, 3} and part.count() == 18 * 6
    assert read_pages(spark, root).count() == 600
    assert read_pages(spark, root, "2025-01-01", "2025-02-01").count() == 0
    assert append_pages([]).count() == 0


def test_rollup_of_touched_days(spark, sf_dir, tmp_path):
    raw, coarse = str(tmp_path / "raw"), str(tmp_path / "coarse")
    points = events_points(spark, sf_dir, keep=())
    first = points.where("ts < '2024-01-10' OR ts >= '2024-01-12'")
    ingest._append(first, raw, "a")
    rollup.refresh_rollup(spark, raw, coarse, "1h", "sum", "1h")
    before = {f for f in read_points(spark, coarse).inputFiles() if "2024-01-1" not in f}
    late = points.where("ts >= '2024-01-10' AND ts < '2024-01-12'")
    ingest._append(late, raw, "b")
    days = rollup.touched_days(late)
    assert [d.day for d in days] == [10, 11]
    rollup.refresh_rollup(spark, raw, coarse, "1h", "sum", "1h", days)
    stored = read_points(spark, coarse)
    assert before <= set(stored.inputFiles())  # other days are as they were
    whole = rollup.rollup(points, "1h", "sum", "1h")

    def rows(df):
        return sorted(df.select("series_key", "ts", F.round("value", 6).alias("v")).collect())
    assert rows(stored) == rows(whole) and stored.select("namespace").distinct().count() == 1
    with pytest.raises(ValueError):
        rollup.rollup(points, "7h", "sum", "x")


def write_events(spark, path):
    """400 samples over five days and one without a time, in four files."""
    spark.range(401).selectExpr(
        "id AS event_id", "IF(id < 400, timestamp_ntz'2024-01-02 00:00:30' + make_dt_interval(0, 0, id * 18), null) "
        "AS ts", "id % 7 AS user_id", "'view' AS event_type", "double(id % 50) AS value", "'{}' AS props") \
        .repartition(4).write.parquet(f"{path}/events.parquet")


def test_rollup_feed_is_not_one_file_and_no_batch_is_kept(spark, tmp_path, monkeypatch):
    write_events(spark, tmp_path)
    monkeypatch.setattr(streams, "scratch_path", lambda spark, label: str(tmp_path / label))

    def kept(*args):
        raise AssertionError("a batch was kept")
    monkeypatch.setattr(type(spark.range(0)), "persist", kept)
    got = streams.stream_rollup(spark, str(tmp_path))
    assert len(spark.read.parquet(str(tmp_path / "rollup/in")).inputFiles()) > 2
    # the late samples are a batch of their own
    raw = read_points(spark, str(tmp_path / "rollup/raw"))
    assert raw.count() == 401 and raw.select("batch_id").distinct().count() == 2
    points = events_points(spark, str(tmp_path), keep=()).where("ts IS NOT NULL")
    whole = rollup.rollup(points, "6h", "max", "6h").select("series_key", "ts", "value")
    assert sorted(got.where("ts IS NOT NULL").collect()) == sorted(whole.collect())


def test_resent_feed_is_not_one_file_and_loses_nothing(spark, tmp_path, monkeypatch):
    write_events(spark, tmp_path)
    monkeypatch.setattr(streams, "scratch_path", lambda spark, label: str(tmp_path / label))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = streams.stream_resent(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sent = spark.read.text(str(tmp_path / "resent/in"))
    assert len(sent.inputFiles()) > 4
    # every message is there twice, every sample came in with the first batch
    assert {r["count"] % 2 for r in sent.groupBy("value").count().collect()} == {0}
    points = events_points(spark, str(tmp_path), keep=()).where("ts IS NOT NULL")
    assert sorted(got) == sorted(points.select("series_key", "ts", "value").collect())
    assert read_points(spark, str(tmp_path / "resent/points")).select("batch_id").distinct().count() == 1


def test_resent_feed_and_bounded_state(spark, tmp_path):
    rows = [("a", m, float(m % 3)) for m in range(0, 3000)] + [("b", m, 0.5) for m in range(0, 3000, 7)]
    points = made(spark, rows)
    folder = str(tmp_path / "in")
    order = points.orderBy("ts")
    for lo, hi in ((0, 1000), (0, 1000), (995, 2000), (1000, 2000), (2000, 3000), (2000, 3000)):
        start = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
        part = order.where((F.col("ts") >= start + F.make_dt_interval(mins=F.lit(lo)))
                           & (F.col("ts") < start + F.make_dt_interval(mins=F.lit(hi))))
        part.coalesce(1).write.mode("append").parquet(folder)
    feed = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1) \
        .option("latestFirst", "false").parquet(folder)
    run = ingest.ingest_points(ingest.once(feed, SETTINGS), str(tmp_path / "out"), str(tmp_path / "ck"))
    run.awaitTermination()
    got = read_points(spark, str(tmp_path / "out")).select("series_key", "ts", "value").collect()
    assert len(got) == len(set(got)) == len(rows)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
    assert kept[-1] < 1500  # of 3,429 samples: what lies behind the newest by ten minutes is gone


def test_series_as_state(spark, tmp_path):
    folder = str(tmp_path / "in")
    for lo in range(3):
        made(spark, [(f"s{i}", i, 1.0) for i in range(lo * 10, lo * 10 + 25)]).coalesce(1) \
            .write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema

    def go():
        feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        for run in ingest.ingest_with_series(feed, str(tmp_path / "points"), str(tmp_path / "series"),
                                             str(tmp_path / "ck")):
            run.awaitTermination()
    go()
    made(spark, [("s3", 1, 1.0), ("new", 2, 1.0)]).coalesce(1).write.mode("append").parquet(folder)
    go()
    series = read_points(spark, str(tmp_path / "series"))
    keys = [r.series_key for r in series.select("series_key").collect()]
    assert len(keys) == len(set(keys)) == 46 and "new" in keys
    assert series.where("series_id is null OR tags is null").count() == 0
    assert read_points(spark, str(tmp_path / "points")).count() == 77


def test_broken_series_table_is_an_error(spark, tmp_path):
    (tmp_path / "series").mkdir()
    (tmp_path / "series" / "part-0.parquet").write_text("no parquet")
    points = made(spark, [("a", 1, 1.0)])
    with pytest.raises(Exception):
        ingest._append_series(points, str(tmp_path / "series"), "x")
    assert not ingest._exists(spark, str(tmp_path / "none"))


def test_requests_are_bounded(spark):
    rows = [("hot", m, float(m)) for m in range(1000)] + [("s", 1, 1.0), ("s", 1, 2.0)]
    points = made(spark, rows)
    requests = write_requests_of(points, max_samples=64)
    assert requests.select(F.max(F.size("samples"))).first()[0] == 64
    back = write_request_points(requests).select("series_key", "ts", "value").collect()
    assert len(back) == 1002
    assert sorted(v for k, _, v in back if k.startswith("k=hot")) == [float(m) for m in range(1000)]


def test_stores_share_one_computation(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    points = made(spark, [("a", m, 1.0) for m in range(100)])
    counted = points.drop("tags").mapInPandas(count, points.drop("tags").schema) \
        .withColumn("tags", F.create_map(F.lit("k"), "series_key")).select(*points.columns)
    stores = [Store(n, StoreType.LOCAL, path=str(tmp_path / n)) for n in ("x", "y", "z")]
    assert fanout_write(counted, stores, allow_all) == ["x", "y", "z"]
    assert seen.value == 100
    assert all(read_points(spark, s.path).count() == 100 for s in stores)
