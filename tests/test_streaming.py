import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidegrid.sources.points import points_from
from tidegrid.sources.stores import Store, StoreType
from tidegrid.sources.wire import WRITE_MESSAGE, write_message_points, write_messages
from tidegrid.streaming import ingest as op

T = datetime(2024, 1, 1)
MS = 1704067200000
SETTINGS = op.NamespaceSettings.of("48h", "2h", "10m", "10m")


def request(i, minutes):
    return json.dumps({"labels": [{"name": "i", "value": str(i)}],
                       "samples": [{"value": float(m), "timestamp": MS + 60000 * m}
                                   for m in minutes]})


def test_settings():
    got = [int(d.total_seconds() * 1e9) for d in (SETTINGS.retention, SETTINGS.block_size,
                                                  SETTINGS.buffer_future, SETTINGS.buffer_past)]
    assert got == [172800000000000, 7200000000000, 600000000000, 600000000000]


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    feed, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    feed.mkdir()
    (feed / "a.json").write_text(request(1, [0, 1]) + "\n" + request(2, [0]) + "\n")
    op.ingest(op.request_stream(spark, str(feed)), out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    (feed / "b.json").write_text(request(3, [5, 1500]) + "\n")
    for _ in range(2):
        op.ingest(op.request_stream(spark, str(feed)), out, mark).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == 5
    assert stored.select("block_date").distinct().count() == 2


def point_stream(spark, path):
    raw = spark.readStream.schema("i string, ts timestamp_ntz, arrival_ts timestamp_ntz, "
                                  "value double").option("maxFilesPerTrigger", 1).parquet(path)
    return points_from(raw, "m", {"i": "i"}, "ts", "value", keep=["arrival_ts"])


def write_file(spark, path, *rows):
    made = [(i, T + timedelta(minutes=m), T + timedelta(minutes=m + late), float(m))
            for i, m, late in rows]
    spark.createDataFrame(made, "i string, ts timestamp_ntz, arrival_ts timestamp_ntz, "
                                "value double").coalesce(1).write.mode("append").parquet(path)


def test_late_and_early_samples(spark, tmp_path):
    path = str(tmp_path / "in")
    write_file(spark, path, ("a", 0, 0), ("a", 1, 10), ("a", 2, 11), ("a", 3, -10), ("a", 4, -11))
    op.ingest_admitted(point_stream(spark, path), SETTINGS, str(tmp_path / "yes"),
                       str(tmp_path / "no"), str(tmp_path / "mark")).awaitTermination()
    def minutes(part):
        return sorted(r["value"] for r in spark.read.parquet(str(tmp_path / part)).collect())
    assert minutes("yes") == [0.0, 1.0, 3.0] and minutes("no") == [2.0, 4.0]


def test_unknown_arrival_is_refused(spark):
    df = spark.createDataFrame([(T, None)], "ts timestamp_ntz, arrival_ts timestamp_ntz")
    accepted, refused = op.admit(df, SETTINGS)
    assert accepted.count() == 0 and refused.count() == 1


def test_windows_close_with_the_watermark(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_file(spark, path, ("a", 0, 0), ("a", 30, 0), ("b", 10, 0), ("a", 125, 0), ("a", 250, 0))
    closed = op.consolidate_stream(point_stream(spark, path), SETTINGS, "sum")
    op.append_stream(closed, out, str(tmp_path / "mark")).awaitTermination()
    got = spark.read.schema(closed.schema).parquet(out).collect()
    assert sorted((r["series_key"], r["step_ts"], r["value"]) for r in got) == [
        ("i=a,", T, 30.0), ("i=a,", T + timedelta(hours=2), 125.0), ("i=b,", T, 10.0)]


def test_a_sample_from_far_ahead_closes_nothing(spark, tmp_path):
    path = str(tmp_path / "in")
    write_file(spark, path, ("a", 0, 0), ("a", 900, -600), ("a", 20, 0))
    closed = op.consolidate_stream(point_stream(spark, path), SETTINGS, "sum",
                                   arrival="arrival_ts")
    out = str(tmp_path / "out")
    op.append_stream(closed, out, str(tmp_path / "mark")).awaitTermination()
    assert spark.read.schema(closed.schema).parquet(out).count() == 0


def test_write_messages(spark):
    points = [(T, 100.0), (T - timedelta(seconds=10), 3.5)]
    queries = spark.createDataFrame(
        [({"a": "b", "c": "d"}, points, 2, bytearray("aasjgał".encode()))],
        "tags map<string,string>, datapoints array<struct<ts:timestamp_ntz,value:double>>, "
        "unit int, annotation binary")
    messages = write_messages(queries)
    assert messages.schema["datapoints"].dataType.elementType.fieldNames() == \
        spark.createDataFrame([], WRITE_MESSAGE).schema["datapoints"].dataType.elementType \
        .fieldNames()
    got = write_message_points(messages).collect()
    assert sorted((r["ts"], r["value"]) for r in got) == sorted(points)
    assert {(r["series_key"], r["unit"], bytes(r["annotation"]).decode()) for r in got} == {
        ("a=b,c=d,", 2, "aasjgał")}
    again = write_messages(queries).select("datapoints").first()
    assert again == messages.select("datapoints").first()


def test_stream_to_stores(spark, tmp_path):
    path = str(tmp_path / "in")
    write_file(spark, path, ("a", 0, 0), ("b", 1, 0))
    targets = [Store("x", StoreType.LOCAL, path=str(tmp_path / "x")),
               Store("y", StoreType.REMOTE, path=str(tmp_path / "y"))]
    op.fanout_ingest(point_stream(spark, path), targets, str(tmp_path / "mark")).awaitTermination()
    assert spark.read.parquet(targets[0].path).count() == 2
    assert not (tmp_path / "y").exists()


def test_feeds_share_a_table_and_keep_its_series(spark, tmp_path):
    out, series = str(tmp_path / "out"), str(tmp_path / "series")
    for feed, rows in (("x", [("a", 0, 0), ("b", 1, 0)]), ("y", [("b", 2, 0), ("c", 3, 0)])):
        path = str(tmp_path / feed)
        for row in rows:
            write_file(spark, path, row)
        op.ingest_points(point_stream(spark, path), out, str(tmp_path / f"mark-{feed}"),
                         series=series).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    keys = [r["series_key"] for r in spark.read.parquet(series).collect()]
    assert sorted(keys) == ["i=a,", "i=b,", "i=c,"]
    op.compact(spark, out, str(tmp_path / "merged"))
    merged = spark.read.parquet(str(tmp_path / "merged"))
    assert merged.count() == 4 and len(merged.inputFiles()) == 1


def test_dropped_partitions(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_file(spark, path, ("a", 0, 0), ("a", 60 * 50, 0))
    spark.createDataFrame([("b", None, None, 1.0)], "i string, ts timestamp_ntz, arrival_ts "
                          "timestamp_ntz, value double").write.mode("append").parquet(path)
    op.ingest_points(point_stream(spark, path), out, str(tmp_path / "mark")).awaitTermination()
    assert op.drop_expired(spark, out, T + timedelta(hours=71), SETTINGS) == []
    assert op.drop_expired(spark, out, T + timedelta(hours=72), SETTINGS) == ["2024-01-01"]
    left = spark.read.parquet(out)
    assert sorted(r["value"] for r in left.collect()) == [1.0, 3000.0]


def test_namespaces_of_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    write_file(spark, path, ("a", 0, 0), ("a", 10, 0), ("a", 70, 0), ("a", 250, 0))
    points = point_stream(spark, path)
    both = points.withColumn("namespace", F.when(F.col("value") == 10, "far").otherwise("near"))

    def closed(name, **kind):
        made = op.consolidate_stream(both, SETTINGS, "count", **kind)
        out = str(tmp_path / name)
        op.append_stream(made, out, f"{out}-mark").awaitTermination()
        got = spark.read.schema(made.schema).parquet(out)
        return sorted((r["step_ts"], r["value"]) for r in got.collect())
    assert closed("apart") == [(T, 1.0), (T, 2.0)]
    assert closed("folded", resolutions={"near": "1m", "far": "1h"}) == [
        (T, 2.0), (T + timedelta(hours=1), 1.0)]


def test_retention(spark):
    points = spark.createDataFrame([(T,), (T + timedelta(hours=50),)], "ts timestamp_ntz") \
        .withColumn("block_date", F.to_date("ts"))
    assert op.retained(points, T + timedelta(hours=60), SETTINGS).count() == 1

    def expired(hours, frame=points):
        return [str(r[0]) for r in op.expired_dates(frame, T + timedelta(hours=hours),
                                                    SETTINGS).collect()]
    assert expired(71) == [] and expired(72) == ["2024-01-01"]
    monthly = points.select(F.trunc("block_date", "month").alias("block_month"))
    assert expired(24 * 32, monthly) == [] and expired(24 * 33, monthly) == ["2024-01-01"]
    yearly = points.select(F.trunc("block_date", "year").alias("block_year"))
    assert expired(24 * 367, yearly) == [] and expired(24 * 368, yearly) == ["2024-01-01"]
