"""Streams and their batch twins.  Streams read the given files or files Spark makes of
them, run over what is there, and stop."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.plans.catalog.common import END, EVENTS, START, between, bucket
from tidegrid.plans.catalog.records import write_requests
from tidegrid.functions.matchers import re_match
from tidegrid.operators.fetch import fetch
from tidegrid.plans.registry import query
from tidegrid.session import scratch_path
from tidegrid.sinks.points import read_points, write_points
from tidegrid.sinks.records import bounded_parts
from tidegrid.sources.points import events_points, points_from, read_table
from tidegrid.sources.stores import Store, StoreType, allow_all
from tidegrid.sources.wire import write_messages, write_request_points
from tidegrid.streaming import ingest as op
from tidegrid.streaming import rollup

SETTINGS = op.NamespaceSettings.of("48h", "2h", "10m", "10m")
HOURLY = op.NamespaceSettings.of("48h", "1h", "10m", "10m")

_ARRIVAL = "(ts + to_minutes((props::JSON ->> 'k')::INTEGER))"


def arriving(events, namespace="default"):
    """Points with the time they came in: ``k`` minutes after the sample."""
    late = F.get_json_object("props", "$.k").cast("int")
    return points_from(events.withColumn("arrival_ts", F.timestamp_add("MINUTE", late,
                                                                       F.col("ts"))),
                       "events", {"event_type": "event_type", "user_id": "user_id"}, "ts",
                       "value", namespace, keep=["event_id", "arrival_ts"])


def event_stream(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet") \
        .parquet(sf_dir)


def batch_files(sent):
    """As many files as were sent so far: a feed of so many a batch reads them as its first batch."""
    return max(1, len(sent.inputFiles()))


def finished(query):
    """Wait for a stream that runs over what is there."""
    query.awaitTermination()
    return query


_ADMISSION = f"""
SELECT event_id, ts, value, {_ARRIVAL} - INTERVAL '10 minutes' <= ts
       AND ts <= {_ARRIVAL} + INTERVAL '10 minutes' AS accepted FROM events"""


@query("q41_admission", _ADMISSION)
def admission(spark, sf_dir):
    accepted, refused = op.admit(arriving(read_table(spark, sf_dir, "events")), SETTINGS)
    return accepted.withColumn("accepted", F.lit(True)).unionByName(
        refused.withColumn("accepted", F.lit(False))) \
        .select("event_id", "ts", "value", "accepted")


@query("q42_retention", f"""
SELECT event_id, series_key, ts, value FROM {EVENTS}
WHERE ts >= TIMESTAMP '2024-01-22 12:00:00' - INTERVAL '240 hours'""")
def retention(spark, sf_dir):
    settings = op.NamespaceSettings.of("240h", "2h", "10m", "10m")
    return op.retained(events_points(spark, sf_dir), "2024-01-22 12:00:00", settings) \
        .select("event_id", "series_key", "ts", "value")


MONTH_END = op.NamespaceSettings.of("240h", "2h", "10m", "10m")


@query("q101_expired_dates", """
SELECT DISTINCT ts::DATE AS block_date FROM events WHERE ts::DATE < DATE '2024-01-12'""")
def expired_dates(spark, sf_dir):
    """Of a stored table, by its partitions."""
    path = scratch_path(spark, "stored")
    write_points(events_points(spark, sf_dir), path)
    return op.expired_dates(read_points(spark, path), "2024-01-22 12:00:00", MONTH_END)


@query("q122_drop_expired", f"""
SELECT event_id, series_key, ts, value FROM {EVENTS} WHERE ts::DATE >= DATE '2024-01-12'""")
def drop_expired(spark, sf_dir):
    """The feed ingested, its expired partitions dropped, the rest read."""
    root = scratch_path(spark, "expiring")
    finished(op.ingest_points(arriving(event_stream(spark, sf_dir)), f"{root}/points",
                              f"{root}/checkpoint", keep=["event_id"]))
    op.drop_expired(spark, f"{root}/points", "2024-01-22 12:00:00", MONTH_END)
    return read_points(spark, f"{root}/points").select("event_id", "series_key", "ts", "value")


@query("q123_stream_series", f"""
SELECT event_id, series_key, ts, value FROM {EVENTS}
WHERE {between()} AND event_type IN ('view', 'error')""")
def stream_series(spark, sf_dir):
    """A fetch by the series table that the ingest keeps up."""
    root = scratch_path(spark, "kept")
    finished(op.ingest_points(arriving(event_stream(spark, sf_dir)), f"{root}/points",
                              f"{root}/checkpoint", keep=["event_id"], series=f"{root}/series"))
    return fetch(read_points(spark, f"{root}/points"), [re_match("event_type", "view|err.*")],
                 START, END, series=read_points(spark, f"{root}/series")) \
        .select("event_id", "series_key", "ts", "value")


@query("q124_stream_namespaces", f"""
SELECT series_key, step_ts, CASE WHEN event_type = 'purchase' THEN 2.0 ELSE 1.0 END::DOUBLE
       AS value
FROM (SELECT DISTINCT series_key, event_type, {bucket('1 hour')} AS step_ts FROM {EVENTS})
WHERE step_ts + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")
def stream_namespaces(spark, sf_dir):
    """Two namespaces in one feed, hourly: how many have samples."""
    root = scratch_path(spark, "both")
    every = arriving(event_stream(spark, sf_dir), "raw")
    bought = arriving(event_stream(spark, sf_dir), "bought") \
        .where(F.col("tags")["event_type"] == "purchase")
    closed = op.consolidate_stream(every.unionByName(bought), HOURLY, "count",
                                   resolutions={"raw": "10m", "bought": "1h"})
    finished(op.append_stream(closed, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(closed.schema).parquet(f"{root}/out").select(
        "series_key", "step_ts", "value")


@query("q43_stream_consolidate", f"""
SELECT series_key, step_ts, round(sum(value), 6) AS value
FROM (SELECT series_key, {bucket('1 hour')} AS step_ts, value FROM {EVENTS})
WHERE step_ts + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'
GROUP BY ALL""")
def stream_consolidate(spark, sf_dir):
    """Hourly sums of the feed, of the windows the watermark has closed."""
    root = scratch_path(spark, "stream")
    points = points_from(event_stream(spark, sf_dir), "events",
                         {"event_type": "event_type", "user_id": "user_id"}, "ts", "value")
    closed = op.consolidate_stream(points, HOURLY, "sum")
    finished(op.append_stream(closed, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(closed.schema).parquet(f"{root}/out").select(
        "series_key", "step_ts", F.round("value", 6).alias("value"))


@query("q56_stream_ingest", f"""
SELECT series_key, date_trunc('milliseconds', ts) AS ts, value FROM {EVENTS}""")
def stream_ingest(spark, sf_dir):
    """Write requests arriving as JSON files, appended to a points table."""
    root = scratch_path(spark, "feed")
    write_requests(spark, sf_dir).write.json(f"{root}/in")
    finished(op.ingest(op.request_stream(spark, f"{root}/in", max_files=2), f"{root}/points",
                       f"{root}/checkpoint", promote=["event_type"]))
    return read_points(spark, f"{root}/points").select("series_key", "ts", "value")


@query("q105_stream_messages", f"""
SELECT series_key, date_trunc('milliseconds', ts) AS ts, value::FLOAT::DOUBLE AS value, 2 AS unit,
       event_type AS note
FROM {EVENTS}""")
def stream_messages(spark, sf_dir):
    """Write messages of another site, with unit and annotation, appended to a points table."""
    root = scratch_path(spark, "messages")
    points = events_points(spark, sf_dir)
    parts = bounded_parts(points, ["series_key"], ["event_id"], 1000)
    queries = parts.groupBy("tags", "part").agg(
        F.collect_list(F.struct("ts", "value")).alias("datapoints")).select(
        "tags", "datapoints", F.lit(2).alias("unit"),
        F.encode(F.col("tags")["event_type"], "UTF-8").alias("annotation"))
    write_messages(queries).write.parquet(f"{root}/in")
    finished(op.ingest_messages(op.message_stream(spark, f"{root}/in"), f"{root}/points",
                                f"{root}/checkpoint"))
    return read_points(spark, f"{root}/points").select(
        "series_key", "ts", "value", "unit", F.decode("annotation", "UTF-8").alias("note"))


@query("q106_stream_admitted_only", f"""
WITH admitted AS (SELECT series_key, {bucket('1 hour')} AS step_ts, ts, value FROM {EVENTS}
                  WHERE (props::JSON ->> 'k')::INTEGER <= 10)
SELECT series_key, step_ts, max(value) AS value FROM admitted
WHERE step_ts + INTERVAL '1 hour' <= (SELECT max(ts) FROM admitted) - INTERVAL '10 minutes'
GROUP BY ALL""")
def stream_admitted_only(spark, sf_dir):
    """Hourly maxima of the admitted samples of the feed."""
    root = scratch_path(spark, "admitted")
    closed = op.consolidate_stream(arriving(event_stream(spark, sf_dir)), HOURLY, "max",
                                   arrival="arrival_ts")
    finished(op.append_stream(closed, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(closed.schema).parquet(f"{root}/out").select(
        "series_key", "step_ts", "value")


@query("q57_stream_admission", _ADMISSION)
def stream_admission(spark, sf_dir):
    """The feed split into admitted and refused samples, each with its own table."""
    root = scratch_path(spark, "admission")
    points = arriving(event_stream(spark, sf_dir))
    finished(op.ingest_admitted(points, SETTINGS, f"{root}/accepted", f"{root}/refused",
                                f"{root}/checkpoint"))
    accepted, refused = (read_points(spark, f"{root}/{part}") for part in ("accepted", "refused"))
    return accepted.withColumn("accepted", F.lit(True)).unionByName(
        refused.withColumn("accepted", F.lit(False))) \
        .select("event_id", "ts", "value", "accepted")


@query("q102_stream_fanout", f"""
SELECT store, event_id, series_key, ts, value FROM {EVENTS}
CROSS JOIN (VALUES ('near'), ('far')) s(store)""")
def stream_fanout(spark, sf_dir):
    """The feed written to every store."""
    root = scratch_path(spark, "fan")
    targets = [Store("near", StoreType.LOCAL, path=f"{root}/near"),
               Store("far", StoreType.REMOTE, path=f"{root}/far")]
    finished(op.fanout_ingest(arriving(event_stream(spark, sf_dir)), targets,
                              f"{root}/checkpoint", allow_all))
    parts = [read_points(spark, s.path).withColumn("store", F.lit(s.label)) for s in targets]
    return parts[0].unionByName(parts[1]).select("store", "event_id", "series_key", "ts", "value")




@query("q139_stream_resent", f"""
SELECT DISTINCT series_key, date_trunc('milliseconds', ts) AS ts, value FROM {EVENTS}""")
def stream_resent(spark, sf_dir):
    """A feed that is sent twice, batch after batch: each sample is in the table once."""
    root = scratch_path(spark, "resent")
    write_requests(spark, sf_dir).write.json(f"{root}/in")
    sent = spark.read.text(f"{root}/in")
    files = batch_files(sent)
    # the very same messages again
    sent.coalesce(files).write.mode("append").text(f"{root}/in")
    points = op.once(write_request_points(op.request_stream(spark, f"{root}/in", max_files=files)), SETTINGS)
    finished(op.ingest_points(points, f"{root}/points", f"{root}/checkpoint"))
    return read_points(spark, f"{root}/points").select("series_key", "ts", "value")


@query("q141_stream_known_series", f"""
SELECT series_key, 1::BIGINT AS n_rows, count(*) AS n_samples FROM {EVENTS} GROUP BY ALL""")
def stream_known_series(spark, sf_dir):
    """Series seen as keyed state: each is in the series table once, its samples in the other."""
    root = scratch_path(spark, "known")
    write_requests(spark, sf_dir).repartition(3).write.json(f"{root}/in")
    points = write_request_points(op.request_stream(spark, f"{root}/in", max_files=1))
    for one in op.ingest_with_series(points, f"{root}/points", f"{root}/series", f"{root}/checkpoint"):
        finished(one)
    rows = read_points(spark, f"{root}/series").groupBy("series_key").agg(F.count(F.lit(1)).alias("n_rows"))
    samples = read_points(spark, f"{root}/points").groupBy("series_key") \
        .agg(F.count(F.lit(1)).alias("n_samples"))
    return rows.join(samples, "series_key", "full")


@query("q138_stream_rollup", f"""
SELECT series_key, {bucket('6 hours')} AS ts, max(value) AS value FROM {EVENTS} GROUP BY ALL""")
def stream_rollup(spark, sf_dir):
    """Six-hour maxima kept beside the raw table while late samples come in."""
    root = scratch_path(spark, "rollup")
    points = points_from(read_table(spark, sf_dir, "events"), "events",
                         {"event_type": "event_type", "user_id": "user_id"}, "ts", "value")
    late = F.pmod(F.xxhash64("series_key", "ts"), F.lit(5)) == 0
    points.where(~late).write.parquet(f"{root}/in")
    files = batch_files(spark.read.schema(points.schema).parquet(f"{root}/in"))
    points.where(late).coalesce(files).write.mode("append").parquet(f"{root}/in")
    feed = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
    finished(rollup.ingest_with_rollup(feed, f"{root}/raw", f"{root}/coarse", f"{root}/checkpoint",
                                       "6h", "max", "6h"))
    return read_points(spark, f"{root}/coarse").select("series_key", "ts", "value")
